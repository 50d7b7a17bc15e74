import hashlib
import random

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline

from .conftest import SCHEMA, prose
from .test_bpe_quality import _slow_verdicts
from .test_licenses_decontamination import WORD, _hits, _lower, _windows
from .test_near import _alike, _brute_kept, _union


def test_stages_on_a_small_corpus(spark, tmp_path):
    clean = [(i, prose(i, 120), "en", "s", 0) for i in range(60)]
    item = prose(900, 30)
    docs = clean + [(100, clean[3][1], "en", "s", 0), (101, "short", "en", "s", 0), (102, f"{prose(300, 60)}\n{item}\n{prose(301, 60)}", "en", "s", 0), (103, None, "en", "s", 0)]
    spark.createDataFrame(docs, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    sf = str(tmp_path)
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert len([i for i in range(60) if i in rows]) >= 58 and not {100, 101, 103} & set(rows) and 102 in rows
    now = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, sf)
        assert now.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    text = now.where(F.col("doc_id") == 102).first().text
    assert item.split()[5] + " " + item.split()[6] not in text.replace("\n", " ") and prose(300, 60).split()[5] in text
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def _slowly(docs, items, library):
    """The five stages by brute force over (doc_id, text, lang): (doc_id, n_tokens, digest of the ids, digest of the decoded text)."""
    kept = [d for d, (ok, _) in zip(docs, _slow_verdicts([(lang, t or "") for _, t, lang in docs]), strict=True) if ok]
    # Lines: of each component the first by doc_id stays.
    lines_left = _brute_kept([(i, t) for i, t, _ in kept])
    cut = []
    for i, t, _ in kept:
        own = t.split("\n")
        stay = [x for n, x in enumerate(own) if not x.strip() or (i, n) in lines_left]
        if any(x.strip() for x in stay):
            cut.append((i, "\n".join(stay) if len(stay) < len(own) else t))
    label = _union(len(cut), _alike([t for _, t in cut]))
    least = {}
    for (i, _), k in zip(cut, label, strict=True):
        least[k] = min(least.get(k, i), i)
    alone = [(i, t) for (i, t), k in zip(cut, label, strict=True) if least[k] == i]
    windows, out = _windows(items), set()
    for i, t in alone:
        places = list(WORD.finditer(_lower(t)))
        _, hit, _ = _hits(t, windows)
        if hit and len(hit) == len(places):
            continue
        parts, at = [], 0
        for k in sorted(hit):
            if k - 1 not in hit:
                parts.append(t[at : places[k].start()])
            if k + 1 not in hit:
                at = places[k].end()
        ids = library.encode("".join(parts) + t[at:], add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        out.add((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    return out


def test_pipeline_equals_brute_force(spark, tmp_path):
    r = random.Random(4)
    docs = [(i, prose(i, r.randint(30, 150)), "en") for i in range(70)]
    item = prose(900, 30)
    docs += [(100, docs[3][1], "en"), (101, "short", "en"), (102, f"{prose(300, 60)}\n{item}\n{prose(301, 60)}", "en"), (103, None, "en"), (104, docs[5][1].replace("the", "THE", 1) + " word", "en")]
    shared = prose(901, 15).replace("\n", " ")
    docs += [(110 + k, f"{prose(400 + k, 50)}\n{shared}{' !' * k}\n\n{prose(500 + k, 40)}", "en") for k in range(4)]
    docs += [(120 + k, " ".join(w + "#$&" for w in prose(600 + k, 60).split()), "en") for k in range(3)] + [(130, "the same eight words again and again here " * 9, "en")]
    items = [(1, item), (2, prose(902, 25)), (None, "tiny")]
    spark.createDataFrame([(*d, "s", 0) for d in docs], SCHEMA).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    want = _slowly(docs, items, Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")))
    found = {(x.doc_id, x.n_tokens, x.ids_sha256, x.decoded_sha256) for x in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert found == want and 60 < len(found) < len(docs) - 6
