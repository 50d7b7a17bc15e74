import hashlib
import json
import math
import random
import re
import time
import tracemalloc
import weakref
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from docloom.llm import bpe, common, quality

from .conftest import SCHEMA, prose

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.Vocabulary(bpe._read(PATH)))


def test_encoding_equals_the_library(codec, library):
    r = random.Random(7)
    letters = [chr(c) for c in [*range(0, 0x250), *range(0x370, 0x400), 0x2028, 0x3000, 0x85, 0x200B, 0xFEFF, 0x3A3, 0x130, 0x1F600, 0x4E2D, 0xAC00, 0x1100, 0x1161, 0x301]]
    texts = ["".join(r.choice(letters if r.random() < 0.5 else "abcd 'sStTrevm\n.,!012") for _ in range(r.randint(0, 60))) for _ in range(3000)]
    texts += ["<|startoftext|>Hi<|endoftext|> <|endoftext|", "a" * 3000, "ab" * 999, "", " ", "don't WE'LL '''s", prose(1, 500)]
    for text, ids, want in zip(texts, codec.encode_batch(texts), library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(ids, "<u4").tolist() == want.ids, ascii(text)
        assert codec.decode(ids) == library.decode(want.ids, skip_special_tokens=False)


def test_long_words_equal_the_library(codec, library):
    r = random.Random(8)
    texts = ["".join(r.choice(letters) for _ in range(n)) for letters, n in (("ab", 1500), ("theanding", 60_000), ("a", 5000), ("中文字éàü", 3000), ("aab", 1001))]
    began = time.perf_counter()
    found = codec.encode_batch(texts)
    assert time.perf_counter() - began < 10
    for ids, want in zip(found, library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(ids, "<u4").tolist() == want.ids
    word = "theandinghere" * 70
    assert bpe.merge_long(codec.vocab, word.encode()).tolist() == bpe.merge_words(codec.vocab, [word.encode()])[0].tolist()


def test_special_tokens_of_any_spelling():
    model = json.loads(bpe._read(PATH))
    model["added_tokens"].append({"content": "[MASK]", "id": 7, "special": True})
    own = bpe.Codec(bpe.Vocabulary(json.dumps(model)))
    assert 7 in np.frombuffer(own.encode_batch(["a [MASK] b"])[0], "<u4").tolist()


def test_cache_is_bounded(codec, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 10)
    for i in range(5):
        codec.encode_batch([" ".join(f"w{i}x{j}" for j in range(50))])
    assert len(codec.cache) <= 500


def test_memory_is_that_of_a_slice_not_of_a_batch(codec, library):
    texts = [prose(i, 4000) for i in range(80)]
    column = pa.array([*texts, None, ""], pa.string())
    tracemalloc.start()
    try:
        found = [ids for own in bpe._slices(column) for ids in codec.encode_batch(own)]
        held, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert sum(map(len, texts)) > 1_500_000 and peak - held < 12e6
    want = library.encode_batch([*texts, "", ""], add_special_tokens=False)
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [x.ids for x in want]


def test_freed_memory_is_handed_back_around_a_pass(monkeypatch):
    class Held(list):
        pass

    refs, alive = [], []
    monkeypatch.setattr(common, "hand_back", lambda: alive.append([r() is not None for r in refs]))

    def run(batches):
        own = Held([1])
        refs.append(weakref.ref(own))
        for x in batches:
            yield x + own[0]

    assert list(common.handing_back(run)(iter([1, 2]))) == [2, 3] and alive == [[], [False]]
    monkeypatch.undo()
    common.hand_back()


def test_round_trip_of_edge_rows(edge, edge_rows, library, empty):
    rows = bpe.round_trip_report(edge, PATH).collect()
    want = Counter()
    for row in edge_rows:
        ids = library.encode(row[1] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want[row[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in rows) == want
    assert bpe.round_trip_report(empty, PATH).collect() == []
    back = bpe.decode(bpe.encode(edge, PATH), PATH).collect()
    assert Counter(r.text for r in back) == Counter(library.decode(library.encode(r[1] or "", add_special_tokens=False).ids, skip_special_tokens=False) for r in edge_rows)


def _brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    inside = {j for p in places.values() if len(p) > 1 for i in p for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def test_base_statistics():
    r = random.Random(3)
    texts = ["", " \x0b\x1c\x85\u2003 a\u00a0b", "a b c d e f g h " * 3, "x\nx\n \ny\nx", "# * | <a> &"] + [" ".join(r.choice("ab") for _ in range(r.randint(0, 60))) for _ in range(300)]
    for t in texts:
        assert quality.base_stats(t) == _brute(t), t


def _slow_model(texts):
    """Modified Kneser-Ney from the texts themselves: probability of a gram's last byte, by gram, and the interpolation for any other byte."""
    counts = Counter()
    for t in texts:
        raw = b"\0" * (quality.ORDER - 1) + t.encode() + b"\0"
        counts.update(raw[k : k + quality.ORDER] for k in range(len(raw) - quality.ORDER + 1))
    levels = {quality.ORDER: counts}
    for k in range(quality.ORDER - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    tables = {}
    for k, own in levels.items():
        n = [sum(v == x for v in own.values()) for x in range(5)]
        d = [0.5, 0.75, 0.9]
        if n[1] and n[2] and n[3]:
            y = n[1] / (n[1] + 2 * n[2])
            d = [min(most, max(0.05, x - (x + 1) * y * n[x + 1] / n[x])) for x, most in ((1, 0.95), (2, 1.9), (3, 2.85))]
        total, cut = Counter(), Counter()
        for g, v in own.items():
            total[g[:-1]] += v
            cut[g[:-1]] += d[min(v, 3) - 1]
        tables[k] = own, d, total, cut

    def p(gram):
        if not gram:
            return 1 / 256
        own, d, total, cut = tables[len(gram)]
        if not total[gram[:-1]]:
            return p(gram[1:])
        v = own[gram]
        return ((v - d[min(v, 3) - 1] if v else 0) + cut[gram[:-1]] * p(gram[1:])) / total[gram[:-1]]

    return counts, p


def test_model_equals_a_slow_one_and_is_a_distribution(spark):
    texts = {"en": [prose(i, 60) for i in range(25)], "xx": [prose(99, 30).upper(), "é€ ok"], None: ["alone"]}
    rows = spark.createDataFrame([(k, t) for k, own in texts.items() for t in own], "lang string, text string").repartition(3)
    found = {(r.lang, r.gram): (r.n, r.p) for r in quality.kneser_ney(quality.count_grams(rows)).collect()}
    numbers = {r.lang: r.k for r in rows.select("lang", quality._language().alias("k")).distinct().collect()}
    want = {}
    for lang, own in texts.items():
        counts, p = _slow_model(own)
        want |= {(numbers[lang], int.from_bytes(g, "big")): (n, p(g)) for g, n in counts.items()}
        for context in (b"\0\0\0", b"the", b"zzz", b"ing", b"\xff\xfe\xfd", b"qth"):
            assert abs(sum(p(context + bytes([x])) for x in range(256)) - 1) < 1e-9
    assert found.keys() == want.keys() and all(found[k][0] == n and abs(found[k][1] - x) < 1e-12 for k, (n, x) in want.items())


def _slow_verdicts(docs):
    """(kept, byte deviation, word deviation) of each (lang, text) by the definition, in floats of double width."""
    models = {k: _slow_model([t for lang, t in docs if lang == k])[1] for k in {k for k, _ in docs}}
    rows = []
    for lang, t in docs:
        raw = b"\0" * 3 + t.encode() + b"\0"
        bits = sum(-math.log2(models[lang](raw[k : k + 4])) for k in range(len(raw) - 3))
        rows.append({"lang": lang, "stats": quality.base_stats(t), "n_bytes": len(raw) - 3, "n_words": len(t.split()), "bits": bits})
    middle = lambda x: sorted(x)[(len(x) + 1) // 2 - 1]
    long = [r for r in rows if r["n_words"] >= quality.MIN_WORDS]
    measure = lambda r, k: r["bits"] / r[k]
    unit = lambda r, k: math.sqrt(1 / r[k] + 1 / quality.MEASURES[k])
    off, out = {}, []
    medians = {(lang, k): (middle([int(measure(r, k) * 100) for r in long if r["lang"] == lang]) + 0.5) / 100 for lang in {r["lang"] for r in long} for k in quality.MEASURES}
    for k in quality.MEASURES:
        off[k] = [(r["lang"], int(abs(measure(r, k) - medians[r["lang"], k]) / unit(r, k) * 100)) for r in long]
    for r in rows:
        n, _, _, _, repeated = r["stats"]
        failed = n < 20 or 100 * repeated > 30 * n
        found = []
        for k in quality.MEASURES if (r["lang"], "n_bytes") in medians and n else ():
            own = [x for lang, x in off[k] if lang == r["lang"]]
            scale = (len(own) * (middle(own) + 0.5) + quality.PRIOR * (middle([x for _, x in off[k]]) + 0.5)) / (len(own) + quality.PRIOR) * 1.4826 / 100
            found.append((measure(r, k) - medians[r["lang"], k]) / (unit(r, k) * scale))
        out.append((not failed and all(abs(x) <= quality.WIDTH for x in found) and bool(found), found))
    return out


def test_verdicts_equal_brute_force(spark):
    r = random.Random(9)
    docs = [("en", prose(i, r.randint(5, 120))) for i in range(70)] + [("xx", prose(500 + i, 40)[::-1].replace("e", "é")) for i in range(9)] + [(None, prose(600, 50)), ("one", prose(601, 30))]
    docs += [("en", " ".join(w + "#$" for w in prose(700 + i, 60).split())) for i in range(4)] + [("en", "same eight words come again and again now " * 8)]
    frame = spark.createDataFrame([(i, *x) for i, x in enumerate(docs)], "doc_id bigint, lang string, text string").repartition(4)
    want = _slow_verdicts(docs)
    for head in (quality.HEAD_GRAMS, 150, 0):  # of 150, or none: most n-grams meet the model in the join
        found = {x.doc_id: x for x in quality.judged(frame, ["doc_id"], head_grams=head).collect()}
        for i, (kept, off) in enumerate(want):
            assert found[i].kept == kept, (head, i)
            if off:
                assert abs(found[i].byte_deviation - off[0]) < 0.05 and abs(found[i].word_deviation - off[1]) < 0.05
    assert any(k for k, _ in want) and not all(k for k, _ in want)


def test_verdicts_hold_when_the_corpus_is_repeated(spark):
    docs = [(i, "en", prose(i, 100)) for i in range(60)] + [(100 + i, "en", " ".join(w + "#$" for w in prose(700 + i, 60).split())) for i in range(4)]
    once = spark.createDataFrame(docs, "doc_id bigint, lang string, text string")
    alone = {r.doc_id: r.kept for r in quality.judge(once).collect()}
    many = quality.judge(once.union(once).union(once)).collect()
    assert len(many) == 3 * len(docs) and all(r.kept == alone[r.doc_id] for r in many) and len(set(alone.values())) == 2


def test_every_language_has_a_model(spark):
    docs = [(100 * k + i, f"l{k}", prose(1000 * k + i, 30)) for k in range(80) for i in range(3)]
    rows = quality.judge(spark.createDataFrame(docs, "doc_id bigint, lang string, text string")).collect()
    assert len(rows) == 240 and all(r.byte_deviation is not None for r in rows)


def test_rows_are_judged_one_by_one(spark):
    good, bad = prose(1, 60), "too short"
    docs = [(i, prose(i, 60), "en", "s", 0) for i in range(150)] + [(1, good, "en", "x", 0), (1, bad, "en", "y", 0), (None, good, "en", "z", 0), (None, bad, "en", "w", 0)]
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(docs, SCHEMA).select("*", *[F.lit(1).alias(c) for c in ("__good", "n_words", "kept_", "row_number_", "lang_", "text_", "bits")])
    rows = quality.keep_good(frame)
    assert rows.columns == frame.columns
    kept = [r.source for r in rows.collect()]
    assert "x" in kept and "z" in kept and "y" not in kept and "w" not in kept


def test_junk_goes_and_clean_stays(spark):
    r = random.Random(5)
    docs = [(i, prose(i, 150), "en", "s", 0) for i in range(200)]
    docs += [(1000 + i, " ".join(w + r.choice(["###", "$$$", "***", "&&&"]) for w in prose(500 + i, 150).split()), "en", "s", 0) for i in range(10)]
    docs += [(2000 + i, "too short", "en", "s", 0) for i in range(3)] + [(3000, "again and again the same eight words come " * 9, "en", "s", 0)]
    rows = {x.doc_id: x for x in quality.judge(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert sum(rows[i].kept for i in range(200)) >= 196
    assert sum(rows[1000 + i].kept for i in range(10)) == 0
    assert all(rows[2000 + i].base_failed and not rows[2000 + i].kept for i in range(3)) and rows[3000].base_failed


def test_quality_of_edge_rows_and_nothing(edge, edge_rows, empty):
    rows = quality.judge(edge).collect()
    assert Counter((r.doc_id, r.n_words) for r in rows) == Counter((x[0], len((x[1] or "").encode().split())) for x in edge_rows)
    assert quality.judge(empty).collect() == [] and quality.keep_good(empty).collect() == []
