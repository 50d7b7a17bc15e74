import random
from collections import Counter, defaultdict

import numpy as np
import xxhash

from docloom.llm import common, components, lines, simhash, similar

from .conftest import SCHEMA, prose


def _union(n, pairs):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_components(spark, monkeypatch):
    r = random.Random(1)
    pairs = [(r.randrange(400), r.randrange(400)) for _ in range(230)] + [(500 + i, 501 + i) for i in range(60)] + [(700, 701 + i) for i in range(50)]
    want = _union(1000, pairs)
    touched = {x for p in pairs for x in p if p[0] != p[1]}
    edges = spark.createDataFrame(pairs, "a bigint, b bigint").repartition(6)
    for options in ({}, {"task_edges": 60}, {"task_edges": 0}):
        found = {x.node: x.label for x in components.components(edges, **options).collect()}
        assert found == {x: want[x] for x in touched}, options
    for hub in (components.HUB, 5):
        assert {x.node: x.label for x in components._starred(edges.where("a <> b"), hub).collect()} == found, hub
    monkeypatch.setattr(components, "TASK_NODES", 3)
    assert {x.node: x.label for x in components.components(edges, 0).collect()} == found
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def _fingerprint(text):
    words = "".join(c.lower() if c.isascii() else c for c in text).encode().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    ones = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if shingles and 2 * ones[b] > len(shingles))


def test_near_duplicates_equal_brute_force(spark, edge, edge_rows, empty):
    rows = simhash.near_duplicate_report(edge).collect()
    fps = [_fingerprint(r[1] or "") for r in edge_rows]
    label = _union(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])
    groups = defaultdict(list)
    for i, k in enumerate(label):
        groups[k].append(edge_rows[i][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    want = Counter((edge_rows[i][0], f"{fps[i]:016x}", least[label[i]]) for i in range(len(fps)))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in rows) == want
    assert simhash.near_duplicate_report(empty).collect() == []


def test_both_ways_find_every_link(spark):
    r = random.Random(4)
    base = [r.getrandbits(64) for _ in range(40)]
    fps = sorted({b ^ sum(1 << p for p in r.sample(range(64), r.randint(0, 6))) for b in base for _ in range(12)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    want = {(max(a, b), min(a, b)) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= 4}
    frame = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    place = {f: i for i, f in enumerate(signed)}
    label = _union(len(signed), [(place[a], place[b]) for a, b in want])
    for options in ({}, {"thirds_up_to": 0}, {"hot_bucket": 3}, {"hot_bucket": 0, "cell": (4, 16)}, {"hot_bucket": 0, "cell": (4, 16), "thirds_up_to": 0}):
        found = {(x.a, x.b) for x in simhash.near_links(frame, **options).collect()}
        assert found == want if "hot_bucket" not in options else found <= want, options
        assert _union(len(signed), [(place[a], place[b]) for a, b in found]) == label, options


def test_a_hot_bucket_gives_a_forest(spark):
    """2,000 fingerprints in one bucket, all near to each other: links grow with their number, not with its square."""
    base = 0x0123456789ABCDEF
    fps = sorted({base ^ 1 << i ^ 1 << j for i in range(64) for j in range(i)})
    rows = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp bigint")
    found = {(x.a, x.b) for x in simhash.near_links(rows, hot_bucket=10).collect()}
    assert len(fps) == 2016 and len(found) < 40 * len(fps)


def _word_sets(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def _edited(text, share, r):
    words = text.split()
    for _ in range(max(1, round(share * len(words)))):
        words[r.randrange(len(words))] = f"w{r.randrange(10**6)}"
    return " ".join(words)


def _alike(texts):
    own = [_word_sets(t) for t in texts]
    return {(j, i) for i in range(len(own)) for j in range(i) if len(own[i] & own[j]) >= 0.8 * len(own[i] | own[j])}


def test_alike_texts_are_found(spark):
    """Pairs from 0.6 to 1 in similarity: none below 0.8 is joined, and at least nine of ten above are."""
    r = random.Random(6)
    texts = []
    for i in range(150):
        t = prose(i, r.randint(15, 400))
        texts += [t, _edited(t, r.choice((0.005, 0.01, 0.02, 0.03, 0.05)), r)] + ([t.upper()] if i % 10 == 0 else [])
    r.shuffle(texts)
    pairs = _alike(texts)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    rows, number = common.numbered(frame)
    label = {x.doc_id: x.label for x in rows.join(simhash.similar_texts(rows, number), number).collect()}
    found = sum(label[a] == label[b] for a, b in pairs)
    assert len(pairs) > 80 and found >= 0.9 * len(pairs), (found, len(pairs))
    want = _union(len(texts), pairs)
    assert all(want[a] == want[b] for a in label for b in label if label[a] == label[b])


def test_large_groups_and_hot_runs(spark, monkeypatch):
    r = random.Random(7)
    base = prose(5, 300)
    texts = [base] * 40 + [_edited(base, 0.003, r) for _ in range(150)] + [prose(100 + i, 60) for i in range(40)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    for run in (simhash.RUN, 20):
        monkeypatch.setattr(simhash, "RUN", run)
        kept = sorted(x.doc_id for x in simhash.keep_one(frame).collect())
        assert kept == [0, *range(190, 230)], run


def test_near_in_runs_equals_all_pairs():
    r = np.random.default_rng(3)
    sizes = [1, 2, 5, 70, 1, 200, 3]
    key = np.repeat(np.arange(len(sizes)), sizes)
    n = len(key)
    node, label, fp = r.permutation(n), r.integers(0, 9, n), r.integers(0, 2**20, n)
    i = np.where(key == 5, 0, 0)
    j, side = np.where(key == 5, 1, 0), np.where(key == 5, np.arange(n) % 2, 0)
    a, b = simhash.near_in_runs([key, i, j, side, node, label, fp], 6)
    want = {(max(node[x], node[y]), min(node[x], node[y])) for y in range(n) for x in range(y) if key[x] == key[y] and label[x] != label[y] and (j[x] == 0 or side[x] != side[y]) and int(fp[x] ^ fp[y]).bit_count() <= 6}
    assert set(zip(a.tolist(), b.tolist())) == {(int(x), int(y)) for x, y in want}


def test_one_of_each_group_stays(spark, edge, empty):
    kept = simhash.keep_one(edge)
    assert kept.columns == edge.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 1 in ids and 2 not in ids and ids.count(9) == 1 and ids.count(4) == 1 and 5 not in ids
    assert simhash.keep_one(empty).collect() == []


def test_rows_are_kept_one_by_one(spark):
    """A repeated id with another text stays; a nameless copy of a named row goes, and one of nameless copies stays."""
    a, b, c = prose(1, 50), prose(2, 50), prose(3, 50)
    docs = [(1, a, "en", "first", 0), (1, b, "en", "other text", 0), (None, a, "en", "copy without id", 0), (None, c, "en", "nameless", 0), (None, c, "en", "nameless", 0), (2, a + " x", "en", "near", 0)]
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(docs, SCHEMA).select("*", *[F.lit(1).alias(x) for x in ("__stay", "row_number_", "node", "label", "shown", "keys", "f0")])
    rows = simhash.keep_one(frame)
    assert rows.columns == frame.columns and sorted(r.source for r in rows.collect()) == ["first", "nameless", "other text"]


def test_hot_keys_are_dealt_to_heaps(spark, monkeypatch):
    monkeypatch.setattr(similar, "SAMPLED", 1)
    bands = [(k, h) for k, n in ((1, 300), (2, 3), (3, 1)) for h in range(n)]
    frame = spark.createDataFrame(bands + bands[:50], "key bigint, h bigint")
    near = similar.near_members(frame, 10).collect()
    assert all(x.before != x.h for x in near)
    for k, n in ((1, 300), (2, 3)):
        label = _union(300, [(x.first, x.h) for x in near if x.key == k])
        assert len({label[h] for h in range(n)}) == 1
    assert not [x for x in near if x.key == 3]


def _brute_kept(docs):
    first = {}
    for i, t in sorted(docs):
        for n, x in lines.lines_of(t.encode()):
            first.setdefault(x, (i, n))
    texts = list(first)
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if lines.jaccard(texts[i], texts[j]) >= lines.SIMILARITY]
    label = _union(len(texts), pairs)
    least = {}
    for t, k in zip(texts, label):
        least[k] = min(least.get(k, first[t]), first[t])
    return set(least.values())


def test_lines_equal_brute_force(spark):
    r = random.Random(2)
    pool = [prose(i, 45).replace("\n", " ") for i in range(40)]
    docs = []
    for i in range(60):
        own = []
        for _ in range(4):
            words = r.choice(pool).split(" ")
            if r.random() < 0.5:
                words[r.randrange(len(words))] = "changed"
            own.append(" ".join(words))
        docs.append((i, "\n".join(own + ["short", ""])))
    found = lines.kept_lines(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)).collect()
    assert {(x.doc_id, n) for x in found for n in x.kept} == _brute_kept(docs)


def test_jaccard_and_bands():
    assert lines.jaccard(b"abc", b"abc") == 1 and lines.jaccard(b"abcdefghij", b"zzzzzzzzzz") == 0
    a = prose(1, 60).replace("\n", " ").encode()
    keys = lines.band_keys([a, a.replace(b"the", b"THE", 1), b"x"])
    assert keys.shape == (3, lines.BANDS) and (keys[0] == keys[1]).any() and not (keys[0] == keys[2]).any()
    many = [prose(i, 40).encode() for i in range(50)]
    assert (lines.band_keys(many) == np.concatenate([lines.band_keys([x]) for x in many])).all()


def test_lines_of_edge_rows(edge, empty):
    found = {r.doc_id: r for r in lines.line_report(edge).collect()}
    assert found[1].n_dropped == 0 and found[2].n_kept == 0 and found[4].n_lines == 0 and found[6].n_lines == 0
    assert lines.line_report(empty).collect() == []
    rows = lines.drop_lines(edge)
    assert rows.columns == edge.columns
    texts = {r.doc_id: r.text for r in rows.collect()}
    assert 2 not in texts and 4 in texts and 1 in texts


def test_lines_of_rows_with_one_id(spark):
    """Rows are documents of their own, whatever their ids; columns of any name pass."""
    from pyspark.sql import functions as F

    a, b, c = ("\n".join(prose(100 * k + i, 12).replace("\n", " ") for i in range(3)) for k in (1, 2, 3))
    docs = [(1, a, "en", "a", 0), (1, b, "en", "b", 0), (None, c, "en", "c", 0), (None, a, "en", "d", 0), (2, a + "\n" + c, "en", "e", 0)]
    frame = spark.createDataFrame(docs, SCHEMA).select("*", *[F.lit(1).alias(x) for x in ("__id", "__n", "__kept", "kept_", "n_lines_", "row_number_")])
    rows = lines.drop_lines(frame)
    assert rows.columns == frame.columns
    left = {r.source: r.text for r in rows.collect()}
    assert left == {"b": b, "c": c, "d": a}  # null ids come first, so their lines stay
    report = lines.line_report(frame).collect()
    assert len(report) == 5 and sum(r.n_kept for r in report) == 9
