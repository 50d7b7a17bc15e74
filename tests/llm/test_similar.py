import random
from collections import defaultdict

import numpy as np

from docloom.llm import lines, similar

from .test_near import _union


def _family(n: int, seed: int = 4):
    """Pairs of alike lines that all share an opening, unlike ones at about 0.66 to each other, shuffled."""
    r = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz "
    opening = "".join(r.choice(letters) for _ in range(160))
    out = []
    for _ in range(n):
        own, changed = "".join(r.choice(letters) for _ in range(36)), opening
        for _ in range(2):
            at = r.randrange(5, 155)
            changed = changed[:at] + "#" + changed[at + 1 :]
        out += [opening + own, changed + own]
    random.Random(1).shuffle(out)
    return out


def _labels(texts):
    """Labels by brute force over all pairs of a band."""
    raw = [t.encode() for t in texts]
    keys, bands = lines.band_keys(raw), defaultdict(list)
    for i, own in enumerate(keys.tolist()):
        for k in own:
            bands[k].append(i)
    pairs = {(b, a) for own in bands.values() for i, a in enumerate(own) for b in own[i + 1 :]}
    return _union(len(raw), [p for p in pairs if lines.jaccard(raw[p[0]], raw[p[1]]) >= lines.SIMILARITY])


def test_all_alike_lines_of_a_band_are_joined(spark):
    texts = _family(200)
    label = _labels(texts)
    want = {min(i for i in range(len(texts)) if label[i] == k) for k in set(label)}
    assert len(want) == 200
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for parts, docs in ((1, rows.coalesce(1)), (5, rows.repartition(5))):
        assert {r.doc_id for r in lines.kept_lines(docs).collect() if r.kept} == want, parts


def test_bounds_and_blocks_lose_no_pair(spark):
    texts = [t.encode() for t in _family(30)]
    own = [lines.shingles(t) for t in texts]
    alike = [(i, j) for j in range(60) for i in range(j) if similar.set_jaccard(own[i], own[j]) >= similar.SIMILARITY]
    want = _union(60, alike)
    near = spark.createDataFrame([(7, 0, i - 1, i) for i in range(1, 60)], "key bigint, first bigint, before bigint, h bigint")
    p, q = alike[0]
    labels = spark.createDataFrame([(p, p), (q, p)], "node bigint, label bigint")
    rows = spark.createDataFrame(list(enumerate(texts)), "h bigint, line binary")
    for block in (4, 2048):
        links = [(r.a, r.b) for r in similar.unjoined_links(near, labels, rows, lines.shingles, block).collect()]
        assert _union(60, [*links, (p, q)]) == want, block
        assert {tuple(sorted(x)) for x in links} <= {tuple(sorted(p if k == q else k for k in x)) for x in alike}


def test_empty_sets_are_alike():
    none, one = np.empty(0, np.uint64), np.ones(1, np.uint64)
    assert similar.set_jaccard(none, none) == 1.0 and similar.set_jaccard(none, one) == 0.0
