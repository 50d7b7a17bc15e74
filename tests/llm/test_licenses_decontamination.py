import hashlib
import random
import re
from collections import Counter

import pytest

from docloom.llm import decontaminate, licenses

from .conftest import SCHEMA, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def _windows(benchmark):
    out = {}
    for i, t in benchmark:
        w = WORD.findall(_lower(t))
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            out.setdefault(tuple(w[k : k + n]), set()).update(() if i is None else {str(i)})
    return out


def _hits(text, windows):
    w = WORD.findall(_lower(text))
    hit, items = set(), set()
    for n in {len(x) for x in windows}:
        for k in range(len(w) - n + 1):
            if (own := windows.get(tuple(w[k : k + n]))) is not None:
                hit |= set(range(k, k + n))
                items |= own
    return w, hit, items


def _cases():
    r = random.Random(8)
    items = [(i, prose(900 + i, 25)) for i in range(12)] + [(20, "tiny item"), (21, ""), (22, None), (23, "Été naïve 123"), (None, prose(950, 12)), (24, prose(900, 25))]
    docs = [(i, prose(i, 60)) for i in range(20)]
    docs += [(100 + i, f"{prose(30 + i, 20)} {r.choice(items[:12])[1].upper()} {prose(60 + i, 20)}") for i in range(15)]
    docs += [(200, "a TINY, item! b"), (201, items[0][1]), (202, " ".join(items[1][1].split()[3:14])), (203, " ".join(items[1][1].split()[3:12])), (204, "x ÉTÉ été naïve 123 y"), (205, None), (206, ""), (None, items[2][1] * 3), (201, items[0][1])]
    return items, docs


@pytest.mark.parametrize("slots", [None, 64])  # with 64 slots nearly every window is a candidate
def test_hits_equal_brute_force(spark, monkeypatch, slots):
    if slots:
        monkeypatch.setattr(decontaminate, "MOST_SLOTS", slots)
        monkeypatch.setattr(decontaminate, "LEAST_SLOTS", slots)
        monkeypatch.setattr(decontaminate, "MAX_BROADCAST_WINDOWS", 0)
    items, docs = _cases()
    windows = _windows(items)
    want = Counter()
    for i, t in docs:
        w, hit, own = _hits(t, windows)
        want[i, len(w), len(hit), len(own), hashlib.sha256(",".join(sorted(own)).encode()).hexdigest(), bool(hit)] += 1
    frame, bench = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontaminate.contamination_report(frame, bench).collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows) == want


def test_spans_are_cut(spark):
    items, docs = _cases()
    windows = _windows(items)
    want = Counter()
    for i, t in docs:
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
        want[i, t if t is None else "".join(parts) + t[at:]] += 1
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("doc_id", "text", "1 AS hits", "2 AS w", "3 AS low")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontaminate.remove_spans(frame, bench)
    assert rows.columns == frame.columns
    assert Counter((r.doc_id, r.text) for r in rows.collect()) == want
    left = {r.doc_id for r in decontaminate.remove_documents(frame, bench).collect()}
    assert left == {i for i, t in docs if not _hits(t, windows)[1]}


def test_empty_sides(spark, edge, edge_rows, empty):
    none = spark.createDataFrame([], "item_id bigint, text string")
    rows = decontaminate.contamination_report(edge, none).collect()
    assert len(rows) == len(edge_rows) and not any(r.contaminated for r in rows)
    assert decontaminate.contamination_report(empty, none).collect() == []


def _dice(a, b):
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


def _licenses(text):
    low = _lower(text)
    lines = re.sub("[^a-z0-9\n]+", " ", low)
    sentences = re.sub("[^a-z0-9\n]+", " ", re.sub("([.!?])[ \t]+", "\\1\n", low))
    blocks = [y for x in re.split("\n ?\n", lines) if (y := " ".join(x.split()))]
    runs = [" ".join(blocks[i : i + k]) for i in range(len(blocks)) for k in range(2, min(8, len(blocks) - i) + 1)]
    pieces = [*sentences.split("\n"), *lines.split("\n"), *blocks, *[x for x in runs if len(x.split()) <= licenses.most_words(licenses.templates())], lines.replace("\n", " ")]
    best = {}
    known = [(t["id"], set(t["grams"])) for t in licenses.templates()]
    for p in {re.sub(" +", " ", x).strip(" ") for x in pieces}:
        w = p.split(" ")
        grams = {f"{a} {b}" for a, b in zip(w, w[1:])}
        scores = [(_dice(grams, g), k) for k, g in known]
        top = max(s for s, _ in scores)
        for s, k in scores:
            if s == top >= licenses.THRESHOLD:
                best[k] = max(best.get(k, 0), s)
    return best


def test_licences_equal_brute_force(spark, edge, empty):
    mit = licenses.TEXTS["MIT"]
    texts = ["Released under the MIT License.", "Some prose. Licensed under CC BY-NC 4.0. More prose", mit, "Copyright 2020 A\n\n" + mit.replace("\n", " "), f"Intro\n\n{mit[:400]}", "This work is licensed under the GNU General Public License, version 3.", prose(1, 200), None, "", "SPDX-License-Identifier: Apache-2.0", licenses.TEXTS["ISC"].upper(), "MIT", "licensed under the mit licence"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: {m["id"]: m["score"] for m in r.matches} for r in licenses.scan_licenses(frame).collect()}
    assert found == {i: _licenses(t) for i, t in enumerate(texts)}
    whole = {k: f"{prose(5, 150)}\n\n\n{t}\n \n{prose(6, 300)}\n\n{prose(7, 40)}" for k, t in licenses.TEXTS.items()}
    inside = {r.doc_id: [m["id"] for m in r.matches] for r in licenses.scan_licenses(spark.createDataFrame([*whole.items()], "doc_id string, text string")).collect()}
    assert all(k in own for k, own in inside.items()) and inside == {k: sorted(_licenses(t)) for k, t in whole.items()}
    own = licenses.scan_licenses(spark.createDataFrame([(1, "You may use Zork as you like, and must tell nobody about it."), (2, "x")], "doc_id bigint, text string"), more={"Zork": ["You may use Zork as you like and tell nobody about it"]})
    assert {r.doc_id: [m["id"] for m in r.matches] for r in own.collect()} == {1: ["Zork"], 2: []}
    assert found[0] == {"MIT": 1.0} and "CC-BY-NC-4.0" in found[1] and found[2] == {"MIT": 1.0} and found[6] == {}
    assert licenses.license_report(edge).count() == edge.count() and licenses.license_report(empty).collect() == []


def test_matches_at_the_threshold_itself(spark):
    phrases = [g.format(n) for names in licenses.NAMES.values() for n in names for g in licenses.GRANTS]
    texts = ["Licensed under MIT.", "Released under ISC", "Intro text.\nLicensed under MIT\nmore"]
    texts += [" ".join(p.split()[:k]) for p in phrases[::7] for k in range(3, len(p.split()))] + [" ".join(x.split()[: 2 * len(x.split()) // 3]) for x in licenses.TEXTS.values()]
    found = {r.doc_id: {m["id"]: m["score"] for m in r.matches} for r in licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    assert found == {i: _licenses(t) for i, t in enumerate(texts)}
    assert found[0] == {"MIT": 0.8} and found[1] == {"ISC": 0.8} and found[2] == {"MIT": 0.8}
