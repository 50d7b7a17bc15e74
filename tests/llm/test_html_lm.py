import functools
import html.parser as html_parser
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from docloom.llm import html, lm, words

from .conftest import prose

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">Menu</a></li></ul></nav>
<div class="ad">Buy this now and more and more words</div><article><h1>Head &amp; title</h1><p><b>First  par<br>line<p>Second&nbsp;par {0}</p></article>
<div class="comments"><p>A reader says many words here</p></div><footer>&copy; me</footer></body></html>"""


def _path(*steps):
    return functools.reduce(html.path_of, steps, "")


def test_main_text():
    article = _path("html", "body", "article")
    assert html.extract(PAGE.format("x"), article) == "Head & title First par line Second par x"
    assert html.extract(PAGE.format("x"), None) == html.extract(PAGE.format("x"), "no such")
    assert html.vote(PAGE.format("x"))[0] == article
    for bad in ("", "<", "<a" * 5000, "<div " * 500 + '"' * 500, "plain &lt; text", "<p>a<p>b", "<!-- open", "<script>x", "</p></div>"):
        assert isinstance(html.extract(bad, None), str)
    assert html.extract("plain &lt; text", None) == "plain < text"


def test_deep_pages():
    for n in (500, 1100, 3000, 50_000):
        page = "<p>one " + "<div>" * n + "deep text" + "</div>" * n + "</section>" * n + "</p><p>two</p>"
        assert html.extract(f"<body><article><p>{'word ' * 40}</p>{page}</article>", None).split()[-4:] == ["one", "deep", "text", "two"]
    # Containers that differ only far above are told apart.
    deep = "<div>" * 300
    a, b = (html.vote(f"<body><{t}>{deep}<div class='x9'>{'word ' * 50}")[0] for t in ("main", "section"))
    assert a != b and html.vote(f"<body><main>{deep}<div class='x10'>{'word ' * 50}")[0] == a


def test_references_are_decoded_in_each_run():
    assert html.extract("<body><article><p>&am<b>p;</b> &amp;lt; &eacute;&#233;&nbsp;x</p></article>", None) == "&amp; &lt; éé x"


def test_chrome_by_name_only():
    for name, stays in (("related-work", True), ("related-posts", False), ("ad", False), ("ads-box top", False), ("adage", True), ("comment", False), ("notice-period", True), ("share-buttons", False)):
        text = html.extract(f"<body><article><p>{'word ' * 30}</p><div class='{name}'><p>inner part</p></div></article>", None)
        assert ("inner part" in text) == stays, name


def test_ties_and_repeated_rows(spark):
    both = "<body><div class='a'>{0}</div><div class='b'>{0}</div></body>".format("same words here " * 5)
    assert html.vote(both)[0] == _path("body")  # of equal scores the first in the page, here the one around the others
    rows = [(1, "http://t/1", both), (1, "http://t/1", both), (2, "http://t/2", "<body><p>" + "other " * 9)]
    found = html.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert len(found) == 3 and len({r.text for r in found if r.page_id == 1}) == 1


def _plain_text(page):
    """What a reader sees of the article, by another parser: its text, a space at each tag that is no inline one."""

    class Reader(html_parser.HTMLParser):
        inside, out = False, ()

        def handle_starttag(self, tag, attrs):
            self.inside = self.inside or tag == "article"
            self.out = (*self.out, " ") if tag not in ("b", "a", "i", "em", "span") else self.out

        def handle_endtag(self, tag):
            self.inside = self.inside and tag != "article"
            self.out = (*self.out, " ") if tag not in ("b", "a", "i", "em", "span") else self.out

        def handle_data(self, data):
            if self.inside:
                self.out = (*self.out, data)

    reader = Reader()
    reader.feed(page)
    reader.close()
    return " ".join("".join(reader.out).split())


def test_every_page_meets_another_parser(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r.page_id: _plain_text(r.html) for r in pages.collect()}
    found = {r.page_id: (r.text, r.n_chars) for r in html.main_text(pages).collect()}
    assert found == {k: (v, len(v)) for k, v in want.items()}


def test_hosts_vote(spark):
    good = [(i, f"https://h.example/{i}", PAGE.format("words " * 30)) for i in range(6)]
    odd = [(7, "https://h.example/odd", PAGE.format("x").replace("<div class=\"ad\">Buy", "<div class='x1'><p>" + "noise " * 200 + "</p>Buy")), (8, None, None), (9, "", ""), (None, "https://h.example/1", PAGE.format("y"))]
    pages = spark.createDataFrame(good + odd, "page_id bigint, url string, html string")
    rows = {r.page_id: r for r in html.main_text(pages.withColumnRenamed("x", "y").selectExpr("*", "1 AS host", "'p' AS path", "2 AS votes")).collect()}
    assert rows[7].text == "Head & title First par line Second par x" and rows[8].text == "" and rows[9].n_chars == 0
    assert rows[0].n_chars == len(rows[0].text) and rows[None].text.endswith("y")
    assert html.main_text(spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []


def _slow_rows(mixer, raw, i):
    """Where the rows of the five contexts of byte ``i`` begin, byte by byte, and the number of the byte's symbol."""
    past, m32 = 0, 0xFFFFFFFF
    for j in range(1, 5):
        past |= (raw[i - j] if i >= j else 0) << 8 * (j - 1)
    word = 0
    lo = i
    while lo and raw[lo - 1] not in b" \t\n\v\f\r":
        lo -= 1
    for j in range(lo, i):
        word += (raw[j] + 1) * pow(lm._BASE, j - lo, 1 << 32)
    word = (word * 257 + (past & 0xFFFF)) & m32
    contexts, of = mixer.contexts, int(mixer.code.of[past & 0xFFFF])
    odd, bits = int(lm._ODD), contexts.bits
    rows = [of, *(((past & (m32 >> (32 - 8 * j))) * odd & m32) >> (32 - bits[j - 1]) for j in (2, 3, 4)), ((word ^ word >> 15) * odd & m32) >> (32 - bits[4])]
    return [r * s + int(b) for r, s, b in zip(rows, contexts.strides, contexts.starts)], of << 8 | raw[i]


def _slow_bits(mixer, text):
    """The text's bits, one after the other, in Python's floats."""
    raw, code, cost = text + lm.END_BYTE, mixer.code, 0.0
    weights = [[w / lm.SCALE for w in lm.FIRST_WEIGHTS] for _ in range(lm.SETS)]
    for i, byte in enumerate(raw):
        begins, pair = _slow_rows(mixer, raw, i)
        gate = sum((mixer.table[begins[k]] != 0) << (k - 2) for k in (2, 3, 4))
        for at in range(code.starts[pair], code.starts[pair] + code.lengths[pair]):
            node, bit = int(code.nodes[at]), int(code.bits[at])
            x = [float(mixer.table[b + node]) for b in begins] + [lm.SCALE, 0.0, 0.0]
            w = weights[gate + 8 * (node == 0)]
            s = sum(a * b for a, b in zip(w, x))
            z = min(-s if bit else s, lm.MOST)
            cost += math.log2(1 + math.exp(z))
            step = (1 - 1 / (1 + math.exp(z))) * lm.RATE / lm.SCALE**2
            for k in range(len(x)):
                w[k] += (step if bit else -step) * x[k]
    return cost


def _texts():
    return {i: prose(i, 80) for i in range(60)} | {1000: "ab " * 9000}


@pytest.fixture(scope="module")
def mixer(spark):
    texts = [*_texts().items()]
    model, _ = lm.train(spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3))
    return model["mixer"]


def test_lanes_equal_the_slow_mixer(mixer, monkeypatch):
    texts = [b"", b"z", "é😀".encode(), b"zzz 123 " * 40, prose(100, 20).encode(), prose(101, 60).encode()[:300], prose(102, 700).encode()[:3000], b"x" * 700]
    slow = [_slow_bits(mixer, t) for t in texts]
    for block, few in ((lm.BLOCK, lm.FEW), (1000, 0), (1000, 5), (1000, 99)):  # of 1,000 bytes: texts go on over many blocks, and words over their edges
        monkeypatch.setattr(lm, "BLOCK", block)
        monkeypatch.setattr(lm, "FEW", few)
        assert np.allclose(mixer.text_bits(texts), slow, rtol=1e-4), block
        assert np.allclose(mixer.text_bits(texts[::-1])[::-1], slow, rtol=1e-4), block
    known, odd = mixer.text_bits([prose(200, 60).encode(), prose(200, 60).upper().encode()])
    assert known < 0.7 * odd


def test_a_text_of_over_a_mebibyte_is_mixed_through(mixer):
    text = prose(103, 300).encode() + b"ab " * 350_000
    assert len(text) > 1 << 20
    assert np.allclose(mixer.text_bits([text, b"short"]), [_slow_bits(mixer, text), _slow_bits(mixer, b"short")], rtol=1e-4)


def test_counts_meet_a_direct_count(spark, mixer):
    zeros, ones, follows = Counter(), Counter(), Counter()
    code = mixer.code

    def count(begins, symbol, times=1):
        for at in range(code.starts[symbol], code.starts[symbol] + code.lengths[symbol]):
            for b in begins:
                (ones if code.bits[at] else zeros)[b + int(code.nodes[at])] += times

    for i, t in _texts().items():
        if zlib.crc32(str(i).encode()) % 10 == 0:
            continue
        raw = t.encode() + lm.END_BYTE
        for j, byte in enumerate(raw):
            begins, symbol = _slow_rows(mixer, raw, j)
            count(begins[1:], symbol)
            follows[raw[j - 1] if j else 0, byte] += 1
    assert len(code.last) > 256
    for k, last in enumerate(code.last.tolist()):
        for byte in range(256):
            count([k * lm.LONGEST_ROW], k << 8 | byte, follows[last, byte])
    want = np.zeros(len(mixer.table), np.int8)
    places = np.array(sorted(k for k in {*zeros, *ones} if zeros[k] + ones[k]))
    want[places] = lm.log_odds(np.array([zeros[k] for k in places.tolist()]), np.array([ones[k] for k in places.tolist()]))
    assert (mixer.table == want).all()


def test_a_mixer_holds_its_table_once(mixer):
    wide = lm.Mixer(mixer.contexts, mixer.code, np.concatenate([mixer.table, mixer.table]))
    held = [sum(x.nbytes for x in vars(own).values() if isinstance(x, np.ndarray)) for own in (mixer, wide)]
    assert held[1] - held[0] == len(mixer.table)


def test_bits_make_a_distribution(mixer):
    """Whatever comes first, the probabilities of all next bytes, each with its bits' update, sum to one."""
    for first in (b"", b"th", prose(104, 3).encode()):
        base = mixer.text_bits([first])[0]
        # The end's bits are in every cost: take them off by the cost of the bytes alone.
        own = [_slow_bits_of_next(mixer, first, byte) for byte in range(256)]
        assert abs(sum(2**-x for x in own) - 1) < 1e-6 and base > 0


def _slow_bits_of_next(mixer, first, byte):
    """Bits of the byte itself behind ``first``."""
    raw, code = first + bytes([byte]), mixer.code
    cost, weights, before = 0.0, [[w / lm.SCALE for w in lm.FIRST_WEIGHTS] for _ in range(lm.SETS)], 0.0
    for i, b in enumerate(raw):
        before = cost
        begins, pair = _slow_rows(mixer, raw, i)
        gate = sum((mixer.table[x] != 0) << (k - 2) for k, x in enumerate(begins) if k >= 2)
        for at in range(code.starts[pair], code.starts[pair] + code.lengths[pair]):
            node, bit = int(code.nodes[at]), int(code.bits[at])
            x = [float(mixer.table[k + node]) for k in begins] + [lm.SCALE, 0.0, 0.0]
            w = weights[gate + 8 * (node == 0)]
            s = sum(p * q for p, q in zip(w, x))
            cost += math.log2(1 + math.exp(-s if bit else s))
            step = (bit - 1 / (1 + math.exp(-s))) * lm.RATE / lm.SCALE**2
            for k in range(len(x)):
                w[k] += step * x[k]
    return cost - before


def test_contexts_grow_with_the_training_bytes():
    sizes = [lm.Contexts(10**k).size for k in (6, 7, 8, 9)]
    assert sizes == sorted(set(sizes)) and lm.Contexts(10**15).size < 32_000_000


def test_word_hashes_tell_words_apart():
    texts = {prose(i, 40 + i % 7).encode() for i in range(300)}
    cut = [w for t in texts for w in t.lower().split()]
    hashes, counts = words.Words()([*texts])
    assert counts.tolist() == [len(t.split()) for t in texts] and len(set(hashes.tolist())) == len(set(cut))
    assert [words.word_hash(w) for w in cut] == hashes.tolist()


def _brute(rows):
    cut = [[*"".join(c.lower() if c.isascii() else c for c in t or "").encode().split(), b"\n"] for _, t in rows]
    out = [i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    c = Counter(w for own, held in zip(cut, out) if not held for w in own)
    n, v = sum(c.values()), len(c)
    return Counter((rows[k][0], out[k], len(own), sum(c[w] > 0 for w in own), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own), 5)) for k, own in enumerate(cut))


def test_scores(spark, edge, edge_rows, empty):
    rows = [(r[0], r[1]) for r in edge_rows] + [(100 + i, prose(i, 30)) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for head in (1_000_000, 20):
        found = lm.score(frame, head).collect()
        assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in found) == _brute(rows), head
        assert all(r.score < 0 for r in found)
    assert lm.score(edge).count() == len(edge_rows)
    assert lm.score(empty).collect() == []
