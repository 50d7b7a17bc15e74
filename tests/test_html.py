import random

import pytest

from docloom.operators import webworks
from docloom.operators.html import convert, gfm, passes
from docloom.operators.html.dom import parse, select, serialise


def _after(html, change):
    root = parse(html)
    change(root)
    return serialise(root)


@pytest.mark.parametrize(
    "html, change, want",
    [
        ('<div class="note">N</div>', passes.callouts, "<blockquote><p><strong>Note:</strong> N</p></blockquote>"),
        ('<table class="AutoNumber_p_Step"><tr><td>1.</td><td>Do</td></tr></table>', passes.fake_lists, "<ol><li>Do</li></ol>"),
        ('<div class="dl"><div class="dlentry"><span class="dt">T</span><div class="dd">D</div></div></div>', passes.definition_lists, "<p><strong>T</strong></p>D"),
        ('<div class="prereq">P</div>', passes.task_sections, "<p><strong>Prerequisites</strong></p>P"),
        ('<span class="menucascade"><span class="uicontrol">File &gt; </span><span class="uicontrol">New</span></span>', passes.inline_spans, "<strong>File &gt; New</strong>"),
        ("<var>x</var>", passes.inline_spans, "<em>x</em>"), ('<span class="mc-variable a">v</span>', passes.inline_spans, "v"), ('<a name="k">t</a>', passes.anchors, "t"),
        ("<pre>a<br/>b</pre>", passes.preformatted_breaks, "<pre>a\nb</pre>"),
        ('<p>x<a class="MCTextPopup">1<span class="MCTextPopupBody">B</span></a></p>', passes.text_popups, "<p>x</p><blockquote><p><strong>Note:</strong> B</p></blockquote>"),
    ],
)
def test_passes(html, change, want):
    assert _after(html, change) == want


def test_tables():
    def tier(html, blocks=passes.CELL_BLOCKS):
        root = parse(html)
        return passes.classify_tables(root, blocks), root

    assert tier("<table><tr><td>a</td></tr><tr><td>b</td></tr></table>")[0]["tier1"] == 1
    assert tier("<table><tr><td><code>a</code></td></tr></table>")[0]["tier2"] == 1
    assert tier("<table><tr><td><h4>a</h4></td></tr></table>", ("ul",))[0]["tier2"] == 1 and tier("<table><tr><td><h4>a</h4></td></tr></table>")[0]["tier3"] == 1
    counts, root = tier("<table><tr><td><ul><li>x</li></ul><table><tr><td>in</td></tr></table></td></tr></table>")
    assert counts == {"tier1": 0, "tier2": 0, "tier3": 1} and len(passes.take_raw_tables(root)) == 1
    split = parse('<table><thead><tr><th>A</th><th>B</th></tr></thead><tbody><tr><td colspan="2">S1</td></tr><tr><td>1</td><td>2</td></tr><tr><td colspan="2">S2</td></tr><tr><td>3</td><td>4</td></tr></tbody></table>')
    assert passes.split_tables(split) == 1
    assert gfm.render(split) == "**S1**\n\n| A | B |\n| --- | --- |\n| 1 | 2 |\n\n**S2**\n\n| A | B |\n| --- | --- |\n| 3 | 4 |"


def test_markdown():
    md = gfm.clean(gfm.render(parse("<h2>T</h2><p>a <b>b </b>c <a href='x.htm'>l</a><br>d</p><ul><li>1<ul><li>2</li></ul></li><li>3</li></ul><pre>x\n y</pre><blockquote><p>q</p></blockquote><p>5*6_7</p>")))
    assert md == "## T\n\na **b** c [l](x.htm)\\\nd\n\n- 1\n  - 2\n- 3\n\n```\nx\n y\n```\n\n> q\n\n5\\*6\\_7\n"


def test_selectors():
    root = parse("<div id='center'><section><article class='a b'>x</article></section></div><div role='main' id='mc-main-content'>y</div>")
    assert [e.text() for e in select(root, "div#center article")] == ["x"] and [e.text() for e in select(root, "div[role='main']#mc-main-content")] == ["y"]
    assert select(root, "article.b.a") and not select(root, "section#center article")


def test_fuzz_never_raises():
    r = random.Random(1)
    bits = ["<div>", "</div>", "<p>", "<table>", "<tr>", "<td colspan='2'>", "</table>", "<ul>", "<li>", "text", "&amp;", "<b", "<pre>", "<br>", "<span class='cmd'>", "<a name=x>", "</p>", "<article>", "<thead>", "<tbody>", "<dt>", "<ol class='steps'>", "\n", "<!--", "<img src='a.png'>"]
    for _ in range(400):
        html = "<article>" + "".join(r.choice(bits) for _ in range(r.randint(0, 60)))
        page = convert.convert_page("https://h/a.htm", html)
        assert page["error"] is None and isinstance(page["body"], str)
        webworks.convert_file("<blockquote>" + html)


def test_front_matter():
    text = convert.front_matter({"title": "T: x", "n": 0, "empty": "", "ids": [1]}) + "body\n"
    head, rest = convert.read_front_matter(text)
    assert head == {"title": "T: x", "n": 0, "ids": [1]} and rest == "\nbody\n"
    assert convert.read_front_matter("no head")[0] == {} and convert.read_front_matter("---\n: [\n---\nx")[0] == {}
    assert convert.read_front_matter(convert.rewrite_front_matter(text, {"title": "U"}))[0]["title"] == "U"


def test_pages_as_rows(spark):
    rows = [(1, "https://h/a.htm", "<html lang='de'><title>T</title><article><h1>H</h1><p>x <a href='b.htm'>b</a></p></article>"), (2, "https://h/n.htm", "<p>none</p>"), (3, None, None)]
    found = {r.page_id: r for r in convert.convert_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert found[1].body == "# H\n\nx [b](b.htm)\n" and found[1].lang == "de" and found[1].links[0].href == "b.htm" and found[2].skipped == "no-content" and found[3].skipped == "no-content"


def test_webworks():
    html = "<title>W</title><blockquote><div class='MinorHead'>M</div><div class='Code'>l1</div><div class='Code'>l2</div><div>x <span class='CodeItalic'>y</span> <a href='a.htm'>A</a> <a href='a.htm#x'>B</a></div></blockquote>"
    assert webworks.convert_file(html) == ("W", "## M\n\n```\n\nl1\n\nl2\n\n```\n\nx _y_ [A](a.md) [B](a.htm#x)\n")
    assert webworks.convert_file("<p>x</p>")[1] is None
    assert webworks.toc_rows("<t><i t='A' l='0'><i t='B' l='1#k'/></i></t>") == [([0], "A", "0"), ([0, 0], "B", "1#k")] and webworks.toc_rows("<") == []


def test_pages_are_converted_in_small_parts():
    import pyarrow as pa

    from docloom.operators.html import convert

    texts = ["x" * n for n in (10, convert.SLICE, 0, 300_000, 800_000, 5)] + [None] + ["y" * 3_000] * 2_000
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["page_id", "html"])
    parts = list(convert.slices(batch, 1))
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()
    for part in parts:
        sizes = [len(t or "") for t in part.column(1).to_pylist()]
        assert sum(sizes[:-1]) < convert.SLICE and len(sizes) <= convert.SLICE // convert.ROW
    assert list(convert.slices(batch.slice(0, 0), 1)) == []
