"""Queries that put made inputs, with a number of each document in them, through one operator; the SQL states what must come out."""

from __future__ import annotations

import json
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .config import Settings
from .functions import text as T
from .operators import pdf, webworks
from .operators.html import convert, gfm, passes
from .operators.html.dom import parse, serialise
from .plans.runner import Step, run_all, run_steps
from .sources import scripts

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
S = Settings()


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _register(name: str, cases: list[tuple[str, str]], run: Callable[[DataFrame], DataFrame]) -> None:
    def query(spark, d):
        k = F.col("doc_id")
        given = F.get(F.array(*[F.lit(x) for x, _ in cases]), F.pmod(k, F.lit(len(cases))).cast("int"))
        return run(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.replace(given, F.lit("@@"), k.cast("string")).alias("given")))

    whens = " ".join(f"WHEN {i} THEN {_quoted(y)}" for i, (_, y) in enumerate(cases))
    QUERIES[name] = query
    ORACLES[name] = f"SELECT doc_id, replace(CASE doc_id % {len(cases)} {whens} END, '@@', CAST(doc_id AS VARCHAR)) AS value FROM documents"


def column(name: str, f: Callable[[Column], Column], *cases: tuple[str, str]) -> None:
    """A native operator over (input, result); ``@@`` stands for the document's number."""
    _register(name, list(cases), lambda rows: rows.select("doc_id", f(F.col("given")).alias("value")))


def page(name: str, f: Callable[[str], str], *cases: tuple[str, str]) -> None:
    """An operator that reads a page or a script in Python, in one Arrow pass."""

    def over(rows: DataFrame) -> DataFrame:
        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f(x.as_py()) for x in batch.column(1)], pa.string())], names=["doc_id", "value"])

        return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, value string")

    _register(name, list(cases), over)


def _pass(f: Callable) -> Callable[[str], str]:
    """Count and tree after a pass, as one text."""

    def run(html: str) -> str:
        root = parse(html)
        n = f(root)
        return f"{json.dumps(n, sort_keys=True) if isinstance(n, dict) else int(n)} {serialise(root)}"

    return run


# Texts.
column(
    "fn1_token_strip", lambda x: F.concat(T.strip_tokens(x), F.lit("|"), T.count_tokens(x).cast("string")),
    ("x [%=a.b%] y [%=c d%] @@", "x  y  @@|2"), ("[%=a%][%=b%]@@", "@@|2"), ("[%a%] @@ [=b%]", "[%a%] @@ [=b%]|0"), ("[%=a-b%]@@", "[%=a-b%]@@|0"),
)
column("fn2_toc_path", T.clean_toc_path, (" A || B@@ ", "A|B@@"), ("User Guide|[%=System.LinkedHeader%]", "User Guide"), ("[%=S.H%]|@@|  ", "@@"), (" | ", ""))
column("fn8_topic_type", lambda x: F.coalesce(T.topic_type(x), F.lit("none")), ("task nested @@", "task"), ("x reference concept", "concept"), ("my-reference", "reference"), ("other @@", "none"))
column("fn10_unescape", T.unescape_js, ("it\\'s @@", "it's @@"), ('a\\"b@@', 'a\\"b@@'), ("\\'\\'@@", "''@@"))
column("fn13_title_head", T.title_head, ("T@@ - Guide - 2", "T@@"), ("T@@-x", "T@@-x"), (" - x@@", ""))
column(
    "htm17_clean_markdown", T.clean_markdown,
    ("**Enter**to @@", "**Enter** to @@\n"), ("(**word** x", "(** word** x\n"), ("\n\na@@  \n\n\n\nb\n", "a@@\n\nb\n"), ("x `a`b @@", "x `a` b @@\n"), ("a **b** c@@", "a **b** c@@\n"),
)

# Passes over a page's tree.
page(
    "htm1_strip_chrome", _pass(lambda r: passes.strip_chrome(r, S.chrome_selectors)),
    ('<div class="toolbar">T</div><p>a@@</p><script>x</script>', "2 <p>a@@</p>"), ('<p><span class="autonumber">@@.</span> b</p>', "1 <p> b</p>"),
    ('<p class="Copyright">c</p><div id="prdnm">@@</div><p>d</p>', "2 <p>d</p>"), ('<div class="toolbars">@@</div>', '0 <div class="toolbars">@@</div>'),
)
page(
    "htm1d_strip_chrome_dita", _pass(lambda r: passes.strip_chrome(r, S.chrome_selectors, numbers=False)),
    ('<p><span class="autonumber">@@.</span> b</p>', '0 <p><span class="autonumber">@@.</span> b</p>'), ("<style>p</style><p>@@</p><noscript>n</noscript>", "2 <p>@@</p>"),
)
page(
    "htm2_fake_lists", _pass(passes.fake_lists),
    ('<table class="AutoNumber_p_Step"><tr><td>1.</td><td>Do @@</td></tr></table>', "1 <ol><li>Do @@</li></ol>"),
    ('<table class="AutoNumber_p_Bullet"><tr><td>-</td><td>x</td></tr><tr><td>-</td><td>y@@</td></tr></table>', "1 <ol><li>x</li><li>y@@</li></ol>"),
    ("<table><tr><td>@@</td></tr></table>", "0 <table><tr><td>@@</td></tr></table>"),
)
page(
    "htm3_callouts", _pass(passes.callouts),
    ('<div class="note">N@@</div>', "1 <blockquote><p><strong>Note:</strong> N@@</p></blockquote>"), ('<div class="x warning">W@@</div>', "1 <blockquote><p><strong>Warning:</strong> W@@</p></blockquote>"),
    ('<div class="danger">@@</div>', '0 <div class="danger">@@</div>'), ('<p class="note">@@</p>', '0 <p class="note">@@</p>'),
)
page(
    "htm3d_callouts_dita", _pass(lambda r: passes.callouts(r, passes.DITA_CALLOUTS, dita=True)),
    ('<div class="note danger"><span class="note__title">Note:</span>D@@</div>', "1 <blockquote><p><strong>Note:</strong> D@@</p></blockquote>"),
    ('<div class="restriction">R@@</div>', "1 <blockquote><p><strong>Restriction:</strong> R@@</p></blockquote>"),
)
page(
    "htm4_text_popups", _pass(passes.text_popups),
    ('<p>x<a class="MCTextPopup popup">1<span class="MCTextPopupBody"><span class="MCTextPopupArrow"> </span>B@@</span></a></p><p>y</p>', "1 <p>x</p><blockquote><p><strong>Note:</strong> B@@</p></blockquote><p>y</p>"),
    ('<b>x<a class="MCTextPopup">1<span class="MCTextPopupBody">in @@</span></a></b>', "1 <b>x</b><blockquote><p><strong>Note:</strong> in @@</p></blockquote>"),
    (
        '<p>a<a class="MCTextPopup">1<span class="MCTextPopupBody">one</span></a>b<a class="MCTextPopup">2<span class="MCTextPopupBody">two @@</span></a></p>',
        "2 <p>ab</p><blockquote><p><strong>Note:</strong> one</p></blockquote><blockquote><p><strong>Note:</strong> two @@</p></blockquote>",
    ),
    ('<p><a class="otherPopup">@@<span class="MCTextPopupBody">B</span></a></p>', '0 <p><a class="otherPopup">@@<span class="MCTextPopupBody">B</span></a></p>'),
)
page(
    "htm5_definition_lists", _pass(passes.definition_lists),
    ('<div class="dl"><div class="dlentry"><span class="dt">T@@</span><div class="dd">D</div></div></div>', "1 <p><strong>T@@</strong></p>D"),
    ("<dl><dt>a</dt><dd>b@@</dd><dt>c</dt><dd>d</dd></dl>", "2 <p><strong>a</strong></p>b@@<p><strong>c</strong></p>d"), ("<ul><li>@@</li></ul>", "0 <ul><li>@@</li></ul>"),
)
page(
    "htm6_task_sections", _pass(passes.task_sections),
    ('<div class="prereq">P@@</div>', "1 <p><strong>Prerequisites</strong></p>P@@"), ('<div class="context">c@@</div>', "1 c@@"),
    ('<ol class="steps"><li>s@@</li></ol>', "1 <p><strong>Procedure</strong></p><ol><li>s@@</li></ol>"), ('<div class="postreq">n@@</div>', "1 <p><strong>What to do next</strong></p>n@@"),
    ('<div class="other">@@</div>', '0 <div class="other">@@</div>'),
)
page(
    "htm6d_task_steps", _pass(passes.task_steps),
    ('<ol class="ol steps"><li class="li step"><span class="ph cmd">Do @@</span></li></ol>', "3 <ol><li>Do @@</li></ol>"), ('<div class="itemgroup info">i@@</div>', "1 i@@"), ("<ol><li>@@</li></ol>", "0 <ol><li>@@</li></ol>"),
)
page("htm6e_short_descriptions", _pass(passes.short_descriptions), ('<p class="shortdesc">s@@</p>', "1 <p>s@@</p>"), ('<div class="shortdesc">@@</div>', '0 <div class="shortdesc">@@</div>'))
page(
    "htm7_inline_spans", _pass(passes.inline_spans),
    ('<span class="menucascade"><span class="uicontrol">File &gt; </span><span class="uicontrol">New @@</span></span>', "1 <strong>File &gt; New @@</strong>"), ("<var>x@@</var>", "1 <em>x@@</em>"),
    ('<span class="mc-variable a">v@@</span>', "1 v@@"), ('<span class="codeph">c@@</span> <span class="wintitle">w</span>', "2 <code>c@@</code> <strong>w</strong>"),
    ('<span class="cmd">do\n  @@</span>', "1 do @@"), ('<span class="plain">@@</span>', '0 <span class="plain">@@</span>'),
)
page("htm8_anchors", _pass(passes.anchors), ('<a name="k">t@@</a>', "1 t@@"), ('<a href="#k" name="k">@@</a>', '0 <a href="#k" name="k">@@</a>'), ('<p id="x"><a id="y"></a>@@</p>', '1 <p id="x">@@</p>'))
_TWO = "<tr><td>a</td><td>b@@</td></tr>"
page(
    "htm9_split_tables", _pass(passes.split_tables),
    (
        f'<table><tbody><tr><td>h</td><td>i</td></tr><tr><td colspan="2">S1</td></tr>{_TWO}<tr><td colspan="2">S2</td></tr>{_TWO}</tbody></table>',
        f"1 <table><tbody><tr><td>h</td><td>i</td></tr></tbody></table><p><strong>S1</strong></p><table><tbody>{_TWO}</tbody></table><p><strong>S2</strong></p><table><tbody>{_TWO}</tbody></table>",
    ),
    (
        f'<table><thead><tr><th>H</th><th>I</th></tr></thead><tbody><tr><td colspan="2">{"long words " * 6}</td></tr>{_TWO}</tbody></table>',
        f"1 <p>{'long words ' * 6}</p><table><thead><tr><th>H</th><th>I</th></tr></thead><tbody>{_TWO}</tbody></table>",
    ),
    (f"<table><tbody>{_TWO}</tbody></table>", f"0 <table><tbody>{_TWO}</tbody></table>"),
)
page(
    "htm10_classify_tables", _pass(lambda r: passes.classify_tables(r, S.cell_block_tags)),
    ("<table><tr><td>a</td></tr><tr><td>@@</td></tr></table>", '{"tier1": 1, "tier2": 0, "tier3": 0} <table><thead><tr><th>a</th></tr></thead><tr><td>@@</td></tr></table>'),
    ("<table><tr><th>a</th></tr><tr><td><code>@@</code></td></tr></table>", '{"tier1": 0, "tier2": 1, "tier3": 0} <table><tr><th>a</th></tr><tr><td><code>@@</code></td></tr></table>'),
    ("<table><tr><th>a</th></tr><tr><td><ul><li>@@</li></ul></td></tr></table>", '{"tier1": 0, "tier2": 0, "tier3": 1} <table data-passthrough="1"><tr><th>a</th></tr><tr><td><ul><li>@@</li></ul></td></tr></table>'),
)
page(
    "htm10a_cell_tier", lambda html: str([passes.cell_tier(c, S.cell_block_tags) for c in parse(html).all("td")]),
    ("<table><tr><td>@@</td><td><p>x</p></td><td><ol><li>y</li></ol></td><td><h4>z</h4></td></tr></table>", "[1, 2, 3, 2]"), ("<table><tr><td><pre>@@</pre></td><td><h3>x</h3></td></tr></table>", "[3, 3]"),
)
page(
    "htm10b_promote_header", _pass(lambda r: passes.promote_header(r.all("table")[0])),
    ("<table><tr><td>a@@</td></tr><tr><td>b</td></tr></table>", "1 <table><thead><tr><th>a@@</th></tr></thead><tr><td>b</td></tr></table>"), ("<table><tr><th>@@</th></tr></table>", "0 <table><tr><th>@@</th></tr></table>"),
    ("<table><thead><tr><td>@@</td></tr></thead></table>", "0 <table><thead><tr><td>@@</td></tr></thead></table>"),
)
page(
    "agg12_table_tier", lambda html: str(max(passes.cell_tier(c, S.cell_block_tags) for c in parse(html).all("td", "th"))),
    ("<table><tr><td>@@</td><td><i>x</i></td></tr></table>", "2"), ("<table><tr><td>@@</td><td>x</td></tr></table>", "1"), ("<table><tr><td><b>@@</b></td><td><ul><li>x</li></ul></td></tr></table>", "3"),
)
page("htm11_join_lines", _pass(passes.join_lines), ("<p>a \n  b@@</p>", "1 <p>a b@@</p>"), ("<pre>a\nb@@</pre>", "0 <pre>a\nb@@</pre>"), ("<p>a\r\nb<b>c\nd@@</b></p>", "2 <p>a b<b>c d@@</b></p>"))
page("htm12_preformatted_breaks", _pass(passes.preformatted_breaks), ("<pre>a<br/>b@@</pre>", "1 <pre>a\nb@@</pre>"), ("<p>a<br/>@@</p>", "0 <p>a<br/>@@</p>"))
page(
    "htm13_relative_images", _pass(passes.relative_images),
    ('<img src="a/@@.png"/><img src="https://h/b.png"/><img src="../c.png"/>', '2 <img src="a/@@.png"/><img src="https://h/b.png"/><img src="../c.png"/>'), ('<img src="data:x"/><img/>@@', '0 <img src="data:x"/><img/>@@'),
)


def _taken(html: str) -> str:
    root = parse(html)
    passes.classify_tables(root, S.cell_block_tags)
    return json.dumps({"out": passes.take_raw_tables(root), "left": serialise(root)}, sort_keys=True)


page(
    "htm14_raw_tables", _taken,
    ("<table><tr><th>a</th></tr><tr><td><ul><li>@@</li></ul></td></tr></table><p>b</p>", json.dumps({"left": "<p>%%PASSTHROUGH-TABLE-0%%</p><p>b</p>", "out": {"%%PASSTHROUGH-TABLE-0%%": "<table><tr><th>a</th></tr><tr><td><ul><li>@@</li></ul></td></tr></table>"}})),
    ("<table><tr><th>@@</th></tr></table>", json.dumps({"left": "<table><tr><th>@@</th></tr></table>", "out": {}})),
)
page(
    "htm15_clean_raw", lambda html: passes.clean_raw(parse(html).all("table")[0]),
    ('<table class="t" border="1" data-passthrough="1"><col/><tr class="r"><td class="c" colspan="2">@@</td></tr></table>', '<table class="t" border="1"><tr><td colspan="2">@@</td></tr></table>'),
    ('<table><tr><td cellpadding="1" rowspan="2">@@</td></tr></table>', '<table><tr><td rowspan="2">@@</td></tr></table>'),
)
page(
    "htm16_markdown", lambda html: gfm.clean(gfm.render(parse(html))),
    ("<h2>T@@</h2><p>a <b>b</b> <i>c</i> <code>d</code></p>", "## T@@\n\na **b** *c* `d`\n"), ("<ul><li>x@@</li><li>y<ul><li>z</li></ul></li></ul>", "- x@@\n- y\n  - z\n"),
    ('<p><a href="u.htm">t@@</a> <img src="i.png" alt="n"/></p>', "[t@@](u.htm) ![n](i.png)\n"), ("<ol><li>a</li><li>b@@</li></ol>", "1. a\n2. b@@\n"),
    ("<table><thead><tr><th>h</th><th>i</th></tr></thead><tr><td>@@</td><td>x|y</td></tr></table>", "| h | i |\n| --- | --- |\n| @@ | x\\|y |\n"), ("<blockquote><p>q@@</p></blockquote>", "> q@@\n"),
    ("<pre>a\n  b@@</pre>", "```\na\n  b@@\n```\n"),
)


def _converted(html: str, dita: bool = False) -> str:
    made = convert.convert_page("https://h/p/x.htm", html, S, dita)
    return json.dumps([made["title"], made["topic_type"], made["skipped"], made["body"], made["stats"].get("callouts", made["stats"].get("dita_callouts", 0))])


_TOPIC = '<html class="{0}"><head><title>{1}</title></head><body><article>{2}</article></body></html>'
page(
    "htm19_all_passes", _converted,
    (_TOPIC.format("task", "T @@", '<div class="toolbar">x</div><h1>H</h1><div class="note">N@@</div>'), json.dumps(["T @@", "task", None, "# H\n\n> **Note:** N@@\n", 1])),
    (_TOPIC.format("x", "", "<h1>H @@</h1><p>a\nb</p>"), json.dumps(["H @@", "", None, "# H @@\n\na b\n", 0])),
    (_TOPIC.format("concept", "U", '<table><tr><td colspan="2">S@@</td></tr></table>'), json.dumps(["U", "concept", None, "| S@@ |\n| --- |\n", 0])),
)
page("flt8_no_content", _converted, ("<html><head><title>t@@</title></head><body><p>x</p></body></html>", json.dumps(["t@@", "", "no-content", None, 0])), (_TOPIC.format("x", "T", "<p>@@</p>"), json.dumps(["T", "", None, "@@\n", 0])))
_DITA = '<html lang="en_US"><head><title>T@@ - Product</title><meta name="DC.type" content="{0}"/></head><body><article><p>x</p></article></body></html>'
page(
    "flt7_no_topic_type", lambda html: _converted(html, True),
    (_DITA.replace("{0}", "concept"), json.dumps(["T@@", "concept", None, "x\n", 0])), (_DITA.replace("{0}", ""), json.dumps(["T@@", "", "no-topic-type", None, 0])),
)
page(
    "prj11_dita_metadata", lambda html: json.dumps(convert.dita_metadata(parse(html)), sort_keys=True),
    (
        '<html lang="pt_BR"><head><title>T@@ - P - Q</title><meta name="DC.type" content="task"/><meta name="DC.identifier" content="GUID-@@"/><meta name="abstract" content="A"/></head>'
        '<body><div id="breadcrumbs"><span class="crumb">Home</span><span class="crumb">Guide</span><span class="crumb">T@@</span></div></body></html>',
        json.dumps({"description": "A", "guid": "GUID-@@", "lang": "pt-br", "title": "T@@", "toc_path": "Guide|T@@", "topic_type": "task"}),
    ),
    ('<html><head><meta name="description" content="d@@"/></head></html>', json.dumps({"description": "d@@", "guid": "", "lang": "en-us", "title": "", "toc_path": "", "topic_type": ""})),
)
page("prj15_index_or_urlset", lambda xml: "index" if "<sitemapindex" in xml else "urlset", ('<?xml version="1.0"?><sitemapindex>@@</sitemapindex>', "index"), ("<urlset>@@</urlset>", "urlset"))

# Front matter.
page(
    "snk2_front_matter", lambda x: convert.front_matter(json.loads(x)),
    ('{"title": "T@@", "lang": "", "n": 0, "none": null, "flag": false}', "---\nn: 0\ntitle: T@@\n---\n\n"), ('{"b": "é@@", "a": ["x", "y"]}', "---\na:\n- x\n- y\nb: é@@\n---\n\n"),
)
page(
    "snk3_rewritten_front_matter", lambda x: convert.rewrite_front_matter(x, {"csh_ids": [1000]}),
    ("---\ntitle: t@@\n---\n\n\nbody", "---\ncsh_ids:\n- 1000\ntitle: t@@\n---\n\nbody"), ("no head @@", "---\ncsh_ids:\n- 1000\n---\n\nno head @@"),
)
page(
    "src39_front_matter", lambda x: json.dumps(convert.read_front_matter(x)),
    ("---\ntitle: t@@\nn: 1\n---\nbody @@", json.dumps([{"title": "t@@", "n": 1}, "body @@"])), ("plain @@", json.dumps([{}, "plain @@"])), ("---\na: [\n---\nx@@", json.dumps([{}, "---\na: [\n---\nx@@"])), ("---\nopen @@", json.dumps([{}, "---\nopen @@"])),
)

# Scripts and lists.
page("src29_toc_tree", lambda x: str(scripts.toc_tree(x)), ("define({a:1,tree:{n:[{i:@@,c:0,n:[{i:7,c:0}]},{i:9,c:1}]}})", "[(@@, None, 0, 0), (7, 0, 1, 1), (9, None, 2, 0)]"), ("define({{}})", "[]"), ("tree:{n:[{i:@@", "[]"))
page(
    "src30_contexts", lambda x: json.dumps(scripts.contexts(x), sort_keys=True),
    ('var a; suitehelp.contexts = {"C@@": "p.html#a", "D": "q}.html"};', json.dumps({"C@@": "p.html#a", "D": "q}.html"})), ("suitehelp.contexts = {broken@@", "{}"),
)
page("src31_toc_html", scripts.toc_html, ('suitehelp.toc = {"toc": "<nav><ul><li>@@</li></ul></nav>"};', "<nav><ul><li>@@</li></ul></nav>"), ("nothing @@", ""))
_LIST = '<ul><li><a href="%APPROOT%a@@.html">A</a><ul><li><a href="b.html">B</a></li></ul></li><li>no link<ul><li><a href="c.html">C</a></li></ul></li><li><a href="d.html"> D  d </a></li></ul>'
_LISTED = "[('a@@.html', 'A', [], 0), ('b.html', 'B', ['A'], 1), ('d.html', 'D d', [], 0)]"
page("src32_topic_list", lambda x: str(scripts.nested_list(x)), (_LIST, _LISTED), ("<p>@@</p>", "[]"))
page("hie5_nav_walk", lambda x: str(scripts.nested_list(scripts.toc_html(x))), (f"suitehelp.toc = {json.dumps({'toc': '<nav>' + _LIST + '</nav>'})};", _LISTED), ("suitehelp.toc = {{}};", "[]"))
page("hie6_topic_list_walk", lambda x: str([(h, "|".join([*up, t]), d) for h, t, up, d in scripts.nested_list(x)]), (_LIST, "[('a@@.html', 'A', 0), ('b.html', 'A|B', 1), ('d.html', 'D d', 0)]"), ("<ul></ul>@@", "[]"))
page("src34_guides", lambda x: str(scripts.guides(x)), ('<div><a href="../G@@/x.htm">1</a><a href="H/y.htm">2</a><a href="../G@@/z.htm">3</a></div>', "['G@@', 'H']"), ("<p><a href='x/@@'>n</a></p>", "[]"))
page("src35_file_index", lambda x: str(scripts.file_index(x)), ('<a href="a@@.htm" title="T">x</a><a name="n">y</a><a href="b.htm"> B  b </a>', "[('a@@.htm', 'T'), ('b.htm', 'B b')]"), ("<p>@@</p>", "[]"))
page("fn11_balanced", lambda x: scripts.balanced(x, 0, "[", "]", strings=True), ("[a[@@]b]c", "[a[@@]b]"), ("['x]@@']y", "['x]@@']"), ("[open @@", ""))

# WebWorks.
page(
    "ww1_inline", lambda x: webworks.inline(parse(x)),
    ('a <span class="Bold">b@@</span> <span class="CodeItalic">c</span>', "a **b@@** _c_"), ('<a href="a.htm">t@@</a> <a href="a.htm#x">u</a>', "[t@@](a.md) [u](a.htm#x)"), ("x<br/>@@\n y", "x  \n@@ y"), ('<img alt="i" src="@@.png"/>', "![i](@@.png)"),
)
page(
    "ww2_list_items", lambda x: str(webworks._list_item(parse(x).all("table")[0])),
    ("<table><tr><td>@@.</td><td> do  it </td></tr></table>", "('@@', 'do it')"), ("<table><tr><td>-</td><td>x@@</td></tr></table>", "('1', 'x@@')"),
)
page(
    "ww3_content_table", lambda x: webworks.content_table(parse(x).all("table")[0]),
    ("<table><tr><td>a|b</td><td>@@</td></tr><tr><td>c</td></tr></table>", "| a\\|b | @@ |\n| --- | --- |\n| c |  |"), ("<table><tr><td><ul><li>@@</li></ul></td></tr></table>", "<table><tr><td><ul><li>@@</li></ul></td></tr></table>"),
)
page(
    "ww4_blocks", lambda x: webworks.blocks(parse(x)),
    ('<div class="Code">l1</div><div class="Code">l@@</div>', "```\n\nl1\n\nl@@\n\n```"), ('<div class="MinorHead">M@@</div><p>b</p>', "## M@@\n\nb"), ('<div class="N3Heading">H@@</div><div class="NoteText">n</div>', "### H@@\n\n> **Note:** n"),
    ('<div class="Bullet_outer"><table><tr><td>-</td><td>x@@</td></tr></table></div>', "- x@@"), ('<div class="Step_outer"><table><tr><td>2</td><td>y@@</td></tr></table></div>', "2. y@@"), ("<ol><li>a</li><li>@@</li></ol>", "1. a\n\n2. @@"),
)
page(
    "ww5_convert_file", lambda x: json.dumps(webworks.convert_file(x)),
    ("<html><head><title> T  @@</title></head><body><blockquote><p>x</p></blockquote></body></html>", json.dumps(["T @@", "x\n"])), ("<html><body><p>@@</p></body></html>", json.dumps(["", None])),
)
page(
    "hie8_webworks_toc", lambda x: str(webworks.toc_rows(x)),
    ('<WebWorksHelpTOC><i t="A@@" l="0#a"><i t="B" l="1"/></i><i t="C"/></WebWorksHelpTOC>', "[([0], 'A@@', '0#a'), ([0, 0], 'B', '1'), ([1], 'C', '')]"), ("<broken @@", "[]"),
)


# Spans and lines of release notes.
def _span(f: Callable[[Column, Column, Column], Column]) -> Callable[[Column], Column]:
    part = lambda x, k: F.split_part(x, F.lit("|"), F.lit(k))
    return lambda x: f(part(x, 1), part(x, 2).cast("double"), part(x, 3)).cast("string")


column(
    "pdf1_glyph_span", _span(pdf.is_glyph),
    ("Wingdings-Regular|12|@@", "true"), ("CourierNew|8|o", "true"), ("ABC+Courier|9.5|\u25aa", "true"), ("CourierNew|10|o", "false"), ("CourierNew|8|x@@", "false"), ("Symbol2|9|s", "true"), ("Helvetica|8|\u2022", "false"), ("Webdings|8|@@", "false"),
)
column(
    "pdf2_code_span", _span(pdf.is_code),
    ("SourceCodePro|9|@@", "true"), ("Menlo|9|@@", "true"), ("ABC+LucidaConsole|9|@@", "true"), ("CourierNew|10|@@", "false"), ("DejaVuSansMono|9|@@", "true"), ("Inconsolata|7|o", "true"), ("Wingdings-Mono|9|@@", "false"), ("Helvetica|9|@@", "false"),
)
column("pdf3_bold", lambda x: pdf.is_bold(F.length(x)).cast("string"), ("x" * 16, "true"), ("x" * 15, "false"), ("x" * 20, "true"), ("x" * 32, "false"))
column("pdf4_meaningful", lambda x: (~x.rlike(r"^(?U:\s|\u00a0)*$")).cast("string"), ("a @@", "true"), (" \u00a0 ", "false"), ("", "false"), ("\t\n", "false"))


def _class(x: Column) -> Column:
    part = lambda k: F.split_part(x, F.lit("|"), F.lit(k))
    first = F.when(part(1) != "", F.struct(part(1).alias("font"), part(2).cast("double").alias("size"), part(3).cast("int").alias("flags"), part(4).alias("text")))
    return pdf.block_class(first, part(5) == "b", F.lit(10.0), part(4))


column(
    "pdf5_block_class", _class,
    ("Arial|15|0|T@@|", "h1"), ("Arial|12|0|T@@|", "h2"), ("Arial|11.9|0|T@@|", "body"), ("Arial|10|16|Short label @@|", "h3"), ("Arial|10|16|Ends here @@.|", "body"), ("Wingdings|10|0|x|r", "bullet"), ("Wingdings|10|0|x|b", "h3"),
    ("CourierNew|8|0|o|", "sub_bullet"), ("|0|0||", "skip"), ("Arial|8|16|small @@|", "body"),
)
page(
    "pdf9_render_table", lambda x: pdf.render_table(json.loads(x)),
    ('[["a|b", null], ["@@", "d", "e"]]', "| a\\|b |  |  |\n| --- | --- | --- |\n| @@ | d | e |"), ('[["h"], ["l1\\nl@@"]]', "<table><tr><th>h</th></tr><tr><td>l1<br/>l@@</td></tr></table>"), ("[]", ""),
)
page(
    "pdf13_table_rows", lambda x: "\n".join(pdf.table_rows(x.split("\n"))),
    ("GS-12 one\ntwo @@\n# H", "| Key | Summary |\n| --- | --- |\n| GS-12 | one two @@ |\n\n# H"), ("text @@\n\nGS-1 a\n\nGS-2 b", "text @@\n\n| Key | Summary |\n| --- | --- |\n| GS-1 | a |\n| GS-2 | b |"),
    ("| SOAP API | REST API |\n| --- | --- |\ncom.x.A@@ com.x.B\n\ncom.x.C com.x.D\n- item\nplain words", "| SOAP API | REST API |\n| --- | --- |\n| com.x.A@@ | com.x.B |\n| com.x.C | com.x.D |\n- item\nplain words"),
    ("| Key | Summary |\n| --- | --- |\nGS-3 z@@\ngoes on\n| x |", "| Key | Summary |\n| --- | --- |\n| GS-3 | z@@ goes on |\n| x |"), ("a\n\nb @@", "a\n\nb @@"),
)
page(
    "pdf14_boilerplate", lambda x: pdf.cut_boilerplate(x, ("Legal Notices",)),
    ("# A\n\nx@@\n\n\n\ny\n\n# Legal Notices\n\nz", "# A\n\nx@@\n\ny\n"), ("# A\n## Legal Notices\nx@@", "# A\n## Legal Notices\nx@@\n"),
)


# Ordered steps.
def _steps(x: str) -> str:
    """``keys/first/last``; a step whose key is negative fails."""
    keys, first, last = x.split("/")

    def step(k: float) -> Step:
        def run(tables):
            if k < 0:
                raise ValueError(f"step {k:g}")
            return {"t": [*tables["t"], k]}

        return Step(abs(k), f"s{abs(k):g}", run)

    out = run_steps([step(float(k)) for k in keys.split(",")], {"t": []}, float(first) if first else None, float(last) if last else None)
    return f"{','.join(out.done)} {out.hint or 'ok'}"


page(
    "orc1_step_range", _steps,
    ("3,1,2/1/2", "s1,s2 ok"), ("1,2.5,3/2/", "s2.5,s3 ok"), ("1,-2,3//", "s1 resume with first=2"), ("@@//", "s@@ ok"), ("1,2/5/", " ok"),
)


def _pipelines(x: str) -> str:
    outcomes, good = run_all({n: [Step(1, n, (lambda bad: lambda t: 1 / 0 if bad else {})(mark == "-"))] for n, mark in (p.split(":") for p in x.split(","))}, {})
    return f"{','.join(n for n, o in outcomes.items() if o.ok)} {good}"


page("orc2_sub_pipelines", _pipelines, ("dita:-,pdf:+,webworks:+", "pdf,webworks False"), ("dita:+,pdf:+", "dita,pdf True"), ("pdf:-", " False"))


def _dry(x: str) -> str:
    stored: list[str] = []
    out = run_steps([Step(1, "a", lambda t: {"k": x})], {}, sink=lambda k, v: stored.append(k) or v, dry_run=x.startswith("dry"))
    return f"{out.tables['k']} {len(stored)}"


page("orc5_dry_run", _dry, ("dry@@", "dry@@ 0"), ("wet@@", "wet@@ 1"))


# Whole pages, and release notes.
def _pages(rows: DataFrame) -> DataFrame:
    return convert.convert_pages(rows.select(F.col("doc_id").alias("page_id"), F.concat(F.lit("https://h/p/"), "doc_id", F.lit(".htm")).alias("url"), F.col("given").alias("html")), S)


_WHOLE = [
    (_TOPIC.format("task", "T @@", '<h1>H</h1><p>a <a href="b.htm">b</a><img src="i.png"/></p>'), "T @@|-|# H\n\na [b](b.htm)![](i.png)\n|1|1"),
    (_TOPIC.format("x", "U", "<table><tr><th>h</th></tr><tr><td><ul><li>@@</li></ul></td></tr></table><p>end</p>"), "U|-|<table><tr><th>h</th></tr><tr><td><ul><li>@@</li></ul></td></tr></table>\n\nend\n|0|0"),
    ("<html><head><title>t@@</title></head><body>no content</body></html>", "t@@|no-content||0|0"), ("", "|no-content||0|0"),
]
_register(
    "htm18_page_conversion", _WHOLE,
    lambda rows: _pages(rows).select(
        F.col("page_id").alias("doc_id"), F.concat_ws("|", F.coalesce("title", F.lit("")), F.coalesce("skipped", F.lit("-")), F.coalesce("body", F.lit("")), F.coalesce(F.size("links"), F.lit(0)).cast("string"), F.coalesce(F.size("images"), F.lit(0)).cast("string")).alias("value")
    ),
)
_register(
    "snk1_written_documents", [(_TOPIC.format("concept", "T: @@", "<p>x</p>"), "---\nlang: en-us\nsource_url: https://h/p/@@.htm\ntitle: 'T: @@'\ntopic_type: concept\n---\n\nx\n"), (_TOPIC.format("x", "U", "<h2>@@</h2>"), "---\nlang: en-us\nsource_url: https://h/p/@@.htm\ntitle: U\n---\n\n## @@\n")],
    lambda rows: convert.documents(_pages(rows)).select(F.regexp_extract("output_path", r"(\d+)\.md$", 1).cast("bigint").alias("doc_id"), F.col("document").alias("value")),
)


def _notes(rows: DataFrame) -> DataFrame:
    """``page/size/flags/font/text`` by line, each a block of its own; the document's number is the file."""
    line = F.split("line", "/")
    part = lambda k: F.get(line, F.lit(k))
    y = (100 + 30 * F.col("i")).cast("double")
    spans = rows.select("doc_id", F.posexplode(F.split("given", "\n")).alias("i", "line")).select(
        F.col("doc_id").alias("doc"), part(0).cast("int").alias("page"), F.lit(800.0).alias("page_h"), F.col("i").alias("block"), F.lit(50.0).alias("block_x0"), y.alias("block_y0"), (y + 10).alias("block_y1"), F.lit(0).alias("line"),
        y.alias("line_y"), F.lit(0).alias("span"), part(4).alias("text"), part(3).alias("font"), part(1).cast("double").alias("size"), part(2).cast("int").alias("flags"), F.lit(50.0).alias("x0"), F.lit(90.0).alias("x1"),
    )
    return pdf.convert(spans).select(F.col("doc").alias("doc_id"), F.col("body").alias("value"))


_COVER = "0/20/0/Arial/Cover @@\n"
_register(
    "pdf12_page_join",
    [
        (_COVER + "1/15/0/Arial/Title @@\n1/10/0/Arial/first page text here\n2/10/0/Arial/second page text\n2/10/0/Wingdings/x", "# Title @@\n\nfirst page text here\n\nsecond page text\n"),
        (_COVER + "1/10/0/Arial/Intro 3\n1/10/0/Arial/Setup 5\n1/10/0/Arial/Use 9\n2/10/0/Arial/GS-1 one @@\n2/10/0/Arial/goes on\n3/15/0/Arial/Next", "| Key | Summary |\n| --- | --- |\n| GS-1 | one @@ goes on |\n\n# Next\n"),
    ],
    _notes,
)
