import io
import zipfile

from pyspark.sql import functions as F

from docloom.operators import csh, links, pdf, rename, report, toc
from docloom.plans.runner import Step, run_all, run_steps
from docloom.sources import files, scripts, sitemaps
from docloom.streaming.incremental import run_incrementally


def test_links(spark):
    body = "[t](y.htm) and [t](../B/z.htm#s), [t](Sub/w.html) [t](none.htm) [t](#a) [t](mailto:a@b) [t](f.pdf) [t](https://other/y.htm) ![i](p.png)"
    rows = [(1, "https://h/pub/p/A/x.htm", "pub/p/A/x.md", body), (2, "https://h/pub/p/A/y.htm", "pub/p/A/y.md", "none"), (3, "https://h/pub/p/B/Z.htm", "pub/p/B/Z.md", ""), (4, "https://h/pub/p/A/Sub/w.html", "pub/p/A/Sub/w.md", None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, output_path string, body string")
    index = links.link_index(pages)
    found = {r.page_id: r for r in links.rewrite(pages, index).collect()}
    assert found[1].body == "[t](y.md) and [t](../B/Z.md#s), [t](Sub/w.md) [t](none.htm) [t](#a) [t](mailto:a@b) [t](f.pdf) [t](https://other/y.htm) ![i](p.png)"
    assert (found[1].n_resolved, found[1].n_unresolved) == (3, 1) and found[2].body == "none"


def test_tree(spark):
    rows = [("v", 1, "d/a.md", "p1", "A"), ("v", 2, "d/b.md", "p2", "A|B"), ("v", 3, "d/c.md", "p1", "A"), ("v", 4, "e/x.md", "p", "A"), ("v", 5, "e/d.md", "p3", None), ("v", 6, "f/e.md", "p4", None), ("v", 7, "g/f.md", "", None)]
    pages = spark.createDataFrame(rows, "version string, ord int, output_path string, title string, toc_path string")
    paths = toc.page_paths(pages)
    nodes = toc.preorder(toc.tree_nodes(paths)).orderBy("position").collect()
    assert ["/".join(n.path) for n in nodes] == ["A", "A/p1", "A/B", "A/B/p2", "A/p", "A/p3", "p4"] and nodes[1].file == "d/c.md" and nodes[0].file is None
    assert [r.output_path for r in toc.orphans(paths).collect()] == ["g/f.md"]
    assert {n.depth for n in nodes} == {0, 1, 2}
    nested = files.nest(toc.tree_nodes(paths)).first().json
    assert nested.startswith('[{"title": "A", "file": null, "children": [{"title": "p1"')


def test_compare(spark):
    def order(names):
        return spark.createDataFrame([("v", x, i, 0) for i, x in enumerate(names)], "version string, url string, position int, depth int")

    row = toc.compare(order("abcd"), order("acbd")).first()
    assert abs(row.sequence_accuracy - 5 / 6) < 1e-9 and (row.matched, row.missing, row.extra, row.wrong_depth) == (4, 0, 0, 0)
    assert toc.compare(order("abcd"), order("abcd")).first().sequence_accuracy == 1 and toc.compare(order("a"), order("ab")).first().sequence_accuracy == 1
    assert toc.compare(order("abc"), order("cba")).first().sequence_accuracy == 0


def test_help_maps(spark):
    alias = spark.createDataFrame([("v", 1, "T1", "A/x.htm", 1000), ("v", 2, "T2", "A/x.htm#k", None), ("v", 3, "T3", "A/y.htm", 1000)], "version string, ord int, name string, link string, resolved_id int")
    pages = spark.createDataFrame([("v", "A/x.htm", "A/x.md"), ("v", "a/Y.htm", "A/y.md")], "version string, rel_path string, output_path string")
    found = {r.output_path: (r.csh_ids, r.csh_names) for r in csh.alias_pages(alias, pages).collect()}
    assert found == {"A/x.md": ([1000], ["T1", "T2"]), "A/y.md": ([1000], ["T3"])}
    made = csh.alias_map(alias)
    assert [tuple(r) for r in made.collect()] == [("v", 1000, "T3", "A/y.htm")]
    assert csh.as_json(made, "csh_id", "csh_name", "file").first().json == '{"1000":{"csh_name":"T3","file":"A/y.htm"}}'
    contexts = spark.createDataFrame([("v", "C1", "GUID-1.html#a"), ("v", "C2", "no.html")], "version string, name string, target string")
    renames = spark.createDataFrame([("v", "GUID-1.html", "topic-one.html")], "version string, guid string, slug string")
    out = spark.createDataFrame([("v", "topic-one.md", "out/topic-one.md")], "version string, rel_path string, output_path string")
    good, bad = csh.context_map(contexts, out, renames)
    assert [tuple(r) for r in good.collect()] == [("v", None, "C1", "out/topic-one.md", "a")] and bad.first().name == "C2"


def test_renames(spark):
    assert rename.free_slugs(["x", "x-2", "x"]) == ["x", "x-2", "x-3"] and rename.free_slugs(["a"] * 3) == ["a", "a-2", "a-3"]
    topics = spark.createDataFrame([("v", "f", "GUID-2.html", "Create_Sheets", ""), ("v", "f", "GUID-1.html", "", "Create Sheets - Guide"), ("v", "f", "GUID-3.html", "", "")], "version string, folder string, guid string, list_title string, page_title string")
    assert {r.guid: r.slug for r in rename.topic_renames(topics).collect()} == {"GUID-1.html": "create-sheets", "GUID-2.html": "create-sheets-2", "GUID-3.html": "guid-3"}
    images = spark.createDataFrame([("v", "G1.png", "Link Activity", 1), ("v", "G1.png", "other", 2), ("v", "G1.png", "Link Activity", 3), ("v", "G2.png", "image", 4), ("v", "G3.png", "Link activity", 5)], "version string, image string, alt string, ord int")
    assert {r.image: r.name for r in rename.image_renames(images).collect()} == {"G1.png": "link-activity.png", "G2.png": "G2.png", "G3.png": "link-activity-2.png"}


def test_scripts(spark):
    assert scripts.toc_tree("define({numchunks:1,tree:{n:[{i:0,c:0,n:[{i:2,c:0}]},{i:1,c:0}]}})") == [(0, None, 0, 0), (2, 0, 1, 1), (1, None, 2, 0)] and scripts.toc_tree("x") == []
    assert scripts.contexts('suitehelp.contexts = {"C":"p.html#a}", "D":"q"};') == {"C": "p.html#a}", "D": "q"} and scripts.contexts("suitehelp.contexts = {bad") == {}
    assert scripts.nested_list("<nav><ul><li><a href='%APPROOT%a.html'>A</a><ul><li><a href='b.html'>B</a></li><li>no link</li></ul></li></ul></nav>") == [("a.html", "A", [], 0), ("b.html", "B", ["A"], 1)]
    chunk = spark.createDataFrame([("v", "c1", r"define({'/p.htm':{i:[7],t:['It\'s'],b:['']},'/q.pdf':{i:[8],t:['Q'],b:['']}})"), ("v", "c2", "define({'/r.html':{i:[7],t:['R'],b:['']}})")], "version string, name string, text string")
    assert [tuple(r) for r in scripts.chunk_entries(chunk).collect()] == [("v", 7, "/r.html", "R")]
    assert [tuple(r) for r in scripts.chunk_entries(chunk.where("name = 'c1'")).collect()] == [("v", 7, "/p.htm", "It's")]
    ctx = spark.createDataFrame([("v", "ctx/help0042.htm", 'x="index.htm?context=G&topic=T1"')], "version string, path string, text string")
    assert [tuple(r) for r in scripts.redirects(ctx).collect()] == [("v", 42, "G", "T1")]
    scripts.register(spark)
    assert spark.sql("SELECT node_id, depth FROM toc_tree('tree:{n:[{i:5,c:0}]}')").collect() == [(5, 0)]
    assert scripts.guides("<div><a href='../g1/x.htm'>1</a></div><div><a href='g2/y.htm'>2</a></div>") == ["g1", "g2"] and scripts.file_index("<a href='a.htm' title='T'>x</a>") == [("a.htm", "T")]


def test_xml_sources(spark, tmp_path):
    (tmp_path / "l2.xml").write_bytes(b"\xef\xbb\xbf<sitemapindex xmlns='http://a/0.9'><sitemap><loc> https://h/v1.xml </loc></sitemap><sitemap><loc>https://h/v1.xml</loc></sitemap><sitemap><loc>https://h/v2.xml</loc></sitemap></sitemapindex>")
    (tmp_path / "l3.xml").write_text("<urlset xmlns='http://a/0.9' xmlns:m='http://m'><url><loc>https://h/a.htm</loc><lastmod>2024-01-02</lastmod><m:metadata><m:name>P</m:name><m:productversion>1.0</m:productversion><m:d_name>D</m:d_name></m:metadata></url><url><lastmod>x</lastmod></url></urlset>")
    (tmp_path / "alias.xml").write_text("<CatapultAliasFile><Map Name='T' Link='/a.htm' ResolvedId='12'/><Map Name='U' Link='/b.htm' ResolvedId='x'/><Map Name='V' ResolvedId='1'/></CatapultAliasFile>")
    assert [r.loc for r in sitemaps.index_entries(spark, str(tmp_path / "l2.xml")).orderBy("ord").collect()] == ["https://h/v1.xml", "https://h/v2.xml"]
    rows = sitemaps.url_entries(spark, str(tmp_path / "l3.xml")).collect()
    assert len(rows) == 1 and (rows[0].product_name, rows[0].product_version, rows[0].doc_name, rows[0].lastmod) == ("P", "1.0", "D", "2024-01-02")
    assert [(r.name, r.resolved_id) for r in sitemaps.alias_entries(spark, str(tmp_path / "alias.xml")).orderBy("ord").collect()] == [("T", 12), ("U", None)]


def test_archives(spark, tmp_path):
    def packed(names):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for n in names:
                z.writestr(n, n)
        return bytearray(out.getvalue())

    rows = [(packed(["top/html/a.htm", "top/b.txt"]), "pub/p/1.0/doc/html/"), (packed(["x/a", "../../../../evil"]), "pub/p/1.0/doc/html/"), (bytearray(b"no zip"), "pub/q/html/")]
    found = {(r.path, r.error) for r in files.expand_archives(spark.createDataFrame(rows, "content binary, html_root string")).collect()}
    assert ("pub/p/1.0/doc/html/a.htm", None) in found and ("pub/p/1.0/doc/b.txt", None) in found and ("../../../../evil", "outside-root") in found and ("pub/q", "corrupt_zip") in found
    notes = spark.createDataFrame([("x/doc/pdf/ABC_foo_bar_1.2.3_relnotes.pdf",), ("x/doc/pdf/other.pdf",)], "path string")
    assert [tuple(r)[1:] for r in files.release_notes(notes).collect()] == [("foo_bar", "1.2.3", "relnotes")]
    files.write_new(spark.range(3).toDF("id"), str(tmp_path / "t"), "id")
    files.write_new(spark.range(5).toDF("id"), str(tmp_path / "t"), "id")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 5
    assert files.read_json_or_empty(spark, str(tmp_path / "none.json"), "a int").collect() == []


def _span(page, block, y, text, size=10.0, flags=0, font="Helvetica", x=50.0, span=0):
    return ("d", page, 800.0, block, x, float(y), float(y) + 10, 0, float(y), span, text, font, size, flags, x + span * 5, x + span * 5 + 4)


def test_release_notes(spark):
    schema = "doc string, page int, page_h double, block bigint, block_x0 double, block_y0 double, block_y1 double, line int, line_y double, span int, text string, font string, size double, flags int, x0 double, x1 double"
    rows = [_span(0, 0, 300, "Cover")]
    rows += [_span(1, i, 100 + 20 * i, t) for i, t in enumerate(["Contents", "Intro 3", "Setup 5"])]
    rows += [_span(2, 0, 100, "Big", 15.0), _span(2, 1, 130, "Mid", 12.0), _span(2, 2, 150, "Short label", 10.0, 16), _span(2, 3, 170, "Ends here.", 10.0, 16), _span(2, 4, 190, "plain body text here")]
    rows += [_span(2, 5, 210, "l", 10.0, 0, "Wingdings"), _span(2, 5, 210, "item", span=2), _span(2, 6, 20, "header"), _span(2, 7, 240, "GS-12 one"), _span(2, 8, 260, "two")]
    spans = spark.createDataFrame(rows, schema)
    assert pdf.body_size(spans).first().body == 10.0
    kinds = {r.block: (r.kind, r.text) for r in pdf.blocks(spans).where("page = 2").collect()}
    assert [kinds[i][0] for i in range(6)] == ["h1", "h2", "h3", "body", "body", "bullet"] and kinds[5][1] == "item" and 6 not in kinds
    body = pdf.convert(spans).first().body
    assert body.startswith("# Big\n\n## Mid\n\n### Short label\n\nEnds here.") and "- item" in body and "| GS-12 | one two |" in body and "Cover" not in body and "Setup" not in body
    assert pdf.table_rows(["GS-12 one", "two", "# H"]) == ["| Key | Summary |", "| --- | --- |", "| GS-12 | one two |", "", "# H"]
    assert pdf.cut_boilerplate("# A\nx\n# Legal\ny", ("Legal",)) == "# A\nx\n" and pdf.render_table([["a", "b"], ["1", None]]) == "| a | b |\n| --- | --- |\n| 1 |  |"


def test_reports(spark):
    rows = spark.createDataFrame([({"a": 1, "b": 2}, None, None), ({"a": 3}, "E", None), (None, None, "skip")], "stats map<string,int>, error string, skipped string")
    row = report.step_report("convert", rows).first()
    assert dict(row["counts"]) == {"a": 4, "b": 2} and (row.rows, row.error_count, row.skip_count) == (3, 1, 1)
    runs = spark.createDataFrame([("s", "2024", 1), ("s", "2025", 2)], "step string, started_at string, n int")
    assert report.latest(runs).first().n == 2


def test_runner(spark):
    def fail(tables):
        raise ValueError("no")

    steps = [Step(2, "two", lambda t: {"b": t["a"].withColumn("x", F.lit(1))}), Step(1, "one", lambda t: {"a": spark.range(3)}), Step(3, "three", fail), Step(4, "four", lambda t: {})]
    out = run_steps(steps, {})
    assert out.done == ["one", "two"] and not out.ok and out.hint == "resume with first=3" and out.tables["b"].count() == 3
    assert run_steps(steps, {"a": spark.range(1)}, first=2, last=2).ok
    outcomes, ok = run_all({"x": steps, "y": steps[:2]}, {})
    assert not ok and outcomes["y"].ok


def test_incremental(spark, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.range(4).write.parquet(source)
    for extra in (None, 7):
        if extra:
            spark.range(2, extra).write.mode("append").parquet(source)
        run_incrementally(spark, source, "id bigint", sink, state, lambda b: b.withColumn("twice", F.col("id") * 2), "id")
    assert sorted(r.id for r in spark.read.parquet(sink).collect()) == list(range(7))


def test_free_slugs_equal_the_exact_rule(spark):
    """Families of one slug are numbered natively, mixed ones by the rule itself: both give what the rule gives for the whole folder."""
    import random

    from docloom.operators import rename

    r = random.Random(2)
    rows = [(f"k{i % 3}", i, r.choice(["x", "x-2", "x-3", "x-2-2", "y", "y-z", "topic", "y-10"] if i % 3 else ["x", "y"])) for i in range(300)]
    found = rename.with_free_slugs(spark.createDataFrame(rows, "folder string, n int, slug string").repartition(5), ["folder"], "n").collect()
    for k in ("k0", "k1", "k2"):
        own = sorted((n, s) for f, n, s in rows if f == k)
        want = dict(zip([n for n, _ in own], rename.free_slugs([s for _, s in own]), strict=True))
        assert {x.n: x.slug for x in found if x.folder == k} == want and len(set(want.values())) == len(want)


def test_preorder_equals_a_walk(spark):
    import random

    from docloom.operators import toc

    r = random.Random(3)
    paths = {("a",)}
    for i in range(200):
        up = r.choice(sorted(paths))
        paths.add((*up, f"n{r.randrange(4)}") if len(up) < 6 and i % 9 else (f"t{i}",))
    nodes = [("v", list(p), r.randrange(5), p[-1]) for p in sorted(paths)]
    below = {}
    for _, p, o, t in nodes:
        below.setdefault(tuple(p[:-1]), []).append((o, t, tuple(p)))
    want, stack = [], [x[2] for x in sorted(below[()], reverse=True)]
    while stack:
        p = stack.pop()
        want.append(p)
        stack += [x[2] for x in sorted(below.get(p, ()), reverse=True)]
    found = toc.preorder(spark.createDataFrame(nodes, "version string, path array<string>, ord int, title string")).collect()
    assert [tuple(x.path) for x in sorted(found, key=lambda x: x.position)] == want and sorted(x.position for x in found) == list(range(1, len(nodes) + 1))


def test_notes_meet_products_by_slug(spark):
    paths = ["pub/foo/", "pub/foo-bar/", "foo", "", "xfoox", None, "pub/bar/foo/"]
    products = [(v, f"{v}{i}", p, 10 - i) for v in "ab" for i, p in enumerate(paths)]
    slugs = ["foo", "foo-bar", "bar/", "", "a slug longer than any of the paths", "oo", "zz"]
    notes = [(f"n{i}", s, v, "relnotes") for v in "abc" for i, s in enumerate(slugs)] + [("n0", "foo", "a", "relnotes")]
    left = spark.createDataFrame(notes, "path string, slug string, version string, doc string")
    right = spark.createDataFrame(products, "product_version string, product_name string, path_slug string, ord int")
    made = files.match_products(left, right)
    want = [(path, slug, v, doc, min([(o, n) for pv, n, p, o in products if pv == v and p is not None and slug in p], default=(0, None))[1]) for path, slug, v, doc in notes]
    key = lambda r: tuple(x or "" for x in r)
    assert sorted(map(tuple, made.collect()), key=key) == sorted(want, key=key)
    # A join by the version alone would pair each note with each product.
    joins = [x for x in made._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftOuter" in x]
    assert len(joins) == 1 and "slug#" in joins[0]


def test_rows_without_a_slug_are_kept(spark):
    rows = [("a", 1, "x"), ("a", 2, None), ("a", 3, "x-2"), ("a", 4, "x"), ("a", 5, None), ("b", 6, None)]
    found = rename.with_free_slugs(spark.createDataFrame(rows, "folder string, n int, slug string"), ["folder"], "n").collect()
    assert {r.n: r.slug for r in found} == {1: "x", 2: None, 3: "x-2", 4: "x-3", 5: None, 6: None}


def test_products_of_one_name_are_in_order_of_slug(spark):
    products = [(f"s{k * 37 % 101:03}", ("", "P", "p")[k % 3], f"l{k}") for k in range(101)]
    rows = spark.createDataFrame(products, "product_slug string, product_name string, l2_sitemap_url string").repartition(7)
    none = spark.createDataFrame([], "l2_sitemap_url string, ord int, product_version string, product_name string")
    found = [r.product_slug for r in report.product_list(rows, none).collect()]
    assert found == [s for s, _, _ in sorted(products, key=lambda r: ((r[1] or r[0]).lower(), r[0]))]


def test_kept_links_are_dealt_over_tasks(spark):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.format_string("https://h/pub/p%d.htm", "id").alias("url"), F.format_string("mailto:a@b%d", "id").alias("href"))
    index = links.link_index(pages.select("page_id", "url", F.format_string("pub/p%d.md", "page_id").alias("output_path")), order="page_id")
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        rows = links.resolve_links(pages, index).groupBy(F.spark_partition_id().alias("task"), "status").count().collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert {r.status for r in rows} == {"kept"} and sum(r["count"] for r in rows) == 3000 and max(r["count"] for r in rows) < 600


def test_release_notes_of_many_documents(spark):
    schema = "doc string, page int, page_h double, block bigint, block_x0 double, block_y0 double, block_y1 double, line int, line_y double, span int, text string, font string, size double, flags int, x0 double, x1 double"
    rows, want = [], {}
    for k in range(12):
        own = [_span(0, 0, 300, "Cover"), _span(1, 0, 100, "Same head", flags=16), _span(1, 1, 130, f"text {k} of one.")]
        own += [_span(2, i, 100 + 30 * i, t) for i, t in enumerate(["Intro 3", "Setup 5", f"Use {k + 10}"])] if k % 2 else []
        own += [_span(3, 0, 100, "Same head", flags=16)] + [x for i in range(k) for x in (_span(3, i + 1, 130 + 30 * i, "l", font="Wingdings"), _span(3, i + 1, 130 + 30 * i, f"item {i}.", span=2))]
        rows += [(f"d{k}", *r[1:]) for r in own]
        want[f"d{k}"] = f"text {k} of one.\n" + ("\n" + "".join(f"- item {i}.\n" for i in range(k)) if k else "")
    made = pdf.convert(spark.createDataFrame(rows, schema).repartition(5))
    assert {r.doc: r.body for r in made.collect()} == want
    # Documents go through Python in batches, not in a call and a frame each.
    assert "FlatMapGroups" not in made._jdf.queryExecution().optimizedPlan().toString()
