"""Queries over sources and sinks: each writes small files made of the test tables, reads them through the engine and states in SQL what must be in them."""

from __future__ import annotations

import io
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config
from .operators import csh, manifest, report, toc, webworks
from .sources import files, scripts, sitemaps

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str):
    def add(f):
        QUERIES[name], ORACLES[name] = f, sql
        return f

    return add


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _scratch(spark: SparkSession) -> str:
    """A new folder that all executors see."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="docloom-")
        spark.sparkContext.setCheckpointDir(named)
    return f"{named.rstrip('/')}/files-{uuid.uuid4().hex}"


def _written(rows: DataFrame, key: str, text: str) -> str:
    """One text file for each value of ``key``, in a folder named after it."""
    path = _scratch(rows.sparkSession)
    rows.select(key, text).repartition(1).write.partitionBy(key).text(path)
    return path


def _key(source: str, key: str):
    return F.regexp_extract(source, rf"{key}=([^/]+)/", 1)


# Sitemaps: an index for each region, whose children are its nations; a list of pages for each nation, whose pages are its suppliers.
def _index_path(spark, d) -> str:
    n = _table(spark, d, "nation")
    each = F.concat(F.lit("<sitemap><loc> https://h/n/"), F.col("n_nationkey"), F.lit(".xml\n</loc><lastmod>2024</lastmod></sitemap>"))
    twice = F.concat(each, F.when(F.col("n_nationkey") % 2 == 0, each).otherwise(F.lit("<sitemap><loc/></sitemap>")))
    rows = n.groupBy(F.col("n_regionkey").alias("r")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", twice.alias("x")))), lambda x: x["x"]), "").alias("x"))
    head = F.when(F.col("r") == 0, F.lit("﻿")).otherwise(F.lit(""))
    return _written(rows.withColumn("x", F.concat(head, F.lit('<?xml version="1.0"?><sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), "x", F.lit("</sitemapindex>"))), "r", "x")


def _urls_path(spark, d) -> str:
    s = _table(spark, d, "supplier")
    meta = F.concat(F.lit("<metadata><name> "), "s_name", F.lit(" </name><productversion>1."), (F.col("s_suppkey") % 3).cast("string"), F.lit("</productversion></metadata>"))
    each = F.concat(F.lit("<url><loc>https://h/p/"), "s_suppkey", F.lit(".htm</loc>"), F.when(F.col("s_suppkey") % 4 == 0, F.lit("")).otherwise(F.lit("<lastmod>2024-01-02</lastmod>")), meta, F.lit("</url>"))
    rows = s.groupBy(F.col("s_nationkey").alias("n")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", each.alias("x")))), lambda x: x["x"]), "").alias("x"))
    return _written(rows.withColumn("x", F.concat(F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9/sitemap.xsd">'), "x", F.lit("<url><loc></loc></url></urlset>"))), "n", "x")


_SQL_INDEX = "SELECT n_regionkey AS region, 'https://h/n/' || n_nationkey || '.xml' AS loc FROM nation"


def _index(spark, d) -> DataFrame:
    return sitemaps.index_entries(spark, f"{_index_path(spark, d)}/r=*")


for _name in ("src5_sitemap_xml", "src6_byte_order_marks", "src7_index_children", "src8_index_children_once", "src16_local_index"):

    @query(_name, _SQL_INDEX)
    def _(spark, d):
        return _index(spark, d).select(_key("source", "r").cast("int").alias("region"), "loc")


_SQL_URLS = "SELECT s_nationkey AS nation, 'https://h/p/' || s_suppkey || '.htm' AS url, CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE '2024-01-02' END AS lastmod, s_name AS product_name, '1.' || (s_suppkey % 3) AS product_version, '' AS doc_name FROM supplier"


def _urls(spark, d) -> DataFrame:
    return sitemaps.url_entries(spark, f"{_urls_path(spark, d)}/n=*")


for _name in ("src9_urlset", "src10_page_metadata"):

    @query(_name, _SQL_URLS)
    def _(spark, d):
        return _urls(spark, d).select(_key("source", "n").cast("int").alias("nation"), "url", "lastmod", "product_name", "product_version", "doc_name")


@query(
    "src11_product_versions",
    "SELECT CAST(n_regionkey AS VARCHAR) AS product, 'https://h/n/' || n_nationkey || '.xml' AS version_sitemap, CASE WHEN s_suppkey IS NULL THEN 'no-sitemap' END AS error, s_suppkey FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey "
    "AND n_nationkey % 5 <> 0 UNION ALL SELECT 'https://h/n/0.xml', 'https://h/n/0.xml', NULL, s_suppkey FROM supplier WHERE s_nationkey = 0",
)
def _(spark, d):
    """Lists of nations whose number five divides are missing, but for that of nation 0, which is a product of its own."""
    index = _index(spark, d).select(_key("source", "r").alias("source"), "loc")
    pages = _urls(spark, d).withColumn("nation", _key("source", "n").cast("int"))
    pages = pages.withColumn("source", F.concat(F.lit("https://h/n/"), "nation", F.lit(".xml")))
    products = index.select(F.col("source").alias("product_sitemap")).distinct().union(spark.createDataFrame([("https://h/n/0.xml",)], "product_sitemap string"))
    key = F.expr("try_cast(regexp_extract(url, '([0-9]+)[.]htm$', 1) AS bigint)").alias("s_suppkey")
    listed = sitemaps.product_versions(index, pages.where("nation % 5 <> 0"))
    alone = sitemaps.product_versions(index, pages.where("nation = 0"), products).where("product_sitemap = 'https://h/n/0.xml'")
    return listed.unionByName(alone).select(F.col("product_sitemap").alias("product"), "version_sitemap", "error", key)


@query("src15_versions_expanded", "SELECT n_regionkey AS region, count(s_suppkey) AS pages, count(DISTINCT n_nationkey) AS versions FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1")
def _(spark, d):
    pages = _urls(spark, d)
    pages = pages.withColumn("source", F.concat(F.lit("https://h/n/"), _key("source", "n"), F.lit(".xml")))
    found = sitemaps.product_versions(_index(spark, d).select(_key("source", "r").cast("int").alias("source"), "loc"), pages)
    return found.groupBy(F.col("product_sitemap").alias("region")).agg(F.count("url").alias("pages"), F.count_distinct("version_sitemap").alias("versions"))


@query("src12_direct_version", "SELECT s_nationkey AS nation, min(s_suppkey) AS first_page FROM supplier GROUP BY 1")
def _(spark, d):
    rows = manifest.first_rows(_urls(spark, d), "source")
    return rows.select(_key("source", "n").cast("int").alias("nation"), F.regexp_extract("url", r"(\d+)\.htm$", 1).cast("bigint").alias("first_page"))


@query(
    "orc7_corpus_crawl",
    "SELECT 'https://h/n/' || s_nationkey || '.xml' AS version_sitemap, count(*) AS page_count, CAST(floor(count(*) * 0.8) AS BIGINT) AS est_images, CASE WHEN count(CASE WHEN s_suppkey % 4 <> 0 THEN 1 END) > 0 THEN '2024-01-02' ELSE '' END AS last_modified, "
    "CASE WHEN count(CASE WHEN s_suppkey % 4 <> 0 THEN 1 END) > 0 THEN 'Current' ELSE 'Legacy' END AS age FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY s_nationkey",
)
def _(spark, d):
    pages = _urls(spark, d)
    pages = pages.withColumn("source", F.concat(F.lit("https://h/n/"), _key("source", "n"), F.lit(".xml")))
    entries = sitemaps.product_versions(_index(spark, d).select("source", "loc"), pages).where("error IS NULL")
    return report.estimate(entries).select("version_sitemap", "page_count", "est_images", "last_modified", F.col("current_or_legacy").alias("age"))


@query("src27_alias_xml", "SELECT c_custkey, 'T' || c_custkey AS name, 'A/' || c_nationkey || '.htm#k' AS link, CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_custkey AS INTEGER) END AS resolved_id FROM customer WHERE c_custkey % 7 <> 0")
def _(spark, d):
    c = _table(spark, d, "customer")
    k = F.col("c_custkey")
    link = F.when(k % 7 == 0, F.lit("")).otherwise(F.concat(F.lit("A/"), "c_nationkey", F.lit(".htm#k")))
    x = F.concat(F.lit('<Map Name="T'), k, F.lit('" Link="'), link, F.lit('" ResolvedId="'), F.when(k % 3 == 0, F.lit("abc")).otherwise(k.cast("string")), F.lit('"/>'))
    rows = c.select((k % 4).alias("f"), k, x.alias("x")).groupBy("f").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "x"))), lambda r: r["x"]), "").alias("x"))
    path = _written(rows.withColumn("x", F.concat(F.lit("<CatapultAliasFile>"), "x", F.lit("</CatapultAliasFile>"))), "f", "x")
    return sitemaps.alias_entries(spark, f"{path}/f=*").select(F.substring("name", 2, 20).cast("bigint").alias("c_custkey"), "name", "link", "resolved_id")


@query("src36_topic_map", "SELECT s_nationkey AS guide, 'T' || s_suppkey AS topic, 'f' || s_suppkey || '.htm#a' AS href FROM supplier")
def _(spark, d):
    s = _table(spark, d, "supplier")
    x = F.concat(F.lit('<Topic name="T'), "s_suppkey", F.lit('" href="f'), "s_suppkey", F.lit('.htm#a"/>'))
    rows = s.groupBy(F.col("s_nationkey").alias("g")).agg(F.array_join(F.collect_list(x), "").alias("x"))
    path = _written(rows.withColumn("x", F.concat(F.lit("<Topics>"), "x", F.lit('<Topic name="" href="n"/></Topics>'))), "g", "x")
    return sitemaps.topic_entries(spark, f"{path}/g=*").select(_key("source", "g").cast("int").alias("guide"), "topic", "href")


# JSON, settings and archives.
@query("src3_json_rows", "SELECT CAST(n_nationkey AS BIGINT) AS k, n_name AS name FROM nation")
def _(spark, d):
    path = _scratch(spark)
    rows = _table(spark, d, "nation").agg(F.to_json(F.collect_list(F.struct(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name")))).alias("x"))
    rows.write.text(path)
    return files.read_json(spark, path, "k bigint, name string")


@query("src4_tolerant_json", "SELECT CAST(r_regionkey AS BIGINT) AS k FROM region")
def _(spark, d):
    path = _scratch(spark)
    good = _table(spark, d, "region").agg(F.to_json(F.collect_list(F.struct(F.col("r_regionkey").alias("k")))).alias("x"))
    good.union(spark.createDataFrame([("[{broken",)], "x string")).write.text(path)
    return files.read_json_or_empty(spark, path, "k bigint").where("k IS NOT NULL").union(files.read_json_or_empty(spark, path + "-none", "k bigint"))


@query("fn19_registry_load", "SELECT 'none' AS state, CAST(0 AS BIGINT) AS n UNION ALL SELECT 'there', count(*) FROM nation")
def _(spark, d):
    path = _scratch(spark)
    files.write_json(_table(spark, d, "nation").select(F.col("n_name").alias("version")), path, "version")
    there, none = files.read_json_or_empty(spark, path, "version string", lines=True), files.read_json_or_empty(spark, path + "-none", "version string")
    return none.agg(F.lit("none").alias("state"), F.count("*").alias("n")).union(there.agg(F.lit("there"), F.count("*")))


@query("src1_settings", "SELECT * FROM (VALUES ('chrome', 'div.x'), ('images', '0.5'), ('prefix', 'm.'), ('guid kept', 'true')) t(name, value)")
def _(spark, d):
    with tempfile.TemporaryDirectory() as folder:  # settings are the driver's
        path = Path(folder) / "s.yaml"
        path.write_text("chrome_selectors: [div.x]\nimages_per_page: 0.5\nproduct_prefix: m.\nno_such_setting: 1\n")
        s = config.load_settings(path)
    rows = [("chrome", ",".join(s.chrome_selectors)), ("images", str(s.images_per_page)), ("prefix", s.product_prefix), ("guid kept", str(s.guid_page == config.GUID_PAGE).lower())]
    return spark.createDataFrame(rows, "name string, value string")


@query("src2_phase", "SELECT * FROM (VALUES ('p1', 'a,b', ''), ('own', '', '1.0'), ('missing', NULL, NULL)) t(name, products, versions)")
def _(spark, d):
    with tempfile.TemporaryDirectory() as first, tempfile.TemporaryDirectory() as second:
        (Path(second) / "p1.yaml").write_text("products: [a, b]\n")
        (Path(first) / "p2.yaml").write_text("name: own\nversions: ['1.0']\n")
        rows = []
        for name in ("p1", "p2", "p3"):
            try:
                found = config.load_phase(name, first, second)
                rows.append((found["name"], ",".join(found["products"]), ",".join(found["versions"])))
            except FileNotFoundError:
                rows.append(("missing", None, None))
    return spark.createDataFrame(rows, "name string, products string, versions string")


@query(
    "src20_archive_members",
    "SELECT r_regionkey, m AS path, CASE WHEN m = 'a.htm' THEN length(r_name) WHEN m = 'b/c.png' THEN 3 END AS size, CASE WHEN m = '../../x' THEN 'outside-root' WHEN m = '' THEN 'corrupt_zip' END AS error "
    "FROM region, (VALUES ('a.htm'), ('b/c.png'), ('../../x'), ('')) t(m) WHERE (r_regionkey % 2 = 0) = (m <> '')",
)
def _(spark, d):
    def run(batches):
        for batch in batches:
            out = []
            for k, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                made = io.BytesIO()
                with zipfile.ZipFile(made, "w") as z:
                    for path, text in (("top/a.htm", name), ("top/b/c.png", "png"), ("top/../../x", "bad")):
                        z.writestr(path, text)
                out.append(made.getvalue() if k % 2 == 0 else b"no archive")
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array([f"v{k}/html/" for k in batch.column(0).to_pylist()])], names=["content", "html_root"])

    archives = _table(spark, d, "region").select("r_regionkey", "r_name").mapInArrow(run, "content binary, html_root string")
    found = [files.expand_archives(archives.where(F.col("html_root") == f"v{k}/html/")).withColumn("r_regionkey", F.lit(k)) for k in range(5)]
    rows = found[0]
    for f in found[1:]:
        rows = rows.unionByName(f)
    bare = F.regexp_replace(F.regexp_replace("path", r"^v\d+(/|$)", ""), "^top/", "")
    return rows.select("r_regionkey", bare.alias("path"), F.length("content").alias("size"), "error")


@query("src33_webworks_versions", "SELECT 'pub/p' || s_suppkey || '/1.' || s_suppkey || '/html' AS root, '1.' || s_suppkey AS version FROM supplier WHERE s_suppkey % 3 <> 0")
def _(spark, d):
    k = F.col("s_suppkey")
    deep = F.when(k % 3 == 0, F.lit("a/b.htm")).otherwise(F.lit("../a/b/c.htm"))
    rows = _table(spark, d, "supplier").select(F.concat(F.lit("pub/p"), k, F.lit("/1."), k, F.lit("/html/wwhelp/books.htm")).alias("path"), F.concat(F.lit('<div><a href="'), deep, F.lit('">x</a></div>')).alias("html"))
    return scripts.webworks_versions(rows.union(rows.select(F.replace("path", F.lit("books"), F.lit("others")), "html")))


_SQL_NOTES = "SELECT 'pub/x' || s_suppkey || '/doc/pdf/' || CASE WHEN s_suppkey % 2 = 0 THEN 'ABC' ELSE 'X' END || '_foo_' || s_suppkey || '_1.2.' || (s_suppkey % 3) || '_relnotes.pdf' AS path, 'foo_' || s_suppkey AS slug, '1.2.' || (s_suppkey % 3) AS version, 'relnotes' AS doc FROM supplier WHERE s_suppkey % 5 <> 0"


def _notes(spark, d) -> DataFrame:
    k = F.col("s_suppkey")
    stem = F.concat(F.when(k % 2 == 0, "ABC").otherwise("X"), F.lit("_foo_"), k, F.lit("_1.2."), (k % 3).cast("string"), F.when(k % 5 == 0, F.lit("_guide")).otherwise(F.lit("_relnotes")))
    return files.release_notes(_table(spark, d, "supplier").select(F.concat(F.lit("pub/x"), k, F.lit("/doc/pdf/"), stem, F.lit(".pdf")).alias("path")))


for _name in ("src38_release_notes", "pdf15_stem"):

    @query(_name, _SQL_NOTES)
    def _(spark, d):
        return _notes(spark, d)


@query("jn10_matched_products", f"SELECT path, CASE WHEN s_suppkey % 4 <> 0 THEN 'P' || s_suppkey END AS product_name FROM ({_SQL_NOTES.replace('SELECT ', 'SELECT s_suppkey, ', 1)})")
def _(spark, d):
    k = F.col("s_suppkey")
    rows = _table(spark, d, "supplier").where("s_suppkey % 4 <> 0")
    products = rows.select(F.concat(F.lit("1.2."), (k % 3).cast("string")).alias("product_version"), F.concat(F.lit("P"), k).alias("product_name"), F.concat(F.lit("pub/foo_"), k, F.lit("/")).alias("path_slug"), k.alias("ord"))
    notes = _notes(spark, d).withColumn("slug", F.concat("slug", F.lit("/")))
    return files.match_products(notes, products).select("path", "product_name")


# Sinks, read back.
@query("snk5_csh_map", "SELECT n_regionkey AS version, '{' || string_agg('\"' || n_nationkey || '\":{\"name\":\"' || n_name || '\",\"file\":\"f\"}', ',' ORDER BY CAST(n_nationkey AS VARCHAR)) || '}' AS json FROM nation GROUP BY 1")
def _(spark, d):
    return csh.as_json(_table(spark, d, "nation").select(F.col("n_regionkey").alias("version"), F.col("n_nationkey").alias("csh_id"), F.col("n_name").alias("name"), F.lit("f").alias("file")), "csh_id", "name", "file")


@query("snk6_toc_json", "SELECT r_regionkey AS version, '[{\"title\": \"' || r_name || '\", \"file\": null, \"children\": [' || string_agg('{\"title\": \"' || n_name || '\", \"file\": \"f' || n_nationkey || '\", \"children\": []}', ', ' ORDER BY n_nationkey) || ']}]' AS json FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY 1, r_name")
def _(spark, d):
    r, n = _table(spark, d, "region"), _table(spark, d, "nation")
    tops = r.select(F.col("r_regionkey").alias("version"), F.array("r_name").alias("path"), F.col("r_name").alias("title"), F.lit(-1).alias("ord"), F.lit(None).cast("string").alias("file"))
    below = n.join(r, n.n_regionkey == r.r_regionkey).select("r_regionkey", F.array("r_name", "n_name"), "n_name", "n_nationkey", F.concat(F.lit("f"), "n_nationkey"))
    return files.nest(tops.union(below))


def _read_lines(spark, path: str) -> DataFrame:
    return spark.read.text(path).select("value")


for _name in ("snk7_registry_json", "snk11_rename_json", "srt6_registry_order"):

    @query(_name, "SELECT '{\"version\":\"' || n_name || '\",\"n\":' || n_regionkey || '}' AS value, row_number() OVER (ORDER BY n_name) AS place FROM nation")
    def _(spark, d):
        path = _scratch(spark)
        files.write_json(_table(spark, d, "nation").select(F.col("n_name").alias("version"), F.col("n_regionkey").alias("n")), path, "version")
        at = F.struct(F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).alias("f"), F.monotonically_increasing_id().alias("i"))
        from pyspark.sql.window import Window

        lines = spark.read.text(path).select("value", at.alias("at"))
        return lines.select("value", F.row_number().over(Window.orderBy("at")).cast("long").alias("place"))


def _csv(spark, rows: DataFrame, headers: dict[str, str], twice: bool) -> DataFrame:
    path = _scratch(spark)
    files.write_csv(rows, path, headers)
    if twice:
        files.write_csv(rows, path, headers, append=True)
    back = spark.read.option("header", True).csv(path)
    return back.select(F.array_join(F.array(*[F.lit(c) for c in back.columns]), ",").alias("header"), F.concat_ws(",", *[F.col(f"`{c}`") for c in back.columns]).alias("value"))


for _name, _twice in (("snk8_csv_report", True), ("snk9_estimate_csv", False), ("snk10_product_csv", False)):

    @query(_name, "SELECT 'Name,Region No.' AS header, n_name || ',' || n_regionkey AS value FROM nation" + (" UNION ALL SELECT 'Name,Region No.', n_name || ',' || n_regionkey FROM nation" if _twice else ""))
    def _(spark, d, twice=_twice):
        return _csv(spark, _table(spark, d, "nation"), {"n_name": "Name", "n_regionkey": "Region No."}, twice)


@query("snk12_step_report", "SELECT 'convert' AS step, count(*) AS rows, 'clicks=' || count(CASE WHEN event_type = 'click' THEN 1 END) AS counts, count(CASE WHEN event_id % 5 = 0 THEN 1 END) AS error_count, count(CASE WHEN event_id % 7 = 0 THEN 1 END) AS skip_count FROM events")
def _(spark, d):
    k = F.col("event_id")
    rows = _table(spark, d, "events").select(
        F.create_map(F.lit("clicks"), (F.col("event_type") == "click").cast("long")).alias("stats"), F.when(k % 5 == 0, "e").alias("error"), F.when(k % 7 == 0, "s").alias("skipped")
    )
    found = report.step_report("convert", rows)
    return found.select("step", "rows", F.array_join(F.transform(F.map_entries("counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("counts"), "error_count", "skip_count")


@query("snk13_run_summary", "SELECT 'errors' AS name, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS n FROM orders UNION ALL SELECT 'rows', count(*) FROM orders")
def _(spark, d):
    failed = (F.col("o_orderstatus") == "F").cast("int")
    return manifest.counters(_table(spark, d, "orders").select(F.create_map(F.lit("rows"), F.lit(1), F.lit("errors"), failed).alias("stats"))).withColumn("n", F.col("n").cast("long"))


@query("snk14_latest_reports", "SELECT o_custkey AS step, max(o_orderkey) AS started_at, arg_max(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY 1")
def _(spark, d):
    rows = _table(spark, d, "orders").select(F.col("o_custkey").alias("step"), F.col("o_orderkey").alias("started_at"), F.col("o_orderstatus").alias("status"))
    return report.latest(rows)


# WebWorks trees.
@query(
    "jn16_places",
    "SELECT c_custkey, CASE WHEN c_custkey % 40 < 30 THEN 'f' || (c_custkey % 40) || '.htm' ELSE '' END AS file, 'a' || c_custkey AS anchor FROM customer",
)
def _(spark, d):
    k = F.col("c_custkey")
    nodes = _table(spark, d, "customer").select(k, F.lit("g").alias("guide"), F.concat(k % 40, F.lit("#a"), k).alias("link"))
    index = _table(spark, d, "customer").where("c_custkey < 30").select(F.lit("g").alias("guide"), k.cast("int").alias("place"), F.concat(F.lit("f"), k, F.lit(".htm")).alias("href"))
    zero = spark.createDataFrame([("g", 0, "f0.htm")], "guide string, place int, href string")
    return webworks.resolve_places(nodes, index.where("place > 0").union(zero)).select("c_custkey", "file", "anchor")


@query("srt1_sorted_files", "SELECT 'p/' || c_name AS path, row_number() OVER (ORDER BY 'p/' || c_name) AS place FROM customer")
def _(spark, d):
    from pyspark.sql.window import Window

    listing = files.sorted_listing(_table(spark, d, "customer").select(F.concat(F.lit("p/"), "c_name").alias("path")))
    return listing.select("path", F.row_number().over(Window.orderBy(F.monotonically_increasing_id())).cast("long").alias("place"))


@query("hie2_script_tree", "SELECT DISTINCT p AS path, f AS file FROM (SELECT r_name AS p, CAST(NULL AS VARCHAR) AS f FROM region JOIN nation ON n_regionkey = r_regionkey WHERE n_nationkey % 3 <> 0 UNION ALL SELECT r_name || '|' || n_name, 'out/p' || n_nationkey || '.md' FROM region JOIN nation ON n_regionkey = r_regionkey WHERE n_nationkey % 3 <> 0)")
def _(spark, d):
    """The tree's node numbers are regions and nations; nations whose number three divides have no output, and go."""
    r, n = _table(spark, d, "region"), _table(spark, d, "nation")
    both = n.join(r, n.n_regionkey == r.r_regionkey)
    v = F.lit("v").alias("version")
    toc_rows = both.select(v, F.array((1000 + F.col("r_regionkey")).cast("string"), F.col("n_nationkey").cast("string")).alias("path"), F.col("n_nationkey").alias("ord"), F.col("n_nationkey").alias("node_id"))
    toc_rows = toc_rows.union(r.select(v, F.array((1000 + F.col("r_regionkey")).cast("string")), F.lit(0), 1000 + F.col("r_regionkey")))
    chunks = n.select(v, F.col("n_nationkey").alias("node_id"), F.concat(F.lit("/P"), "n_nationkey", F.lit(".htm")).alias("url"), F.col("n_name").alias("title"))
    chunks = chunks.union(r.select(v, 1000 + F.col("r_regionkey"), F.lit("/none.htm"), F.col("r_name")))
    pages = n.where("n_nationkey % 3 <> 0").select(v, F.concat(F.lit("p"), "n_nationkey", F.lit(".htm")).alias("rel_url"), F.concat(F.lit("out/p"), "n_nationkey", F.lit(".md")).alias("output_path"))
    found = toc.prune(toc.attach_files(toc_rows, chunks, pages), F.col("file").isNotNull())
    tops = found.where(F.size("path") == 1).select(F.get("path", F.lit(0)).alias("top"), F.col("title").alias("up"))
    named = found.join(tops, F.get("path", F.lit(0)) == F.col("top"))
    return named.select(F.when(F.size("path") == 1, F.col("up")).otherwise(F.concat_ws("|", "up", "title")).alias("path"), "file").distinct()
