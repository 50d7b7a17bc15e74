"""Queries over the relational operators that the first registry leaves out, each with the SQL that a second engine runs for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Settings
from .functions import text as T
from .operators import admission, csh, links, manifest, pdf, rename, report, toc
from .plans.pipelines import dita_steps, dita_toc, webworks_steps
from .plans.runner import run_all

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
S = Settings()


def query(name: str, sql: str):
    def add(f):
        QUERIES[name], ORACLES[name] = f, sql
        return f

    return add


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _both(spark, d) -> DataFrame:
    n, r = _table(spark, d, "nation"), _table(spark, d, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey)


# Manifests: a version for each nation, whose pages are its customers.
def _manifest(spark, d) -> DataFrame:
    k = F.col("c_custkey")
    return _table(spark, d, "customer").select(
        k.alias("ord"), F.concat(F.lit("https://h/pub/n"), "c_nationkey", F.lit("/1.0/doc/html/"), k, F.lit(".htm")).alias("url"), F.concat(F.lit("v"), "c_nationkey").alias("version_sitemap"),
        F.concat(F.lit("pub/n"), "c_nationkey", F.lit("/1.0/doc/html/"), k, F.lit(".md")).alias("output_path"), F.col("c_mktsegment").alias("product_name"), F.lit("1.0").alias("product_version"),
        F.concat(F.lit("D"), (k % 2).cast("string")).alias("doc_name"), F.lit("").alias("lastmod"),
        F.when(F.col("c_nationkey") % 3 == 0, "sdl_dita").when(F.col("c_nationkey") % 3 == 1, "file_dita").otherwise("madcap").alias("version_format"),
    )


@query("src18_phase_download", "SELECT 'v' || c_nationkey AS version_sitemap, count(*) AS n FROM customer WHERE c_nationkey % 4 <> 0 AND c_custkey % 3 <> 0 GROUP BY 1")
def _(spark, d):
    rows = _manifest(spark, d)
    covered = _table(spark, d, "nation").where("n_nationkey % 4 = 0").select(F.concat(F.lit("v"), "n_nationkey").alias("version_sitemap"))
    cached = rows.where("ord % 3 = 0").select(F.regexp_replace("url", "^https://h/", "").alias("path"))
    return manifest.download_plan(rows, covered, cached).groupBy("version_sitemap").agg(F.count("*").alias("n"))


@query("src22_extracted", "SELECT r_regionkey, r_regionkey % 2 = 0 AS extracted FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY 1")
def _(spark, d):
    path = F.when((F.col("r_regionkey") % 4 == 0) & (F.col("n_nationkey") % 2 == 0), "Data/Tocs/a.js").when(F.col("r_regionkey") == 2, "x/static/body.js").otherwise("Data/Tocs2/a.js")
    found = admission.version_formats(_both(spark, d).select("r_regionkey", path.alias("path")), "r_regionkey", "path")
    return found.select("r_regionkey", "extracted")


@query(
    "src26_cached_pages",
    "SELECT c_custkey AS ord, c_custkey % 2 = 0 AS in_manifest, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE f END AS product_name FROM customer LEFT JOIN (SELECT c_nationkey, arg_min(c_mktsegment, c_custkey) AS f FROM customer WHERE c_custkey % 2 = 0 GROUP BY 1) USING (c_nationkey)",
)
def _(spark, d):
    rows = _manifest(spark, d)
    files = rows.select("ord", F.regexp_replace("url", "^https://h/", "").alias("path"), F.regexp_extract("output_path", "^(.*/doc/html/)", 1).alias("version_root"))
    found = manifest.cached_entries(files.drop("ord"), rows.where("ord % 2 = 0"))
    return found.join(files.select("ord", "path"), "path").select("ord", "in_manifest", "product_name")


@query("prj9_dita_paths", "SELECT c_custkey AS ord, CASE WHEN c_nationkey % 3 = 0 AND c_nationkey % 2 = 0 THEN 'root/n' || c_nationkey || '/' || CASE WHEN c_custkey % 5 <> 0 THEN 'slug-' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END || '.md' ELSE 'pub/n' || c_nationkey || '/1.0/doc/html/' || c_custkey || '.md' END AS dita_path FROM customer")
def _(spark, d):
    rows = _manifest(spark, d)
    key = F.col("c_custkey")
    renames = _table(spark, d, "customer").where("c_nationkey % 2 = 0 AND c_custkey % 5 <> 0").select(
        F.concat(F.lit("v"), "c_nationkey").alias("version_sitemap"), F.concat(F.lit("root/n"), "c_nationkey", F.lit("/")).alias("html_root"), F.concat(key, F.lit(".htm")).alias("guid"), F.concat(F.lit("slug-"), key, F.lit(".html")).alias("slug")
    )
    blank = F.when(F.col("ord") % 2 == 0, F.lit("")).otherwise(F.col("output_path"))
    return manifest.dita_outputs(rows.withColumn("output_path", blank), renames).select("ord", "dita_path")


@query("flt6_phase_has_dita", "SELECT r_name, count(CASE WHEN n_nationkey % 6 < 2 THEN 1 END) > 0 AS dita FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY 1")
def _(spark, d):
    kind = F.when(F.col("n_nationkey") % 6 == 0, "sdl_dita").when(F.col("n_nationkey") % 6 == 1, "file_dita").otherwise("madcap")
    rows = _both(spark, d).select("r_name", kind.alias("version_format"))
    names = [r["r_name"] for r in _table(spark, d, "region").select("r_name").collect()]  # one phase a region
    return spark.createDataFrame([(n, admission.has_dita(rows.where(F.col("r_name") == n))) for n in names], "r_name string, dita boolean")


@query("flt10_images", "SELECT p_partkey, p_partkey % 6 IN (0, 4) AS kept FROM part")
def _(spark, d):
    k = F.col("p_partkey")
    src = F.get(F.array(*[F.lit(x) for x in ("i/a.png", "data:image/png;x", "Skins/a.png", "../Skins/b.png", "SkinsX/a.png", "x/Resources/Scripts/a.png")]), (k % 6).cast("int"))
    return _table(spark, d, "part").select("p_partkey", admission.image_admitted(src, S).alias("kept"))


@query("flt11_navigation", "SELECT c_custkey FROM customer WHERE c_custkey % 4 = 1 AND c_nationkey % 3 = 2")
def _(spark, d):
    root = F.when(F.col("c_custkey") % 4 == 1, "pub/Foo-Bar/x").otherwise("pub/foo/x")
    version = F.concat(F.lit("1."), (F.col("c_nationkey") % 3).cast("string"))
    return _table(spark, d, "customer").where(admission.nav_filter(root, version, "FOO-b", "1.2")).select("c_custkey")


@query("jn3_format_split", "SELECT c_custkey AS ord, CASE WHEN c_nationkey % 3 < 2 THEN 'dita' ELSE 'other' END AS way FROM customer")
def _(spark, d):
    rows = _manifest(spark, d)
    known = admission.dita_versions(rows.where("version_format = 'sdl_dita'").select("version_sitemap", F.col("version_format").alias("format")), rows.where("version_format <> 'sdl_dita'"))
    dita, rest = manifest.split_by_format(rows, known)
    return dita.select("ord", F.lit("dita").alias("way")).unionByName(rest.select("ord", F.lit("other").alias("way")))


@query("srt8_first_match", "SELECT 'v' || c_nationkey AS version_sitemap, min(c_custkey) AS ord FROM customer WHERE c_custkey % 3 = 1 GROUP BY 1")
def _(spark, d):
    return manifest.first_rows(_manifest(spark, d).where("ord % 3 = 1"), "version_sitemap").select("version_sitemap", "ord")


# Reports.
@query("prj14_cost_model", "SELECT n_nationkey, round(p / 12.4, 9) AS download, round(p / 16.8, 9) AS convert, round(floor(p * 0.8) / 12.4, 9) AS images FROM (SELECT n_nationkey, CAST(n_nationkey * 37 AS DOUBLE) AS p FROM nation)")
def _(spark, d):
    seconds = T.stage_seconds(F.col("n_nationkey") * 37, S.rates, S.images_per_page)
    return _table(spark, d, "nation").select("n_nationkey", *[F.round(seconds[k], 9).alias(k) for k in ("download", "convert", "images")])


_SQL_REPORT = (
    "SELECT 'v' || c_nationkey AS version_sitemap, count(*) AS topics, CASE WHEN c_nationkey % 4 = 0 THEN 'zip' WHEN c_nationkey % 4 = 1 THEN 'missing: no_zip' ELSE 'crawl' END AS archive, "
    "CASE WHEN c_nationkey % 5 = 0 THEN 3 ELSE 0 END AS md_files, CASE WHEN c_nationkey % 5 = 0 THEN 1 ELSE 0 END AS pdf_files, CASE WHEN c_nationkey % 2 = 0 THEN 'madcap_js' ELSE 'none' END AS toc_source FROM customer GROUP BY c_nationkey"
)


def _report(spark, d) -> DataFrame:
    n = F.col("n_nationkey")
    rows = _manifest(spark, d).withColumn("alias_xml_url", F.regexp_replace("url", "[^/]+$", "Data/Alias.xml"))
    nations = _table(spark, d, "nation")
    v = F.concat(F.lit("v"), n).alias("version_sitemap")
    root = F.concat(F.lit("pub/n"), n, F.lit("/1.0/doc/html/")).alias("root")
    outputs = nations.where("n_nationkey % 5 = 0").select(root, F.explode(F.array(*[F.lit(k) for k in ("md", "md", "md", "pdf")])).alias("kind"))
    tocs = nations.where("n_nationkey % 2 = 0").select(root, F.lit("madcap_js").alias("toc_source"))
    return report.version_report(rows, nations.where("n_nationkey % 4 = 0").select(v, F.lit("madcap").alias("format")), nations.where("n_nationkey % 4 = 1").select(v, F.lit("no_zip").alias("reason")), outputs, tocs)


for _name in ("jn11_archive_states", "agg11_file_counts", "fn18_toc_source"):

    @query(_name, _SQL_REPORT)
    def _(spark, d):
        return _report(spark, d).select("version_sitemap", F.col("topics_in_sitemap").alias("topics"), "archive", F.col("md_files").cast("int").alias("md_files"), F.col("pdf_files").cast("int").alias("pdf_files"), "toc_source")


def _placed(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows in their order, with their place."""
    from pyspark.sql.window import Window

    return rows.select(*columns, F.row_number().over(Window.orderBy(F.monotonically_increasing_id())).cast("long").alias("place"))


@query("srt4_products_by_pages", "SELECT product_name, pages, row_number() OVER (ORDER BY t DESC, pages DESC, product_name) AS place FROM (SELECT c_mktsegment AS product_name, count(*) AS pages, grouping(c_mktsegment) AS t FROM customer GROUP BY ROLLUP (c_mktsegment))")
def _(spark, d):
    versions = _manifest(spark, d).groupBy("product_name", "version_sitemap").agg(F.count("*").alias("page_count"))
    return _placed(report.product_rollup(versions), "product_name", "pages")


@query("srt5_products_by_name", "SELECT s_name AS product_slug, row_number() OVER (ORDER BY lower(CASE WHEN s_suppkey % 3 = 0 THEN s_name ELSE 'p' || (s_suppkey * 7919 % 10007) END)) AS place FROM supplier")
def _(spark, d):
    k = F.col("s_suppkey")
    s = _table(spark, d, "supplier")
    products = s.select(F.col("s_name").alias("product_slug"), F.when(k % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("P"), (k * 7919 % 10007).cast("string"))).alias("product_name"), k.cast("string").alias("l2_sitemap_url"))
    versions = s.where("s_suppkey < 0").select(k.cast("string").alias("l2_sitemap_url"), k.alias("ord"), F.lit("1").alias("product_version"), F.lit("").alias("product_name"))
    return _placed(report.product_list(products, versions), "product_slug")


# Links, help maps and renames.
def _bodies(spark, d) -> tuple[DataFrame, DataFrame]:
    k = F.col("page_id")
    raw = _table(spark, d, "pages").select("page_id", F.concat(F.lit("https://h/pub/p"), k, F.lit("/a.htm")).alias("url"), F.concat(F.lit("pub/p"), k, F.lit("/a.md")).alias("output_path"))
    body = F.concat(F.lit("x [%=a.b%][t](../p"), k + 1, F.lit("/a.htm#s) ![i](i"), k, F.lit(".png) [u](no.htm) [v](#a) [w](https://other/a.htm) [z](https://h/pub/p1/a.htm)"))
    made = raw.select("*", F.when(k % 10 != 9, body).alias("body"), F.concat(F.lit(" A |[%=x%]| "), k).alias("toc_path"))
    return made, links.link_index(raw, order="page_id")


_SQL_BODY = (
    "SELECT page_id, 'x [t](' || CASE WHEN page_id + 1 IN (SELECT page_id FROM pages) THEN '../p' || (page_id + 1) || '/a.md#s' ELSE '../p' || (page_id + 1) || '/a.htm#s' END || ') ![i](i' || page_id || '.png) [u](no.htm) [v](#a) [w](https://other/a.htm) [z](' "
    "|| CASE WHEN 1 NOT IN (SELECT page_id FROM pages) THEN 'https://h/pub/p1/a.htm' WHEN page_id = 1 THEN 'a.md' ELSE '../p1/a.md' END || ')' AS body FROM pages"
)


@query("fn4_rewritten_links", _SQL_BODY.replace("'x [t]", "'x [%=a.b%][t]") + " WHERE page_id % 10 <> 9")
def _(spark, d):
    made, index = _bodies(spark, d)
    return links.rewrite(made.where("body IS NOT NULL"), index).select("page_id", "body")


@query("fn6_postprocessed", f"SELECT page_id, 'A|' || page_id AS toc_path, CASE WHEN page_id % 10 <> 9 THEN body END AS body, CASE WHEN page_id % 10 <> 9 THEN 1 ELSE 0 END AS n_tokens, CASE WHEN page_id % 10 = 9 THEN 'no-body' END AS error FROM ({_SQL_BODY})")
def _(spark, d):
    return links.postprocess(*_bodies(spark, d)).select("page_id", "toc_path", "body", F.col("n_tokens").cast("int").alias("n_tokens"), "error")


@query(
    "jn5_link_status",
    "SELECT l_linestatus AS page, CAST(l_linenumber AS INTEGER) AS n, CASE WHEN l_linenumber % 7 IN (1, 2) THEN 'resolved' WHEN l_linenumber % 7 = 3 THEN 'unresolved' ELSE 'kept' END AS status, count(*) AS c FROM lineitem GROUP BY 1, 2, 3",
)
def _(spark, d):
    hrefs = ["mailto:a@b", "b.htm#f", "https://h/x/B.HTM", "c.htm", "#k", "b.pdf", "https://other/x/b.htm"]
    rows = _table(spark, d, "lineitem").select(F.col("l_linestatus").alias("page"), F.col("l_linenumber").cast("int").alias("n"), F.lit("https://h/x/a.htm").alias("url"), F.get(F.array(*[F.lit(h) for h in hrefs]), (F.col("l_linenumber") % 7).cast("int")).alias("href"))
    index = links.link_index(spark.createDataFrame([("https://h/x/b.htm", "x/b.md")], "url string, output_path string"))
    return links.resolve_links(rows, index).groupBy("page", "n", "status").agg(F.count("*").alias("c"))


_SQL_CONTEXTS = "SELECT o_custkey AS version, 'C' || o_orderkey AS name, CASE WHEN c_nationkey < 10 THEN 's' || o_custkey || '.md' END AS file, 'a' || o_orderkey AS anchor FROM orders JOIN customer ON o_custkey = c_custkey"


def _contexts(spark, d) -> tuple[DataFrame, DataFrame]:
    """A context for each order; its page is its customer's, which has a new name and, for some nations, is there."""
    o, c = _table(spark, d, "orders"), _table(spark, d, "customer")
    contexts = o.select(F.col("o_custkey").alias("version"), F.concat(F.lit("C"), "o_orderkey").alias("name"), F.concat(F.lit("GUID"), "o_custkey", F.lit(".html#a"), "o_orderkey").alias("target"))
    renames = c.select(F.col("c_custkey").alias("version"), F.concat(F.lit("GUID"), "c_custkey", F.lit(".html")).alias("guid"), F.concat(F.lit("s"), "c_custkey", F.lit(".html")).alias("slug"))
    pages = c.where("c_nationkey < 10").select(F.col("c_custkey").alias("version"), F.concat(F.lit("s"), "c_custkey", F.lit(".md")).alias("rel_path"), F.concat(F.lit("s"), "c_custkey", F.lit(".md")).alias("output_path"))
    return csh.context_map(contexts, pages, renames)


for _name in ("csh2_context_map", "jn8_renamed_targets"):

    @query(_name, f"SELECT * FROM ({_SQL_CONTEXTS}) WHERE file IS NOT NULL")
    def _(spark, d):
        return _contexts(spark, d)[0].select("version", F.col("csh_name").alias("name"), "file", "anchor")


@query("jn14_missing_pages", f"SELECT version, name, 's' || version || '.html' AS page FROM ({_SQL_CONTEXTS}) WHERE file IS NULL")
def _(spark, d):
    return _contexts(spark, d)[1]


@query("jn6_alias_pages", "SELECT 'P' || (c_custkey % 50) AS output_path, count(*) AS n FROM customer WHERE c_custkey % 50 < 40 GROUP BY 1")
def _(spark, d):
    c = _table(spark, d, "customer")
    k = (F.col("c_custkey") % 50).cast("string")
    alias = c.select(F.lit("v").alias("version"), F.col("c_custkey").alias("ord"), F.col("c_name").alias("name"), F.concat(F.lit("../A/p"), k, F.lit(".htm")).alias("link"), F.col("c_nationkey").alias("resolved_id"))
    pages = c.where("c_custkey % 50 < 40").select(F.lit("v").alias("version"), F.concat(F.when(F.col("c_custkey") % 2 == 0, "A/p").otherwise("a/P"), k, F.lit(".htm")).alias("rel_path"), F.concat(F.lit("P"), k).alias("output_path")).distinct()
    return csh.alias_pages(alias, pages).select("output_path", F.size("csh_names").cast("long").alias("n"))


@query("jn9_redirect_misses", "SELECT 'T' || o_custkey AS topic, o_orderkey AS csh_id FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey >= 10")
def _(spark, d):
    o, c = _table(spark, d, "orders"), _table(spark, d, "customer")
    redirects = o.select(F.lit("g").alias("guide"), F.concat(F.lit("T"), "o_custkey").alias("topic"), F.col("o_orderkey").alias("csh_id"), F.col("o_orderkey").alias("ord"))
    topics = c.select(F.lit("g").alias("guide"), F.concat(F.lit("T"), "c_custkey").alias("topic"), F.concat(F.lit("f"), "c_custkey", F.lit(".htm#a")).alias("href"))
    guide_files = c.where("c_nationkey < 10").select(F.lit("g").alias("guide"), F.concat(F.lit("f"), "c_custkey", F.lit(".htm")).alias("href"), F.col("c_name").alias("md_path"))
    return csh.redirect_map(redirects, topics, guide_files)[1].select("topic", "csh_id")


@query(
    "jn7_tree_pages",
    "SELECT n_nationkey AS node_id, CASE WHEN n_nationkey % 4 <> 0 THEN n_name ELSE 'Section ' || n_nationkey END AS title, CASE WHEN n_nationkey % 4 <> 0 AND n_nationkey % 2 = 0 THEN 'o' || n_nationkey END AS file FROM nation",
)
def _(spark, d):
    n, k = _table(spark, d, "nation"), F.col("n_nationkey")
    v = F.lit("v").alias("version")
    tree = n.select(v, F.array("n_name").alias("path"), k.alias("ord"), k.alias("node_id"))
    chunks = n.where("n_nationkey % 4 <> 0").select(v, k.alias("node_id"), F.concat(F.lit("/A\\P"), k, F.lit(".htm")).alias("url"), F.col("n_name").alias("title"))
    pages = n.where("n_nationkey % 2 = 0").select(v, F.concat(F.lit("a/p"), k, F.lit(".htm")).alias("rel_url"), F.concat(F.lit("o"), k).alias("output_path"))
    return toc.attach_files(tree, chunks, pages).select("node_id", "title", "file")


@query("fn15_topic_renames", "SELECT doc_id, s || CASE WHEN r > 1 THEN '-' || r ELSE '' END AS slug FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY lang, s ORDER BY lpad(CAST(doc_id AS VARCHAR), 12, '0')) AS r FROM (SELECT doc_id, lang, CASE doc_id % 3 WHEN 0 THEN regexp_replace(lower(source), '[^a-z0-9]+', '-', 'g') WHEN 1 THEN lang || '-guide' ELSE 'g-' || lpad(CAST(doc_id AS VARCHAR), 12, '0') END AS s FROM documents))")
def _(spark, d):
    k = F.col("doc_id")
    guid = F.lpad(k.cast("string"), 12, "0")
    rows = _table(spark, d, "documents").select(
        F.lit("v").alias("version"), F.col("lang").alias("folder"), F.concat(F.lit("g-"), guid, F.lit(".html")).alias("guid"), F.when(k % 3 == 0, F.col("source")).otherwise("").alias("list_title"),
        F.when(k % 3 == 1, F.concat("lang", F.lit(" Guide - Product"))).alias("page_title"),
    )
    return rename.topic_renames(rows).select(F.regexp_extract("guid", r"g-0*(\d+)\.", 1).cast("long").alias("doc_id"), "slug")


@query("fn14_image_renames", "SELECT image, CASE WHEN c_nationkey % 3 = 0 THEN image ELSE 'shot-of-' || lower(n_name) || '.png' END AS name FROM (SELECT DISTINCT 'GUID-' || c_nationkey || '.png' AS image, c_nationkey, regexp_replace(n_name, '[^A-Za-z0-9]+', '-', 'g') AS n_name FROM customer JOIN nation ON c_nationkey = n_nationkey)")
def _(spark, d):
    c, n = _table(spark, d, "customer"), _table(spark, d, "nation")
    rows = c.join(n, c.c_nationkey == n.n_nationkey)
    text = F.when(F.col("c_nationkey") % 3 == 0, "Figure").otherwise(F.concat(F.lit(" Shot of "), "n_name"))
    images = rows.select(F.lit("v").alias("version"), F.concat(F.lit("GUID-"), "c_nationkey", F.lit(".png")).alias("image"), text.alias("alt"), F.col("c_custkey").alias("ord"))
    return rename.image_renames(images).select("image", "name")


@query("fn16_toc_paths", "SELECT 'g' || n_nationkey AS guid, r_name || '|' || n_name AS toc_path FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(spark, d):
    rows = _both(spark, d).select(F.lit("v").alias("version"), F.concat(F.lit("g"), "n_nationkey").alias("guid"), F.array("r_name").alias("ancestors"), F.col("n_name").alias("list_title"))
    return rename.toc_paths(rows).select("guid", "toc_path")


# Trees and orders.
_SQL_ORDERS = (
    "WITH a AS (SELECT c_nationkey AS v, c_custkey AS k, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) AS p, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_name, c_custkey) AS q FROM customer WHERE c_custkey % 5 <> 0) "
)


def _orders(spark, d) -> tuple[DataFrame, DataFrame]:
    from pyspark.sql.window import Window

    rank = lambda c: F.row_number().over(Window.partitionBy("c_nationkey").orderBy(c, "c_custkey"))
    rows = _table(spark, d, "customer").where("c_custkey % 5 <> 0")
    made = [rows.select(F.col("c_nationkey").alias("version"), F.concat(F.lit("/P/"), "c_custkey").alias("url"), rank(c).alias("position"), F.lit(0).alias("depth")) for c in ("c_acctbal", "c_name")]
    return made[0], made[1]


for _name in ("jn13_pairs_in_order", "agg15_concordance"):

    @query(_name, _SQL_ORDERS + "SELECT v AS version, count(*) AS n, round(coalesce(any_value(s), 1.0), 9) AS accuracy FROM a LEFT JOIN (SELECT x.v, avg(CASE WHEN x.q < y.q THEN 1.0 ELSE 0.0 END) AS s FROM a x JOIN a y ON x.v = y.v AND x.p < y.p GROUP BY 1) USING (v) GROUP BY 1")
    def _(spark, d):
        return toc.concordance(toc.matched(*_orders(spark, d))).select("version", "n", F.round("accuracy", 9).alias("accuracy"))


@query("srt3_previews", "SELECT c_nationkey AS version, side, place, 'p/' || c_custkey AS key FROM (SELECT c_nationkey, c_custkey, CASE WHEN c_custkey % 5 = 1 THEN 'missing' ELSE 'extra' END AS side, row_number() OVER (PARTITION BY c_nationkey, c_custkey % 5 ORDER BY 'p/' || c_custkey) AS place FROM customer WHERE c_custkey % 5 IN (1, 2)) WHERE place <= 20")
def _(spark, d):
    a, b = _orders(spark, d)
    number = F.regexp_extract("url", r"(\d+)$", 1).cast("long")
    found = toc.previews(toc.matched(a.where(number % 5 != 2), b.where(number % 5 != 1)))
    return found.withColumn("place", F.col("place").cast("long"))


@query("agg18_any_all", "SELECT o_custkey AS version_sitemap, count(*) AS n FROM orders GROUP BY 1 HAVING bool_and(o_orderstatus <> 'F') ")
def _(spark, d):
    o = _table(spark, d, "orders").withColumnRenamed("o_custkey", "version_sitemap")
    return manifest.clean_versions(o.groupBy("version_sitemap").agg(F.count("*").alias("n")), o.where("o_orderstatus = 'F'"))


@query("csh4_dita_toc", "SELECT o_custkey AS version, min(CASE WHEN n1 > 0 THEN 'nav' WHEN n2 > 0 THEN 'list' ELSE 'page' END) AS source, count(*) AS nodes FROM (SELECT o_custkey, o_orderstatus, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) OVER w AS n1, sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) OVER w AS n2 FROM orders WINDOW w AS (PARTITION BY o_custkey)) WHERE (n1 > 0 AND o_orderstatus = 'F') OR (n1 = 0 AND n2 > 0 AND o_orderstatus = 'O') OR (n1 = 0 AND n2 = 0 AND o_orderstatus = 'P') GROUP BY 1")
def _(spark, d):
    o = _table(spark, d, "orders")

    def rows(status: str, name: str) -> DataFrame:
        return o.where(F.col("o_orderstatus") == status).select(
            F.col("o_custkey").alias("version"), F.col("o_orderkey").alias("ord"), F.concat(F.lit("p"), "o_orderkey").alias("output_path"), F.concat(F.lit("t"), "o_orderkey").alias("title"), F.concat(F.lit(name), "o_orderkey").alias("toc_path")
        )

    nodes = dita_toc(rows("F", "nav"), rows("O", "list"), rows("P", "page"))
    return nodes.groupBy("version").agg(F.regexp_extract(F.min("title"), "^([a-z]+)", 1).alias("source"), F.count("*").alias("nodes"))


# Release notes: a span for each line of each document.
def _spans(spark, d) -> DataFrame:
    k, i = F.col("doc_id"), F.col("i")
    y = (i % 100 * 8).cast("double")
    rows = _table(spark, d, "documents").select("doc_id", "source", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("i", "text"))
    return rows.select(
        F.col("source").alias("doc"), (k % 7).cast("int").alias("page"), F.lit(800.0).alias("page_h"), (k * 10000 + i).alias("block"), F.lit(50.0).alias("block_x0"), y.alias("block_y0"), (y + 10).alias("block_y1"),
        F.lit(0).alias("line"), y.alias("line_y"), F.lit(0).alias("span"), "text", F.lit("Helvetica").alias("font"), (9 + (k + i) % 4).cast("double").alias("size"), F.when((k + i) % 3 == 0, 16).otherwise(0).alias("flags"),
        F.lit(50.0).alias("x0"), F.lit(90.0).alias("x1"),
    )


_SQL_SPANS = (
    "WITH s AS (SELECT source AS doc, doc_id % 7 AS page, doc_id * 10000 + i AS block, i % 100 * 8 AS y, t, CAST(9 + (doc_id + i) % 4 AS DOUBLE) AS size, (doc_id + i) % 3 = 0 AS bold "
    "FROM (SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS t, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents) WHERE NOT regexp_matches(t, '^[\\s\xa0\x0b]*$')) "
)
_SQL_ZONE = "y >= 64 AND y + 10 <= 736"

for _name in ("pdf7_body_size", "agg13_weighted_mode"):

    @query(
        _name,
        _SQL_SPANS + f", g AS (SELECT doc, size, sum(length(t)) AS n FROM s WHERE page BETWEEN 1 AND 5 AND {_SQL_ZONE} GROUP BY 1, 2) "
        "SELECT doc, coalesce(size, 12.0) AS body FROM (SELECT DISTINCT source AS doc FROM documents) LEFT JOIN (SELECT doc, size FROM g QUALIFY row_number() OVER (PARTITION BY doc ORDER BY n DESC, size) = 1) USING (doc)",
    )
    def _(spark, d):
        return pdf.body_size(_spans(spark, d))


for _name in ("pdf8_repeated_headings", "agg14_repeated_texts"):

    @query(_name, _SQL_SPANS + "SELECT doc, trim(t, ' ') AS text FROM s WHERE bold AND length(trim(t, ' ')) BETWEEN 1 AND 59 GROUP BY 1, 2 HAVING count(DISTINCT page) >= 2")
    def _(spark, d):
        return pdf.repeated_headings(_spans(spark, d))


_SQL_TEXT = r"trim(regexp_replace(t, '[\s\xa0\x0b]+', ' ', 'g'))"


@query("pdf10_blocks", _SQL_SPANS + f"SELECT doc, block, {_SQL_TEXT} AS text FROM s WHERE {_SQL_ZONE}")
def _(spark, d):
    return pdf.blocks(_spans(spark, d)).select("doc", "block", "text")


@query("jn15_table_overlap", _SQL_SPANS + f"SELECT doc, block FROM s WHERE {_SQL_ZONE} AND NOT (page = 2 AND 200 < y + 10 AND 400 > y)")
def _(spark, d):
    spans = _spans(spark, d)
    tables = spans.select("doc").distinct().select("doc", F.lit(2).alias("page"), F.lit(0.0).alias("x0"), F.lit(200.0).alias("y0"), F.lit(600.0).alias("x1"), F.lit(400.0).alias("y1"))
    return pdf.blocks(spans, tables).select("doc", "block")


def _made_spans(spark, d, *parts: tuple[str, str, int, float, float]) -> DataFrame:
    """Parts (text, font, line, x0, x1) of one block for each supplier."""
    rows = _table(spark, d, "supplier")
    part = F.explode(F.array(*[F.struct(F.lit(i).alias("span"), F.lit(t).alias("t"), F.lit(f).alias("font"), F.lit(n).alias("line"), F.lit(a).alias("x0"), F.lit(b).alias("x1")) for i, (t, f, n, a, b) in enumerate(parts)]))
    return rows.select("s_suppkey", part.alias("p")).select(
        F.col("s_suppkey").alias("doc"), F.lit(0).alias("page"), F.lit(800.0).alias("page_h"), F.lit(1).alias("block"), F.lit(50.0).alias("block_x0"), F.lit(100.0).alias("block_y0"), F.lit(120.0).alias("block_y1"), F.col("p.line").alias("line"),
        (F.col("p.line") * 12.0).alias("line_y"), F.col("p.span").alias("span"), F.replace("p.t", F.lit("@@"), F.col("s_suppkey").cast("string")).alias("text"), F.col("p.font").alias("font"), F.lit(12.0).alias("size"), F.lit(0).alias("flags"),
        F.col("p.x0").alias("x0"), F.col("p.x1").alias("x1"),
    )


@query("pdf6_text_assembly", "SELECT s_suppkey AS doc, 'Run `cmd' || s_suppkey || '` now Then go on' AS text FROM supplier")
def _(spark, d):
    spans = _made_spans(spark, d, ("Run", "Arial", 0, 50.0, 60.0), ("cmd@@", "Menlo", 0, 62.0, 80.0), ("now", "Arial", 0, 83.0, 90.0), ("Then", "Arial", 0, 90.2, 99.0), ("go  on", "Arial", 1, 50.0, 70.0))
    return pdf.blocks(spans).select("doc", "text")


@query("pdf11_contents_pages", "SELECT s_suppkey AS doc FROM supplier WHERE s_suppkey % 3 <> 2")
def _(spark, d):
    """By the heading, by lines that end in numbers, and not at all."""
    k = F.col("s_suppkey") % 3
    texts = F.when(k == 0, F.array(F.lit("h1|Contents"), F.lit("body|x"))).when(k == 1, F.array(F.lit("body|Intro 3"), F.lit("body|Setup5"), F.lit("body|Use 9"))).otherwise(F.array(F.lit("body|Contents"), F.lit("body|Intro 3"), F.lit("body|a 1234"), F.lit("body|b")))
    rows = _table(spark, d, "supplier").select(F.col("s_suppkey").alias("doc"), F.lit(1).alias("page"), F.explode(texts).alias("t"))
    return pdf.contents_pages(rows.select("doc", "page", F.split_part("t", F.lit("|"), F.lit(1)).alias("kind"), F.split_part("t", F.lit("|"), F.lit(2)).alias("text"))).select("doc")


@query("srt7_blocks_by_height", "SELECT n_regionkey AS doc, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey * 7 % 25, n_nationkey) AS place, n_name AS text FROM nation")
def _(spark, d):
    k = F.col("n_nationkey")
    found = _table(spark, d, "nation").select(F.col("n_regionkey").alias("doc"), F.lit(1).alias("page"), k.alias("block"), F.lit(10.0).alias("body"), (k * 7 % 25 * 30).cast("double").alias("y"), F.lit(50.0).alias("x"), F.lit("body").alias("kind"), F.col("n_name").alias("text"))
    return pdf.page_lines(found).select("doc", F.col("seq").cast("long").alias("place"), "text")


# Runners.
@query(
    "orc3_dita_runner",
    "SELECT 'csh' AS name, count(*) FILTER (n_nationkey % 4 <> 0) AS n FROM nation UNION ALL SELECT 'csh_unresolved', count(*) FILTER (n_nationkey % 4 = 0) FROM nation UNION ALL SELECT 'converted', count(*) FROM nation "
    "UNION ALL SELECT 'outputs', count(*) FROM nation UNION ALL SELECT 'renames', count(*) FROM nation UNION ALL SELECT 'toc', count(*) + 1 FROM nation",
)
def _(spark, d):
    n, k = _table(spark, d, "nation"), F.col("n_nationkey")
    v = F.lit("v")
    guid = F.concat(F.lit("GUID"), k, F.lit(".html"))
    url = F.concat(F.lit("https://h/p/"), guid)
    html = F.concat(F.lit('<html><head><title>'), "n_name", F.lit('</title><meta name="DC.type" content="task"/></head><body><article><p>'), "n_name", F.lit("</p></article></body></html>"))
    none = n.where("n_nationkey < 0").select(v.alias("version"), k.alias("ord"), F.lit("").alias("output_path"), F.lit("").alias("title"), F.lit("").alias("toc_path"))
    tables = {
        "topics": n.select(v.alias("version"), F.lit("root").alias("folder"), guid.alias("guid"), F.col("n_name").alias("list_title"), F.lit("").alias("page_title")),
        "manifest": n.select(k.alias("ord"), url.alias("url"), F.lit("").alias("output_path"), v.alias("version_sitemap"), F.lit("sdl_dita").alias("version_format")),
        "pages": n.select(k.alias("page_id"), url.alias("url"), html.alias("html")),
        "contexts": n.select(v.alias("version"), F.concat(F.lit("C"), k).alias("name"), F.when(k % 4 == 0, F.lit("lost.html")).otherwise(guid).alias("target")),
        "nav": none, "topic_list": none,
    }
    outcomes, good = run_all({"dita": dita_steps()}, tables)
    made = outcomes["dita"].tables
    rows = [(name, made[name].count()) for name in ("csh", "csh_unresolved", "converted", "outputs", "renames", "toc") if good]
    return spark.createDataFrame(rows, "name string, n bigint")


@query(
    "orc4_webworks_runner",
    "SELECT 'converted' AS name, count(*) AS n FROM nation UNION ALL SELECT 'csh', count(*) FILTER (n_nationkey % 2 = 0) FROM nation UNION ALL SELECT 'csh_unresolved', count(*) FILTER (n_nationkey % 2 = 1) FROM nation UNION ALL SELECT 'toc', count(*) FROM nation",
)
def _(spark, d):
    n, k = _table(spark, d, "nation"), F.col("n_nationkey")
    g = F.lit("g").alias("guide")
    tables = {
        "files": n.select(F.concat(F.lit("cache/p"), k, F.lit(".htm")).alias("path"), F.lit("<blockquote><p>x</p></blockquote>").alias("html")),
        "redirects": n.select(g, F.concat(F.lit("T"), k).alias("topic"), k.alias("csh_id"), k.alias("ord")),
        "topics": n.select(g, F.concat(F.lit("T"), k).alias("topic"), F.concat(F.lit("p"), k, F.lit(".htm#a")).alias("href")),
        "guide_files": n.where("n_nationkey % 2 = 0").select(g, F.concat(F.lit("p"), k, F.lit(".htm")).alias("href"), F.concat(F.lit("p"), k, F.lit(".md")).alias("md_path")),
        "toc_nodes": n.select(g, F.col("n_name").alias("title"), F.concat(k, F.lit("#a")).alias("link")), "file_index": n.select(g, k.alias("place"), F.concat(F.lit("p"), k, F.lit(".htm")).alias("href")),
    }
    outcomes, _good = run_all({"webworks": webworks_steps()}, tables)
    made = outcomes["webworks"].tables
    return spark.createDataFrame([(name, made[name].count()) for name in ("converted", "csh", "csh_unresolved", "toc")], "name string, n bigint")
