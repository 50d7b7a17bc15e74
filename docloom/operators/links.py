"""Link resolution (FN4, FN17, JN5): links are rows, the index is a table, and the rewritten text is put together in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import urls

LINK = r"(!?\[[^\]]*\])\(([^)\s]+)\)"


def link_index(pages: DataFrame, url: str = "url", path: str = "output_path", order: str | None = None) -> DataFrame:
    """FN17: (key, target); of pages with one key the last by ``order`` counts."""
    place = F.col(order) if order else F.col(url)
    return pages.where(F.col(url).isNotNull()).groupBy(urls.link_key(F.col(url)).alias("key")).agg(F.max_by(F.col(path), place).alias("target"))


def is_rewritable(href: Column, source: Column, s: Settings = Settings()) -> Column:
    """Only relative topic links, and absolute ones of the page's own or a listed host, are looked up."""
    host = urls.url_host(href)
    absolute = href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:")
    own = href.rlike(r"^https?://") & ((host == urls.url_host(source)) | host.isin(*s.internal_hosts))
    topic = F.lower(urls.extension(urls.url_path(F.when(absolute, href).otherwise(F.concat(F.lit("x://h/"), href))))).isin(*s.html_extensions)
    return ~F.startswith(href, F.lit("#")) & ~href.rlike("^(mailto|data|javascript):") & F.when(absolute, own & topic).otherwise(topic)


def target_path(source: Column, href: Column) -> Column:
    """Key under which a link's page is found in the index."""
    path = F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://"), urls.url_path(href)).otherwise(urls.resolve(source, href))
    return F.lower(F.regexp_replace(path, "/+$", ""))


def resolve_links(links: DataFrame, index: DataFrame, source: str = "url", href: str = "href", s: Settings = Settings()) -> DataFrame:
    """``links`` with ``status`` (kept, resolved, unresolved) and ``target``; Spark broadcasts the index only if it is small.

    Links that are kept have no key.  They are most of them, so they are dealt by a hash of the row: rows without a key would all meet in one task.
    """
    wanted = is_rewritable(F.col(href), F.col(source), s)
    own = F.xxhash64(*[c for c, kind in links.dtypes if "map<" not in kind])
    keyed = links.withColumn("_key", F.when(wanted, target_path(F.col(source), F.col(href)))).withColumn("_dealt", F.coalesce("_key", own.cast("string")))
    known = index.select(F.col("key").alias("_known"), "target")
    found = keyed.join(known, (F.col("_dealt") == F.col("_known")) & F.col("_key").isNotNull(), "left")
    status = F.when(F.col("_key").isNull(), "kept").when(F.col("target").isNull(), "unresolved").otherwise("resolved")
    return found.withColumn("status", status).drop("_key", "_dealt", "_known")


def rewrite(pages: DataFrame, index: DataFrame, s: Settings = Settings(), carried: tuple[str, ...] = ()) -> DataFrame:
    """page_id, ``carried``, body, n_resolved, n_unresolved: links to known pages become relative Markdown paths with their fragments.

    ``pages``: page_id, url, output_path, body.  They are read once; rows without a body are left out.
    """
    body = F.col("body")
    found = F.regexp_extract_all(body, F.lit(LINK), F.lit(1))
    hrefs = F.regexp_extract_all(body, F.lit(LINK), F.lit(2))
    pieces = F.split(body, LINK, -1)
    cut = pages.where(body.isNotNull()).select("page_id", "url", "output_path", *carried, F.arrays_zip(pieces.alias("before"), found.alias("label"), hrefs.alias("href")).alias("parts"))
    rows = cut.select("page_id", "url", "output_path", *carried, F.posexplode("parts").alias("at", "part")).select(
        "page_id", "url", "output_path", *carried, "at", F.col("part.before").alias("before"), F.col("part.label").alias("label"), F.col("part.href").alias("href")
    )
    known = resolve_links(rows.withColumn("href", F.coalesce("href", F.lit("#"))), index, s=s)
    fragment = F.regexp_extract("href", "(#.*)$", 1)
    href = F.when(F.col("status") == "resolved", F.concat(urls.relative_path(F.col("output_path"), F.col("target")), fragment)).otherwise(F.col("href"))
    text = F.concat(F.coalesce("before", F.lit("")), F.when(F.col("label").isNotNull(), F.concat("label", F.lit("("), href, F.lit(")"))).otherwise(F.lit("")))
    real = F.col("label").isNotNull()
    return (
        known.groupBy("page_id")
        .agg(
            *[F.first(c).alias(c) for c in carried],
            F.array_sort(F.collect_list(F.struct("at", text.alias("text")))).alias("parts"),
            F.sum((real & (F.col("status") == "resolved")).cast("long")).alias("n_resolved"),
            F.sum((real & (F.col("status") == "unresolved")).cast("long")).alias("n_unresolved"),
        )
        .select("page_id", *carried, F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("body"), "n_resolved", "n_unresolved")
    )


def image_plan(converted: DataFrame, cached: DataFrame, s: Settings = Settings()) -> DataFrame:
    """SNK4, FLT10: images of pages that are in the cache, with their place there."""
    from .admission import image_admitted

    images = converted.select("page_id", "url", F.explode("images").alias("src")).where(image_admitted(F.col("src"), s))
    placed = images.withColumn("path", F.when(F.col("src").rlike("^https?://"), urls.cache_path(F.col("src"))).otherwise(F.substring(urls.resolve(F.col("url"), F.col("src")), 2, 1 << 20)))
    return placed.join(cached.select("path").distinct(), "path", "left_semi").select("page_id", "src", "path").distinct()


def postprocess(pages: DataFrame, index: DataFrame, s: Settings = Settings()) -> DataFrame:
    """FN6: the path in the table of contents cleaned, variables taken out of the text and counted, then links rewritten; a page without a body is a row with an error."""
    from ..functions.text import clean_toc_path, count_tokens, strip_tokens

    bare = pages.select(
        "page_id", "url", "output_path", clean_toc_path(F.coalesce("toc_path", F.lit(""))).alias("toc_path"), F.coalesce(count_tokens(F.col("body")), F.lit(0)).alias("n_tokens"),
        F.when(F.col("body").isNull(), F.lit("no-body")).alias("error"), strip_tokens(F.coalesce("body", F.lit(""))).alias("body"),
    )
    rows = rewrite(bare, index, s, ("toc_path", "n_tokens", "error"))
    return rows.select("page_id", "toc_path", F.when(F.col("error").isNull(), F.col("body")).alias("body"), "n_tokens", "n_resolved", "n_unresolved", "error")
