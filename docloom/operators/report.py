"""Coverage, cost and conversion reports (AGG7-AGG11, ORC7-ORC9, SRT3-SRT6, SNK8-SNK14, FN18)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.text import duration, stage_seconds
from ..functions.urls import public_url, root_of_alias

CURRENT_SINCE = "2023"


def estimate(entries: DataFrame, s: Settings = Settings()) -> DataFrame:
    """AGG7: pages, images, documents and age of each version; dates are compared as text."""
    rows = entries.groupBy("version_sitemap").agg(
        F.min_by("product_name", "ord").alias("product_name"), F.min_by("product_version", "ord").alias("version"), F.count("*").alias("page_count"),
        F.array_sort(F.collect_set(F.when(F.col("doc_name") != "", F.col("doc_name")))).alias("doc_names"), F.coalesce(F.max(F.substring("lastmod", 1, 10)), F.lit("")).alias("last_modified"),
    )
    year = F.substring("last_modified", 1, 4)
    return rows.select(
        "*", F.floor(F.col("page_count") * s.images_per_page).cast("long").alias("est_images"), year.alias("last_modified_year"),
        F.when(year >= CURRENT_SINCE, "Current").otherwise("Legacy").alias("current_or_legacy"),
    )


def product_rollup(versions: DataFrame) -> DataFrame:
    """AGG8, SRT4: products by pages, most first, with a grand total (NULL name) from the same pass."""
    rolled = versions.rollup("product_name").agg(F.count("*").alias("versions"), F.sum("page_count").alias("pages"), F.grouping("product_name").alias("is_total"))
    return rolled.orderBy(F.desc("is_total"), F.desc("pages"), "product_name")


def total_cost(versions: DataFrame, s: Settings = Settings()) -> DataFrame:
    """AGG9, PRJ14, PRJ13: one row: pages, images, seconds by stage and the total as text."""
    totals = versions.agg(F.coalesce(F.sum("page_count"), F.lit(0)).alias("pages"))
    seconds = stage_seconds(F.col("pages"), s.rates, s.images_per_page)
    return totals.select("pages", F.floor(F.col("pages") * s.images_per_page).cast("long").alias("images"), *[v.alias(f"{k}_s") for k, v in seconds.items()], duration(seconds["total"]).alias("total"))


def version_report(manifest: DataFrame, archives: DataFrame, missing: DataFrame, outputs: DataFrame, tocs: DataFrame) -> DataFrame:
    """ORC9, JN11, AGG11, FN18: a row for each version with its archive's state, counts of outputs by kind and where its tree came from."""
    key = "version_sitemap"
    rows = manifest.groupBy(key).agg(
        F.count("*").alias("topics_in_sitemap"), F.min_by("product_name", "ord").alias("product_name"), F.min_by("product_version", "ord").alias("product_version"),
        F.min_by("alias_xml_url", "ord").alias("alias"),
    )
    rows = rows.select("*", root_of_alias(F.col("alias")).alias("root"), public_url(F.col("alias")).alias("public_url"))
    has = archives.select(key, F.lit(True).alias("_zip"), "format").dropDuplicates([key])
    lost = missing.select(key, F.lit(True).alias("_lost"), "reason").dropDuplicates([key])
    counts = outputs.groupBy("root").agg(F.count_if(F.col("kind") == "md").alias("md_files"), F.count_if(F.col("kind") == "pdf").alias("pdf_files"))
    joined = rows.join(has, key, "left").join(lost, key, "left").join(counts, "root", "left").join(tocs.select("root", "toc_source").dropDuplicates(["root"]), "root", "left")
    status = F.when(F.col("_zip"), "zip").when(F.col("_lost"), F.concat(F.lit("missing: "), "reason")).otherwise("crawl")
    return joined.select(
        key, "product_name", "product_version", "public_url", "topics_in_sitemap", F.coalesce("format", F.lit("unknown")).alias("format"), status.alias("archive"),
        F.coalesce("md_files", F.lit(0)).alias("md_files"), F.coalesce("pdf_files", F.lit(0)).alias("pdf_files"), F.coalesce("toc_source", F.lit("none")).alias("toc_source"),
    )


def by_status(rows: DataFrame, status: str = "status") -> DataFrame:
    """AGG10."""
    return rows.groupBy(status).agg(F.count("*").alias("n"))


def product_list(products: DataFrame, versions: DataFrame) -> DataFrame:
    """ORC8, SRT5: products (slug, name, l2) with the number of versions and the last one; sorted by name or slug in lower case, then by slug and by list."""
    last = versions.groupBy("l2_sitemap_url").agg(F.count("*").alias("version_count"), F.max_by("product_version", "ord").alias("latest_version"), F.max_by("product_name", "ord").alias("listed_name"))
    rows = products.join(last, "l2_sitemap_url", "left")
    named = F.col("listed_name").isNotNull() & (F.col("listed_name") != "")
    out = rows.select("product_slug", F.when(named, F.col("listed_name")).otherwise(F.col("product_name")).alias("product_name"), F.when(named, "metadata").otherwise("slug").alias("name_source"), "l2_sitemap_url", F.coalesce("version_count", F.lit(0)).alias("version_count"), "latest_version")
    return out.orderBy(F.lower(F.coalesce(F.when(F.col("product_name") != "", F.col("product_name")), F.col("product_slug"))), "product_slug", "l2_sitemap_url")


def latest(reports: DataFrame, key: str = "step", at: str = "started_at") -> DataFrame:
    """SNK14: the newest report of each step."""
    others = [c for c in reports.columns if c not in (key, at)]
    return reports.groupBy(key).agg(F.max(at).alias(at), F.max_by(F.struct(*others), at).alias("r")).select(key, at, "r.*")


def step_report(step: str, rows: DataFrame, stats: str = "stats", error: str = "error", skipped: str = "skipped") -> DataFrame:
    """SNK12, D21: one row: the counters, errors and skips of a step's rows."""
    sums = rows.select(F.explode_outer(stats).alias("name", "n")).groupBy("name").agg(F.sum("n").alias("n")).where("name is not null")
    merged = sums.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "n")))).alias("counts"))
    tally = rows.agg(F.count("*").alias("rows"), F.count(error).alias("error_count"), F.count(skipped).alias("skip_count"))
    return tally.crossJoin(merged).select(F.lit(step).alias("step"), "rows", "counts", "error_count", "skip_count")
