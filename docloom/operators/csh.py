"""Context-sensitive help maps (CSH1-CSH3, JN6, JN8, JN9, JN14, AGG16) in one shape: version, csh_id, csh_name, file, anchor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import help_link


def alias_map(alias: DataFrame) -> DataFrame:
    """CSH1: id -> (name, link) of rows (version, ord, name, link, resolved_id); the last row of an id counts, the link stays as written."""
    rows = alias.where(F.col("resolved_id").isNotNull())
    return rows.groupBy("version", F.col("resolved_id").alias("csh_id")).agg(F.max_by("name", "ord").alias("csh_name"), F.max_by("link", "ord").alias("file"))


def alias_pages(alias: DataFrame, pages: DataFrame, order: tuple[str, ...] = ("ord",)) -> DataFrame:
    """CSH1, JN6: page -> csh_ids (not null) and csh_names in ``order``; ``pages`` has version, rel_path (``.htm``) and output_path."""
    columns = (*order, "name", "resolved_id")
    links = alias.withColumn("_link", help_link(F.col("link")))
    exact = pages.join(links, (links["version"] == pages["version"]) & (links["_link"] == pages["rel_path"])).select(pages["output_path"], *columns)
    found = exact.select("output_path").distinct()
    rest = pages.join(found, "output_path", "left_anti")
    loose = rest.join(links, (links["version"] == rest["version"]) & (F.lower(links["_link"]) == F.lower(rest["rel_path"]))).select("output_path", *columns)
    rows = exact.unionByName(loose).groupBy("output_path").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("rows"))
    ids = F.filter(F.transform("rows", lambda r: r["resolved_id"]), lambda x: x.isNotNull())
    return rows.select("output_path", ids.alias("csh_ids"), F.transform("rows", lambda r: r["name"]).alias("csh_names"))


def context_map(contexts: DataFrame, pages: DataFrame, renames: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """CSH2, JN8, JN14: (resolved, unresolved) of rows (version, name, target); GUID targets go by the rename map first."""
    bare = F.regexp_extract("target", "^([^#]*)", 1)
    rows = contexts.select("version", "name", bare.alias("page"), F.regexp_extract("target", "#(.*)$", 1).alias("anchor"))
    if renames is not None:
        rows = rows.join(renames.select("version", F.col("guid").alias("page"), "slug"), ["version", "page"], "left").withColumn("page", F.coalesce("slug", "page")).drop("slug")
    rows = rows.withColumn("rel_path", F.regexp_replace("page", r"\.html?$", ".md"))
    found = rows.join(pages.select("version", "rel_path", "output_path"), ["version", "rel_path"], "left")
    resolved = found.where(F.col("output_path").isNotNull()).select("version", F.lit(None).cast("int").alias("csh_id"), F.col("name").alias("csh_name"), F.col("output_path").alias("file"), "anchor")
    return resolved, found.where(F.col("output_path").isNull()).select("version", "name", "page")


def merged_names(existing: DataFrame, added: DataFrame) -> DataFrame:
    """AGG16: sorted union of names by file."""
    both = existing.select("file", "csh_name").unionByName(added.select("file", "csh_name"))
    return both.groupBy("file").agg(F.array_sort(F.collect_set("csh_name")).alias("csh_names"))


def redirect_map(redirects: DataFrame, topics: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """CSH3, JN9: (map, misses) of rows (guide, topic, csh_id, ord) over topics (guide, topic, href) and files (guide, href, md_path)."""
    rows = redirects.join(topics, ["guide", "topic"], "left").withColumn("_page", F.regexp_extract("href", "^([^#]*)", 1)).withColumn("anchor", F.regexp_extract("href", "#(.*)$", 1))
    found = rows.join(files.select("guide", F.col("href").alias("_page"), "md_path"), ["guide", "_page"], "left")
    good = found.where(F.col("md_path").isNotNull())
    best = good.groupBy("csh_id").agg(F.max_by(F.struct("md_path", "anchor", F.col("topic").alias("topic_name")), "ord").alias("r")).select("csh_id", "r.*")
    return best, found.where(F.col("md_path").isNull()).select("guide", "topic", "csh_id")


def as_json(rows: DataFrame, key: str, *values: str) -> DataFrame:
    """SNK5: one JSON object a version, keys sorted."""
    entry = F.struct(F.col(key).cast("string").alias("k"), F.to_json(F.struct(*values)).alias("v"))
    return rows.groupBy("version").agg(
        F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda e: F.concat(F.to_json(F.array(e["k"])).substr(F.lit(2), F.length(F.to_json(F.array(e["k"]))) - 2), F.lit(":"), e["v"])), ","), F.lit("}")).alias("json")
    )
