"""Rename maps of GUID pages and images (FN7, FN14-FN16): slugs from titles, the first free suffix where two collide."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import slugify, title_head
from .toc import majority

# Words that name no image.
GENERIC_ALTS = ("image", "picture", "graphic", "figure", "screenshot", "icon", "diagram", "logo")


def free_slugs(slugs: list[str]) -> list[str]:
    """FN7: ``x``, ``x-2``, ``x-3``, ...: the first that is not taken."""
    taken: set[str] = set()
    counts: dict[str, int] = {}
    out = []
    for s in slugs:
        own, k = s, counts.get(s, 1)
        while own in taken:
            k += 1
            own = f"{s}-{k}"
        counts[s] = k
        taken.add(own)
        out.append(own)
    return out


def with_free_slugs(rows: DataFrame, keys: list[str], order: str, slug: str = "slug") -> DataFrame:
    """``rows`` with collisions of ``slug`` inside each key solved in order.

    Only slugs that differ in nothing but numbers at their end can clash.  Where such a family has one slug, its rows are numbered natively; only mixed
    families (``x`` beside ``x-2``) are put through the exact rule.  Rows without a slug stay without one.
    """
    names = rows.columns
    family = F.regexp_replace(slug, "(-[0-9]+)+$", "")
    same = Window.partitionBy(*keys, "_family")
    marked = rows.withColumn("_family", family).withColumn("_mixed", F.coalesce(F.min(slug).over(same) != F.max(slug).over(same), F.lit(False)))
    n = F.row_number().over(Window.partitionBy(*keys, "_family", slug).orderBy(order))
    calm = marked.where(~F.col("_mixed")).withColumn("_n", n).withColumn(slug, F.when(F.col("_n") > 1, F.concat(slug, F.lit("-"), "_n")).otherwise(F.col(slug)))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(order, kind="stable")
        return group.assign(**{slug: free_slugs(group[slug].tolist())})

    mixed = marked.where("_mixed").drop("_mixed")
    solved = mixed.groupBy(*keys, "_family").applyInPandas(run, mixed.schema)
    return calm.select(*names).unionByName(solved.select(*names))


def topic_renames(topics: DataFrame) -> DataFrame:
    """FN15: (version, folder, guid, list_title, page_title) -> slug, in order of the GUIDs."""
    title = F.coalesce(F.when(F.col("list_title") != "", F.col("list_title")), F.when(F.col("page_title") != "", title_head(F.col("page_title"))), F.regexp_replace("guid", r"\.[^.]*$", ""))
    return with_free_slugs(topics.select("version", "folder", "guid", slugify(title).alias("slug")), ["version", "folder"], "guid")


def image_renames(images: DataFrame) -> DataFrame:
    """FN14: (version, image, alt, ord) -> name: the majority text's slug, or the image's own name if that says nothing."""
    best = majority(images.withColumn("alt", F.trim(F.coalesce("alt", F.lit("")))), ["version", "image"], "alt", "ord")
    suffix = F.regexp_extract("image", r"(\.[^.]*)$", 1)
    plain = (F.length("alt") < 4) | F.lower("alt").isin(*GENERIC_ALTS)
    rows = best.select("version", "image", suffix.alias("suffix"), plain.alias("plain"), slugify(F.col("alt")).alias("slug"))
    named = with_free_slugs(rows.where(~F.col("plain")), ["version", "suffix"], "image")
    kept = rows.where("plain").select("version", "image", F.col("image").alias("name"))
    return named.select("version", "image", F.concat("slug", "suffix").alias("name")).unionByName(kept)


def toc_paths(topics: DataFrame) -> DataFrame:
    """FN16: GUID -> ancestors and title, parted by pipes."""
    return topics.select("version", "guid", F.array_join(F.concat("ancestors", F.array("list_title")), "|").alias("toc_path"))
