"""Manifests and registries (ORC6, JN1-JN4, AGG1-AGG5, AGG17-AGG19, SRC18, SRC21, SRC26, FN19)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import Settings
from ..functions import urls
from .admission import exempt_guids, guid_versions, reject_reason


def pending(versions: DataFrame, registry: DataFrame, key: str = "version_sitemap") -> DataFrame:
    """JN1: versions that the registry has not."""
    return versions.join(registry.select(key).distinct(), key, "left_anti")


def build_manifest(entries: DataFrame, registry: DataFrame, s: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """ORC6: (manifest, rejects) of sitemap rows (ord, url, version_sitemap, product_version, ...).

    Versions in the registry are left out; a page's reason decides, but for GUID pages of GUID versions; version-level URLs come from each
    version's first admitted page.  Empty versions are those in ``entries`` that the manifest lacks.
    """
    rows = pending(entries, registry)
    dita = guid_versions(rows, "version_sitemap", "url", s)
    judged = rows.join(dita, "version_sitemap").withColumn("version_format", F.when(F.col("is_dita"), "sdl_dita").otherwise("madcap"))
    judged = judged.withColumn("reason", exempt_guids(reject_reason(F.col("url"), s), F.col("version_format"))).drop("is_dita")
    admitted = judged.where(F.col("reason").isNull()).drop("reason")
    first = admitted.groupBy("version_sitemap").agg(F.min_by("url", "ord").alias("_first"), F.min_by("product_version", "ord").alias("_version"))
    made = admitted.join(first, "version_sitemap").select(
        *admitted.columns, urls.output_path(F.col("url")).alias("output_path"), urls.alias_url(F.col("_first")).alias("alias_xml_url"),
        urls.zip_url(F.col("_first"), F.col("version_sitemap"), F.col("_version")).alias("zip_url"),
    )
    return made, judged.where(F.col("reason").isNotNull())


def split_by_format(rows: DataFrame, dita: DataFrame, key: str = "version_sitemap") -> tuple[DataFrame, DataFrame]:
    """JN3: (rows of DITA versions, the others)."""
    known = dita.select(key).distinct()
    return rows.join(known, key, "left_semi"), rows.join(known, key, "left_anti")


def dita_outputs(manifest: DataFrame, renames: DataFrame) -> DataFrame:
    """PRJ9: ``manifest`` with ``dita_path``: a GUID page of a renamed version lies in its root under its new name; else the manifest's path, or the URL's.

    ``renames``: version_sitemap, html_root, guid (file name) and slug.
    """
    name = urls.file_name(urls.url_path(F.col("url")))
    roots = renames.groupBy("version_sitemap").agg(F.first("html_root").alias("_root"))
    rows = manifest.withColumn("_name", name).join(roots, "version_sitemap", "left")
    rows = rows.join(renames.select("version_sitemap", F.col("guid").alias("_name"), F.col("slug").alias("_slug")), ["version_sitemap", "_name"], "left")
    page = lambda x: F.regexp_replace(x, r"\.html?$", ".md")
    renamed = F.concat(F.regexp_replace("_root", "/+$", ""), F.lit("/"), page(F.coalesce("_slug", "_name")))
    own = F.coalesce(F.when(F.col("output_path") != "", F.col("output_path")), page(urls.cache_path(F.col("url"))))
    return rows.withColumn("dita_path", F.when((F.col("version_format") == "sdl_dita") & F.col("_root").isNotNull(), renamed).otherwise(own)).drop("_name", "_root", "_slug")


def empty_versions(entries: DataFrame, manifest: DataFrame) -> DataFrame:
    """D6: versions of which no page was admitted, and how many pages they list."""
    return entries.groupBy("version_sitemap").agg(F.count("*").alias("raw_page_count")).join(manifest.select("version_sitemap").distinct(), "version_sitemap", "left_anti")


def first_rows(rows: DataFrame, key: str, order: str = "ord") -> DataFrame:
    """AGG4, SRC12: the first row of each key."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("_n = 1").drop("_n")


def version_totals(manifest: DataFrame) -> DataFrame:
    """AGG2."""
    return manifest.groupBy("version_sitemap").agg(
        F.count("*").alias("page_count"), *[F.min_by(c, "ord").alias(c) for c in ("product_name", "product_version", "doc_name") if c in manifest.columns]
    )


def clean_versions(totals: DataFrame, errors: DataFrame) -> DataFrame:
    """AGG3: versions without a failed page; ``errors`` has one row for each failure."""
    failed = errors.groupBy("version_sitemap").agg(F.count("*").alias("n")).where("n > 0")
    return totals.join(failed, "version_sitemap", "left_anti")


def upsert(registry: DataFrame, fresh: DataFrame, key: str = "version_sitemap") -> DataFrame:
    """D9: one row for each key, the fresh one where there are two."""
    both = registry.withColumn("_new", F.lit(0)).unionByName(fresh.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    others = [c for c in both.columns if c not in (key, "_new")]
    return both.groupBy(key).agg(F.max_by(F.struct(*others), "_new").alias("row")).select(key, "row.*")


def last_wins(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """AGG17."""
    return rows.groupBy(key).agg(F.max_by(value, order).alias(value))


def counters(rows: DataFrame, stats: str = "stats") -> DataFrame:
    """AGG1, AGG19, SNK13: sums of map columns by name."""
    return rows.select(F.explode(stats).alias("name", "n")).groupBy("name").agg(F.sum("n").alias("n"))


def collect_by(rows: DataFrame, key: str, order: str, *columns: str) -> DataFrame:
    """AGG5: each key's rows in order, as an array of structs."""
    return rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, *columns))).alias("rows"))


def download_plan(manifest: DataFrame, zip_covered: DataFrame, cached: DataFrame) -> DataFrame:
    """SRC18, JN2: pages of versions without an archive that the cache lacks."""
    rows = manifest.join(zip_covered.select("version_sitemap").distinct(), "version_sitemap", "left_anti").withColumn("path", urls.cache_path(F.col("url")))
    return rows.join(cached.select("path").distinct(), "path", "left_anti")


def archive_state(versions: DataFrame, extracted: DataFrame, on_disk: DataFrame, failed: DataFrame, dry_run: bool = False) -> DataFrame:
    """SRC21: what is to be done for each version's archive, in order of the tests."""
    key = "version_sitemap"

    def flag(df: DataFrame, name: str) -> DataFrame:
        return df.select(key).distinct().withColumn(name, F.lit(True))

    rows = versions.join(flag(extracted, "_x"), key, "left").join(flag(on_disk, "_d"), key, "left").join(flag(failed, "_f"), key, "left")
    state = F.when(F.col("_x"), "already-extracted").when(F.col("_f"), "missing")
    state = state.when(F.lit(dry_run), "dry-run").when(F.col("_d"), "cached").otherwise("to-download")
    return rows.withColumn("state", state).drop("_x", "_d", "_f")


def cached_entries(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """SRC26, JN4: cached pages (path, version_root) with their manifest row, or else their version's metadata; each path once."""
    meta = ["product_name", "product_version", "doc_name", "version_sitemap"]
    rows = manifest.withColumn("path", urls.cache_path(F.col("url"))).withColumn("version_root", urls.root_of_output(F.col("output_path")))
    known = first_rows(rows, "path").select("path", *[F.col(c).alias(f"_own_{c}") for c in meta])
    roots = first_rows(rows, "version_root").select("version_root", *[F.col(c).alias(f"_root_{c}") for c in meta])
    joined = files.dropDuplicates(["path"]).join(known, "path", "left").join(roots, "version_root", "left")
    return joined.select("path", "version_root", F.col("_own_version_sitemap").isNotNull().alias("in_manifest"), *[F.coalesce(f"_own_{c}", f"_root_{c}").alias(c) for c in meta])
