"""Which pages are topics (FLT1-FLT6, FLT9-FLT11), with the reason of every rejection as a column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import urls


def reject_reason(url: Column, s: Settings = Settings()) -> Column:
    """FLT1: NULL admits.  File names are compared in lower case, a page without suffix is admitted."""
    path = urls.url_path(url)
    name, suffix = urls.file_name(path), urls.extension(path)
    out = F.when((suffix != "") & ~F.lower(suffix).isin(*s.html_extensions), F.concat(F.lit("non-html-extension:"), F.lower(suffix)))
    out = out.when(F.lower(name).isin(*s.shell_pages), F.concat(F.lit("shell-page:"), name))
    out = out.when(name.rlike(f"(?i){s.guid_page}"), F.lit("guid-page"))
    for segment in s.skip_segments:
        bare = segment.rstrip("/")
        out = out.when(F.contains(path, F.lit(bare)), F.lit(f"skip-path:{bare.lstrip('/')}"))
    return out


def admitted_strictly(url: Column, s: Settings = Settings()) -> Column:
    """FLT2: names as written, a suffix is needed, segments with both slashes."""
    path = urls.url_path(url)
    name, suffix = urls.file_name(path), urls.extension(path)
    out = ~name.isin(*s.shell_pages_exact) & F.lower(suffix).isin(*s.html_extensions) & ~name.rlike(f"(?i){s.guid_page}")
    for segment in s.skip_segments:
        out = out & ~F.contains(path, F.lit(segment))
    return out


def exempt_guids(reason: Column, version_format: Column) -> Column:
    """FLT3: versions of the GUID format keep their GUID pages."""
    return F.when(~((version_format == "sdl_dita") & (reason == "guid-page")), reason)


def guid_versions(rows: DataFrame, version: str, url: str, s: Settings = Settings()) -> DataFrame:
    """FLT4: for each version, whether any of its pages has a GUID name."""
    name = urls.file_name(urls.url_path(F.col(url)))
    return rows.groupBy(version).agg(F.bool_or(name.rlike(f"(?i){s.guid_page}")).alias("is_dita"))


def dita_versions(archives: DataFrame, manifest: DataFrame) -> DataFrame:
    """FLT5: versions that the archives' formats or the manifest call a DITA format."""
    dita = F.col("format").isin("sdl_dita", "file_dita")
    own = manifest.select("version_sitemap", F.col("version_format").alias("format"))
    return archives.select("version_sitemap", "format").unionByName(own).where(dita).select("version_sitemap").distinct()


def has_dita(manifest: DataFrame) -> bool:
    """FLT6."""
    return not manifest.where(F.col("version_format").isin("sdl_dita", "file_dita")).limit(1).isEmpty()


def is_topic_file(path: Column) -> Column:
    """FLT9: not a title page, list of figures, list of tables or glossary."""
    return ~F.lower(urls.file_name(path)).isin("title.htm", "lof.htm", "lot.htm", "glossary.htm")


def image_admitted(src: Column, s: Settings = Settings()) -> Column:
    """FLT10 and SNK4: no data URL, and no skipped folder at the start or behind a slash."""
    out = ~F.startswith(src, F.lit("data:")) & (src != "")
    for p in s.image_skip_prefixes:
        out = out & ~F.startswith(src, F.lit(p)) & ~F.contains(src, F.lit("/" + p))
    return out


def nav_filter(root: Column, version: Column, product: str | None = None, number: str | None = None) -> Column:
    """FLT11: part of the product's path in lower case, and the whole version."""
    out = F.lit(True)
    if product:
        out = out & F.contains(F.lower(root), F.lit(product.lower()))
    return out & (version == number) if number else out


def version_formats(files: DataFrame, root: str, path: str) -> DataFrame:
    """SRC22, SRC23: format of each extracted version by the files below its root, and whether it is extracted at all."""
    p = F.col(path)
    tocs, body = p.rlike(r"(^|/)Data/Tocs/[^/]*\.js$"), p.rlike(r"(^|/)static/body\.js$")
    guid = p.rlike(r"(^|/)GUID-[^/]*\.html$")
    seen = files.groupBy(root).agg(F.bool_or(tocs).alias("tocs"), F.bool_or(body).alias("body"), F.bool_or(guid).alias("guid"))
    kind = F.when(F.col("body") & F.col("guid"), "sdl_dita").when(F.col("body"), "file_dita").when(F.col("tocs"), "madcap").otherwise("unknown")
    return seen.select(root, kind.alias("format"), (F.col("tocs") | F.col("body")).alias("extracted"))
