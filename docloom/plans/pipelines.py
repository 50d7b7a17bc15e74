"""ORC3, ORC4: the steps of the DITA and of the WebWorks pipeline, for ``run_steps`` and ``run_all``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..operators import csh, manifest, rename, toc, webworks
from ..operators.html.convert import convert_pages
from .runner import Step

Tables = dict[str, DataFrame]


def dita_toc(nav: DataFrame, topic_list: DataFrame, pages: DataFrame) -> DataFrame:
    """CSH4: nodes of each version from the first of its navigation, its topic list and its pages' own paths that has any.

    All three: version, ord, output_path, title and toc_path.
    """
    return toc.tree_nodes(toc.dita_paths(toc.prefer_source(nav, topic_list, pages)))


def dita_steps(s: Settings = Settings()) -> list[Step]:
    """Over ``topics`` (version, folder, guid, list_title, page_title), ``manifest``, ``pages``, ``contexts``, ``nav`` and ``topic_list``."""

    def names(t: Tables) -> Tables:
        slugs = rename.topic_renames(t["topics"])
        return {"renames": slugs.select("version", "folder", "guid", F.concat("slug", F.lit(".html")).alias("slug"))}

    def convert(t: Tables) -> Tables:
        known = t["renames"].select(F.col("version").alias("version_sitemap"), F.col("folder").alias("html_root"), "guid", "slug")
        return {"outputs": manifest.dita_outputs(t["manifest"], known), "converted": convert_pages(t["pages"], s, dita=True)}

    def help_maps(t: Tables) -> Tables:
        pages = t["outputs"].select(F.col("version_sitemap").alias("version"), F.regexp_extract("dita_path", "([^/]*)$", 1).alias("rel_path"), F.col("dita_path").alias("output_path"))
        found, lost = csh.context_map(t["contexts"], pages, t["renames"])
        return {"csh": found, "csh_unresolved": lost}

    def trees(t: Tables) -> Tables:
        own = t["outputs"].join(t["converted"].select("url", "title", "toc_path"), "url").select(
            F.col("version_sitemap").alias("version"), "ord", F.col("dita_path").alias("output_path"), "title", "toc_path"
        )
        return {"toc": dita_toc(t["nav"], t["topic_list"], own)}

    return [Step(1, "rename", names), Step(2, "convert", convert), Step(3, "csh", help_maps), Step(4, "toc", trees)]


def webworks_steps() -> list[Step]:
    """Over ``files`` (path, html), ``redirects``, ``topics``, ``guide_files``, ``toc_nodes`` and ``file_index``."""
    return [
        Step(1, "convert", lambda t: {"converted": webworks.convert_files(t["files"])}),
        Step(2, "csh", lambda t: dict(zip(("csh", "csh_unresolved"), csh.redirect_map(t["redirects"], t["topics"], t["guide_files"]), strict=True))),
        Step(3, "toc", lambda t: {"toc": webworks.resolve_places(t["toc_nodes"], t["file_index"])}),
    ]
