"""Hierarchies as flat node rows (HIE1-HIE13, JN7, JN12, JN13, AGG6, AGG15, SRT2): no recursion, siblings by first insertion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import clean_toc_path, collapse
from ..functions.urls import comparable, parent


def majority(rows: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """AGG6: each key's most frequent value, the first seen of those with the same count."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    best = Window.partitionBy(*keys).orderBy(F.desc("n"), "first")
    return counts.withColumn("_k", F.row_number().over(best)).where("_k = 1").drop("_k", "first")


def page_paths(pages: DataFrame) -> DataFrame:
    """HIE1, first half: (version, ord, output_path, title, path array) with the fallbacks; NULL path: orphan.

    A page without a path of its own takes its folder's majority path; its title ends the path.
    """
    own = F.filter(F.split(clean_toc_path(F.coalesce("toc_path", F.lit(""))), r"\|"), lambda x: x != "")
    rows = pages.select("version", "ord", "output_path", collapse(F.coalesce("title", F.lit(""))).alias("title"), own.alias("own"), parent(F.col("output_path")).alias("folder"))
    rows = rows.withColumn("key", F.when(F.size("own") > 0, F.array_join("own", "|")))
    common = majority(rows, ["version", "folder"], "key", "ord").select("version", "folder", F.col("key").alias("common"))
    joined = rows.join(common, ["version", "folder"], "left")
    base = F.when(F.size("own") > 0, F.col("own")).when(F.col("common").isNotNull(), F.split("common", r"\|")).otherwise(F.array().cast("array<string>"))
    return joined.select("version", "ord", "output_path", "title", F.when(F.col("title") != "", F.concat(base, F.array("title"))).alias("path"))


def tree_nodes(paths: DataFrame) -> DataFrame:
    """HIE1, second half: (version, path, depth, title, ord, file): a node for each prefix; the last page with a path is its file."""
    each = paths.where(F.size("path") > 0).select(
        "version", "ord", "output_path", F.col("path").alias("full"), F.explode(F.transform(F.sequence(F.lit(1), F.size("path")), lambda i: F.slice("path", F.lit(1), i))).alias("node")
    )
    leaf = F.size("node") == F.size("full")
    nodes = each.groupBy("version", F.col("node").alias("path")).agg(F.min("ord").alias("ord"), F.max_by(F.when(leaf, F.col("output_path")), F.when(leaf, F.col("ord"))).alias("file"))
    return nodes.select("version", "path", (F.size("path") - 1).alias("depth"), F.element_at("path", -1).alias("title"), "ord", "file")


def orphans(paths: DataFrame) -> DataFrame:
    return paths.where(F.col("path").isNull()).select("version", "output_path")


def dita_paths(pages: DataFrame) -> DataFrame:
    """HIE7: the path's last part is the page; pages without one stand under ``_orphans``, files that begin with ``_`` nowhere."""
    own = F.filter(F.split(clean_toc_path(F.coalesce("toc_path", F.lit(""))), r"\|"), lambda x: x != "")
    name = F.regexp_extract("output_path", r"([^/]*)$", 1)
    order = F.row_number().over(Window.partitionBy("version").orderBy("output_path"))
    path = F.when(F.size(own) > 0, own).otherwise(F.array(F.lit("_orphans"), F.coalesce(F.when(F.col("title") != "", F.col("title")), name)))
    return pages.where(~F.startswith(name, F.lit("_"))).select("version", order.alias("ord"), "output_path", "title", path.alias("path"))


def preorder(nodes: DataFrame) -> DataFrame:
    """HIE4: ``nodes`` with their place in a depth-first walk, siblings by ``ord`` then title.

    A node stands one behind its parent and all that the siblings before it hold: so the widest thing that one task orders is the children of one node.
    """
    steps = nodes.select("version", "path", F.explode(F.transform(F.sequence(F.lit(1), F.size("path")), lambda i: F.slice("path", F.lit(1), i))).alias("prefix"))
    held = steps.groupBy("version", "prefix").agg(F.count("*").alias("held"))
    siblings = Window.partitionBy("version", "up").orderBy("ord", "title").rowsBetween(Window.unboundedPreceding, -1)
    up = F.slice("path", F.lit(1), F.size("path") - 1)
    before = nodes.select("version", F.col("path").alias("prefix"), up.alias("up"), "ord", "title").join(held, ["version", "prefix"])
    before = before.select("version", "prefix", (1 + F.coalesce(F.sum("held").over(siblings), F.lit(0))).alias("step"))
    places = steps.join(before, ["version", "prefix"]).groupBy("version", "path").agg(F.sum("step").alias("position"))
    return nodes.join(places, ["version", "path"])


def prune(nodes: DataFrame, exists: Column) -> DataFrame:
    """HIE2, HIE10: nodes that have a file, or one below them."""
    alive = nodes.where(exists).select("version", F.explode(F.transform(F.sequence(F.lit(1), F.size("path")), lambda i: F.slice("path", F.lit(1), i))).alias("path")).distinct()
    return nodes.join(alive, ["version", "path"], "left_semi")


def attach_files(toc: DataFrame, chunks: DataFrame, pages: DataFrame) -> DataFrame:
    """HIE2, JN7: rows (version, path, ord, node_id) get title and URL from chunks and the output of that page; the rest are sections."""
    named = toc.join(chunks.select("version", "node_id", "url", "title"), ["version", "node_id"], "left")
    files = pages.select("version", comparable(F.col("rel_url")).alias("_k"), F.col("output_path").alias("file"))
    joined = named.withColumn("_k", comparable(F.col("url"))).join(files, ["version", "_k"], "left").drop("_k")
    return joined.withColumn("title", F.coalesce(F.when(F.col("title") != "", F.col("title")), F.concat(F.lit("Section "), F.col("node_id").cast("string"))))


def unused_pages(nodes: DataFrame, pages: DataFrame) -> DataFrame:
    """JN17: outputs that no node has, sorted."""
    used = nodes.where(F.col("file").isNotNull()).select("version", F.col("file").alias("output_path"))
    return pages.select("version", "output_path").join(used, ["version", "output_path"], "left_anti").orderBy("version", "output_path")


def prefer_source(*sources: DataFrame) -> DataFrame:
    """HIE3, CSH4: of each version the rows of the first source that has any."""
    ranked = [s.withColumn("_rank", F.lit(i)) for i, s in enumerate(sources)]
    both = ranked[0]
    for s in ranked[1:]:
        both = both.unionByName(s, allowMissingColumns=True)
    best = both.groupBy("version").agg(F.min("_rank").alias("_rank"))
    return both.join(best, ["version", "_rank"]).drop("_rank")


def version_label(pages: DataFrame) -> DataFrame:
    """HIE9."""
    return pages.groupBy("version").agg(F.min_by(F.concat_ws(" ", "product_name", "product_version"), "ord").alias("label"))


def flat_nav(paths: DataFrame, column: str = "output_path") -> DataFrame:
    """HIE11: files by the first three parts of their path, in order."""
    return paths.groupBy(F.array_join(F.slice(F.split(column, "/"), 1, 3), "/").alias("root")).agg(F.array_sort(F.collect_list(column)).alias("files"))


def common_root(paths: DataFrame, column: str = "output_path") -> DataFrame:
    """HIE12: the folders that all paths share, from the least and the greatest of them."""
    ends = paths.agg(F.min(parent(F.col(column))).alias("a"), F.max(parent(F.col(column))).alias("b"))
    a, b = F.split("a", "/"), F.split("b", "/")
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    n = F.when(F.array_position(same, False) == 0, F.least(F.size(a), F.size(b))).otherwise(F.array_position(same, False) - 1).cast("int")
    return ends.select(F.array_join(F.slice(a, F.lit(1), n), "/").alias("root"))


def matched(reference: DataFrame, other: DataFrame) -> DataFrame:
    """JN12: (version, key, ref_pos, ref_depth, pos, depth, side) over rows (version, url, position, depth); side is matched, missing or extra."""

    def keyed(df: DataFrame, p: str, d: str) -> DataFrame:
        return df.groupBy("version", comparable(F.col("url")).alias("key")).agg(F.min("position").alias(p), F.min_by("depth", "position").alias(d))

    both = keyed(reference, "ref_pos", "ref_depth").join(keyed(other, "pos", "depth"), ["version", "key"], "full_outer")
    return both.withColumn("side", F.when(F.col("pos").isNull(), "missing").when(F.col("ref_pos").isNull(), "extra").otherwise("matched"))


def _ranks(pairs: DataFrame) -> DataFrame:
    own = Window.partitionBy("version")
    return pairs.where("side = 'matched'").select(
        "version", "key", F.row_number().over(own.orderBy("ref_pos")).alias("ref_rank"), F.row_number().over(own.orderBy("pos")).alias("rank"), F.count("*").over(own).alias("n")
    )


def concordance(pairs: DataFrame) -> DataFrame:
    """JN13, AGG15: (version, n, accuracy): share of pairs of matched pages that stand in the same order in both; 1 for fewer than two.

    Two pages are out of order exactly if, at the highest bit in which their ranks differ, the one ahead has it set: counting those bit by bit
    is n log n work, where a self join has n squared pairs.
    """
    ranked = _ranks(pairs).withColumn("r", F.col("rank") - 1)
    levels = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest("n", F.lit(2)).cast("double"))).cast("int"))
    bits = ranked.select("version", "n", "ref_rank", "r", F.explode(levels).alias("k"))
    value = F.expr("shiftright(r, k)")
    bits = bits.select("version", "n", "ref_rank", "k", F.shiftright(value, 1).alias("block"), value.bitwiseAND(1).alias("bit"))
    ahead = Window.partitionBy("version", "k", "block").orderBy("ref_rank").rowsBetween(Window.unboundedPreceding, -1)
    crossed = bits.withColumn("ones", F.when(F.col("bit") == 0, F.coalesce(F.sum("bit").over(ahead), F.lit(0))).otherwise(F.lit(0)))
    sums = crossed.groupBy("version").agg(F.max("n").alias("n"), F.sum("ones").alias("inverted"))
    all_versions = pairs.select("version").distinct().join(sums, "version", "left").select("version", F.coalesce("n", F.lit(0)).alias("n"), "inverted")
    return all_versions.select("version", "n", F.when(F.col("n") < 2, F.lit(1.0)).otherwise(1 - F.col("inverted") / (F.col("n") * (F.col("n") - 1) / 2)).alias("accuracy"))


def compare(reference: DataFrame, other: DataFrame) -> DataFrame:
    """HIE13: a row of counts and accuracies for each version."""
    pairs = matched(reference, other)
    counts = pairs.groupBy("version").agg(
        F.count_if(F.col("side") == "matched").alias("matched"), F.count_if(F.col("side") == "missing").alias("missing"), F.count_if(F.col("side") == "extra").alias("extra"),
        F.count_if((F.col("side") == "matched") & (F.col("depth") != F.col("ref_depth"))).alias("wrong_depth"),
    )
    return counts.join(concordance(pairs).select("version", F.col("accuracy").alias("sequence_accuracy")), "version")


def worst_deltas(pairs: DataFrame, n: int = 15) -> DataFrame:
    """SRT2: the matched pages that moved most, ties by version and key."""
    return _ranks(pairs).select("version", "key", F.abs(F.col("rank") - F.col("ref_rank")).alias("delta")).orderBy(F.desc("delta"), "version", "key").limit(n)


def previews(pairs: DataFrame, n: int = 20) -> DataFrame:
    """SRT3: of each version and side the first ``n`` pages that only one of the trees has, by key."""
    order = Window.partitionBy("version", "side").orderBy("key")
    return pairs.where("side <> 'matched'").withColumn("place", F.row_number().over(order)).where(F.col("place") <= n).select("version", "side", "place", "key")
