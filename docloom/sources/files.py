"""Files as tables and tables as files (SRC3, SRC4, SRC19, SRC20, SRC38, SRC39, SNK1, SNK6-SNK11)."""

from __future__ import annotations

import io
import json
import posixpath
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.html.convert import read_front_matter


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """SRC3: a JSON array as rows; a missing file is an error."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_json_or_empty(spark: SparkSession, path: str, schema: StructType | str, lines: bool = False) -> DataFrame:
    """SRC4, FN19: as above, but missing or malformed files give no rows; ``lines``: an object a line, as ``write_json`` has it."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", not lines).option("mode", "DROPMALFORMED").json(path)


def expand_archives(archives: DataFrame, html_root: str = "html_root") -> DataFrame:
    """SRC20: (path, content, error) of the members of ZIP rows (content, html_root).

    One common top folder is taken off; members lie below the parent of the version's root, and one that would leave it is an error.
    """

    def run(batches):
        for batch in batches:
            for content, root in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                rows = list(_members(content.as_py(), posixpath.dirname((root or "").rstrip("/"))))
                for lo in range(0, len(rows), 64):
                    own = rows[lo : lo + 64]
                    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in own], t) for k, t in enumerate((pa.string(), pa.binary(), pa.string()))], names=["path", "content", "error"])

    return archives.select("content", html_root).mapInArrow(run, "path string, content binary, error string")


def _members(content: bytes, base: str):
    try:
        archive = zipfile.ZipFile(io.BytesIO(content))
    except (zipfile.BadZipFile, TypeError):
        yield base, None, "corrupt_zip"
        return
    with archive:
        names = [n for n in archive.namelist() if not n.endswith("/")]
        tops = {n.split("/", 1)[0] for n in names}
        strip = len(tops) == 1 and all("/" in n for n in names)
        for n in names:
            inner = n.split("/", 1)[1] if strip else n
            path = posixpath.normpath(posixpath.join(base, inner.replace("\\", "/")))
            if inner.startswith("/") or not (path + "/").startswith(base + "/" if base else "") or path.startswith(".."):
                yield n, None, "outside-root"
                continue
            try:
                yield path, archive.read(n), None
            except (zipfile.BadZipFile, OSError, RuntimeError) as e:
                yield path, None, f"unreadable: {type(e).__name__}"


def release_notes(files: DataFrame, pattern: str = "relnotes") -> DataFrame:
    """SRC38, PDF15: (path, slug, version, doc) of PDF paths below ``doc/pdf`` whose stem names a product, a version and a document."""
    stem = F.regexp_extract("path", r"([^/]*)\.pdf$", 1)
    parse = r"^[A-Z]+_(.+)_(\d+(?:\.\d+)*)_([^_]+)$"
    rows = files.where(F.col("path").rlike(r"/doc/pdf/[^/]*\.pdf$") & F.contains(stem, F.lit(pattern)) & stem.rlike(parse))
    return rows.select("path", *[F.regexp_extract(stem, parse, k).alias(n) for k, n in ((1, "slug"), (2, "version"), (3, "doc"))])


def match_products(notes: DataFrame, products: DataFrame) -> DataFrame:
    """JN10: of a version's products the first whose path holds the slug; one row for each note.

    A product's path is cut into all its pieces that are as long as some slug, so that slugs meet them by equality and no note meets every product of its version.
    """
    lengths = notes.agg(F.collect_set(F.length("slug")).alias("_lengths"))
    path = F.col("path_slug")

    def cut(n):
        return F.transform(F.sequence(F.lit(1), F.length(path) - n + 1), lambda at: F.substring(path, at, n))

    pieces = F.array_distinct(F.flatten(F.transform(F.filter("_lengths", lambda n: n <= F.length(path)), cut)))
    rows = products.crossJoin(F.broadcast(lengths)).select(F.col("product_version").alias("version"), F.explode(pieces).alias("slug"), F.struct("ord", "product_name").alias("product"))
    first = rows.groupBy("version", "slug").agg(F.min("product").alias("product"))
    return notes.join(first, ["version", "slug"], "left").select("path", "slug", "version", "doc", F.col("product.product_name").alias("product_name"))


def read_front_matters(files: DataFrame) -> DataFrame:
    """SRC39: (path, meta as JSON, body) of documents (path, text)."""

    def run(batches):
        for batch in batches:
            found = [read_front_matter(t.as_py() or "") for t in batch.column(1)]
            metas = pa.array([json.dumps(m, default=str, ensure_ascii=False) for m, _ in found], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), metas, pa.array([b for _, b in found], pa.string())], names=["path", "meta", "body"])

    return files.select("path", "text").mapInArrow(run, "path string, meta string, body string")


def write_new(rows: DataFrame, path: str, key: str, force: bool = False) -> None:
    """SNK1: append only rows whose key the table lacks; ``force`` replaces all."""
    spark = rows.sparkSession
    if force or not exists(spark, path):
        rows.write.mode("overwrite").parquet(path)
        return
    rows.join(spark.read.parquet(path).select(key), key, "left_anti").write.mode("append").parquet(path)


def write_json(rows: DataFrame, path: str, key: str) -> None:
    """SNK7, SNK11: sorted by key."""
    rows.orderBy(key).write.mode("overwrite").json(path)


def write_csv(rows: DataFrame, path: str, headers: dict[str, str], append: bool = False) -> None:
    """SNK8-SNK10: chosen columns under display names; appending adds files, each with its header."""
    rows.select(*[F.col(k).alias(v) for k, v in headers.items()]).write.mode("append" if append else "overwrite").option("header", True).csv(path)


def nest(nodes: DataFrame) -> DataFrame:
    """SNK6: (version, json) of node rows: the tree of each version, whose nodes are one group at this sink."""

    def run(group):
        rows = sorted(group.to_dict("records"), key=lambda r: (len(r["path"]), r["ord"], r["title"]))
        top: list = []
        at = {(): top}
        for r in rows:
            path = tuple(r["path"])
            node = {"title": r["title"], "file": r["file"], "children": []}
            at.get(path[:-1], top).append(node)
            at[path] = node["children"]
        import pandas as pd

        return pd.DataFrame({"version": [group["version"].iloc[0]], "json": [json.dumps(top, ensure_ascii=False)]})

    return nodes.select("version", "path", "title", "ord", "file").groupBy("version").applyInPandas(run, f"version {nodes.schema['version'].dataType.simpleString()}, json string")


def sorted_listing(listing: DataFrame, path: str = "path") -> DataFrame:
    """SRT1: files in the order of their paths' code points."""
    return listing.orderBy(path)
