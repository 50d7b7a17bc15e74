"""XML sources (SRC5-SRC12, SRC15, SRC16, SRC27, SRC36) with fixed schemas: strings stay strings, missing fields are empty or NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

_TEXT = StringType()
INDEX = StructType([StructField("loc", _TEXT), StructField("lastmod", _TEXT)])
METADATA = StructType([StructField(n, _TEXT) for n in ("name", "productversion", "access_level", "parent_product", "d_name")])
URLSET = StructType([StructField("loc", _TEXT), StructField("lastmod", _TEXT), StructField("metadata", METADATA)])
ALIAS = StructType([StructField(n, _TEXT) for n in ("_Name", "_Link", "_ResolvedId")])
TOPIC = StructType([StructField(n, _TEXT) for n in ("_name", "_href")])


def _xml(spark: SparkSession, path: str, tag: str, schema: StructType) -> DataFrame:
    """Rows in the order in which they stand in their file; namespaces and byte-order marks don't count, broken files give no rows."""
    rows = spark.read.format("xml").option("rowTag", tag).option("ignoreNamespace", "true").option("mode", "DROPMALFORMED").schema(schema).load(path)
    return rows.select("*", F.col("_metadata.file_path").alias("source"), F.monotonically_increasing_id().alias("ord"))


def index_entries(spark: SparkSession, path: str) -> DataFrame:
    """SRC7, SRC8, SRC16: (source, ord, loc): children of an index, trimmed, the first of repeated ones."""
    rows = _xml(spark, path, "sitemap", INDEX).select("source", "ord", F.trim("loc").alias("loc")).where("loc <> ''")
    return rows.groupBy("source", "loc").agg(F.min("ord").alias("ord")).select("source", "ord", "loc")


def url_entries(spark: SparkSession, path: str) -> DataFrame:
    """SRC9, SRC10: pages of a version with their metadata; rows without an address are left out."""
    rows = _xml(spark, path, "url", URLSET)
    names = {"product_name": "name", "product_version": "productversion", "doc_name": "d_name", "access_level": "access_level", "parent_product": "parent_product"}
    meta = [F.coalesce(F.trim(f"metadata.{v}"), F.lit("")).alias(k) for k, v in names.items()]
    return rows.select("source", "ord", F.trim("loc").alias("url"), F.coalesce(F.trim("lastmod"), F.lit("")).alias("lastmod"), *meta).where("url <> ''")


def product_versions(index: DataFrame, entries: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """SRC11, SRC15: a product's versions with their pages; a version whose sitemap is absent is a row with an error, and costs no other.

    A product (``products.product_sitemap``) whose file is no index but a list of pages is its own and only version.
    """
    if products is not None:
        single = products.select(F.col("product_sitemap").alias("source")).join(index.select("source").distinct(), "source", "left_anti")
        single = single.join(entries.select("source").distinct(), "source", "left_semi")
        index = index.select("source", "loc").unionByName(single.select("source", F.col("source").alias("loc")))
    joined = index.select(F.col("source").alias("product_sitemap"), F.col("loc").alias("version_sitemap")).join(
        entries.withColumnRenamed("source", "version_sitemap"), "version_sitemap", "left"
    )
    return joined.withColumn("error", F.when(F.col("url").isNull(), F.lit("no-sitemap")))


def alias_entries(spark: SparkSession, path: str) -> DataFrame:
    """SRC27: (source, ord, name, link, resolved_id); rows without a name or a link are left out, an id that is no number is NULL."""
    rows = _xml(spark, path, "Map", ALIAS)
    return rows.select("source", "ord", F.col("_Name").alias("name"), F.col("_Link").alias("link"), F.expr("try_cast(_ResolvedId AS int)").alias("resolved_id")).where("name <> '' AND link <> ''")


def topic_entries(spark: SparkSession, path: str) -> DataFrame:
    """SRC36: (source, topic, href)."""
    return _xml(spark, path, "Topic", TOPIC).select("source", F.col("_name").alias("topic"), F.col("_href").alias("href")).where("topic <> ''")
