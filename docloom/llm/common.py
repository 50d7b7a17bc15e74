"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import ctypes
import gc
import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

_written: list[tuple[SparkSession, str, int]] = []
_count = 0


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees; one of our own only where the session names none and there are no other machines."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="docloom-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def unused(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` written with a number for each row that stays the same whenever it is read, and that column's name."""
    name = unused(df, "row_number_")
    return saved(df.withColumn(name, F.monotonically_increasing_id())), name


def saved(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet in the shared folder and read it back."""
    global _count
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/docloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path, _count))
    _count += 1
    out = spark.read.schema(df.schema).parquet(path)
    out._docloom_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete what ``saved`` wrote for ``df`` once nothing reads it any more."""
    path = getattr(df, "_docloom_path", None)
    if path:
        _delete(df.sparkSession, path)
        _written[:] = [x for x in _written if x[1] != path]


def written() -> int:
    """A mark: how many tables have been written so far."""
    return _count


def release(since: int, until: int) -> None:
    """Delete the tables that were written between two marks, when nothing reads them any more."""
    for own in [x for x in _written if since <= x[2] < until]:
        _delete(own[0], own[1])
        _written.remove(own)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _sweep() -> None:
    for spark, path, _ in _written:
        try:
            _delete(spark, path)
        except Exception:  # the session is gone; its shared folder outlives it
            return


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hand_back() -> None:
    """Return to the system what this process has freed; allocators keep it otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim:
        trim(0)


def handing_back(run):
    """An Arrow pass like ``run`` whose worker holds no freed memory before and after it: idle workers stay beside their executor and count with it."""

    def whole(batches):
        hand_back()
        yield from run(batches)
        hand_back()

    return whole


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; the fast built-in serves texts that are all ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def running_sum(lengths: Column) -> Column:
    """Inclusive prefix sums of an array of int by doubling steps: O(n log n), where a fold that appends copies n times."""
    steps = F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(F.size(lengths), F.lit(1)))).cast("int"))),
        lambda k: F.expr("1").cast("int") * F.pow(F.lit(2.0), k).cast("int"),
    )
    return F.aggregate(
        steps,
        lengths,
        lambda acc, d: F.transform(acc, lambda x, i: x + F.when(i >= d, F.get(acc, i - d)).otherwise(F.lit(0))),
    )
