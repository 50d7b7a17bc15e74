"""Operator 1, sharding by histogram sort.

The order is a 63-bit key: 31 bits of the text's hash, then 32 bits of the row's.  Equal texts are neighbours in
it, so a group is divided only where a shard boundary falls inside it, and a hot group still spreads over the low bits.
Bytes below candidate boundaries are counted exactly in rounds: the first over 4,096 equal parts of the key
space, each later one over 256 parts of only those intervals that still hold an unmet splitter.  A
splitter stands when it is within the tolerance, or when one row is all that its interval holds.
Then rows move once, to (shard, cell) windows that number the slots.

Null text: size 8, CRC of the empty text.  Null doc_id: kept.  Repeated rows: each gets a slot of its own.
Empty table: no rows.  Columns other than doc_id and text are ignored, whatever their names, unless ``payload`` is set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import saved

KEY_BITS = 63
FIRST_BITS = 12
ROUND_BITS = 8
SUB_CELLS = 64
HOT_FACTOR = 8


def row_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def key_table(docs: DataFrame, payload: bool = False) -> DataFrame:
    """doc_id, size, text_crc32 and the key, written once so that every later pass reads the same rows."""
    text = F.coalesce(F.col("text"), F.lit(""))
    row = F.xxhash64(F.lit(1), F.col("doc_id"), F.monotonically_increasing_id())
    key = F.shiftrightunsigned(F.xxhash64(text), 33) * F.lit(1 << 32) + F.shiftrightunsigned(row, 32)
    rest = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if payload else []
    return saved(
        docs.select("doc_id", row_size(F.col("text")).alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), key.alias("key"), *rest)
    )


def splitters(keys: DataFrame, shards: int, tolerance: float = 0.001) -> tuple[list[int], list[int]]:
    """The ``shards - 1`` lower bounds of shards 1, 2, ..., and the first-round cells that hold many times the mean of rows."""
    shift = KEY_BITS - FIRST_BITS
    first = _histogram(keys.select(F.shiftrightunsigned("key", shift).alias("part"), "size"))
    total = sum(b for _, b, _ in first)
    slack = total / shards * tolerance
    mean = max(1, sum(n for *_, n in first) // (1 << FIRST_BITS))
    hot = [p for p, _, n in first if n > HOT_FACTOR * mean and n > HOT_FACTOR]
    found: list[int | None] = [None] * (shards - 1)
    targets = [total * (i + 1) / shards for i in range(shards - 1)]
    parts, below = first, {None: 0}
    open_now = dict.fromkeys(range(shards - 1))
    while open_now:
        by_parent: dict = {}
        for p in parts:
            by_parent.setdefault(None if shift == KEY_BITS - FIRST_BITS else p[0] >> step, []).append(p)
        still, next_below = {}, {}
        for i, parent in open_now.items():
            at, target = below[parent], targets[i]
            for p, size, rows in by_parent.get(parent, []):
                if at + size < target:
                    at += size
                    continue
                low, high = abs(target - at), abs(at + size - target)
                if min(low, high) <= slack or rows == 1 or shift == 0:
                    found[i] = (p if low <= high else p + 1) << shift
                else:
                    still[i] = p
                    next_below[p] = at
                break
            else:
                found[i] = 1 << KEY_BITS if not parts else (by_parent[parent][-1][0] + 1) << shift
        open_now, below = still, next_below
        if open_now:
            step = min(ROUND_BITS, shift)
            inside = F.shiftrightunsigned("key", shift).isin(sorted(set(open_now.values())))
            shift -= step
            parts = _histogram(keys.where(inside).select(F.shiftrightunsigned("key", shift).alias("part"), "size"))
    return [min(x, (1 << KEY_BITS) - 1) for x in found], hot


def _histogram(parts: DataFrame) -> list[tuple[int, int, int]]:
    """Exact bytes and rows by part; at most 4,096 rows, or 256 for each splitter."""
    rows = parts.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()
    return sorted((r["part"], r["bytes"], r["n"]) for r in rows)


def assign_shards(docs: DataFrame, shards: int = 24, tolerance: float = 0.001, payload: bool = False) -> DataFrame:
    """Shards of nearly equal bytes: doc_id, size, text_crc32, law, shard, slot, grown_shard, and ``row`` (all input columns) if ``payload``."""
    keys = key_table(docs, payload)
    bounds, hot = splitters(keys, shards, tolerance)
    shard = F.lit(0)
    for b in bounds:
        shard = shard + (F.col("key") >= F.lit(b)).cast("int")
    cell = F.shiftrightunsigned("key", KEY_BITS - FIRST_BITS).cast("int")
    sub = F.when(cell.isin(hot), F.col("key").bitwiseAND(F.lit(SUB_CELLS - 1)).cast("int")).otherwise(F.lit(0)) if hot else F.lit(0)
    placed = keys.select("*", shard.cast("int").alias("shard"), cell.alias("cell"), sub.cast("int").alias("sub"))
    # At most 4,096 cells, one more for each splitter, and 64 for each of at most 512 hot cells: small enough to broadcast at any size.
    counts = placed.groupBy("shard", "cell", "sub").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("shard").orderBy("cell", "sub").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "cell", "sub", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "cell", "sub").orderBy("key", "doc_id")
    out = placed.withColumn("rank", F.row_number().over(within)).join(F.broadcast(starts), ["shard", "cell", "sub"])
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("start") + F.col("rank") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        *(["row"] if payload else []),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 24, tolerance: float = 0.001) -> None:
    """Write every input row under ``path/shard=N``, in slot order within each file."""
    out = assign_shards(docs, shards, tolerance, payload=True)
    names = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    picked = out.select("shard", "slot", *[F.col("row").getField(c).alias(c) for c in names])
    picked.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
