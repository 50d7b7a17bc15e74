"""Links between alike sets that share a key: all of them, without comparing pairs that other links already join.

First each member of a key is compared with the key's first member and with the one before it.  What those links leave in
different components is then compared exactly, every member with every other of another component.  A hot key's members are dealt to blocks, and
each two blocks meet in a cell of their own, which passes by pairs that its own links have joined and so gives no more links than it has members.  Before
its sets are met, a pair has to pass bounds that no pair of similarity 0.8 fails: two sets of n and m elements with that similarity differ in at most (n + m) / 9 elements, so their sizes and
the parities of their elements over 512 places differ by no more.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import discard, handing_back, saved
from .components import components

SIMILARITY = 0.8
PLACES = 512
BLOCK = 1024
#: One of so many members is in the sample; a key with so many of them there is hot; heaps of a hot key.
SAMPLED, HOT_SAMPLE, HEAPS = 256, 16, 64
#: Hot keys up to which they are broadcast; 16 bytes each.
MAX_BROADCAST_KEYS = 500_000
#: Sets that a task keeps while it verifies pairs, and the length of a text up to which it does.
KEPT_SETS, LONGEST_KEPT = 512, 1 << 16

Sets = Callable[[bytes], np.ndarray]


def set_jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """Of sorted distinct elements; 0 where the sizes alone rule ``SIMILARITY`` out."""
    if min(len(x), len(y)) < SIMILARITY * max(len(x), len(y)):
        return 0.0
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both) if len(x) else 1.0


def near_members(bands: DataFrame, hot_sample: int = HOT_SAMPLE) -> DataFrame:
    """(key, first, before, h) for every member of a key but its first one; (key, h) may repeat in ``bands``.

    A hot key's members are dealt to heaps, each with a first member of its own, and these are named with the first of them: so no
    key is a single task's work.  Which keys are hot is told by a sample of their members; that decides on the dealing only, as what neighbours leave
    apart is compared each with each later on.
    """
    order = lambda *keys: Window.partitionBy(*keys).orderBy("h")

    def named(rows: DataFrame, *keys: str) -> DataFrame:
        first = F.first("h").over(order(*keys).rowsBetween(Window.unboundedPreceding, 0))
        return rows.select(*keys, first.alias("first"), F.lag("h").over(order(*keys)).alias("before"), "h")

    sampled = bands.where(F.pmod(F.xxhash64("h"), F.lit(SAMPLED)) == 0).groupBy("key").count()
    hot = saved(sampled.where(F.col("count") >= hot_sample).select("key", F.lit(HEAPS).alias("heaps")))
    n = hot.count()
    if not n:
        return named(bands, "key").where(F.col("before") != F.col("h"))
    dealt = bands.join(F.broadcast(hot) if n <= MAX_BROADCAST_KEYS else hot, "key", "left")
    heap = F.when(F.col("heaps").isNull(), -1).otherwise(F.pmod(F.xxhash64("h", F.lit(1)), F.lit(HEAPS))).cast("int")
    seen = named(dealt.select("key", "h", heap.alias("heap")), "key", "heap")
    # Written once, as both what follows a heap's first member and these first ones are needed.
    seen = saved(seen.where((F.col("before") != F.col("h")) | (F.col("before").isNull() & (F.col("heap") >= 0))))
    tops = named(seen.where(F.col("before").isNull()).select("key", "h"), "key")
    return seen.where(F.col("before").isNotNull()).drop("heap").union(tops.where(F.col("before") != F.col("h")))


def first_pairs(near: DataFrame) -> DataFrame:
    pairs = near.select(F.explode(F.array(F.struct(F.col("first").alias("a"), F.col("h").alias("b")), F.struct(F.col("before").alias("a"), F.col("h").alias("b")))).alias("x"))
    return pairs.select("x.a", "x.b").distinct()


def verified(pairs: DataFrame, texts: DataFrame, sets: Sets) -> DataFrame:
    """The pairs whose texts (h, line) are alike."""
    both = pairs.join(texts.select(F.col("h").alias("a"), F.col("line").alias("x")), "a").join(texts.select(F.col("h").alias("b"), F.col("line").alias("y")), "b")

    def run(batches):
        keep = lru_cache(KEPT_SETS)(sets)
        of = lambda x: keep(x) if len(x) <= LONGEST_KEPT else sets(x)
        for batch in batches:
            good = [set_jaccard(of(x.as_py()), of(y.as_py())) >= SIMILARITY for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.select("a", "b", "x", "y").mapInArrow(handing_back(run), "a bigint, b bigint")


def sketch(own: np.ndarray) -> np.ndarray:
    """The parity of the number of the set's elements at each of 512 places, as eight words."""
    places = (own * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 9)
    parity = (np.bincount(places.astype(np.int64), minlength=PLACES) & 1).astype(np.uint8)
    return np.packbits(parity, bitorder="little").view(np.uint64)


def cell_links(left: list[int], right: list[int], labels: list[int], own: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that join all alike members ``left`` x ``right`` (numbers of sets) of different labels; none between what is joined already."""
    names = {k: k for k in labels}

    def find(k: int) -> int:
        while names[k] != k:
            names[k] = names[names[k]]
            k = names[k]
        return k

    words = np.stack([sketch(x) for x in own])
    sizes = np.array([len(x) for x in own], np.int64)
    label, others, out = np.array(labels), np.array(right), []
    for x in left:
        y = others[(others > x) & (label[others] != label[x])] if left is right else others[label[others] != label[x]]
        room = sizes[y] + sizes[x]
        y = y[9 * np.abs(sizes[y] - sizes[x]) <= room]
        apart = np.bitwise_count(words[y] ^ words[x]).sum(axis=1, dtype=np.int64)
        for other in y[9 * apart <= sizes[y] + sizes[x]].tolist():
            a, b = find(labels[x]), find(labels[other])
            if a != b and set_jaccard(own[x], own[other]) >= SIMILARITY:
                names[max(a, b)] = min(a, b)
                out.append((labels[x], labels[other]))
    return out


def unjoined_links(near: DataFrame, labels: DataFrame, texts: DataFrame, sets: Sets, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between labels: those of alike members of a key that ``labels`` leaves in different components."""
    wide = near.groupBy("key").count().where("count > 1").select("key")
    own = near.join(wide, "key", "left_semi").select("key", F.explode(F.array("first", "h")).alias("h")).distinct()
    own = saved(own.join(labels, F.col("h") == F.col("node"), "left").select("key", "h", F.coalesce("label", "h").alias("label")))
    parted = own.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("m")).where("lo <> hi")
    member = own.join(parted.select("key", F.ceil(F.col("m") / block).cast("int").alias("nb")), "key")
    member = member.withColumn("k", F.pmod(F.xxhash64("h"), "nb").cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    cells = member.select("key", F.least("k", "o").alias("i"), F.greatest("k", "o").alias("j"), (F.col("k") > F.col("o")).alias("second"), "h", "label")
    rows = cells.join(texts, "h").select("key", "i", "j", "second", "label", "line").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def linked(cell, rows):
        own, labels = [sets(x) for _, _, x in rows], [k for _, k, _ in rows]
        every = list(range(len(rows)))
        if cell[1] == cell[2]:
            return cell_links(every, every, labels, own)
        return cell_links([n for n in every if not rows[n][0]], [n for n in every if rows[n][0]], labels, own)

    def run(batches):
        cell, held = None, []
        for batch in batches:
            out = []
            for key, i, j, second, label, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (key, i, j) != cell:
                    out += linked(cell, held) if held else []
                    cell, held = (key, i, j), []
                held.append((second, label, line))
            yield _link_batch(out)
        yield _link_batch(linked(cell, held) if held else [])

    return rows.mapInArrow(handing_back(run), "a bigint, b bigint").distinct()


def _link_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[j] for x in links], pa.int64()) for j in (0, 1)], names=["a", "b"])


def joined_labels(near: DataFrame, texts: DataFrame, sets: Sets, known: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """(node, label) of all members that some link joins; ``near`` and ``texts`` are saved, ``known`` are links (a, b) already verified."""
    pairs = saved(first_pairs(near))
    links = verified(pairs, texts, sets)
    labels = components(links if known is None else links.union(known))
    more = saved(unjoined_links(near, labels, texts, sets, block))
    discard(pairs)
    if more.isEmpty():
        return labels
    again = components(more).select(F.col("node").alias("was"), F.col("label").alias("now"))
    # Members without a label until now come in as their own ones.
    both = labels.join(again, F.col("label") == F.col("was"), "left").select("node", F.coalesce("now", "label").alias("label"))
    alone = again.join(labels, F.col("was") == F.col("node"), "left_anti").select(F.col("was").alias("node"), F.col("now").alias("label"))
    return both.union(alone)
