"""Operator 8, benchmark decontamination.

The hashes of the benchmark's normalised windows form a set that is broadcast with the plan, as a table of marked slots (32 for each window, at most
``MOST_SLOTS``); each document's word windows are scanned in place.  A window's first words are looked up, then the whole window; what is
left is spelled out and verified as a string in a join with the benchmark's windows.  There is one way for every size of benchmark: with more windows
than slots more candidates reach the join, and the results are the same.

Null or empty text: no words, not contaminated.  An item of fewer words than a window is one window; one of none is nothing.  Null
item_id: its windows count as hits, but the item has no name and is not among the items.  Repeated rows: each is reported.  Empty tables: no rows, or no hits.
Columns other than doc_id, item_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, running_sum, saved

# Fixed value: a word, after A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
HEAD = 3
SLOTS, LEAST_SLOTS, MOST_SLOTS = 32, 1 << 12, 1 << 23
#: Windows up to which they are broadcast to the join; a row is under 200 bytes for words of usual length.
MAX_BROADCAST_WINDOWS = 100_000
#: Hits up to which the rows they stand for are broadcast; each is its window's text.
MAX_BROADCAST_HITS = 300_000


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """item, size (words in the window) and text of each distinct window of each item."""
    w = F.col("w")
    return (
        benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("w"))
        .where(F.size(w) > 0)
        .withColumn("size", F.least(F.lit(window), F.size(w)))
        .withColumn("at", F.explode(F.sequence(F.lit(1), F.size(w) - F.col("size") + 1)))
        .select("item", "size", F.array_join(F.slice(w, F.col("at"), F.col("size")), " ").alias("text"))
        .distinct()
    )


def _hash(words: Column, at: Column, n: int, size: int) -> Column:
    """Of ``n`` words from 0-based ``at``, given by their own hashes; windows of other sizes hash apart."""
    return F.xxhash64(F.lit(size), *[F.get(words, at + i) for i in range(n)])


def _word_hashes(words: Column) -> Column:
    return F.transform(words, lambda x: F.xxhash64(x))


class Marked:
    """Slots that the benchmark's windows mark: by their first words and as a whole."""

    def __init__(self, windows: DataFrame, sizes: list[int], n: int):
        self.bits = max(LEAST_SLOTS, min(MOST_SLOTS, SLOTS * n)).bit_length() - 1
        own = windows.select("size", _word_hashes(F.split("text", " ")).alias("w"))
        self.tables = []
        for most in (HEAD, max(sizes)):
            spot = F.coalesce(*[F.when(F.col("size") == s, self.slot(_hash(F.col("w"), F.lit(0), min(most, s), s))) for s in sizes])
            table = bytearray(1 << self.bits)
            for r in own.select(spot.alias("k")).distinct().toLocalIterator():
                table[r["k"]] = 1
            self.tables.append(F.lit(table))

    def slot(self, h: Column) -> Column:
        return F.shiftrightunsigned(h, 64 - self.bits).cast("int")

    def __call__(self, h: Column, whole: bool) -> Column:
        return F.substring(self.tables[whole], self.slot(h) + 1, F.lit(1)) == F.lit(b"\x01")


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, hits array<struct<at,size,key>> by position (0-based), items array<string>; every input row once."""
    windows = saved(benchmark_windows(benchmark, window))
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # at most ``window`` of them
    w, n = F.col("w"), windows.count()
    found = docs.select("doc_id", words_of(F.col("text")).alias("w"))
    no_hits, no_items = (F.expr("array()").cast(f"array<{x}>") for x in ("struct<at:int,size:int,key:string>", "string"))
    if not n:
        return found.select("doc_id", F.size(w).cast("long").alias("n_words"), no_hits.alias("hits"), no_items.alias("items"))
    marked = Marked(windows, sizes, n)
    # explode() of one struct keeps the hashes of a text from being computed again for every size.
    found = found.select(F.explode(F.array(F.struct("doc_id", "w", _word_hashes(w).alias("h")))).alias("x")).select("x.*")

    def candidates(size: int) -> Column:
        starts = F.when(F.size(w) >= size, F.sequence(F.lit(0), F.size(w) - size)).otherwise(F.expr("array()").cast("array<int>"))
        near = F.filter(starts, lambda i: marked(_hash(F.col("h"), i, min(HEAD, size), size), False))
        near = F.filter(near, lambda i: marked(_hash(F.col("h"), i, size, size), True))
        return F.transform(near, lambda i: F.struct(i.alias("at"), F.lit(size).alias("size"), F.array_join(F.slice(w, i + 1, F.lit(size)), " ").alias("key")))

    rows = found.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.size(w).cast("long").alias("n_words"), F.concat(no_hits, *map(candidates, sizes)).alias("near"))
    rows = saved(rows)
    known = windows.groupBy("size", F.col("text").alias("key")).agg(F.collect_set("item").alias("own"))
    known = F.broadcast(known) if n <= MAX_BROADCAST_WINDOWS else known
    hits = saved(rows.select("row", F.explode("near").alias("x")).select("row", "x.at", "x.size", "x.key").join(known, ["size", "key"]))
    by_row = hits.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("at", "size", "key"))).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("own")))).alias("items"))
    by_row = F.broadcast(by_row) if hits.count() <= MAX_BROADCAST_HITS else by_row
    return rows.drop("near").join(by_row, "row", "left").select("doc_id", "n_words", F.coalesce("hits", no_hits).alias("hits"), F.coalesce("items", no_items).alias("items"))


def hit_positions(hits: Column) -> Column:
    """0-based positions of the words inside any hit window."""
    return F.array_distinct(F.flatten(F.transform(hits, lambda h: F.sequence(h["at"], h["at"] + h["size"] - 1))))


def contamination_report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    found = find_hits(docs, benchmark, window)
    n_hit = F.when(F.size("hits") > 0, F.size(hit_positions(F.col("hits")))).otherwise(F.lit(0)).cast("long")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
    )


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the text from the first to the last word of each run of hit words taken out; other texts are returned as they are.

    A document that is left without words goes.
    """
    names = docs.columns
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc_id"), F.col("text"))
    found = find_hits(held, benchmark, window).select(F.col("doc_id").alias("row"), "n_words", "hits")
    dirty = F.size("hits") > 0
    text = F.coalesce(F.col("row.text"), F.lit(""))
    # One step at a time, so that what a later step uses for each element is computed once for each text.
    steps = found.withColumn("hit", F.when(dirty, F.array_sort(hit_positions(F.col("hits")))))
    steps = steps.withColumn("low", F.when(dirty, ascii_lower(text)))
    steps = steps.withColumn("sizes", F.transform(F.regexp_extract_all("low", F.lit(WORD), F.lit(0)), lambda x: F.length(x)))
    steps = steps.withColumn("gaps", F.transform(F.split("low", WORD, -1), lambda x: F.length(x)))
    steps = steps.withColumn("ends", running_sum(F.zip_with("gaps", "sizes", lambda g, x: g + F.coalesce(x, F.lit(0)))))
    # Each maximal run of hit words is cut with the gaps inside it; the gaps around it stay.
    steps = steps.withColumn("first", F.filter("hit", lambda p, i: (i == 0) | (F.get("hit", i - 1) != p - 1)))
    steps = steps.withColumn("last", F.filter("hit", lambda p, i: (i == F.size("hit") - 1) | (F.get("hit", i + 1) != p + 1)))
    steps = steps.withColumn("begins", F.transform("first", lambda p: F.get("ends", p) - F.get("sizes", p)))
    steps = steps.withColumn("stops", F.transform("last", lambda p: F.get("ends", p)))
    kept = F.zip_with(F.concat(F.array(F.lit(0)), "stops"), F.concat("begins", F.array(F.length(text))), lambda a, b: F.substring(text, a + 1, b - a))
    clean = F.when(dirty, F.array_join(kept, "")).otherwise(F.col("row.text"))
    rest = F.struct(*[(clean if c == "text" else F.col("row").getField(c)).alias(c) for c in names])
    # explode() drops the documents that are all hits; a filter would be pushed below and search every text twice.
    stay = F.coalesce(F.size("hit") < F.col("n_words"), F.lit(True))
    return steps.select(F.explode(F.when(stay, F.array(rest))).alias("row")).select("row.*")


def remove_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without those that hold a benchmark window."""
    names = docs.columns
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc_id"), F.col("text"))
    return find_hits(held, benchmark, window).where(F.size("hits") == 0).select(*[F.col("doc_id").getField(c).alias(c) for c in names])
