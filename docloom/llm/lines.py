"""Operator 4, fuzzy line deduplication by MinHash.

Lines are known by the 64-bit hash of their bytes, so equal lines are one from the start.  Each distinct line of a batch gets a one-permutation
MinHash signature of its eight-byte shingles (empty bins borrow from the next full one) and 12 bands of five bins.  Lines that share
a band are linked to the band's first line and to their neighbour in it, inside a batch at once and then across batches; lines of a band
that these links leave in different components are compared each with each (``similar``), so every two lines that share a band and are alike
are joined, however rows fall into batches.  Every link is verified by exact Jaccard similarity of the shingle sets; connected lines
form a component, and of each component the line with the smallest (doc_id, row, line number) stays.

Lines are ``\\n``-separated; those of white space only are no lines here and are left alone.  Null or empty text: no lines.  Null doc_id: sorts first.
Every row is a document of its own, whatever its doc_id; of repeated rows one keeps its lines.  Empty table: no rows.  Columns other
than doc_id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, handing_back, numbered, saved, unused
from .similar import SIMILARITY, joined_labels, near_members, set_jaccard

SHINGLE = 8
BANDS, ROWS = 12, 5
BINS = BANDS * ROWS
SEED = 42
CHUNK = 1 << 17  # bytes at a time: its arrays stay in the processor's cache
#: Bits of the filter that keeps texts of candidate lines, for each of them, and in all: 32 MB at most.
FILTER_SHARE, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 28
#: Numbers of kept lines (4 bytes each) up to which the rows that lose lines are broadcast.
MAX_BROADCAST_LINES = 5_000_000
_EMPTY = np.uint32(0xFFFFFFFF)


def lines_of(text: bytes) -> list[tuple[int, bytes]]:
    return [(i, x) for i, x in enumerate(text.split(b"\n")) if x.strip()]


def shingles(line: bytes) -> np.ndarray:
    """Distinct shingles, sorted; a shorter line is one shingle."""
    b = line.ljust(SHINGLE, b"\0")
    n = len(b) - SHINGLE + 1
    out = np.empty(n, np.uint64)
    for o in range(min(SHINGLE, n)):
        k = (n - o + SHINGLE - 1) // SHINGLE
        out[o::SHINGLE] = np.frombuffer(b, "<u8", k, o)
    return np.unique(out)


def jaccard(a: bytes, b: bytes) -> float:
    return set_jaccard(shingles(a), shingles(b))


def band_keys(lines: list[bytes]) -> np.ndarray:
    """(lines, BANDS) keys as signed 64-bit integers."""
    padded = [x.ljust(SHINGLE, b"\0") for x in lines]
    lengths = np.fromiter(map(len, padded), np.int64, len(padded))
    buffer = b"".join(padded)
    n = len(buffer) - SHINGLE + 1
    x = np.empty(n, np.uint64)
    for o in range(min(SHINGLE, n)):
        x[o::SHINGLE] = np.frombuffer(buffer, "<u8", (n - o + SHINGLE - 1) // SHINGLE, o)
    owner = np.repeat(np.arange(len(lines), dtype=np.int64), lengths)[:n]
    inside = np.ones(len(buffer), bool)
    ends = np.cumsum(lengths)
    for j in range(1, SHINGLE):
        inside[ends - j] = False
    inside = inside[:n]
    x, owner = x[inside], owner[inside]
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    low = np.full(len(lines) * BINS, _EMPTY)
    value = x.astype(np.uint32)
    x >>= np.uint64(32)
    x *= np.uint64(BINS)
    x >>= np.uint64(32)
    owner *= BINS
    owner += x.view(np.int64)
    np.minimum.at(low, owner, value)
    low = low.reshape(-1, BINS)
    # An empty bin takes the value of the next full one, changed by the distance to it.
    twice = np.concatenate([low, low], axis=1)
    places = np.where(twice != _EMPTY, np.arange(2 * BINS), 4 * BINS)
    nearest = np.minimum.accumulate(places[:, ::-1], axis=1)[:, ::-1][:, :BINS]
    nearest = np.minimum(nearest, 2 * BINS - 1)
    full = np.take_along_axis(twice, nearest, axis=1).astype(np.uint64) + ((nearest - np.arange(BINS)).astype(np.uint64) << np.uint64(33))
    keys = np.zeros((len(lines), BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        keys = (keys ^ full[:, r::ROWS]) * np.uint64(0xFF51AFD7ED558CCD)
        keys ^= keys >> np.uint64(32)
    return keys.view(np.int64)


def _local(hashes: np.ndarray, lines: list[bytes]) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray]:
    """Verified links inside a batch; (key, hash) of every line's bands."""
    flat = np.concatenate([band_keys(lines[a:b]) for a, b in _chunks(lines)]).ravel()
    order = np.argsort(flat, kind="stable")
    flat, who = flat[order], order // BANDS
    del order
    head = np.append(True, flat[1:] != flat[:-1])
    first = np.flatnonzero(head)
    sizes = np.diff(np.append(first, len(flat)))
    leader = np.repeat(first, sizes)
    rest = np.flatnonzero(~head)
    pairs = np.concatenate([np.stack([who[leader[rest]], who[rest]], 1), np.stack([who[rest - 1], who[rest]], 1)])
    pairs = np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)
    links = [(int(hashes[a]), int(hashes[b])) for a, b in pairs.tolist() if jaccard(lines[a], lines[b]) >= SIMILARITY]
    return links, flat, hashes[who]


def _chunks(lines: list[bytes]):
    start = held = 0
    for i, x in enumerate(lines):
        held += len(x)
        if held >= CHUNK:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(lines):
        yield start, len(lines)


def _hash(line: bytes) -> int:
    h = xxhash.xxh64_intdigest(line, SEED)
    return h - (1 << 64) if h >> 63 else h


def line_table(docs: DataFrame, number: str | None = None) -> DataFrame:
    """One row for each document (doc_id, row, nos, hashes), and for each batch rows with its links (a, b) and its bands (keys, owners).

    ``row`` is the column ``number``, or made here, and holds once the table is saved.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    longs = pa.list_(pa.int64())
    names = ["doc_id", "row", "nos", "hashes", "a", "b", "keys", "owners"]

    def run(batches):
        for batch in batches:
            nos, hashes, met = [], [], {}
            for text in batch.column(2).cast(pa.binary()):
                own = lines_of(text.as_py() or b"")
                nos.append([i for i, _ in own])
                hashes.append([_hash(x) for _, x in own])
                met.update(zip(hashes[-1], (x for _, x in own)))
            none = pa.nulls(batch.num_rows, longs)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(nos, pa.list_(pa.int32())), pa.array(hashes, longs), none, none, none, none], names=names)
            if met:
                links, keys, owners = _local(np.fromiter(met, np.int64, len(met)), list(met.values()))
                a, b = ([x[j] for x in links] for j in (0, 1))
                step = 50_000
                m = max(1, -(-len(keys) // step))
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(m, c.type) for c in batch.columns[:2]] + [pa.nulls(m, pa.list_(pa.int32())), pa.nulls(m, longs), pa.array([a] + [[]] * (m - 1), longs), pa.array([b] + [[]] * (m - 1), longs)]
                    + [pa.array([x[i * step : (i + 1) * step] for i in range(m)], longs) for x in (keys, owners)],
                    names=names,
                )

    schema = f"doc_id {kind}, row bigint, nos array<int>, hashes array<bigint>, a array<bigint>, b array<bigint>, keys array<bigint>, owners array<bigint>"
    text = F.col("text").cast("string")
    row = F.col(number) if number else F.monotonically_increasing_id()
    return docs.select("doc_id", row.alias("row"), text).mapInArrow(handing_back(run), schema)


def _near(rows: DataFrame) -> DataFrame:
    bands = rows.where("keys IS NOT NULL").select(F.explode(F.arrays_zip("keys", "owners")).alias("x")).select(F.col("x.keys").alias("key"), F.col("x.owners").alias("h"))
    return near_members(bands)


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h, line) for the lines in ``wanted``, found by a second reading of the documents behind a bitmap of their hashes."""
    bits = max(LEAST_BITS, min(MOST_BITS, 1 << (FILTER_SHARE * wanted.count()).bit_length()))
    spot = F.pmod(F.col("h"), F.lit(bits)) + 1
    maps = wanted.select(spot.alias("s")).groupBy(F.bitmap_bucket_number("s").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("m"))
    chunks = {r["k"]: bytes(r["m"]) for r in maps.toLocalIterator()}  # pieces of 4 KB, one bit for each hash
    shared = docs.sparkSession.sparkContext.broadcast(chunks)

    def run(batches):
        own_bits = {k: np.frombuffer(m, np.uint8) for k, m in shared.value.items()}
        for batch in batches:
            out: dict[int, bytes] = {}
            for text in batch.column(0).cast(pa.binary()):
                for _, x in lines_of(text.as_py() or b""):
                    h = _hash(x)
                    s = h % bits
                    own = own_bits.get(s // 32768 + 1)
                    if own is not None and own[(s % 32768) >> 3] >> (s & 7) & 1:
                        out[h] = x
            yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int64()), pa.array(list(out.values()), pa.binary())], names=["h", "line"])

    found = docs.select(F.col("text").cast("string")).mapInArrow(handing_back(run), "h bigint, line binary")
    return found.join(wanted, "h", "left_semi").dropDuplicates(["h"])


def kept_lines(docs: DataFrame, number: str | None = None) -> DataFrame:
    """doc_id, row, n_lines and kept, the sorted numbers of the lines that stay, for every row."""
    rows = saved(line_table(docs, number))
    near = saved(_near(rows))
    wanted = saved(near.select(F.explode(F.array("first", "h")).alias("h")).distinct())
    texts = saved(_texts(docs, wanted))
    local = rows.where("a IS NOT NULL").select(F.explode(F.arrays_zip("a", "b")).alias("x")).select("x.a", "x.b")
    labels = joined_labels(near, texts, shingles, local)
    for used in (near, wanted, texts):
        discard(used)
    own = rows.where("hashes IS NOT NULL")
    at = F.struct("doc_id", "row", F.col("x.nos").alias("no"))
    lines = own.select("doc_id", "row", F.explode(F.arrays_zip("hashes", "nos")).alias("x")).select(F.col("x.hashes").alias("h"), at.alias("at"))
    first = lines.groupBy("h").agg(F.min("at").alias("at"))
    first = first.join(labels, F.col("h") == F.col("node"), "left").select(F.coalesce("label", "h").alias("h"), "at")
    stay = first.groupBy("h").agg(F.min("at").alias("at")).groupBy(F.col("at.row").alias("row")).agg(F.array_sort(F.collect_set("at.no")).alias("kept"))
    found = own.select("doc_id", "row", F.size("hashes").cast("long").alias("n_lines")).join(stay, "row", "left").select(
        "doc_id", "row", "n_lines", F.coalesce("kept", F.expr("array()").cast("array<int>")).alias("kept")
    )
    out = saved(found)
    discard(rows)
    return out


def line_report(docs: DataFrame) -> DataFrame:
    return kept_lines(docs).select("doc_id", "n_lines", F.size("kept").cast("long").alias("n_kept"), (F.col("n_lines") - F.size("kept")).alias("n_dropped"), "kept")


def drop_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with only the lines that stay (and blank ones); a row that had lines and keeps none goes."""
    rows, number = numbered(docs)
    n, stay = unused(docs, "n_lines_"), unused(docs, "kept_")
    changed = kept_lines(rows, number).where(F.size("kept") < F.col("n_lines"))  # all other rows stay as they are
    size = changed.agg(F.coalesce(F.sum(F.size("kept") + 8), F.lit(0))).first()[0]
    kept = changed.select(F.col("row").alias(number), F.col("n_lines").alias(n), F.col("kept").alias(stay))
    kept = F.broadcast(kept) if size <= MAX_BROADCAST_LINES else kept
    parts = F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)
    blank = r"^[\x20\x09-\x0D]*$"
    text = F.array_join(F.filter(parts, lambda x, i: x.rlike(blank) | F.array_contains(stay, i)), "\n")
    text = F.when(F.col(n).isNotNull(), text).otherwise(F.col("text"))
    joined = rows.join(kept, number, "left").where(F.col(n).isNull() | (F.size(stay) > 0))
    return joined.select(*[(text if c == "text" else F.col(f"`{c}`")).alias(c) for c in docs.columns])
