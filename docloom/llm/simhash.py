"""Operator 7, SimHash near-duplicates by multi-index hashing.

Fingerprints (``near_duplicates``).  Equal fingerprints are merged first.  Distinct ones are split into three segments of 21, 21 and 22 bits; two that differ in at most
four bits differ in at most one bit of the first or of the second segment, or in none of the third.  So each fingerprint
probes the Hamming balls of radius 1, 1 and 0 around its segments, meets the table of exact segments and has its
whole distance verified.  Where there are so many fingerprints that 21 bits are too few, halves of 32 bits with balls of radius 2 and 1 stand in.
A hot bucket is dealt to cells of bounded size, and a cell gives a forest that joins what is near in it, not all its pairs.  The links
have the same components as all pairs of four bits or fewer have; none is lost and none is capped.

Texts (``similar_texts``).  Shingles of five words and a Jaccard similarity of 0.8 lie at some 15 % of a fingerprint's bits, so here the fingerprint is wide (128 bits
and more, as the number of documents asks): segments of about log2(n) bits, balls of radius 1 around both the entries and the probes, which meet at a
distance of two, and a bound on the whole distance.  What is left is verified by the exact similarity of the shingle sets.  With ``segments`` of them
at least 94 of 100 pairs at similarity 0.8 meet, and 98 at 0.85.  First only neighbours in the tables of exact segments are compared, so that a group
of copies becomes one; then whatever lies in different groups.

Null or empty text: fingerprint zero, all alike.  Null doc_id: kept, and never a component's name unless all its ids are null.  Repeated rows: each is returned.
Empty table: no rows.  Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from itertools import accumulate, combinations
from math import ceil, comb, log, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, handing_back, numbered, saved
from .components import components
from .similar import SIMILARITY, first_pairs, near_members, verified
from .words import Words, mixed, slices

SEED = 42
MAX_BITS = 4
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_PIECE = 1 << 16

#: (shift, bits, radius) of each segment: the radii leave no room for five differing bits.
THIRDS = ((0, 21, 1), (21, 21, 1), (42, 22, 0))
HALVES = ((0, 32, 2), (32, 32, 1))
#: Up to so many fingerprints the thirds' buckets hold a few rows each on average.
THIRDS_UP_TO = 1 << 24
#: Entries of a bucket up to which all its pairs are met in a join.
HOT_BUCKET = 64
#: Entries and probes of a cell of a hot bucket.
CELL = (2048, 16384)

# Of similar texts.
WIDTH = 5
LEAST_BITS, DEVIATIONS, MISSED = 128, 4, 0.06
#: Members of an expanded bucket up to which one task compares them.
RUN = 4096
#: Numbers of texts to verify up to which they are broadcast; 16 bytes each.
MAX_BROADCAST_TEXTS = 500_000


def fingerprint(text: bytes, width: int = 4) -> int:
    """64 bits; each is set where over half of the shingles' hashes have it set."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda at, n: at + 1 + n))
    starts = [0, *(e + 1 for e in ends)]
    stops = ends[width - 1 :] or ends[-1:]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for lo in range(0, len(stops), _PIECE):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[lo : lo + _PIECE], stops[lo : lo + _PIECE])], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(stops), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """doc_id and fp (the 64 bits as a signed long) of every row."""

    def run(batches):
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py() or b"", width) for t in batch.column(1).cast(pa.binary())), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp bigint")


def _key(fp: Column, k: int, segment: tuple[int, int, int]) -> Column:
    """The segment's bits, and the segment's number in the two top bits."""
    shift, bits, _ = segment
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << bits) - 1)).bitwiseOR(F.lit(k << 60))


def _ball(bits: int, radius: int) -> list[int]:
    return [sum(1 << b for b in own) for r in range(radius + 1) for own in combinations(range(bits), r)]


def _rows(fps: DataFrame, segments, balls: bool) -> DataFrame:
    """(key, fp) of each segment, or of every point of the ball around each."""
    fp = F.col("fp")
    if not balls:
        return fps.select(F.explode(F.array(*[_key(fp, k, s) for k, s in enumerate(segments)])).alias("key"), "fp")
    points = [_xor_all(_key(fp, k, s), F.array(*[F.lit(m).cast("bigint") for m in _ball(s[1], s[2])])) for k, s in enumerate(segments)]
    return fps.select(F.explode(F.concat(*points)).alias("key"), "fp")


def _xor_all(key: Column, masks: Column) -> Column:
    return F.transform(masks, lambda m: key.bitwiseXOR(m))


def _verified(probes: DataFrame, entries: DataFrame) -> DataFrame:
    near = F.bit_count(F.col("p.fp").bitwiseXOR(F.col("t.fp"))) <= MAX_BITS
    return probes.alias("p").join(entries.alias("t"), (F.col("p.key") == F.col("t.key")) & (F.col("p.fp") != F.col("t.fp")) & near).select(
        F.greatest("p.fp", "t.fp").alias("a"), F.least("p.fp", "t.fp").alias("b")
    )


def near_links(fps: DataFrame, thirds_up_to: int = THIRDS_UP_TO, hot_bucket: int = HOT_BUCKET, cell: tuple[int, int] = CELL) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints, given once in ``fps.fp``, that differ in at most four bits: all of calm buckets, and of hot ones a forest for each cell."""
    segments = THIRDS if fps.count() <= thirds_up_to else HALVES
    entries, probes = _rows(fps, segments, False), _rows(fps, segments, True)
    hot = saved(entries.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > hot_bucket))
    if hot.isEmpty():
        return _verified(probes, entries).distinct()
    calm = _verified(probes, entries.join(hot, "key", "left_anti"))
    sizes = probes.join(hot.select("key"), "key", "left_semi").groupBy("key").agg(F.count("*").alias("m")).join(hot, "key")
    sizes = saved(sizes.select("key", F.ceil(F.col("n") / cell[0]).cast("int").alias("ni"), F.ceil(F.col("m") / cell[1]).cast("int").alias("nj")))
    spot = lambda n: F.pmod(F.xxhash64("fp"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = entries.join(sizes, "key").select("key", spot("ni").alias("i"), every("nj").alias("j"), F.lit(True).alias("entry"), "fp")
    met = probes.join(sizes, "key").select("key", every("ni").alias("i"), spot("nj").alias("j"), F.lit(False).alias("entry"), "fp")
    rows = own.union(met).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return calm.union(rows.mapInArrow(_forests, "a bigint, b bigint")).distinct()


def _forests(batches):
    for _, rows in _runs(batches, 3):
        entry = rows[3]
        links = forest(rows[4][entry], np.unique(rows[4]))
        yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in links], pa.int64()) for j in (0, 1)], names=["a", "b"])


def forest(entries: np.ndarray, fps: np.ndarray) -> list[tuple[int, int]]:
    """Links (larger, smaller) that join all of ``fps`` near an entry to it, and no more of them than there are ``fps``."""
    group, out = np.arange(len(fps)), []
    for x in entries.tolist():
        near = np.flatnonzero(np.bitwise_count((fps ^ np.int64(x)).view(np.uint64)) <= MAX_BITS)
        groups, at = np.unique(group[near], return_index=True)
        if len(groups) > 1:
            # The entry is near all of these, so one of each group stands for it.
            out += [(max(x, y), min(x, y)) for y in fps[near[at]].tolist() if x != y]
            group[np.isin(group, groups)] = groups[0]
    return out


def _runs(batches, n_keys: int):
    """(key, columns) of each run of rows with equal first ``n_keys`` columns, as numpy arrays; a run may go on over many batches."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        head = np.zeros(batch.num_rows, bool)
        for c in columns[:n_keys]:
            head[1:] |= c[1:] != c[:-1]
        edges = [0, *np.flatnonzero(head).tolist(), batch.num_rows]
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            key = tuple(c[lo] for c in columns[:n_keys])
            if key != last and held:
                yield last, [np.concatenate(c) for c in zip(*held, strict=True)]
                held = []
            last = key
            held.append([c[lo:hi] for c in columns])
    if held:
        yield last, [np.concatenate(c) for c in zip(*held, strict=True)]


def near_duplicates(docs: DataFrame, width: int = 4) -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id that a chain of links reaches."""
    rows = saved(fingerprints(docs, width))
    groups = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    labels = components(near_links(groups.select("fp")))
    own = saved(groups.join(labels, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("label", "fp").alias("label")))
    least = own.groupBy("label").agg(F.min("least").alias("component_id"))
    named = saved(own.join(least, "label").select("fp", "component_id"))
    discard(groups)
    discard(own)
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def near_duplicate_report(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


class Plan:
    """Segments of wide fingerprints: as many bits as tell ``n`` texts apart, and as many segments as leave at most ``MISSED`` of pairs at the threshold unmet."""

    def __init__(self, n: int, similarity: float = SIMILARITY):
        # Two sets of that similarity, of equal size, at the angle between them.
        share = float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)
        self.bits = min(32, max(16, ceil(log2(max(2, n)))))
        meet = sum(comb(self.bits, k) * share**k * (1 - share) ** (self.bits - k) for k in range(3))
        self.segments = max(LEAST_BITS // self.bits, ceil(log(MISSED) / log(1 - meet)))
        width = self.bits * self.segments
        self.words = -(-width // 64)
        self.most = ceil(share * width + DEVIATIONS * (width * share * (1 - share)) ** 0.5)


def shingle_set(text: bytes, width: int = WIDTH) -> np.ndarray:
    return Words().shingles([text], width)[0]


def wide_fingerprint(hashes: np.ndarray, plan: Plan) -> np.ndarray:
    """The fingerprint's words: its bits are set where over half of the distinct shingles' hashes, mixed anew for each word, have them set."""
    ones = np.zeros((plan.words, 64), np.int64)
    for lo in range(0, len(hashes), _PIECE):
        for k in range(plan.words):
            own = mixed(hashes[lo : lo + _PIECE] * np.uint64(2 * k + 3) + np.uint64(k))
            ones[k] += np.unpackbits(own.view(np.uint8).reshape(len(own), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    ones = ones.ravel()
    ones[plan.bits * plan.segments :] = 0
    return np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")


def _segments(fps: np.ndarray, plan: Plan) -> np.ndarray:
    """(texts, segments) keys; the segment's number is in the top bits."""
    bits = np.unpackbits(fps.view(np.uint8), axis=1, bitorder="little")[:, : plan.bits * plan.segments].reshape(len(fps), plan.segments, plan.bits)
    values = bits.astype(np.int64) @ (np.int64(1) << np.arange(plan.bits, dtype=np.int64))
    return values | (np.arange(plan.segments, dtype=np.int64) << np.int64(40))


def _texts_table(rows: DataFrame, number: str, plan: Plan, width: int) -> DataFrame:
    """(number, f0, f1, ..., keys) of every row."""
    names = [number, *(f"f{k}" for k in range(plan.words)), "keys"]

    def run(batches):
        words = Words()
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column(1).cast(pa.binary())]
            found = [wide_fingerprint(h, plan) for lo, hi in slices(texts) for h in words.shingles(texts[lo:hi], width)]
            fps = np.stack(found) if found else np.zeros((0, plan.words), np.uint64)
            keys = pa.FixedSizeListArray.from_arrays(pa.array(_segments(fps, plan).ravel()), plan.segments).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(np.ascontiguousarray(fps[:, k]).view(np.int64)) for k in range(plan.words)), keys], names=names)

    return rows.select(number, F.col("text").cast("string")).mapInArrow(handing_back(run), f"{number} bigint, {', '.join(f'f{k} bigint' for k in range(plan.words))}, keys array<bigint>")


def _distance(a, b, words: int) -> Column:
    return sum((F.bit_count(a(f"f{k}").bitwiseXOR(b(f"f{k}"))) for k in range(words)), F.lit(0))


def _label_pairs(nodes: DataFrame, plan: Plan) -> DataFrame:
    """Pairs (a, b) of nodes of different labels that share a point of the balls around a segment, and differ in at most ``plan.most`` bits."""
    fps = [f"f{k}" for k in range(plan.words)]
    masks = F.array(*[F.lit(m).cast("bigint") for m in _ball(plan.bits, 1)])
    counts = nodes.select(F.explode("keys").alias("key")).groupBy("key").count()
    crowded = saved(counts.where(F.col("count") > RUN).select("key"))
    expanded = nodes.select("node", "label", *fps, F.explode(F.flatten(F.transform("keys", lambda k: _xor_all(k, masks)))).alias("key"))
    if crowded.isEmpty():
        cells = expanded.withColumns({"i": F.lit(0), "j": F.lit(0), "side": F.lit(0)})
    else:  # whatever lies near a crowded key may be hot
        near = crowded.select(F.explode(_xor_all(F.col("key"), masks)).alias("key")).distinct()
        sizes = expanded.select("key").join(near, "key", "left_semi").groupBy("key").agg(F.ceil(F.count("*") / RUN).cast("int").alias("nb")).where("nb > 1")
        parted = expanded.join(saved(sizes), "key", "left").withColumn("k", F.coalesce(F.pmod(F.xxhash64("node"), "nb"), F.lit(0)).cast("int"))
        parted = parted.withColumn("o", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("nb"), F.lit(1)) - 1)))
        cells = parted.withColumns({"i": F.least("k", "o"), "j": F.greatest("k", "o"), "side": (F.col("k") > F.col("o")).cast("int")})
    rows = cells.select("key", "i", "j", "side", "node", "label", *fps).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def run(batches):
        for batch in batches_of_runs(batches):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in near_in_runs(batch, plan.most)], names=["a", "b"])

    return rows.mapInArrow(handing_back(run), "a bigint, b bigint").distinct()


def batches_of_runs(batches, least: int = 1 << 16):
    """Columns (numpy) of neighbouring rows, cut only between runs of equal (key, i, j)."""
    held: list = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        n += batch.num_rows
        if n < least:
            continue
        columns = [np.concatenate(c) for c in zip(*held, strict=True)]
        same = (columns[0] == columns[0][-1]) & (columns[1] == columns[1][-1]) & (columns[2] == columns[2][-1])
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if cut:
            yield [c[:cut] for c in columns]
        held = [[c[cut:] for c in columns]]
        n = len(held[0][0]) if cut else 0
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def near_in_runs(columns: list[np.ndarray], most: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes (larger, smaller) of different labels within a run that differ in at most ``most`` bits; of a cell off the diagonal only across its sides."""
    key, i, j, side, node, label, *fps = columns
    head = np.append(True, (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))
    run = np.cumsum(head)
    starts = np.flatnonzero(head)
    sizes = np.diff(np.append(starts, len(key)))
    found = []

    def keep(a: np.ndarray, b: np.ndarray) -> None:
        fits = (label[a] != label[b]) & ((i[a] == j[a]) | (side[a] != side[b]))
        a, b = a[fits], b[fits]
        apart = sum(np.bitwise_count((f[a] ^ f[b]).view(np.uint64)).astype(np.int32) for f in fps)
        near = apart <= most
        found.append(np.unique(np.stack([np.maximum(node[a[near]], node[b[near]]), np.minimum(node[a[near]], node[b[near]])]), axis=1))

    narrow = np.repeat(sizes <= 64, sizes)
    at = np.flatnonzero(narrow)
    for d in range(1, int(sizes[sizes <= 64].max(initial=1))):
        at = at[at + d < len(key)]
        at = at[run[at + d] == run[at]]
        if not len(at):
            break
        keep(at, at + d)
    for lo, n in zip(starts[sizes > 64].tolist(), sizes[sizes > 64].tolist(), strict=True):
        step = max(1, (1 << 20) // n)
        for a in range(lo, lo + n, step):
            left, right = np.meshgrid(np.arange(a, min(a + step, lo + n)), np.arange(lo, lo + n), indexing="ij")
            before = left < right
            keep(left[before], right[before])
    both = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), np.int64)
    return both[0], both[1]


def similar_texts(rows: DataFrame, number: str, width: int = WIDTH) -> DataFrame:
    """(``number``, label): rows of alike texts have one label.  ``rows`` are numbered and saved."""
    plan = Plan(rows.count())
    fps = [f"f{k}" for k in range(plan.words)]
    made = _texts_table(rows, number, plan, width).withColumn("node", F.xxhash64(*fps))
    made = saved(made)
    nodes = saved(made.groupBy("node").agg(F.min(number).alias("shown"), *[F.first(f).alias(f) for f in fps], F.first("keys").alias("keys")))
    table = F.struct("node", *fps)
    near = near_members(nodes.select(F.explode("keys").alias("key"), table.alias("h")))
    pairs = first_pairs(near).where(_distance(lambda f: F.col("a")[f], lambda f: F.col("b")[f], plan.words) <= plan.most)
    pairs = saved(pairs.select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct())
    labels = saved(components(_alike(rows, number, nodes, pairs, width)))
    own = nodes.join(labels.withColumnRenamed("node", "known"), F.col("node") == F.col("known"), "left").select("node", "keys", *fps, F.coalesce("label", "node").alias("label"))
    more = saved(_label_pairs(own, plan))
    links = _alike(rows, number, nodes, more, width).union(labels.select(F.col("node").alias("a"), F.col("label").alias("b")))
    named = saved(components(links))
    out = saved(made.select(number, "node").join(named.withColumnRenamed("node", "known"), F.col("node") == F.col("known"), "left").select(number, "node", F.coalesce("label", "node").alias("label")))
    for used in (made, nodes, pairs, labels, more, named):
        discard(used)
    return out


def _alike(rows: DataFrame, number: str, nodes: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """The pairs whose texts are alike."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    shown = saved(nodes.select("node", "shown").join(wanted, "node", "left_semi"))
    small = shown.count() <= MAX_BROADCAST_TEXTS
    texts = rows.select(F.col(number).alias("shown"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("line")).join(F.broadcast(shown) if small else shown, "shown")
    texts = saved(texts.select(F.col("node").alias("h"), F.col("line").cast("binary").alias("line")))
    return verified(pairs, texts, lambda text: shingle_set(text, width))


def keep_one(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with one row of each group of alike texts: that of the smallest doc_id (a null one only where there is no other); of several such rows that of the least text hash, then of the least number."""
    rows, number = numbered(docs)
    found = similar_texts(rows, number, width)
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id").alias("id"), "node", F.col(number).alias("n"))
    first = rows.select(F.col(number), "doc_id").join(found, number).groupBy("label").agg(F.min(order).alias("first"))
    gone = saved(found.select(number).join(first.select(F.col("first.n").alias(number)), number, "left_anti"))
    discard(found)
    gone = F.broadcast(gone) if gone.count() <= MAX_BROADCAST_TEXTS else gone
    return rows.join(gone, number, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
