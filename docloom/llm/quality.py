"""Operator 5, quality rules: base rules, and a perplexity band for each language.

A modified Kneser-Ney model over bytes, of order four, is counted and smoothed by Spark over all documents, for each language, as one table of
n-grams with their log probability; every language has a model, however few its documents.  It trains on what it judges, so it holds every n-gram of every
document.  The most frequent ``HEAD_GRAMS`` go to executors as arrays sorted by hash of language and by n-gram, which are searched by halving;
n-grams beyond them meet the rest of the table in a shuffled join, so the result is that of the whole model at every size.
Perplexity is taken twice, as bits a byte and as bits a word (padding with symbols hides in the first, lists of odd words in the second); both must lie in
the language's band: its median, plus and minus ``width`` scales, where short texts get more room.  Medians and scales (scaled median
absolute deviations, drawn towards that of all languages by the weight of ``PRIOR`` documents) come from exact histograms over all documents.

Null text: no words, so it fails.  Null language: a language of its own.  Null doc_id and repeated rows: judged like any other.
Empty table: no rows.  Columns other than doc_id, text and lang are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType
from pyspark.sql.window import Window

from .common import discard, handing_back, numbered, saved

ORDER = 4
HEAD_GRAMS = 4_000_000
WIDTH = 5.0
PRIOR = 20
FLUSH = 1 << 22
BIN, MOST_BITS = 100, 200.0  # of the histograms of measures: bins in a bit, and bits
#: Length that each measure is a mean over, and the length beyond which texts no longer gather more closely round the median.
MEASURES = {"n_bytes": 1000.0, "n_words": 200.0}

# White space, symbols and limits of the base rules.
WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS, WINDOW, MAX_REPEATED = 20, 8, 30


def base_stats(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    raw = text.encode()
    words = raw.split()
    chars = len(text) - sum(map(text.count, WHITE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur at least twice; equal hashes are verified word by word."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    own = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    own ^= own >> np.uint64(29)
    mixed = np.zeros(n, np.uint64)
    for j in range(window):
        mixed = mixed * np.uint64(0xD6E8FEB86659FD93) + own[j : j + n]
    order = np.sort(mixed)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    met: dict = {}
    for i in np.flatnonzero(np.isin(mixed, twice)).tolist():
        met.setdefault(tuple(words[i : i + window]), []).append(i)
    inside = np.zeros(len(words) + 1, np.int64)
    for places in met.values():
        if len(places) > 1:
            at = np.array(places)
            np.add.at(inside, at, 1)
            np.add.at(inside, at + window, -1)
    return int((np.cumsum(inside) > 0).sum())


def gram_codes(raw: bytes, order: int = ORDER) -> np.ndarray:
    """The bytes that precede and make each predicted byte, packed oldest first; zeros stand before the text and one behind it."""
    b = np.frombuffer(b"\0" * (order - 1) + raw + b"\0", np.uint8).astype(np.uint32)
    n = len(raw) + 1
    out = np.zeros(n, np.uint32)
    for j in range(order):
        out = (out << np.uint32(8)) | b[j : j + n]
    return out


def _language() -> Column:
    """A language's number: the hash of its name."""
    return F.xxhash64(F.coalesce(F.col("lang").cast("string"), F.lit("")))


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(where, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


def count_grams(docs: DataFrame) -> DataFrame:
    """lang (its number), gram, n: counted within each task first, then by Spark over all documents."""

    def run(batches):
        held: dict[int, list] = {}
        sums: dict[int, tuple] = {}
        size = 0

        def fold() -> None:
            for k, own in held.items():
                made = np.concatenate(own)
                made.sort()
                head = np.flatnonzero(np.append(True, made[1:] != made[:-1]))
                part = made[head], np.diff(np.append(head, len(made)))
                sums[k] = _summed([sums[k], part]) if k in sums else part
            held.clear()

        def out():
            for k, (keys, n) in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), k, np.int64)), pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])
            sums.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                codes = gram_codes(text.as_py() or b"")
                held.setdefault(lang, []).append(codes)
                size += len(codes)
                if size > FLUSH:
                    fold()
                    size = 0
                    if sum(len(k) for k, _ in sums.values()) > FLUSH:  # what a task holds is bounded, whatever the texts
                        yield from out()
        fold()
        yield from out()

    parts = docs.select(_language().alias("lang"), F.col("text").cast("string")).mapInArrow(handing_back(run), "lang bigint, gram bigint, n bigint")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _discounts(counts: DataFrame) -> DataFrame:
    """lang, d1, d2, d3: what is taken off counts of one, of two, and of three and more."""
    k = [F.count_if(F.col("n") == i).cast("double") for i in (1, 2, 3, 4)]
    met = counts.groupBy("lang").agg(*[c.alias(f"n{i}") for i, c in enumerate(k, 1)])
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))
    full = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col("n3") > 0)

    def bounded(i: int, default: float, most: float) -> Column:
        own = i - (i + 1) * F.try_divide(y * F.col(f"n{i + 1}"), F.col(f"n{i}"))
        return F.when(full, F.least(F.lit(most), F.greatest(F.lit(0.05), own))).otherwise(F.lit(default)).alias(f"d{i}")

    return met.select("lang", bounded(1, 0.5, 0.95), bounded(2, 0.75, 1.9), bounded(3, 0.9, 2.85))


def kneser_ney(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """lang, gram, n and p, the interpolated modified Kneser-Ney probability of a gram's last byte after those before it, for every gram counted."""
    levels = {order: counts}
    for k in range(order - 1, 0, -1):  # continuation counts: in how many distinct left contexts
        levels[k] = levels[k + 1].select("lang", F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1)).alias("gram")).groupBy("lang", "gram").agg(F.count("*").alias("n"))
    below = None
    for k in range(1, order + 1):
        if k < order:
            levels[k] = saved(levels[k])
        rows = levels[k].join(F.broadcast(_discounts(levels[k])) if _few_languages(levels[k]) else _discounts(levels[k]), "lang")
        rows = rows.withColumn("cut", F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3")))
        context = Window.partitionBy("lang", F.shiftrightunsigned("gram", 8))  # at most 256 grams
        rows = rows.withColumns({"total": F.sum("n").over(context), "gamma": F.sum("cut").over(context)})
        if below is None:
            lower = F.lit(1 / 256)
        else:
            rows = rows.withColumn("suffix", F.col("gram").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1))).join(below, ["lang", "suffix"])
            lower = F.col("lower")
        made = rows.select("lang", "gram", "n", ((F.col("n") - F.col("cut") + F.col("gamma") * lower) / F.col("total")).alias("p"))
        below = made.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("lower"))
    return made


#: Languages up to which their discounts are broadcast; 40 bytes each.
MAX_BROADCAST_LANGUAGES = 50_000


def _few_languages(counts: DataFrame) -> bool:
    return counts.select("lang").distinct().count() <= MAX_BROADCAST_LANGUAGES


class Head:
    """The most frequent grams' surprisal in bits, by language in sorted arrays."""

    def __init__(self, lang: np.ndarray, gram: np.ndarray, bits: np.ndarray):
        order = np.lexsort((gram, lang))
        lang, gram, bits = lang[order], gram[order].astype(np.uint32), bits[order]
        edges = np.unique(np.append(np.flatnonzero(lang[1:] != lang[:-1]) + 1, [0, len(lang)]))
        self.models = {int(lang[a]): (gram[a:b], bits[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)}

    def __call__(self, lang: int, codes: np.ndarray) -> tuple[float, np.ndarray]:
        """Sum of bits of the codes in the head, and the codes that are not."""
        if lang not in self.models:
            return 0.0, codes
        grams, bits = self.models[lang]
        at = np.minimum(np.searchsorted(grams, codes), len(grams) - 1)
        hit = grams[at] == codes
        return float(bits[at[hit]].sum(dtype=np.float64)), codes[~hit]


def train(docs: DataFrame, head_grams: int = HEAD_GRAMS) -> tuple[Head, DataFrame | None]:
    """The head of the model, of bounded size, and (lang, gram, bits) of grams beyond it (None if the head has all)."""
    counts = saved(count_grams(docs))
    model = saved(kneser_ney(counts).select("lang", "gram", "n", (-F.log2("p")).cast("float").alias("bits")))
    discard(counts)
    head, tail = model, None
    if model.count() > head_grams:
        seen, bar = 0, 0
        for r in model.groupBy("n").count().orderBy(F.desc("n")).toLocalIterator():
            seen += r["count"]
            if seen > head_grams:
                bar = r["n"]
                break
        head, tail = model.where(F.col("n") > bar), model.where(F.col("n") <= bar).select("lang", "gram", "bits")
    signed = F.when(F.col("gram") >= 1 << 31, F.col("gram") - (1 << 32)).otherwise(F.col("gram")).cast("int")
    rows = head.select("lang", signed.alias("gram"), "bits").toArrow()
    return Head(rows.column("lang").to_numpy(), rows.column("gram").to_numpy().view(np.uint32), rows.column("bits").to_numpy()), tail


def score(docs: DataFrame, head: Head, tail: DataFrame | None, carried: list[str]) -> DataFrame:
    """The columns ``carried``, the base statistics, lang, n_bytes and bits (the sum of surprisals over bytes).

    A carried column that is a struct with the text is not joined by the text a second time.
    """
    shared = docs.sparkSession.sparkContext.broadcast(head)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    n = len(carried)

    def run(batches):
        own = shared.value
        for batch in batches:
            rows, rest = [], []
            texts = batch.column(at).field(inside).cast(pa.string()) if at < n else batch.column(at)
            for lang, value in zip(batch.column(n).to_pylist(), texts, strict=True):
                text = value.as_py() or ""
                codes = gram_codes(text.encode())
                bits, left = own(lang, codes)
                rows.append((*base_stats(text), lang, len(codes), bits))
                rest.append(left.astype(np.int64) if len(left) else None)
            columns = [list(c) for c in zip(*rows, strict=True)] or [[]] * 8
            kinds = [pa.int64()] * 7 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *map(pa.array, columns, kinds), pa.array(rest, pa.list_(pa.int64()))], names=[*carried, *names, "lang", "n_bytes", "bits", "rest"])

    made = StructType([*(StructField(x, LongType()) for x in [*names, "lang", "n_bytes"]), StructField("bits", DoubleType()), StructField("rest", ArrayType(LongType()))])
    schema = StructType([docs.schema[c] for c in carried] + made.fields)
    holding = [(k, docs.schema[c].dataType.names.index("text")) for k, c in enumerate(carried) if isinstance(docs.schema[c].dataType, StructType) and "text" in docs.schema[c].dataType.names]
    at, inside = holding[0] if holding else (n + 1, 0)
    text = [] if holding else [F.col("text").cast("string").alias("text_")]
    scored = docs.select(*carried, _language().alias("lang_"), *text).mapInArrow(handing_back(run), schema)
    if tail is None:
        return scored.drop("rest")
    scored, row = numbered(scored)
    each = scored.select(row, "lang", F.explode("rest").alias("gram")).groupBy(row, "lang", "gram").agg(F.count("*").alias("times"))
    more = each.join(tail.withColumnRenamed("bits", "own"), ["lang", "gram"]).groupBy(row).agg(F.sum(F.col("times") * F.col("own").cast("double")).alias("more"))
    return scored.join(more, row, "left").withColumn("bits", F.col("bits") + F.coalesce("more", F.lit(0.0))).drop("rest", "more", row)


def _measure(length: str) -> Column:
    return F.col("bits") / F.col(length)


def _unit(length: str) -> Column:
    """How far a text of that length may stray, in units of the language's scale."""
    return F.sqrt(1 / F.col(length) + 1 / F.lit(MEASURES[length]))


def _medians(rows: DataFrame, bins: dict[str, Column], by: list[str]) -> DataFrame:
    """``by``, n, and for each of ``bins`` the lower median bin, from exact histograms of at most 20,001 bins."""
    each = rows.select(*by, F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), b.cast("int").alias("bin")) for k, b in bins.items()])).alias("x")).select(*by, "x.*")
    counted = each.groupBy(*by, "kind", "bin").agg(F.count("*").alias("c"))
    upto = Window.partitionBy(*by, "kind").orderBy("bin")
    whole = upto.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    summed = counted.withColumns({"seen": F.sum("c").over(upto), "n": F.sum("c").over(whole)})
    return summed.where(2 * F.col("seen") >= F.col("n")).groupBy(*by).agg(F.max("n").alias("n"), *[F.min(F.when(F.col("kind") == k, F.col("bin"))).alias(k) for k in bins])


def bands(scored: DataFrame) -> DataFrame:
    """lang, and for each measure its median and its scale."""
    long = scored.where(F.col("n_words") >= MIN_WORDS)
    middle = _medians(long, {k: F.floor(F.least(_measure(k), F.lit(MOST_BITS)) * BIN) for k in MEASURES}, ["lang"])
    middle = saved(middle.select("lang", "n", *[((F.col(k) + 0.5) / BIN).alias(f"{k}_middle") for k in MEASURES]))
    off = long.join(middle, "lang").select("lang", *[F.floor(F.least(F.abs(_measure(k) - F.col(f"{k}_middle")) / _unit(k), F.lit(MOST_BITS)) * BIN).alias(k) for k in MEASURES])
    off = saved(off)
    scale = lambda k: (F.col(k) + 0.5) * (1.4826 / BIN)
    own = _medians(off, {k: F.col(k) for k in MEASURES}, ["lang"]).select("lang", *[scale(k).alias(f"{k}_own") for k in MEASURES])
    every = _medians(off.withColumn("all", F.lit(1)), {k: F.col(k) for k in MEASURES}, ["all"]).select(*[scale(k).alias(f"{k}_all") for k in MEASURES]).collect()
    pooled = {k: float(every[0][f"{k}_all"]) if every else 1.0 for k in MEASURES}
    out = middle.join(own, "lang").select(
        "lang", *[f"{k}_middle" for k in MEASURES], *[((F.col("n") * F.col(f"{k}_own") + PRIOR * pooled[k]) / (F.col("n") + PRIOR)).alias(f"{k}_scale") for k in MEASURES]
    )
    return saved(out)


def judged(docs: DataFrame, carried: list[str], width: float = WIDTH, head_grams: int = HEAD_GRAMS) -> DataFrame:
    """``carried``, base statistics, base_failed, kept, and the two measures in units of the language's scale from its median."""
    scored = saved(score(docs, *train(docs, head_grams), carried))
    off = {k: (_measure(k) - F.col(f"{k}_middle")) / (_unit(k) * F.col(f"{k}_scale")) for k in MEASURES}
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    inside = F.coalesce(F.greatest(*[F.abs(x) for x in off.values()]) <= width, F.lit(False))
    return scored.join(bands(scored), "lang", "left").select(
        *carried, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & inside).alias("kept"),
        off["n_bytes"].alias("byte_deviation"), F.when(F.col("n_words") > 0, off["n_words"]).alias("word_deviation"),
    )


def judge(docs: DataFrame, width: float = WIDTH) -> DataFrame:
    """doc_id, the base statistics, base_failed, kept and the deviations of every row."""
    return judged(docs, ["doc_id"], width)


def keep_good(docs: DataFrame, width: float = WIDTH) -> DataFrame:
    """``docs`` without the rejected rows; each row is judged by itself."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")  # rows go through the judgement, so none is looked up again
    return judged(docs.select(whole, "text", "lang"), ["whole"], width).where("kept").select(*[F.col("whole").getField(c).alias(c) for c in docs.columns])
