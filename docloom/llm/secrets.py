"""Operator 2, secret scans.

Three base patterns give spans by position.  Beside them, a battery of randomness tests looks at every run of 20 or more
letters, digits and ``+/_=-`` that mixes letters with digits: the encoding is inferred (hex, base32, base62 or base64), and
chi-squared uniformity over its alphabet, the Wald-Wolfowitz runs test about its middle and the lag-one serial
correlation must none of them refute randomness (Bonferroni over the three at ``alpha``).  Against ordinary text, whose symbols
repeat far more, the same chi-squared gives a p-value that sharpens with length; Benjamini-Hochberg at rate ``q`` runs
in each class of length over all tokens of the table, from exact counts of p-values in tenths of a decade.

Null or empty text: no spans.  Repeated rows: each scanned alike.  Empty table: no rows.  Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import running_sum, saved

# The three base patterns and the candidate token.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"

KINDS = ("assign", "access", "hex", "random")
#: Alphabet and the excess of coincidences that ordinary text shows in it (m * sum of squared shares - 1); plain numbers
#: and words in hexadecimal use about six of its digits.
ALPHABETS = {
    "hex": ("0123456789abcdef", 1.5),
    "base32": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 1.1),
    "base62": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 3.0),
    "base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 3.0),
}
ENCODINGS = tuple(ALPHABETS)
CLASSES = (24, 32, 48, 64, 128)


def _spans(text: Column, pattern: str, kind: int) -> Column:
    """Spans of a pattern's matches as array<struct<s,k,e>>, in code points; the pieces between matches give the positions."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    lengths = F.zip_with(
        F.transform(F.split(text, pattern, -1), lambda x: F.length(x)),
        F.transform(found, lambda x: F.length(x)),
        lambda gap, m: F.struct(gap.alias("gap"), F.coalesce(m, F.lit(0)).alias("m")),
    )
    ends = running_sum(F.transform(lengths, lambda x: x["gap"] + x["m"]))
    # The last piece has no match behind it.
    return F.filter(F.zip_with(ends, lengths, lambda e, x: F.struct((e - x["m"]).alias("s"), F.lit(kind).alias("k"), e.alias("e"))), lambda x: x["e"] > x["s"])


def _base_spans(text: Column) -> Column:
    none = F.expr("array()").cast("array<struct<s:int,k:int,e:int>>")

    def where(pattern: str, spans: Column) -> Column:
        return F.when(text.rlike(pattern), spans).otherwise(none)

    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    assign = F.transform(
        F.filter(F.arrays_zip(_spans(text, ASSIGN, 0).alias("x"), F.transform(values, lambda v: F.length(v)).alias("n")), lambda z: z["n"] >= 8),
        lambda z: z["x"],
    )
    return F.array_sort(F.concat(where(ASSIGN, assign), where(ACCESS, _spans(text, ACCESS, 1)), where(HEX, _spans(text, HEX, 2))))


def normal_tail(z: Column) -> Column:
    """P(Z > z) by a rational approximation, absolute error under 1e-7, and by its density over z beyond six."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    density = F.exp(-z * z / 2) * 0.3989422804014327
    poly = F.lit(1.330274429)
    for c in (-1.821255978, 1.781477937, -0.356563782, 0.319381530):
        poly = poly * t + c
    body = F.when(F.abs(z) > 6, density / F.abs(z)).otherwise(density * poly * t)
    return F.when(z >= 0, body).otherwise(1 - body)


def _let(rows: Column, **made) -> Column:
    """Each struct of an array with further fields, so that what a formula uses twice is computed once."""
    return F.transform(rows, lambda x: F.struct(x.alias("of"), *[f(x).alias(k) for k, f in made.items()]))


def battery(rows: Column, alpha: float) -> Column:
    """array<struct<s,e,t>> -> array<struct<s,e,passes,class,bin>>.

    ``passes``: randomness is not refuted; ``bin``: tenths of a decade of the chi-squared p-value under ordinary text.
    """
    pick = lambda enc, field: F.get(F.array(*[F.lit(ALPHABETS[k][field] if field < 2 else len(ALPHABETS[k][0])) for k in ENCODINGS]), enc)
    rows = _let(rows, enc=lambda x: _encoding(x["t"]))
    rows = _let(
        rows,
        t=lambda x: F.when(x["enc"] == 0, F.lower(x["of"]["t"])).when(x["enc"] == 3, F.translate(F.rtrim(x["of"]["t"], F.lit("=")), "_-", "/+")).otherwise(x["of"]["t"]),
        alphabet=lambda x: pick(x["enc"], 0),
        excess=lambda x: pick(x["enc"], 1),
        m=lambda x: pick(x["enc"], 2),
    )
    rows = _let(
        rows,
        n=lambda x: F.length(x["t"]).cast("double"),
        squares=lambda x: F.aggregate(
            F.sequence(F.lit(1), x["m"]),
            F.lit(0.0),
            lambda acc, i: acc + F.pow((F.length(x["t"]) - F.length(F.replace(x["t"], F.substr(x["alphabet"], i, F.lit(1)), F.lit("")))).cast("double"), F.lit(2.0)),
        ),
        x=lambda x: F.transform(F.split(x["t"], ""), lambda c: F.instr(x["alphabet"], c).cast("double")),
    )
    rows = _let(
        rows,
        halves=lambda x: F.array_join(F.transform(x["x"], lambda y: F.when(y * 2 > x["of"]["m"], F.lit("h")).otherwise(F.lit("l"))), ""),
        total=lambda x: F.aggregate(x["x"], F.lit(0.0), lambda acc, y: acc + y),
        power=lambda x: F.aggregate(x["x"], F.lit(0.0), lambda acc, y: acc + y * y),
        lagged=lambda x: F.aggregate(
            F.zip_with(x["x"], F.slice(x["x"], 2, F.size(x["x"])), lambda a, b: a * F.coalesce(b, F.get(x["x"], F.lit(0)))), F.lit(0.0), lambda acc, y: acc + y
        ),
    )
    rows = F.transform(
        rows,
        lambda x: F.struct(
            x["of"]["of"]["of"]["of"]["s"].alias("s"), x["of"]["of"]["of"]["of"]["e"].alias("e"), x["of"]["n"].alias("n"), x["of"]["of"]["m"].alias("m"),
            (x["of"]["squares"] * x["of"]["of"]["m"] / x["of"]["n"] - x["of"]["n"]).alias("chi"), x["of"]["of"]["excess"].alias("excess"),
            (F.length(x["halves"]) - F.length(F.replace(x["halves"], F.lit("h"), F.lit("")))).cast("double").alias("high"),
            ((2 * x["of"]["n"] - F.length(F.replace(x["halves"], F.lit("lh"), F.lit(""))) - F.length(F.replace(x["halves"], F.lit("hl"), F.lit("")))) / 2).alias("changes"),
            (x["power"] - x["total"] * x["total"] / x["of"]["n"]).alias("spread"), (x["lagged"] - x["total"] * x["total"] / x["of"]["n"]).alias("lag"),
        ),
    )
    rows = _let(
        rows,
        expected=lambda x: 1 + 2 * x["high"] * (x["n"] - x["high"]) / x["n"],
        v=lambda x: 2.0 / (9 * (x["m"] - 1)),
    )
    rows = _let(
        rows,
        # Wilson-Hilferty: the cube root of chi-squared over its degrees of freedom is nearly normal.
        z_chi=lambda x: F.abs((F.pow(F.greatest(x["of"]["chi"], F.lit(0.0)) / (x["of"]["m"] - 1), F.lit(1 / 3)) - (1 - x["v"])) / F.sqrt(x["v"])),
        variance=lambda x: (x["expected"] - 1) * (x["expected"] - 2) / (x["of"]["n"] - 1),
        z_text=lambda x: ((x["of"]["m"] - 1) + x["of"]["n"] * x["of"]["excess"] - x["of"]["chi"]) / F.sqrt(2.0 * (x["of"]["m"] - 1) + 4 * x["of"]["n"] * x["of"]["excess"]),
    )
    # The largest of the three deviations decides: its p-value, times three, is held against alpha.
    rows = _let(
        rows,
        z=lambda x: F.greatest(
            x["z_chi"],
            F.when(x["variance"] > 0, F.abs((x["of"]["of"]["changes"] + 1 - x["of"]["expected"]) / F.sqrt(x["variance"]))).otherwise(F.lit(40.0)),
            F.when(x["of"]["of"]["spread"] > 0, F.abs(x["of"]["of"]["lag"] / x["of"]["of"]["spread"] * F.sqrt(x["of"]["of"]["n"]))).otherwise(F.lit(40.0)),
        ),
    )
    return F.transform(
        rows,
        lambda x: F.struct(
            x["of"]["of"]["of"]["s"].alias("s"), x["of"]["of"]["of"]["e"].alias("e"), (6 * normal_tail(x["z"]) >= alpha).alias("passes"),
            _length_class(x["of"]["of"]["of"]["n"]).alias("class"),
            F.floor(-10 * F.log10(F.greatest(F.least(F.lit(1.0), normal_tail(x["of"]["z_text"])), F.lit(1e-40)))).cast("int").alias("bin"),
        ),
    )


def _encoding(token: Column) -> Column:
    """Index in ``ENCODINGS``."""
    return (
        F.when(token.rlike(r"^(?:[0-9a-f]+|[0-9A-F]+)$"), F.lit(0))
        .when(token.rlike(r"^[A-Z2-7]+$"), F.lit(1))
        .when(token.rlike(r"^[A-Za-z0-9]+$"), F.lit(2))
        .otherwise(F.lit(3))
    )


def _length_class(n: Column) -> Column:
    out = F.lit(0)
    for edge in CLASSES:
        out = out + (n >= edge).cast("int")
    return out


def scan_secrets(docs: DataFrame, q: float = 0.05, alpha: float = 0.001) -> DataFrame:
    """doc_id, base array<struct<s,k,e>>, random array<struct<s,k,e>>: all spans of every text; ``k`` indexes ``KINDS``."""
    text = F.col("text")
    none = F.expr("array()").cast("array<struct<s:int,k:int,e:int>>")
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    spans = F.when(text.rlike(TOKEN), _spans(text, TOKEN, 3)).otherwise(none)
    rows = rows.select("doc_id", "text", _base_spans(text).alias("base"), spans.alias("runs"))
    cut = F.transform(F.col("runs"), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.substring(text, x["s"] + 1, x["e"] - x["s"]).alias("t")))
    mixed = F.filter(cut, lambda x: x["t"].rlike("[A-Za-z]") & x["t"].rlike("[0-9]"))
    graded = battery(mixed, alpha)
    kept = saved(rows.select("doc_id", "base", F.when(F.size("runs") > 0, graded).alias("tokens")))
    # At most six classes times 401 bins come to the driver.
    bins = kept.select(F.explode("tokens").alias("t")).groupBy("t.class", "t.bin").agg(F.count("*").alias("n")).collect()
    least = {}
    for c in {r["class"] for r in bins}:
        own = sorted(((r["bin"], r["n"]) for r in bins if r["class"] == c), reverse=True)
        total, rank = sum(n for _, n in own), 0
        for b, n in own:
            rank += n
            if 10 ** (-b / 10) * total / rank <= q:
                least[c] = b
    limit = [F.lit(least.get(c, 1_000)) for c in range(len(CLASSES) + 1)]
    chosen = F.filter(F.col("tokens"), lambda x: x["passes"] & (x["bin"] >= F.get(F.array(*limit), x["class"])))
    random = F.transform(chosen, lambda x: F.struct(x["s"].alias("s"), F.lit(3).alias("k"), x["e"].alias("e")))
    return kept.select("doc_id", "base", F.coalesce(random, none).alias("random"))


def span_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def secret_report(docs: DataFrame, q: float = 0.05, alpha: float = 0.001) -> DataFrame:
    found = scan_secrets(docs, q, alpha)

    def count(kind: int) -> Column:
        return F.size(F.filter(F.col("base"), lambda x: x["k"] == kind)).cast("long")

    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.array_sort(F.concat("base", "random"))).alias("spans"),
        F.size("random").cast("long").alias("n_random"),
    )

