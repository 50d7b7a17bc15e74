import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "the of and ing tion er on re nd th es st en at or ti ha he ea".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    out = []
    for i in range(n):
        out.append("".join(r.choice(WORDS) for _ in range(r.randint(1, 4))))
        if i % 17 == 16:
            out[-1] += ".\n"
    return " ".join(out).replace("\n ", "\n")


@pytest.fixture(scope="session")
def edge_rows():
    """Rows with nulls in each column, empty, blank, very long and repeated texts, ties and odd letters."""
    long_text = prose(1, 12_000)
    return [
        (1, prose(2, 80), "en", "a", 1), (2, prose(2, 80), "en", "a", 1), (3, prose(2, 80) + " extra", None, "b", None), (4, None, "en", "a", 0), (5, "", "fr", None, 0), (6, " \n\t ", "fr", "a", 3),
        (7, long_text, "de", "a", len(long_text)), (8, "Été naïve Ωmega ÀÉÎ 😀 naïve ß İ Σας", "fr", "a", 1), (None, prose(3, 40), "en", "a", 1), (9, prose(4, 60), "en", "a", 1),
        (9, prose(4, 60), "en", "a", 1), (10, "x" * 5000, "zz", "a", 1), (11, "one", "en", "a", 3), (12, prose(5, 30).upper() + "!!", "en", "a", 1),
    ]


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    """The same rows with extra columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(edge_rows, SCHEMA)
    return rows.select("*", *[F.lit("x").alias(c) for c in ("shard", "key", "fp", "hits", "w", "base", "label", "h", "kept", "row", "bits", "pieces", "a", "b")])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
