"""Small documents for the operators' tests."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names the operators use inside.
CLASHING = ["kf", "kr", "row", "kept", "size", "h", "name", "rank", "copies", "length", "host", "unit", "z", "fp", "_metadata"]

#: Nulls in any column, empty and blank texts, repeated rows and ids, a very long text.
ODD = [
    (1, None, "en", "a", 0), (2, "", None, "a", None), (3, " \n\t ", "en", None, 1), (None, "lost and found here", "en", "b", 2),
    (None, "lost and found here", "en", "b", 2), (4, "Same TEXT over here", "en", "b", 3), (4, "Same TEXT over here", "en", "b", 3),
    (5, "same text over here", "fr", "c", 4), (6, "éÉ ß 你好 🙂 words", "de", "c", 5), (7, "word " * 60_000, "en", "c", 6), (6, "another text, same id", None, None, None),
]


def docs(spark, rows, clashing=False):
    df = spark.createDataFrame(rows, SCHEMA)
    if clashing:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit(f"x-{c}").alias(c) for c in CLASHING])
    return df


def words(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def table(spark, rows):
    """Rows as a DataFrame that is read from files."""
    from casewatch.llm.common import written
    return written(docs(spark, rows), "test-docs")
