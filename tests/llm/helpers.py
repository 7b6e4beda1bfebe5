"""Small tables with awkward rows, for every operator."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

WORDS = ["th", "er", "on", "an", "re", "ing", "ou", "é", "漢", "|", "A1"]


def text(rng, n):
    return " ".join("".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def awkward(spark, extra=()):
    """Null ids, texts, languages and sources, empty and blank texts, a repeated row, ties, and a very long text."""
    rng = random.Random(0)
    base = text(rng, 90)
    docs = [
        (1, base, "en", "s", 1), (1, base, "en", "s", 1), (2, base, "en", "s", 1), (3, None, "en", None, None), (4, "", None, "s", 0), (5, " \n\t ", "de", "s", 3),
        (None, "no id " * 60, "de", "t", 5), (None, None, None, None, None), (6, "x", "fr", "t", 1), (7, text(rng, 40_000), "fr", "t", 9), (8, base + " more", "en", "s", 2), *extra,
    ]
    return spark.createDataFrame(docs, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
