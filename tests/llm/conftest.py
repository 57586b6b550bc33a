import random

import pytest

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed, vocabulary=300):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}x{rng.randrange(50)}" for _ in range(n)]


@pytest.fixture(scope="session")
def make(spark):
    """Documents from ``(doc_id, text)`` pairs."""
    def build(rows, partitions=3):
        return spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], DOCS).repartition(partitions)
    return build


@pytest.fixture(scope="session")
def odd(make):
    """Nulls, empty and blank texts, a very long text, ties and repeated rows, a null doc_id."""
    text = " ".join(words(120, 1))
    long = "\n".join(" ".join(words(40, k)) for k in range(2500))
    return make([(1, text), (2, text), (2, text), (3, None), (4, ""), (5, "   \n\t "), (None, text + " tail"), (6, long),
                 (7, "one word"), (7, "Other words, same id"), (8, "é" * 5000), (-3, text.upper())])


@pytest.fixture(scope="session")
def clashing():
    """Columns whose names an operator may use itself."""
    def add(df):
        for name in ("k", "line", "rid", "spans", "repeats", "n_words", "items", "score", "length", "piece", "gone", "row"):
            if name not in df.columns:
                df = df.withColumn(name, F.lit("taken"))
        return df
    return add
