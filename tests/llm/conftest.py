import random

import pytest

WORDS = [a + b + c for a in ("ba", "de", "fi", "go", "lu") for b in ("na", "re", "ti", "so", "mu") for c in ("l", "n", "r", "s", "th", "x")]


def prose(seed, words=60):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(words))


@pytest.fixture
def text():
    return prose


@pytest.fixture
def frame(spark):
    """A table with columns that clash with names used inside operators."""

    def make(rows, schema):
        df = spark.createDataFrame(rows, schema)
        taken = {c.lower() for c in df.columns}
        for c in ("id", "key", "n_links", "spans", "score", "ids", "_low", "_source"):
            if c not in taken:
                from pyspark.sql import functions as F

                df = df.withColumn(c, F.lit(f"other {c}"))
        return df

    return make
