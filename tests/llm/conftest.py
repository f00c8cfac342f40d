import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (id, text) or (id, text, source); clashing extra columns on request."""

    def make(rows, extra=False):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            for name in ("score", "key", "ids", "block", "slot", "failed", "words", "spans", "hash", "predicted", "position"):
                df = df.withColumn(name, df["doc_id"])
        return df

    return make


@pytest.fixture(scope="session")
def pool():
    """A seeded supply of invented words."""
    import random

    rnd = random.Random(7)
    letters = "abcdefghijklmnoprstuvwz"
    words = ["".join(rnd.choice(letters) for _ in range(rnd.randint(2, 9))) for _ in range(4000)]

    def take(n, seed):
        return [random.Random(seed * 100_003 + i).choice(words) for i in range(n)]

    return take
