import random

from pyspark.sql import types as T

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "fp", "size", "row", "bucket", "mark", "key", "unit", "root", "n", "start", "kept"]
SCHEMA = T.StructType(
    [T.StructField(c, T.LongType() if c in ("doc_id", "n_chars") else T.StringType()) for c in COLUMNS]
)
WORDS = "the of and a to in that is was he for it with as his on be at by had not are but from or have an they which one".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "ing", "er", "ly", "x", "zu"]) for _ in range(n))


def frame(spark, rows):
    """A table of (doc_id, text, source) rows with further columns, whose names operators use inside."""
    full = [(i, t, "en", s, None if t is None else len(t), *["?"] * (len(COLUMNS) - 5)) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)
