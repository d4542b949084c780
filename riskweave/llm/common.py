"""Helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.session import cut_lineage, scratch_path

#: Arrow batches that Python tasks get: bounded in rows and in bytes, so that very
#: long texts do not meet in one batch.
BATCH_ROWS = 2000
BATCH_BYTES = 4 << 20

#: The separators of words, as a Java or Python character class.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def bounded_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Set the session's Arrow batch bounds."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """(doc_id, text, *more) of any table that has them; a null text counts as empty.

    Other columns go, whatever their names. Null ids stay.
    """
    bounded_batches(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *[F.col(c) for c in more],
    )


def text_bytes(docs: DataFrame, *more: str) -> DataFrame:
    """As :func:`texts`, with the text as UTF-8 bytes."""
    return texts(docs, *more).withColumn("text", F.col("text").cast("binary"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, safe from lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hashed_key(*cols: str | Column) -> Column:
    return F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in cols])


def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, ...]]:
    """The columns of every batch as Python lists."""
    for batch in rows:
        yield tuple(col.to_pylist() for col in batch.columns)


def record_batch(schema: pa.Schema, *columns: Sequence) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b: long); root is the smallest node it reaches.

    Every round points each node at its smallest neighbour, follows those pointers to
    their ends by doubling, and contracts the links to the ends, so that the links
    shrink until none is left. All steps are hash aggregates and equi-joins; hubs
    aggregate before the shuffle and large join keys are left to the adaptive skew
    join. Repeated and self links are harmless; an empty table gives an empty result.
    """
    flat = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = cut_lineage(flat.filter("a < b").distinct())
    roots = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("b"))
        step = cut_lineage(low.select(F.col("a").alias("node"), F.least("a", "b").alias("root")))
        while True:
            ahead = step.select(F.col("node").alias("root"), F.col("root").alias("_end"))
            jump = cut_lineage(step.join(ahead, "root").select("node", "root", "_end"))
            step = jump.select("node", F.col("_end").alias("root"))
            if jump.filter("root != _end").isEmpty():
                break
        if roots is None:
            roots = step
        else:
            onward = step.select(F.col("node").alias("root"), F.col("root").alias("_next"))
            joined = roots.join(onward, "root", "left")
            roots = cut_lineage(joined.select("node", F.coalesce("_next", "root").alias("root")))
        to = lambda c: step.select(F.col("node").alias(c), F.col("root").alias(f"_{c}"))
        moved = edges.join(to("a"), "a").join(to("b"), "b")
        moved = moved.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
        edges = cut_lineage(moved.filter("a < b").distinct())
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
