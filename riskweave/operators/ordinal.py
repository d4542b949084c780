"""Positions in a total order, without sorting all rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.session import written_table

_ROW_BITS = 33


def with_positions(df: DataFrame, order: Sequence[Column | str], name: str = "position") -> DataFrame:
    """``df`` with its rows' positions, from 0, in ``order``.

    Rows are dealt to range partitions and sorted inside them; a row's position is its
    place in its partition plus the rows of all partitions before, by a prefix sum over
    one count for each partition. That table has as many rows as the shuffle has
    partitions, whatever the data, so that it is broadcast. The sorted rows are written
    once, so that a task run again sees the same places. Rows that agree in all of
    ``order`` lie in one partition: end ``order`` with a hash of the row where many do.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    numbered = ordered.select(
        "*",
        F.shiftrightunsigned(place, _ROW_BITS).cast("int").alias("_part"),
        place.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_place"),
    )
    table = written_table(numbered, "ordered")
    counts = table.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    placed = table.join(F.broadcast(bases), "_part")
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_base") + F.col("_place")).alias(name))
