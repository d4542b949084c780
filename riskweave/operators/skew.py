"""Joins and lags that hold when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HOT_SHARE = 1 / 256
SALTS = 64
#: Groups by hash that are counted first, many more than there can be hot keys.
HASH_GROUPS = 1 << 16


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """Keys that own at least ``share`` of the rows.

    At most ``1 / share`` keys can do so, whatever the size of ``df``: the result
    is small enough to broadcast by arithmetic. Rows are counted by a hash of the key
    first; only keys in a group that is large enough are counted themselves, so the keys
    of a large table neither fill a task's memory nor cross a shuffle.
    """
    hashed = df.select(*keys, F.pmod(F.xxhash64(*keys), F.lit(HASH_GROUPS)).alias("_group"))
    groups = hashed.groupBy("_group").agg(F.count(F.lit(1)).alias("_n"))
    least = groups.agg(F.sum("_n") * F.lit(share)).scalar()
    large = groups.filter(F.col("_n") >= least).select("_group")
    counts = hashed.join(F.broadcast(large), "_group", "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") >= least).select(*keys)


def salted_lookup(
    many: DataFrame,
    one: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    how: str = "left",
    hot: DataFrame | None = None,
    share: float = HOT_SHARE,
    salts: int = SALTS,
) -> DataFrame:
    """Equi-join of ``many`` rows per key to one row per key, hot keys spread over salts.

    Rows of a hot key in ``many`` are spread by a hash of ``spread``; the matching
    row of ``one`` is repeated once per salt for those keys only (at most
    ``salts / share`` extra rows). Every other key joins as usual. Pass ``hot``, a
    result of :func:`hot_keys`, when the same ``many`` is joined repeatedly.
    """
    hot = hot_keys(many, keys, share) if hot is None else hot
    hot = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*spread), F.lit(salts))).otherwise(F.lit(0))
    left = many.join(hot, list(keys), "left").withColumn("_salt", salt.cast("int")).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = one.join(hot, list(keys), "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def previous_value(
    df: DataFrame, key: str, ts: str, order: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Add ``prev_<value>``: the values of the key's preceding row in (ts, order).

    A plain lag over the key would sort a hot key's whole history in one task.
    Here the window runs per (key, day); only the first row of each day looks at
    the last row of the key's previous day, a table of one row per key and day.
    """
    rows = df.withColumn("_day", F.col(ts).cast("date"))
    # Values last, so that a recomputed task orders full ties the same way.
    within = Window.partitionBy(key, "_day").orderBy(ts, *order, *values)
    packed = F.struct(*values)
    lagged = rows.withColumn("_prev", F.lag(packed).over(within)).withColumn(
        "_next", F.lead(F.lit(True)).over(within)
    )
    lasts = lagged.filter(F.col("_next").isNull()).select(key, "_day", packed.alias("_last"))
    heads = lasts.select(
        key,
        "_day",
        F.lag("_last").over(Window.partitionBy(key).orderBy("_day")).alias("_before"),
    )
    joined = lagged.join(heads, [key, "_day"], "left")
    prev = F.coalesce(F.col("_prev"), F.col("_before"))
    out = [F.col(c) for c in df.columns]
    return joined.select(*out, *[prev[v].alias(f"prev_{v}") for v in values])
