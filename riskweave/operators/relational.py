"""Joins, set operations, rankings and distributions between feeds and the graph."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave import rules
from riskweave.functions.clean import lenient_double, status_class, strip_quotes, trim_only
from riskweave.functions.weights import beyond_first
from riskweave.operators.skew import salted_lookup


def distinct_key(df: DataFrame, column: str, alias: str = "uid") -> DataFrame:
    """Distinct non-blank values of a column."""
    return df.select(trim_only(column).alias(alias)).filter(F.col(alias).isNotNull()).distinct()


# -- containment and membership -----------------------------------------------


def with_found_flag(rows: DataFrame, base: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with ``found``: whether the key occurs in ``base``."""
    marker = base.select(*keys).distinct().withColumn("_found", F.lit(True))
    spread = [c for c in rows.columns if c not in keys] or list(keys)
    return salted_lookup(rows, marker, keys, spread).withColumn("found", F.coalesce("_found", F.lit(False))).drop("_found")


def containment(rows: DataFrame, base: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Total, found, not found and their ratios, as one row.

    Rows are counted per key first, so the join sees each key once.
    """
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    flagged = counted.join(base.select(*keys).distinct().withColumn("_found", F.lit(True)), list(keys), "left")
    n, hit = F.col("_n"), F.col("_found").isNotNull()
    sums = flagged.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(hit, n)), F.lit(0)).alias("found"),
        F.coalesce(F.sum(F.when(~hit, n)), F.lit(0)).alias("not_found"),
    )
    return sums.select(
        "*",
        F.try_divide("found", "total").alias("found_ratio"),
        F.try_divide("not_found", "total").alias("not_found_ratio"),
    )


def missing_keys(base_ids: DataFrame, log_ids: DataFrame) -> DataFrame:
    """Base ids the log never mentions; both sides distinct."""
    return base_ids.join(log_ids, base_ids.columns, "left_anti")


def completeness(base_ids: DataFrame, log_ids: DataFrame) -> DataFrame:
    """Distinct ids in base and log, and ids missing from the log, as one row."""
    sides = base_ids.withColumn("_b", F.lit(1)).withColumn("_l", F.lit(0)).unionByName(
        log_ids.withColumn("_b", F.lit(0)).withColumn("_l", F.lit(1))
    )
    per_id = sides.groupBy(*base_ids.columns).agg(F.max("_b").alias("b"), F.max("_l").alias("l"))
    return per_id.agg(
        F.count_if(F.col("b") == 1).alias("base_ids"),
        F.count_if(F.col("l") == 1).alias("log_ids"),
        F.count_if((F.col("b") == 1) & (F.col("l") == 0)).alias("missing_ids"),
    )


def overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """Sizes of two id lists, their overlap and its share of each, as one row."""
    sides = a.withColumn("_a", F.lit(1)).withColumn("_b", F.lit(0)).unionByName(
        b.withColumn("_a", F.lit(0)).withColumn("_b", F.lit(1))
    )
    per_id = sides.groupBy(*a.columns).agg(F.max("_a").alias("a"), F.max("_b").alias("b"))
    both = (F.col("a") == 1) & (F.col("b") == 1)
    sums = per_id.agg(
        F.count_if(F.col("a") == 1).alias("first_ids"),
        F.count_if(F.col("b") == 1).alias("second_ids"),
        F.count_if(both).alias("overlap_ids"),
    )
    return sums.select(
        "*",
        F.try_divide("overlap_ids", "first_ids").alias("share_of_first"),
        F.try_divide("overlap_ids", "second_ids").alias("share_of_second"),
    )


# -- devices ------------------------------------------------------------------


def device_links(edges: DataFrame) -> DataFrame:
    """Distinct (device, uid) over any relation between the two."""
    forward = (F.col("src_type") == "uid") & (F.col("dst_type") == "device_no")
    backward = (F.col("src_type") == "device_no") & (F.col("dst_type") == "uid")
    return (
        edges.filter(forward | backward)
        .select(
            F.when(forward, F.col("dst_key")).otherwise(F.col("src_key")).alias("device_no"),
            F.when(forward, F.col("src_key")).otherwise(F.col("dst_key")).alias("uid"),
        )
        .distinct()
    )


def device_user_counts(edges: DataFrame) -> DataFrame:
    """Distinct uids per device. Pairs dedupe first, so no device gathers in one task."""
    return device_links(edges).groupBy("device_no").agg(F.count(F.lit(1)).alias("uid_count"))


def device_user_counts_approx(edges: DataFrame, rsd: float = 0.02) -> DataFrame:
    """The same by sketch, for a quick look over very large graphs."""
    pairs = edges.filter((F.col("src_type") == "uid") & (F.col("dst_type") == "device_no"))
    return pairs.groupBy(F.col("dst_key").alias("device_no")).agg(
        F.approx_count_distinct("src_key", rsd).alias("uid_count")
    )


def all_devices_with_counts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Every device node, zero when no uid uses it."""
    devices = nodes.filter(F.col("node_type") == "device_no").select(F.col("key").alias("device_no"))
    return devices.join(device_user_counts(edges), "device_no", "left").withColumn(
        "uid_count", F.coalesce("uid_count", F.lit(0))
    )


def top_devices(counts: DataFrame, n: int = rules.TOP_DEVICES) -> DataFrame:
    """Devices with most uids; a repeated device keeps its larger count."""
    best = counts.groupBy("device_no").agg(F.max("uid_count").alias("uid_count"))
    return best.orderBy(F.desc("uid_count"), "device_no").limit(n)


def shared_beyond_first(counts: DataFrame) -> DataFrame:
    return counts.withColumn("adjusted", beyond_first(F.col("uid_count")))


def device_channels(login: DataFrame, device_column: str, channel_column: str, seq: str = "seq") -> DataFrame:
    """First non-empty channel per device in file order."""
    rows = login.select(
        F.lower(strip_quotes(device_column)).alias("device_no"),
        trim_only(channel_column).alias("channel"),
        F.col(seq).alias("_seq"),
    ).filter((F.col("device_no") != "") & F.col("channel").isNotNull())
    return rows.groupBy("device_no").agg(F.min_by("channel", F.struct("_seq", "channel")).alias("channel"))


def with_channel(devices: DataFrame, channels: DataFrame) -> DataFrame:
    return devices.join(channels, "device_no", "left").withColumn(
        "channel", F.coalesce("channel", F.lit("UNKNOWN"))
    )


def device_risk_summary(risks: DataFrame) -> DataFrame:
    """Max, min and mean risk per device; rows whose risk is no number are ignored."""
    rows = risks.select(
        F.lower(strip_quotes("device_no")).alias("device_no"), lenient_double("risk").alias("risk")
    ).filter((F.col("device_no") != "") & F.col("risk").isNotNull())
    return rows.groupBy("device_no").agg(
        F.max("risk").alias("max_risk"), F.min("risk").alias("min_risk"), F.avg("risk").alias("avg_risk")
    )


def parse_risk_lines(lines: DataFrame, columns: Sequence[str], column: str = "value") -> DataFrame:
    """Whitespace-separated lines into text columns; shorter lines and blanks are dropped."""
    text = trim_only(column)
    parts = F.split(text, r"\s+")
    kept = [c for c in lines.columns if c != column]
    return (
        lines.select(*kept, parts.alias("_p"))
        .filter(F.col("_p").isNotNull() & (F.size("_p") >= len(columns)))
        .select(*kept, *[F.col("_p")[i].alias(c) for i, c in enumerate(columns)])
    )


# -- uid lists ----------------------------------------------------------------


def best_risk_per_uid(risks: DataFrame) -> DataFrame:
    return (
        risks.select("uid", lenient_double("risk").alias("risk"))
        .filter(F.col("risk").isNotNull())
        .groupBy("uid")
        .agg(F.max("risk").alias("risk"))
    )


def top_risks(
    lines: DataFrame,
    order: Sequence[str],
    read: int | None = None,
    n: int = rules.TOP_RISKS,
) -> DataFrame:
    """Highest risk per uid over the non-blank lines, then the top ``n`` uids.

    All lines count unless the caller gives ``read``, the number of first lines in ``order``.
    """
    head = lines.filter(trim_only("value").isNotNull())
    if read is not None:
        head = head.orderBy(*order).limit(read)
    risks = parse_risk_lines(head.select("value"), ["uid", "risk"])
    return best_risk_per_uid(risks).orderBy(F.desc("risk"), "uid").limit(n)


def in_list(risks: DataFrame, uids: DataFrame) -> DataFrame:
    return risks.join(uids, "uid", "left_semi")


def without_device(risks: DataFrame, edges: DataFrame, device: str) -> DataFrame:
    """Drop uids linked to one device."""
    linked = device_links(edges).filter(F.col("device_no") == device).select("uid")
    return risks.join(linked, "uid", "left_anti")


# -- order status -------------------------------------------------------------


def status_distribution(orders: DataFrame) -> DataFrame:
    """Orders per category and status with their share, and per category (status null).

    One pass counts the statuses; shares and category totals come from that small
    table, whose total is a scalar subquery over it.
    """
    counts = orders.groupBy(status_class("order_status").alias("category"), "order_status").agg(
        F.count(F.lit(1)).alias("orders")
    )
    total = counts.agg(F.sum("orders").alias("t")).scalar()
    by_category = counts.groupBy("category").agg(F.sum("orders").alias("orders"))
    levels = counts.withColumn("level", F.lit("status")).unionByName(
        by_category.withColumn("order_status", F.lit(None).cast("string")).withColumn("level", F.lit("category"))
    )
    return levels.withColumn("share", F.col("orders") / total)


def users_with_status(orders: DataFrame, statuses: Sequence[str]) -> DataFrame:
    return distinct_key(orders.filter(F.col("order_status").isin(*statuses)), "user_id")


def unclassified_statuses(orders: DataFrame) -> DataFrame:
    known = (*rules.NORMAL_STATUSES, *rules.ABNORMAL_STATUSES, *rules.EXCLUDED_STATUSES)
    return orders.select("order_status").distinct().filter(~F.col("order_status").isin(*known))


def training_cohorts(orders: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Each uid once with its cohort: blacklist, normal, or both (overlap)."""
    normal = users_with_status(orders, rules.NORMAL_STATUSES).withColumn("_n", F.lit(1)).withColumn("_b", F.lit(0))
    listed = distinct_key(blacklist, "c_customer_no").withColumn("_n", F.lit(0)).withColumn("_b", F.lit(1))
    per_uid = normal.unionByName(listed).groupBy("uid").agg(F.max("_n").alias("n"), F.max("_b").alias("b"))
    cohort = F.when((F.col("n") == 1) & (F.col("b") == 1), "overlap").when(F.col("b") == 1, "blacklist").otherwise("normal")
    return per_uid.select("uid", cohort.alias("cohort"))
