"""Which users share an identifier, and what that is worth as risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave import rules
from riskweave.functions.weights import beyond_first, lookup
from riskweave.operators.graph import Graph, union_all
from riskweave.operators.skew import salted_lookup


def direct_links(edges: DataFrame) -> DataFrame:
    """Node, uid and latest time over all direct uid edges to an identifier."""
    direct = edges.filter((F.col("src_type") == "uid") & F.col("dst_type").isin(*rules.ASSOCIATED_TYPES))
    return direct.groupBy(
        F.col("dst_type").alias("node_type"), F.col("dst_key").alias("key"), F.col("src_key").alias("uid")
    ).agg(F.max("last_seen_ts").alias("latest_ts"))


def association_counts(edges: DataFrame) -> DataFrame:
    """Distinct uids per identifier node, nodes without any left out."""
    return direct_links(edges).groupBy("node_type", "key").agg(F.count(F.lit(1)).alias("associated_uid_count"))


def association_entries(edges: DataFrame) -> DataFrame:
    """One row per node and uid: latest time, and the node's count of uids.

    The complete uid -> latest time map of every node, however shared, as a long table.
    """
    links = direct_links(edges)
    return salted_lookup(links, association_counts(edges), ["node_type", "key"], ["uid"])


def association_statistics(counts: DataFrame) -> DataFrame:
    c = "associated_uid_count"
    return counts.groupBy("node_type").agg(
        F.count(F.lit(1)).alias("total_nodes"),
        F.avg(c).alias("avg_uid_count"),
        F.max(c).alias("max_uid_count"),
        F.min(c).alias("min_uid_count"),
    )


def association_histogram(counts: DataFrame, first: int = 5) -> DataFrame:
    """The ``first`` smallest counts per node type and how many nodes have them.

    The window sees distinct counts only: they are distinct whole numbers that add
    up to at most the number of links.
    """
    hist = counts.groupBy("node_type", F.col("associated_uid_count").alias("uid_count")).agg(
        F.count(F.lit(1)).alias("node_count")
    )
    rank = F.row_number().over(Window.partitionBy("node_type").orderBy("uid_count"))
    return hist.withColumn("_r", rank).filter(F.col("_r") <= first).drop("_r")


def nodes_of_uid(edges: DataFrame, uid: Column) -> DataFrame:
    """Identifiers a uid uses, with their association counts."""
    mine = direct_links(edges).filter(F.col("uid") == uid)
    return mine.join(association_counts(edges), ["node_type", "key"])


# -- association score --------------------------------------------------------

# Bucket -> (node type, direct uid relations, order relations)
BUCKETS = {
    "phone_main": ("phone_num", ("LOGIN_WITH_PHONE", "HAS_PHONE"), ("ORDER_APPLY_PHONE",)),
    "phone_contact": ("phone_num", ("HAS_CONTACT_PHONE",), ()),
    "identity": ("identity_no", ("HAS_IDENTITY",), ("ORDER_APPLY_IDENTITY",)),
    "card": ("card_no", (), ("ORDER_APPLY_CARD", "ORDER_REPAY_CARD")),
    "device": ("device_no", ("LOGIN_WITH_DEVICE",), ()),
    "td_device": ("td_device_id", ("LOGIN_WITH_TD_DEVICE",), ()),
    "ip": ("remote_ip", ("LOGIN_WITH_IP",), ()),
    "geo": ("geo_code", ("LOCATED_AT",), ()),
}


def _bucket_of(rel: Column, position: int) -> Column:
    pairs = [(r, b) for b, spec in BUCKETS.items() for r in spec[position]]
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in pairs for x in pair]), rel)


def windowed_links(graph: Graph) -> DataFrame:
    """IP and location edges inside the window that ends at the node's update time.

    Many edges meet one node row, so the lookup is salted for busy nodes.
    """
    links = graph.edges.filter(F.col("rel").isin("LOGIN_WITH_IP", "LOCATED_AT")).select(
        _bucket_of(F.col("rel"), 1).alias("bucket"),
        F.col("dst_type").alias("node_type"),
        F.col("dst_key").alias("key"),
        F.col("src_key").alias("uid"),
        "last_seen_ts",
    )
    keep = F.col("node_type").isin("remote_ip", "geo_code")
    nodes = graph.nodes.filter(keep).select("node_type", "key", "updated_at")
    joined = salted_lookup(links.filter(F.col("last_seen_ts").isNotNull()), nodes, ["node_type", "key"], ["uid"])
    start = F.col("updated_at")
    for bucket, days in rules.ASSOCIATION_WINDOW_DAYS.items():
        start = F.when(F.col("bucket") == bucket, F.col("updated_at") - F.expr(f"INTERVAL {days} DAYS")).otherwise(start)
    inside = F.col("last_seen_ts").between(start, F.col("updated_at"))
    return joined.filter(F.coalesce(inside, F.lit(True))).select("bucket", "node_type", "key", "uid")


def bucket_links(graph: Graph, via_orders: bool = True) -> DataFrame:
    """Distinct (bucket, node, uid) over all association paths."""
    edges = graph.edges
    direct = (
        edges.filter((F.col("src_type") == "uid") & ~F.col("rel").isin("LOGIN_WITH_IP", "LOCATED_AT"))
        .select(
            _bucket_of(F.col("rel"), 1).alias("bucket"),
            F.col("dst_type").alias("node_type"),
            F.col("dst_key").alias("key"),
            F.col("src_key").alias("uid"),
        )
        .filter(F.col("bucket").isNotNull())
    )
    parts = [direct, windowed_links(graph)]
    if via_orders:
        placed = edges.filter(F.col("rel") == "PLACED_ORDER").select(
            F.col("dst_key").alias("order_key"), F.col("src_key").alias("uid")
        )
        applied = (
            edges.filter(F.col("src_type") == "order")
            .select(
                F.col("src_key").alias("order_key"),
                _bucket_of(F.col("rel"), 2).alias("bucket"),
                F.col("dst_type").alias("node_type"),
                F.col("dst_key").alias("key"),
            )
            .filter(F.col("bucket").isNotNull())
        )
        parts.append(applied.join(placed, "order_key").drop("order_key"))
    return union_all(parts).distinct()


def bucket_counts(graph: Graph, via_orders: bool = True) -> DataFrame:
    """Distinct uids per node and bucket."""
    return (
        bucket_links(graph, via_orders)
        .groupBy("node_type", "key", "bucket")
        .agg(F.count(F.lit(1)).alias("uid_count"))
    )


def association_scores(graph: Graph, via_orders: bool = True) -> DataFrame:
    """Weighted count of further users per node; nodes without one are left out.

    ``via_orders=False`` takes direct relations only, and scores a phone's contacts
    only when it also has a main user.
    """
    counts = bucket_counts(graph, via_orders)
    term = lookup(rules.ASSOCIATION_WEIGHTS, F.col("bucket"), 0.0) * beyond_first(F.col("uid_count"))
    score = F.sum(term)
    if not via_orders:
        others = F.sum(F.when(F.col("bucket") != "phone_contact", term))
        has_main = F.max(F.col("bucket") == "phone_main")
        score = F.when(has_main, score).otherwise(F.coalesce(others, F.lit(0.0)))
    return counts.groupBy("node_type", "key").agg(score.alias("association_risk"))
