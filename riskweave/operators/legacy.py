"""First-generation multigraph: an edge per event time, or per order."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions.clean import clean_columns, trim_only
from riskweave.functions.timeparse import first_existing_time
from riskweave.operators.graph import CONTACT_FEEDS, union_all

# Dataset -> (uid column, time columns, [(relation, node type, column)])
EVENT_EDGES = {
    "customer_log": (
        "baseid",
        ("log_create_date",),
        [("modify_phone_num", "phone_num", "mobile_phone"), ("modify_identity_no", "identity_no", "identity_no")],
    ),
    "lbs_gps": ("cid", ("create_date",), [("gps_geo_code", "geo_code", "geo_code")]),
    **{
        name: ("cid", ("create_date", "modify_date"), [("linkman_phone_num", "phone_num", column)])
        for name, column in zip(CONTACT_FEEDS, ("mobile_phone", "second_mobile_phone") * 2)
    },
    "login": (
        "cif_user_id",
        ("login_time",),
        [
            ("login_phone_num", "phone_num", "phone_num"),
            ("login_device_no", "device_no", "device_no"),
            ("login_td_device_id", "td_device_id", "td_device_id"),
            ("login_remote_ip", "remote_ip", "remote_ip"),
        ],
    ),
}

# Order columns renamed on load.
ORDER_RENAMES = {
    "id": "order_id",
    "user_id": "uid",
    "apply_loan_tel": "phone_num",
    "apply_ident_no": "identity_no",
    "apply_card_no": "card_no",
    "apply_bank_mobile": "card_phone_num",
    "repay_bank_mobile": "repay_card_phone_num",
    "apply_loan_date": "apply_time",
    "sign_date": "sign_time",
}

# Fixed values: (relation, node type, renamed order column)
ORDER_EDGES = [
    ("order_apply_phone_num", "phone_num", "phone_num"),
    ("order_apply_identity_no", "identity_no", "identity_no"),
    ("order_apply_card_no", "card_no", "card_no"),
    ("order_apply_card_phone_num", "phone_num", "card_phone_num"),
    ("order_repay_card_no", "card_no", "repay_card_no"),
    ("order_repay_card_phone_num", "phone_num", "repay_card_phone_num"),
]


def _legacy_key(name: str):
    return F.lower(trim_only(name))


def _links(specs):
    return F.inline(
        F.array(
            *[
                F.struct(F.lit(rel).alias("rel"), F.lit(t).alias("dst_type"), _legacy_key(c).alias("dst_key"))
                for rel, t, c in specs
            ]
        )
    )


def event_edges(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct (uid, relation, node, event time)."""
    parts = []
    for dataset, (uid, times, specs) in EVENT_EDGES.items():
        if dataset not in feeds:
            continue
        df = clean_columns(feeds[dataset])
        parts.append(
            df.select(_legacy_key(uid).alias("uid"), first_existing_time(df, times).alias("event_time"), _links(specs))
        )
    keep = F.col("uid").isNotNull() & F.col("event_time").isNotNull() & F.col("dst_key").isNotNull()
    return union_all(parts).filter(keep).distinct()


def order_edges(orders: DataFrame) -> DataFrame:
    """Per (uid, relation, node, order): the newest row's status and times."""
    df = clean_columns(orders).withColumnsRenamed(ORDER_RENAMES)
    seq = F.col("seq") if "seq" in df.columns else F.lit(None).cast("long")
    rows = df.select(
        trim_only("order_id").alias("order_id"),
        _legacy_key("uid").alias("uid"),
        trim_only("order_status").alias("order_status"),
        first_existing_time(df, ["apply_time"]).alias("apply_time"),
        first_existing_time(df, ["sign_time"]).alias("sign_time"),
        seq.alias("seq"),
        _links(ORDER_EDGES),
    ).filter(F.col("order_id").isNotNull() & F.col("uid").isNotNull() & F.col("dst_key").isNotNull())
    newest = F.max(F.struct("seq", "order_status", "apply_time", "sign_time")).alias("v")
    return (
        rows.groupBy("uid", "rel", "dst_type", "dst_key", "order_id")
        .agg(newest)
        .select("uid", "rel", "dst_type", "dst_key", "order_id", "v.order_status", "v.apply_time", "v.sign_time")
    )


def multigraph(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """All first-generation edges."""
    parts = [event_edges(feeds)]
    if "order" in feeds:
        parts.append(order_edges(feeds["order"]))
    return union_all(parts)


def association_time(edges: DataFrame):
    """First non-null of the edge's time columns."""
    names = ("event_time", "modify_time", "create_time", "apply_time", "sign_time", "last_seen_ts")
    present = [F.col(c) for c in names if c in edges.columns]
    return F.coalesce(*present)


def mark_blacklisted(nodes: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Nodes named by a blacklist entry that has a reason; keys compare as delivered."""
    return nodes.join(_marks(blacklist).select("node_type", "key").distinct(), ["node_type", "key"], "left_semi")


def _marks(blacklist: DataFrame) -> DataFrame:
    df = clean_columns(blacklist)
    named = F.array(
        *[
            F.struct(F.lit(t).alias("node_type"), trim_only(c).alias("key"))
            for t, c in (("uid", "c_customer_no"), ("phone_num", "c_mobile_phone"), ("identity_no", "c_identity_no"))
        ]
    )
    reasoned = df.filter(trim_only("c_reason_list").isNotNull())
    return reasoned.select(F.inline(named)).filter(F.col("key").isNotNull())


def count_updates(nodes: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Entries with a reason, and node updates they cause, per node type."""
    listed = _marks(blacklist).groupBy("node_type", "key").agg(F.count(F.lit(1)).alias("n"))
    return (
        listed.join(nodes.select("node_type", "key").distinct(), ["node_type", "key"])
        .groupBy("node_type")
        .agg(F.sum("n").alias("updates"), F.count(F.lit(1)).alias("nodes_marked"))
    )
