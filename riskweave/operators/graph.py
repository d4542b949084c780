"""The identifier graph as two tables.

Edges are a mergeable aggregate per (src, rel, dst): min and max time, count.
Nodes are a mergeable aggregate per (type, key). Raw rows shuffle once, for the
edge aggregate; nodes come from the aggregated edges plus the few rows that touch
a node without an edge. Links that many rows repeat are combined before the shuffle.
Links that hold an order's own number seldom repeat: there the narrow rows of an order
shuffle and are made links where they meet, so that no task holds the links of a whole
file, and an order's links lie together when nodes are made from them. The nodes of orders
and plans are made from narrow rows too, their touches and attributes in one shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.operators.feeds import valid_rows
from riskweave.operators.skew import previous_value

EDGE_KEY = ["src_type", "src_key", "rel", "dst_type", "dst_key"]
NODE_KEY = ["node_type", "key"]

CONTACT_FEEDS = (
    "first_linkman",
    "second_linkman",
    "first_linkman_derived",
    "second_linkman_derived",
)

# dataset -> (src type, src column, relation, dst type, dst column)
_CONTACT_EDGES = [("uid", "uid", "HAS_CONTACT_PHONE", "phone_num", "phone_num")]
_CASE_EDGES = [
    ("complaint_case", "case_key", "C_HAS_IDENTITY", "identity_no", "identity_no"),
    ("complaint_case", "case_key", "C_REGISTER_PHONE", "phone_num", "register_phone"),
    ("complaint_case", "case_key", "C_CONTACT_PHONE", "phone_num", "contact_phone"),
]
# Per feed the relations (source type, source column, relation, target type, target column).
EDGES = {
    "login": [
        ("uid", "uid", "LOGIN_WITH_PHONE", "phone_num", "phone_num"),
        ("uid", "uid", "LOGIN_WITH_DEVICE", "device_no", "device_no"),
        ("uid", "uid", "LOGIN_WITH_TD_DEVICE", "td_device_id", "td_device_id"),
        ("uid", "uid", "LOGIN_WITH_IP", "remote_ip", "remote_ip"),
    ],
    "lbs_gps": [("uid", "uid", "LOCATED_AT", "geo_code", "geo_code")],
    **{name: _CONTACT_EDGES for name in CONTACT_FEEDS},
    "order": [
        ("uid", "uid", "PLACED_ORDER", "order", "order_id"),
        ("order", "order_id", "ORDER_APPLY_PHONE", "phone_num", "apply_loan_tel"),
        ("order", "order_id", "ORDER_APPLY_IDENTITY", "identity_no", "apply_ident_no"),
        ("order", "order_id", "ORDER_APPLY_CARD", "card_no", "apply_card_no"),
        ("order", "order_id", "ORDER_REPAY_CARD", "card_no", "repay_card_no"),
        ("card_no", "apply_card_no", "CARD_BIND_PHONE", "phone_num", "apply_bank_mobile"),
        ("card_no", "repay_card_no", "CARD_BIND_PHONE", "phone_num", "repay_bank_mobile"),
    ],
    "company_log": [("uid", "uid", "BELONGS_TO_COMPANY", "company_name", "company_name")],
    "complaint": _CASE_EDGES,
    "consumer_protection_case": _CASE_EDGES,
    "repay_plan": [("order", "order_id", "REPAY_PLAN", "repay_plan", "repay_plan_id")],
    "customer_log": [
        ("uid", "uid", "HAS_IDENTITY", "identity_no", "new_identity"),
        ("uid", "uid", "HAS_PHONE", "phone_num", "new_phone"),
    ],
}

# Dataset -> the column that is at one end of its links, and the relation of those where it is not.
RECORDS = {"order": ("order_id", "CARD_BIND_PHONE"), "repay_plan": ("order_id", None)}

# Dataset -> the type of node that only its rows describe, the column of its key, plain and stamped attributes.
RECORD_NODES = {
    "order": ("order", "order_id", (), ("order_status",)),
    "repay_plan": (
        "repay_plan", "repay_plan_id", ("due_date", "repayed_date"), ("early_mark", "overdue_mark", "overdue_days", "plan_status")
    ),
}

# Each (source type, relation, target type) once: a link's rows name it by its place.
_KINDS = list(dict.fromkeys((st, rel, dt) for links in EDGES.values() for st, _, rel, dt, _ in links))

# Dataset -> nodes a row touches even when it carries no edge
OWNERS = {
    "customer_log": [("uid", "uid")],
    "login": [("uid", "uid")],
    "logout": [("uid", "uid"), ("identity_no", "identity_no"), ("phone_num", "phone_num")],
    "complaint": [("complaint_case", "case_key")],
    "consumer_protection_case": [("complaint_case", "case_key")],
    "blacklist_log": [("uid", "uid"), ("identity_no", "identity_no"), ("phone_num", "phone_num")],
}


@dataclass(frozen=True)
class Graph:
    nodes: DataFrame
    edges: DataFrame


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows by keys in as many partitions as the session shuffles to.

    Partitions that the shuffle joins up by their compressed size hold more rows than a task can group in memory.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


# -- edges --------------------------------------------------------------------


def customer_changes(rows: DataFrame) -> DataFrame:
    """Mark each customer row whose identity or phone differs from the one before.

    A missing value counts as a value; the first row differs when it has one.
    """
    seen = previous_value(rows, "uid", "ts", ["seq"], ["identity_no", "phone_num"])
    identity_changed = ~F.col("identity_no").eqNullSafe(F.col("prev_identity_no"))
    phone_changed = ~F.col("phone_num").eqNullSafe(F.col("prev_phone_num"))
    return seen.select(
        *rows.columns,
        identity_changed.alias("identity_changed"),
        phone_changed.alias("phone_changed"),
        (~identity_changed & ~phone_changed).alias("deduplicated"),
        F.when(identity_changed, F.col("identity_no")).alias("new_identity"),
        F.when(phone_changed, F.col("phone_num")).alias("new_phone"),
    )


def _link_rows(dataset: str, rows: DataFrame, rels: Sequence[str] | None = None) -> DataFrame:
    """One row per link seen in a cleaned feed: its place in ``_KINDS``, its ends and ``ts``; of the given relations only."""
    if dataset == "customer_log":
        rows = customer_changes(rows)
    links = [
        F.struct(
            F.lit(_KINDS.index((src_type, rel, dst_type))).alias("kind"), F.col(src).alias("src_key"), F.col(dst).alias("dst_key")
        )
        for src_type, src, rel, dst_type, dst in EDGES[dataset]
        if rels is None or rel in rels
    ]
    linked = rows.select("ts", F.inline(F.array(*links)))
    return linked.filter(F.col("src_key").isNotNull() & F.col("dst_key").isNotNull())


def _named(links: DataFrame) -> DataFrame:
    """Links with the names of their kind in its place."""
    kinds = F.array(*[F.struct(F.lit(st).alias("src_type"), F.lit(rel).alias("rel"), F.lit(dt).alias("dst_type")) for st, rel, dt in _KINDS])
    others = [c for c in links.columns if c not in ("kind", "src_key", "dst_key")]
    named = links.withColumn("_kind", kinds[F.col("kind")])
    return named.select("_kind.src_type", "src_key", "_kind.rel", "_kind.dst_type", "dst_key", *others)


def edge_rows(dataset: str, rows: DataFrame) -> DataFrame:
    """One row per edge seen in a cleaned feed: edge key and ``ts``."""
    return _named(_link_rows(dataset, rows))


def _counts_of_links() -> list[Column]:
    return [F.min("ts").alias("first_seen_ts"), F.max("ts").alias("last_seen_ts"), F.count(F.lit(1)).alias("event_count")]


def aggregate_edges(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*EDGE_KEY).agg(*_counts_of_links())


def _record_edges(dataset: str, rows: DataFrame) -> DataFrame:
    """Edges of a record feed at the record: its rows meet in one partition and are made links there.

    A link is known there by the record, its kind and its other end. No other feed has its relations.
    """
    record, left_out = RECORDS[dataset]
    own = [e for e in EDGES[dataset] if e[2] != left_out]
    others = [dst if src == record else src for _, src, _, _, dst in own]
    kinds = [_KINDS.index((st, rel, dt)) for st, _, rel, dt, _ in own]
    met = dealt(rows.select("ts", record, *dict.fromkeys(others)).filter(F.col(record).isNotNull()), record)
    links = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("other")) for k, c in zip(kinds, others)])
    linked = met.select("ts", F.col(record).alias("record"), F.inline(links)).filter(F.col("other").isNotNull())
    counted = linked.groupBy("record", "kind", "other").agg(*_counts_of_links())
    outward = F.col("kind").isin([k for k, e in zip(kinds, own) if e[1] == record])
    ends = {
        "src_key": F.when(outward, F.col("record")).otherwise(F.col("other")),
        "dst_key": F.when(outward, F.col("other")).otherwise(F.col("record")),
    }
    return _named(counted.withColumns(ends).drop("record", "other"))


def feed_edges(rows: Mapping[str, DataFrame]) -> DataFrame | None:
    """The edges of cleaned feeds; None where no feed has any."""
    feeds = [d for d in rows if d in EDGES]
    links = [_link_rows(d, rows[d]) for d in feeds if d not in RECORDS]
    links += [_link_rows(d, rows[d], [RECORDS[d][1]]) for d in feeds if d in RECORDS and RECORDS[d][1]]
    parts = [_record_edges(d, rows[d]) for d in feeds if d in RECORDS]
    if links:
        parts.append(_named(union_all(links).groupBy("kind", "src_key", "dst_key").agg(*_counts_of_links())))
    return union_all(parts) if parts else None


def merge_edges(*parts: DataFrame) -> DataFrame:
    """Combine edge tables; associative and commutative."""
    return (
        union_all(list(parts))
        .groupBy(*EDGE_KEY)
        .agg(
            F.min("first_seen_ts").alias("first_seen_ts"),
            F.max("last_seen_ts").alias("last_seen_ts"),
            F.sum("event_count").alias("event_count"),
        )
    )


# -- nodes --------------------------------------------------------------------

def edge_ends(edges: DataFrame) -> DataFrame:
    """Node touches implied by edges."""
    ends = F.array(
        F.struct(F.col("src_type").alias("node_type"), F.col("src_key").alias("key")),
        F.struct(F.col("dst_type").alias("node_type"), F.col("dst_key").alias("key")),
    )
    return edges.select(
        F.inline(ends),
        F.col("first_seen_ts").alias("created_at"),
        F.col("last_seen_ts").alias("updated_at"),
    )


def owner_touches(dataset: str, rows: DataFrame) -> DataFrame:
    """Node touches of a feed beyond its edges, with its fixed-width attributes."""
    no_time = F.lit(None).cast("timestamp_ntz")
    is_logout = dataset == "logout"
    owners = []
    for node_type, column in OWNERS[dataset]:
        owners.append(
            F.struct(
                F.lit(node_type).alias("node_type"),
                F.col(column).alias("key"),
                (F.col("ts") if dataset == "login" else no_time).alias("last_login_ts"),
                (F.col("ts") if dataset == "customer_log" else no_time).alias("last_update_ts"),
                F.lit(is_logout and node_type == "uid").alias("logout_flag"),
                F.lit(int(is_logout and node_type != "uid")).cast("long").alias("logout_count"),
            )
        )
    out = rows.select("ts", F.inline(F.array(*owners))).filter(F.col("key").isNotNull())
    return aggregate_nodes(
        out.withColumn("created_at", F.col("ts")).withColumnRenamed("ts", "updated_at")
    )


def aggregate_nodes(touches: DataFrame) -> DataFrame:
    """Fixed-width aggregates only, so both sides of the shuffle hash-aggregate."""
    return touches.groupBy(*NODE_KEY).agg(
        F.min("created_at").alias("created_at"),
        F.max("updated_at").alias("updated_at"),
        F.max("last_login_ts").alias("last_login_ts"),
        F.max("last_update_ts").alias("last_update_ts"),
        F.max("logout_flag").alias("logout_flag"),
        F.sum("logout_count").alias("logout_count"),
    )


# Attributes travel "stamped": a struct that starts with (ts, seq), so that ``max``
# picks the newest and tables of them merge like the counters do. Dates and the
# case source merge by plain ``max``.
_VALUE = "struct<ts:timestamp_ntz,seq:bigint,value:string>"
#: The status that a blacklist backfill sets.
LISTED = "BLACKLISTED"
STAMPED = {
    "customer": "struct<ts:timestamp_ntz,seq:bigint,identity_no:string,phone_num:string>",
    "order_status": _VALUE,
    "blacklist": "struct<ts:timestamp_ntz,seq:bigint,status:string,reason_list:string>",
    "due_date": "timestamp_ntz",
    "repayed_date": "timestamp_ntz",
    "early_mark": _VALUE,
    "overdue_mark": _VALUE,
    "overdue_days": _VALUE,
    "plan_status": _VALUE,
    "source": "string",
    "listed": "boolean",
}


def _stamp(column: str) -> Column:
    """A value with its time; the largest is the newest non-null one."""
    return F.when(F.col(column).isNotNull(), F.struct("ts", "seq", F.col(column).alias("value"))).alias(column)


def _of_node(rows: DataFrame, node_type: str, key: str, *values: Column) -> DataFrame:
    return rows.select(F.lit(node_type).alias("node_type"), F.col(key).alias("key"), *values)


def _newest(stamped: DataFrame) -> DataFrame:
    """One row per node: the largest of every column."""
    return stamped.groupBy(*NODE_KEY).agg(*[F.max(c).alias(c) for c in stamped.columns if c not in NODE_KEY])


def _customer_attributes(rows: DataFrame) -> DataFrame:
    """Newest identity and phone; a newest missing value stays missing."""
    return _of_node(rows, "uid", "uid", F.struct("ts", "seq", "identity_no", "phone_num").alias("customer"))


def _record_values(dataset: str) -> list[Column]:
    """Largest dates; newest non-null marks, days and status."""
    _, _, plain, stamped = RECORD_NODES[dataset]
    return [*[F.col(c) for c in plain], *[_stamp(c) for c in stamped]]


def _order_attributes(rows: DataFrame) -> DataFrame:
    return _of_node(rows, "order", "order_id", *_record_values("order"))


def blacklist_marks(rows: DataFrame) -> DataFrame:
    """Blacklist rows per named uid, identity and phone."""
    marks = F.array(
        *[F.struct(F.lit(t).alias("node_type"), F.col(c).alias("key")) for t, c in OWNERS["blacklist_log"]]
    )
    return rows.select("*", F.inline(marks)).filter(F.col("key").isNotNull())


def _blacklist_attributes(rows: DataFrame) -> DataFrame:
    """Newest entry; later rows win ties."""
    return blacklist_marks(rows).select(*NODE_KEY, F.struct("ts", "seq", "status", "reason_list").alias("blacklist"))


def _plan_attributes(rows: DataFrame) -> DataFrame:
    return _of_node(rows, "repay_plan", "repay_plan_id", *_record_values("repay_plan"))


def _case_attributes(rows: DataFrame) -> DataFrame:
    return _of_node(rows, "complaint_case", "case_key", F.col("source"))


# Dataset -> its rows as node key and stamped values.
ATTRIBUTES = {
    "customer_log": _customer_attributes,
    "order": _order_attributes,
    "blacklist_log": _blacklist_attributes,
    "repay_plan": _plan_attributes,
    "complaint": _case_attributes,
    "consumer_protection_case": _case_attributes,
}


# Feeds with about one row per node, which is not worth combining before the shuffle.
_OWN_NODES = ("order", "repay_plan", "complaint", "consumer_protection_case")


def stamped_attributes(rows: Mapping[str, DataFrame]) -> DataFrame | None:
    """All feeds' attributes, one row per node.

    Customer and blacklist rows, many of which name one node, are combined first. Rows of
    orders and repayment plans shuffle as they are, once, and are sorted behind the shuffle;
    the result is partitioned and sorted by node, as the join with the touches wants it.
    """
    shared = [_newest(ATTRIBUTES[d](rows[d])) for d in rows if d in ATTRIBUTES and d not in _OWN_NODES]
    own = [ATTRIBUTES[d](rows[d]) for d in rows if d in _OWN_NODES]
    if not shared and not own:
        return None
    together = _all_stamped(union_all(shared + own)).repartition(*NODE_KEY)
    return _newest(together).select(*NODE_KEY, *STAMPED)


def _all_stamped(attributes: DataFrame) -> DataFrame:
    have = attributes.columns
    lacking = [F.lit(None).cast(t).alias(c) for c, t in STAMPED.items() if c not in have]
    return attributes.select("*", *lacking).select(*NODE_KEY, *STAMPED)


def merge_attributes(*parts: DataFrame) -> DataFrame:
    wide = _all_stamped(union_all(list(parts)))
    return wide.groupBy(*NODE_KEY).agg(*[F.max(c).alias(c) for c in STAMPED])


def node_touches(edges: DataFrame, rows: Mapping[str, DataFrame]) -> DataFrame:
    """Fixed-width node table of the given edges and cleaned feeds."""
    parts = [_with_blank_touch(edge_ends(edges))]
    parts += [owner_touches(d, rows[d]) for d in rows if d in OWNERS]
    return aggregate_nodes(union_all(parts))


def nodes_from(edges: DataFrame, rows: Mapping[str, DataFrame]) -> DataFrame:
    """Node table of cleaned feeds, ``edges`` being the edges of the same feeds."""
    records = [d for d in rows if d in RECORD_NODES]
    types = [RECORD_NODES[d][0] for d in records]
    others = {d: r for d, r in rows.items() if d not in records}
    outer = edges.filter(~(F.col("src_type").isin(types) & F.col("dst_type").isin(types)))
    parts = [_with_blank_touch(edge_ends(outer).filter(~F.col("node_type").isin(types)))]
    parts += [owner_touches(d, others[d]) for d in others if d in OWNERS]
    nodes = [finish_nodes(aggregate_nodes(union_all(parts)), stamped_attributes(others))]
    return union_all(nodes + [_record_nodes(d, edges, rows[d]) for d in records])


def _record_nodes(dataset: str, edges: DataFrame, rows: DataFrame) -> DataFrame:
    """The nodes that only a record feed describes: its narrow rows and other feeds' touches shuffle once, by node.

    A row touches its node when it has one of the node's links, and describes it in any case.
    """
    node_type, key, plain, stamped = RECORD_NODES[dataset]
    links = [(src, dst) for st, src, _, dt, dst in EDGES[dataset] if (node_type, key) in ((st, src), (dt, dst))]
    linked = reduce(Column.__or__, [F.col(src).isNotNull() & F.col(dst).isNotNull() for src, dst in links])
    own = rows.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), linked.alias("linked"), "ts", F.lit(None).cast("timestamp_ntz").alias("until"), "seq", *plain, *stamped
    )
    rels = sorted(
        {rel for d, feed in EDGES.items() if d != dataset for st, _, rel, dt, _ in feed if node_type in (st, dt)}
    )
    if rels:
        ends = edge_ends(edges.filter(F.col("rel").isin(rels))).filter(F.col("node_type") == node_type)
        touches = ends.groupBy("key").agg(F.min("created_at").alias("ts"), F.max("updated_at").alias("until"))
        own = own.unionByName(touches.withColumn("linked", F.lit(True)), allowMissingColumns=True)
    since, until = F.when(F.col("linked"), F.col("ts")), F.when(F.col("linked"), F.coalesce("until", "ts"))
    met = dealt(own, "key").select("key", "linked", since.alias("since"), until.alias("until"), *_record_values(dataset))
    touched = met.groupBy("key").agg(
        F.max("linked").alias("linked"),
        F.min("since").alias("created_at"),
        F.max("until").alias("updated_at"),
        *[F.max(c).alias(c) for c in (*plain, *stamped)],
    )
    nodes = touched.filter("linked").drop("linked").withColumn("node_type", F.lit(node_type))
    lacking = [F.lit(None).cast(t).alias(c) for c, t in STAMPED.items() if c not in (*plain, *stamped)]
    return _unwrapped(_with_blank_touch(nodes).select("*", *lacking))


def _with_blank_touch(ends: DataFrame) -> DataFrame:
    return ends.select(
        "*",
        F.lit(None).cast("timestamp_ntz").alias("last_login_ts"),
        F.lit(None).cast("timestamp_ntz").alias("last_update_ts"),
        F.lit(False).alias("logout_flag"),
        F.lit(0).cast("long").alias("logout_count"),
    )


def finish_nodes(touches: DataFrame, attributes: DataFrame | None) -> DataFrame:
    """Node table: touches with attributes unwrapped. Both sides hold one row per
    node and are partitioned by it already."""
    if attributes is None:
        nodes = touches
        for name, dtype in STAMPED.items():
            nodes = nodes.withColumn(name, F.lit(None).cast(dtype))
    else:
        nodes = touches.join(attributes, NODE_KEY, "left")
    return _unwrapped(nodes)


def _unwrapped(nodes: DataFrame) -> DataFrame:
    is_uid = F.col("node_type") == "uid"
    counted = F.col("node_type").isin("phone_num", "identity_no")
    return nodes.select(
        *NODE_KEY,
        "created_at",
        "updated_at",
        "last_login_ts",
        "last_update_ts",
        F.when(is_uid, F.col("logout_flag")).alias("logout_flag"),
        F.when(counted, F.col("logout_count")).alias("logout_count"),
        F.col("customer.identity_no").alias("latest_identity"),
        F.col("customer.phone_num").alias("latest_phone"),
        F.col("order_status.value").alias("order_status"),
        F.when(F.col("listed"), F.lit(LISTED)).otherwise(F.col("blacklist.status")).alias("status"),
        F.col("blacklist.reason_list").alias("reason_list"),
        "due_date",
        "repayed_date",
        *[F.col(f"{c}.value").alias(c) for c in ("early_mark", "overdue_mark", "overdue_days", "plan_status")],
        "source",
        (F.col("blacklist").isNotNull() | F.coalesce("listed", F.lit(False))).alias("is_blacklisted"),
    )


# -- whole graph --------------------------------------------------------------


def clean_feeds(feeds: Mapping[str, DataFrame], blacklist_max_ts: str | None = None) -> dict[str, DataFrame]:
    return {
        d: valid_rows(d, raw, blacklist_max_ts if d == "blacklist_log" else None)
        for d, raw in feeds.items()
    }


def build_edges(rows: Mapping[str, DataFrame]) -> DataFrame:
    return feed_edges(rows)


def build_graph(feeds: Mapping[str, DataFrame], blacklist_max_ts: str | None = None) -> Graph:
    """Nodes and edges of raw feeds (dataset name -> DataFrame)."""
    rows = clean_feeds(feeds, blacklist_max_ts)
    edges = build_edges(rows)
    return Graph(nodes_from(edges, rows), edges)


def duplicate_keys(nodes: DataFrame) -> DataFrame:
    """Node keys that are not unique; empty for a sound table."""
    return (
        nodes.groupBy(*NODE_KEY)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )


def graph_summary(graph: Graph) -> DataFrame:
    """Node count, edge count, sorted labels and relations, as one row.

    Counts per label and per relation are aggregated first; the lists hold at
    most one entry per node type and per relation.
    """
    labels = graph.nodes.groupBy(F.col("node_type").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    rels = graph.edges.groupBy(F.col("rel").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    both = labels.withColumn("kind", F.lit("node")).unionByName(rels.withColumn("kind", F.lit("edge")))
    node, edge = F.col("kind") == "node", F.col("kind") == "edge"
    return both.agg(
        F.coalesce(F.sum(F.when(node, F.col("n"))), F.lit(0)).alias("node_count"),
        F.coalesce(F.sum(F.when(edge, F.col("n"))), F.lit(0)).alias("edge_count"),
        F.array_sort(F.collect_list(F.when(node, F.col("name")))).alias("labels"),
        F.array_sort(F.collect_list(F.when(edge, F.col("name")))).alias("relations"),
    )


# -- status backfills ---------------------------------------------------------


def order_status_delta(nodes: DataFrame, order_rows: DataFrame) -> DataFrame:
    """The existing order nodes that the rows name, with their newest known status."""
    newest = _newest(_order_attributes(order_rows)).select(*NODE_KEY, F.col("order_status.value").alias("_status"))
    orders = nodes.filter(F.col("node_type") == "order")
    touched = orders.join(newest.filter(F.col("_status").isNotNull()), NODE_KEY)
    return touched.withColumn("order_status", F.col("_status")).drop("_status")


def blacklist_delta(nodes: DataFrame, blacklist_rows: DataFrame) -> DataFrame:
    """The existing uid, phone and identity nodes that the blacklist names, marked."""
    listed = blacklist_marks(blacklist_rows).select(*NODE_KEY).distinct()
    types = [F.col("node_type") == t for t in ("uid", "phone_num", "identity_no")]
    touched = nodes.filter(types[0] | types[1] | types[2]).join(listed, NODE_KEY, "left_semi")
    return touched.withColumns({"is_blacklisted": F.lit(True), "status": F.lit(LISTED)})


def backfill_attributes(dataset: str, rows: DataFrame, as_of: str) -> DataFrame:
    """Backfill rows as stamped attributes, which merge like those of feeds and make no node.

    An order's status counts from ``as_of``: it wins over order rows up to then, later rows
    win over it. A blacklist mark stays.
    """
    if dataset == "order":
        newest = _newest(_order_attributes(rows)).filter(F.col("order_status").isNotNull())
        when = F.lit(as_of).cast("timestamp_ntz").alias("ts")
        last = F.lit((1 << 63) - 1).alias("seq")
        stamped = F.struct(when, last, F.col("order_status.value").alias("value"))
        return _all_stamped(newest.select(*NODE_KEY, stamped.alias("order_status")))
    if dataset != "blacklist_log":
        raise ValueError(f"no backfill from {dataset}")
    return _all_stamped(blacklist_marks(rows).select(*NODE_KEY).distinct().withColumn("listed", F.lit(True)))


def backfill_order_status(nodes: DataFrame, order_rows: DataFrame) -> DataFrame:
    """Set the newest known status on existing order nodes; others stay."""
    newest = _newest(_order_attributes(order_rows)).select(*NODE_KEY, F.col("order_status.value").alias("_status"))
    return (
        nodes.join(newest, NODE_KEY, "left")
        .withColumn("order_status", F.coalesce("_status", "order_status"))
        .drop("_status")
    )


def backfill_blacklist(nodes: DataFrame, blacklist_rows: DataFrame) -> DataFrame:
    """Mark existing uid, phone and identity nodes named in the blacklist."""
    listed = blacklist_marks(blacklist_rows).select(*NODE_KEY).distinct().withColumn("_listed", F.lit(True))
    hit = F.coalesce("_listed", F.lit(False))
    return (
        nodes.join(listed, NODE_KEY, "left")
        .withColumn("is_blacklisted", F.col("is_blacklisted") | hit)
        .withColumn("status", F.when(hit, F.lit(LISTED)).otherwise(F.col("status")))
        .drop("_listed")
    )
