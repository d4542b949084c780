"""Graph construction, merges, backfills and associations over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave import rules
from riskweave.catalog import register
from riskweave.catalog.context import feed, fresh_graph, graph, rows
from riskweave.catalog.sql import CUT, query
from riskweave.fixtures import raw_feeds
from riskweave.operators import association as asc
from riskweave.operators import graph as G
from riskweave.operators import legacy
from riskweave.operators.feeds import backfill_rows
from riskweave.operators.risk import near_overdue_order, neighbour_edges
from riskweave.plans import jobs
from riskweave.session import scratch_path
from riskweave.sources.store import GraphStore

_EDGE = "src_type, src_key, rel, dst_type, dst_key, first_seen_ts, last_seen_ts, event_count"


def _edges_of(spark, sf, *datasets):
    return G.build_edges({d: rows(spark, sf, d) for d in datasets})


def _edge_query(*rels: str) -> str:
    names = ", ".join(f"'{r}'" for r in rels)
    return query(f"SELECT {_EDGE} FROM edges WHERE rel IN ({names})")


@register("G01_edge_upsert", query(f"SELECT {_EDGE} FROM edges"))
def g01(spark, sf):
    return fresh_graph(spark, sf).edges


@register(
    "G02_customer_changes",
    query(
        "SELECT uid, seq, identity_changed, phone_changed, NOT identity_changed AND NOT phone_changed AS deduplicated "
        "FROM changes"
    ),
)
def g02(spark, sf):
    return G.customer_changes(rows(spark, sf, "customer_log")).select(
        "uid", "seq", "identity_changed", "phone_changed", "deduplicated"
    )


@register("G02_customer_edges", _edge_query("HAS_IDENTITY", "HAS_PHONE"))
def g02_edges(spark, sf):
    return _edges_of(spark, sf, "customer_log")


@register(
    "W01_value_change",
    query("SELECT uid, seq, identity_no, lag(identity_no) OVER (PARTITION BY uid ORDER BY ts, seq) AS prev_identity_no FROM c_customer_log"),
)
def w01(spark, sf):
    seen = G.previous_value(rows(spark, sf, "customer_log"), "uid", "ts", ["seq"], ["identity_no"])
    return seen.select("uid", "seq", "identity_no", "prev_identity_no")


@register(
    "G03_login_edges", _edge_query("LOGIN_WITH_PHONE", "LOGIN_WITH_DEVICE", "LOGIN_WITH_TD_DEVICE", "LOGIN_WITH_IP")
)
def g03(spark, sf):
    return _edges_of(spark, sf, "login")


@register("G04_gps_edges", _edge_query("LOCATED_AT"))
def g04(spark, sf):
    return _edges_of(spark, sf, "lbs_gps")


@register("G05_contact_edges", _edge_query("HAS_CONTACT_PHONE"))
def g05(spark, sf):
    return _edges_of(spark, sf, "first_linkman", "second_linkman", "first_linkman_derived", "second_linkman_derived")


@register(
    "G06_order_edges",
    _edge_query("PLACED_ORDER", "ORDER_APPLY_PHONE", "ORDER_APPLY_IDENTITY", "ORDER_APPLY_CARD", "ORDER_REPAY_CARD"),
)
def g06(spark, sf):
    return _edges_of(spark, sf, "order").filter(F.col("rel") != "CARD_BIND_PHONE")


@register("G06_order_status", query("SELECT order_id AS key, order_status FROM newest_status"))
def g06_status(spark, sf):
    stamped = G.stamped_attributes({"order": rows(spark, sf, "order")})
    return stamped.select("key", F.col("order_status.value").alias("order_status"))


@register("G07_card_phones", _edge_query("CARD_BIND_PHONE"))
def g07(spark, sf):
    return _edges_of(spark, sf, "order").filter(F.col("rel") == "CARD_BIND_PHONE")


@register("G08_logout", query("SELECT node_type, key, n AS logouts FROM logouts"))
def g08(spark, sf):
    touched = G.owner_touches("logout", rows(spark, sf, "logout"))
    counted = rows(spark, sf, "logout").groupBy("uid").agg(F.count(F.lit(1)).alias("n"))
    flagged = touched.filter("logout_flag").join(counted, F.col("key") == F.col("uid"))
    return flagged.select("node_type", "key", F.col("n").alias("logouts")).unionByName(
        touched.filter("logout_count > 0").select("node_type", "key", F.col("logout_count").alias("logouts"))
    )


@register("G10_company_edges", _edge_query("BELONGS_TO_COMPANY"))
def g10(spark, sf):
    return _edges_of(spark, sf, "company_log")


def _case_query(source: str) -> str:
    return query(f"SELECT {_EDGE} FROM edges WHERE src_type = 'complaint_case' AND src_key LIKE '{source}:%'")


@register("G11_complaint_edges", _case_query("complaint"))
def g11(spark, sf):
    return _edges_of(spark, sf, "complaint")


@register("G12_consumer_case_edges", _case_query("consumer"))
def g12(spark, sf):
    return _edges_of(spark, sf, "consumer_protection_case")


@register("G13_blacklist_marks", query("SELECT node_type, key, status, reason_list FROM newest_mark"))
def g13(spark, sf):
    stamped = G.stamped_attributes({"blacklist_log": rows(spark, sf, "blacklist_log")})
    return stamped.select("node_type", "key", "blacklist.status", "blacklist.reason_list")


@register(
    "G14_repay_plans",
    query("SELECT repay_plan_id AS key, due_date, repayed_date, overdue_mark, plan_status FROM plans"),
)
def g14(spark, sf):
    stamped = G.stamped_attributes({"repay_plan": rows(spark, sf, "repay_plan")})
    return stamped.select(
        "key",
        "due_date",
        "repayed_date",
        F.col("overdue_mark.value").alias("overdue_mark"),
        F.col("plan_status.value").alias("plan_status"),
    )


@register("G14_repay_plan_edges", _edge_query("REPAY_PLAN"))
def g14_edges(spark, sf):
    return _edges_of(spark, sf, "repay_plan")


# Orders of the first half of the keys get a new status; unknown orders are ignored.
_UPDATES = "SELECT id, CASE WHEN seq % 2 = 0 THEN 'SETTLED' END AS order_status, create_date, seq FROM fx_order WHERE seq % 3 = 0"


def _status_updates(spark, sf) -> DataFrame:
    """Status rows, a fifth of them without a time, and as many of unknown orders."""
    raw = feed(spark, sf, "order").filter(F.col("seq") % 3 == 0)
    raw = raw.withColumn("order_status", F.when(F.col("seq") % 2 == 0, "SETTLED"))
    raw = raw.withColumn("create_date", F.when(F.col("seq") % 5 != 0, F.col("create_date")))
    strangers = raw.withColumn("id", F.concat(F.lit("missing-"), F.col("id")))
    return backfill_rows("order", raw.unionByName(strangers))


def _listed(spark, sf) -> DataFrame:
    """Blacklist rows, a third of them without a time."""
    raw = feed(spark, sf, "blacklist_log")
    return backfill_rows("blacklist_log", raw.withColumn("d_begin_date", F.when(F.col("seq") % 3 != 0, F.col("d_begin_date"))))


@register(
    "G15_order_status_delta",
    query(f"SELECT n.key, u.order_status FROM nodes n JOIN ({_UPDATES}) u ON u.id = n.key WHERE n.node_type = 'order' AND u.order_status IS NOT NULL"),
)
def g15_delta(spark, sf):
    return G.order_status_delta(graph(spark, sf).nodes, _status_updates(spark, sf)).select("key", "order_status")


@register(
    "G15_order_status_backfill",
    query(
        "SELECT n.key, coalesce(u.order_status, n.order_status) AS order_status FROM nodes n "
        f"LEFT JOIN (SELECT * FROM ({_UPDATES}) WHERE order_status IS NOT NULL) u ON u.id = n.key WHERE n.node_type = 'order'"
    ),
)
def g15(spark, sf):
    patched = G.backfill_order_status(graph(spark, sf).nodes, _status_updates(spark, sf))
    return patched.filter(F.col("node_type") == "order").select("key", "order_status")


_ALL_MARKS = (
    "SELECT DISTINCT node_type, key FROM (SELECT 'uid' AS node_type, lower(c_customer_no) AS key FROM fx_blacklist_log "
    "UNION ALL SELECT 'phone_num', lower(c_mobile_phone) FROM fx_blacklist_log "
    "UNION ALL SELECT 'identity_no', lower(c_identity_no) FROM fx_blacklist_log)"
)


@register(
    "G16_blacklist_delta",
    query(
        f"SELECT n.node_type, n.key, 'BLACKLISTED' AS status FROM nodes n JOIN ({_ALL_MARKS}) m "
        "ON m.node_type = n.node_type AND m.key = n.key"
    ),
)
def g16_delta(spark, sf):
    return G.blacklist_delta(graph(spark, sf).nodes, _listed(spark, sf)).select("node_type", "key", "status")


@register(
    "G16_blacklist_backfill",
    query(
        "SELECT n.node_type, n.key, CASE WHEN m.key IS NOT NULL THEN 'BLACKLISTED' ELSE n.status END AS status, "
        "n.is_blacklisted OR m.key IS NOT NULL AS is_blacklisted FROM nodes n "
        f"LEFT JOIN ({_ALL_MARKS}) m ON m.node_type = n.node_type AND m.key = n.key "
        "WHERE n.node_type IN ('uid', 'phone_num', 'identity_no')"
    ),
)
def g16(spark, sf):
    listed = _listed(spark, sf)
    patched = G.backfill_blacklist(graph(spark, sf).nodes, listed)
    return patched.filter(F.col("node_type").isin(*rules.BLACKLISTABLE_TYPES)).select(
        "node_type", "key", "status", "is_blacklisted"
    )


@register(
    "J13_update_three_types",
    query(
        f"SELECT n.node_type, count(*) AS updated FROM nodes n JOIN ({_ALL_MARKS}) m "
        "ON m.node_type = n.node_type AND m.key = n.key GROUP BY 1"
    ),
)
def j13(spark, sf):
    listed = _listed(spark, sf)
    patched = G.backfill_blacklist(graph(spark, sf).nodes, listed)
    return (
        patched.filter(F.col("status") == "BLACKLISTED").groupBy("node_type").agg(F.count(F.lit(1)).alias("updated"))
    )


@register(
    "G16_stored_backfills",
    query(
        "SELECT n.node_type, n.key, coalesce(u.order_status, n.order_status) AS order_status, "
        "CASE WHEN m.key IS NOT NULL THEN 'BLACKLISTED' ELSE n.status END AS status, n.reason_list, "
        f"n.is_blacklisted OR m.key IS NOT NULL AS is_blacklisted FROM nodes n LEFT JOIN ({_ALL_MARKS}) m "
        f"ON m.node_type = n.node_type AND m.key = n.key LEFT JOIN (SELECT * FROM ({_UPDATES}) WHERE order_status IS NOT NULL) u "
        "ON n.node_type = 'order' AND u.id = n.key"
    ),
)
def g16_stored(spark, sf):
    """Both backfills between two batches of all feeds, then folded: the nodes of one rebuild, backfilled."""
    store = GraphStore(spark, scratch_path(spark, "backfill-store"))
    feeds = {d: rows(spark, sf, d) for d in raw_feeds(spark, sf)}
    number = {d: F.pmod(F.coalesce("seq", F.xxhash64(*r.columns)), F.lit(2)) for d, r in feeds.items()}
    store.append("feeds", 0, {d: r.filter(number[d] == 0) for d, r in feeds.items()})
    for _ in range(2):
        store.backfill("status", 0, "order", _status_updates(spark, sf), "2100-01-01 00:00:00")
        store.backfill("listed", 0, "blacklist_log", _listed(spark, sf), "2100-01-01 00:00:00")
    store.compact()
    store.append("feeds", 1, {d: r.filter(number[d] == 1) for d, r in feeds.items()})
    return store.read().nodes.select("node_type", "key", "order_status", "status", "reason_list", "is_blacklisted")


@register("G17_nodes", query("SELECT * FROM nodes"))
def g17_nodes(spark, sf):
    return fresh_graph(spark, sf).nodes


@register(
    "G17_rebuild_summary",
    query(
        "SELECT 'customer_log' AS dataset, count(*) AS total_rows, count(*) AS written_rows, 0 AS skipped_rows FROM fx_customer_log "
        "UNION ALL SELECT 'login', count(*), count(*), 0 FROM fx_login "
        "UNION ALL SELECT 'lbs_gps', count(*), count(*), 0 FROM fx_lbs_gps "
        "UNION ALL SELECT 'first_linkman', count(*), count(*), 0 FROM fx_linkman "
        "UNION ALL SELECT 'second_linkman', count(*), count(*), 0 FROM fx_second_linkman "
        "UNION ALL SELECT 'first_linkman_derived', count(*), count(*), 0 FROM fx_linkman_derived "
        "UNION ALL SELECT 'second_linkman_derived', count(*), count(*), 0 FROM fx_second_linkman_derived "
        "UNION ALL SELECT 'logout', count(*), count(*), 0 FROM fx_logout "
        "UNION ALL SELECT 'order', count(*), count(*), 0 FROM fx_order "
        "UNION ALL SELECT 'repay_plan', count(*), count(*), 0 FROM fx_repay_plan "
        "UNION ALL SELECT 'company_log', count(*), count(*), 0 FROM fx_company_log "
        "UNION ALL SELECT 'complaint', count(*), count(*), 0 FROM fx_cases WHERE source = 'complaint' "
        "UNION ALL SELECT 'consumer_protection_case', count(*), count(*), 0 FROM fx_cases WHERE source = 'consumer' "
        f"UNION ALL SELECT 'blacklist_log', count(*), count(*) FILTER (WHERE d_begin_date < {CUT}), "
        f"count(*) FILTER (WHERE d_begin_date >= {CUT}) FROM fx_blacklist_log"
    ),
)
def g17_summary(spark, sf):
    return jobs.rebuild(raw_feeds(spark, sf))[1]


def _stored(spark, sf, compact: bool):
    """The graph stored in four batches, the first delivered twice."""
    store = GraphStore(spark, scratch_path(spark, "store"))
    groups = (
        ("customer_log", "login", "lbs_gps", "logout"),
        ("order", "repay_plan", "company_log"),
        ("first_linkman", "second_linkman", "complaint", "consumer_protection_case", "blacklist_log"),
        ("first_linkman_derived", "second_linkman_derived"),
    )
    for batch, names in enumerate(groups):
        store.append("feeds", batch, {d: rows(spark, sf, d) for d in names})
        if batch == 0:
            store.append("feeds", batch, {d: rows(spark, sf, d) for d in names})
        if compact and batch == 1:
            store.compact()
    return store.read()


@register("G18_increments_edges", query(f"SELECT {_EDGE} FROM edges"))
def g18(spark, sf):
    return _stored(spark, sf, compact=True).edges


@register("S10_graph_store", query("SELECT * FROM nodes"))
def s10(spark, sf):
    return _stored(spark, sf, compact=False).nodes


@register(
    "G19_graph_summary",
    query(
        "SELECT (SELECT count(*) FROM nodes) AS node_count, (SELECT count(*) FROM edges) AS edge_count, "
        "(SELECT string_agg(DISTINCT node_type, ',' ORDER BY node_type) FROM nodes) AS labels, "
        "(SELECT string_agg(DISTINCT rel, ',' ORDER BY rel) FROM edges) AS relations"
    ),
)
def g19(spark, sf):
    out = G.graph_summary(graph(spark, sf))
    return out.withColumns({c: F.array_join(c, ",") for c in ("labels", "relations")})


_LEGACY = " UNION ".join(
    f"SELECT lower(trim({uid})) AS uid, '{rel}' AS rel, '{t}' AS dst_type, lower(trim({c})) AS dst_key, {ts} AS event_time "
    f"FROM {src} WHERE {c} IS NOT NULL"
    for src, uid, ts, rel, t, c in (
        ("fx_customer_log", "baseid", "log_create_date", "modify_phone_num", "phone_num", "mobile_phone"),
        ("fx_customer_log", "baseid", "log_create_date", "modify_identity_no", "identity_no", "identity_no"),
        ("fx_lbs_gps", "cid", "create_date", "gps_geo_code", "geo_code", "geo_code"),
        ("fx_linkman", "cid", "create_date", "linkman_phone_num", "phone_num", "mobile_phone"),
        ("fx_second_linkman", "cid", "create_date", "linkman_phone_num", "phone_num", "second_mobile_phone"),
        ("fx_linkman_derived", "cid", "create_date", "linkman_phone_num", "phone_num", "mobile_phone"),
        ("fx_second_linkman_derived", "cid", "create_date", "linkman_phone_num", "phone_num", "second_mobile_phone"),
        ("fx_login", "cif_user_id", "login_time", "login_phone_num", "phone_num", "phone_num"),
        ("fx_login", "cif_user_id", "login_time", "login_device_no", "device_no", "device_no"),
        ("fx_login", "cif_user_id", "login_time", "login_td_device_id", "td_device_id", "td_device_id"),
        ("fx_login", "cif_user_id", "login_time", "login_remote_ip", "remote_ip", "remote_ip"),
    )
)


@register("G20_event_multigraph", query(_LEGACY))
def g20(spark, sf):
    return legacy.event_edges(raw_feeds(spark, sf))


_LEGACY_ORDERS = " UNION ALL ".join(
    f"SELECT lower(user_id) AS uid, '{rel}' AS rel, '{t}' AS dst_type, lower({c}) AS dst_key, id AS order_id, order_status "
    f"FROM fx_order WHERE {c} IS NOT NULL"
    for rel, t, c in (
        ("order_apply_phone_num", "phone_num", "apply_loan_tel"),
        ("order_apply_identity_no", "identity_no", "apply_ident_no"),
        ("order_apply_card_no", "card_no", "apply_card_no"),
        ("order_apply_card_phone_num", "phone_num", "apply_bank_mobile"),
        ("order_repay_card_no", "card_no", "repay_card_no"),
        ("order_repay_card_phone_num", "phone_num", "repay_bank_mobile"),
    )
)


@register("G20_order_multigraph", query(_LEGACY_ORDERS))
def g20_orders(spark, sf):
    return legacy.order_edges(feed(spark, sf, "order")).select(
        "uid", "rel", "dst_type", "dst_key", "order_id", "order_status"
    )


_LEGACY_NODES = (
    f"SELECT DISTINCT dst_type AS node_type, dst_key AS key FROM ({_LEGACY_ORDERS}) "
    f"UNION SELECT DISTINCT 'uid', uid FROM ({_LEGACY_ORDERS})"
)


@register(
    "G21_legacy_marking",
    query(
        "SELECT m.node_type, sum(m.n) AS updates, count(*) AS nodes_marked FROM (SELECT node_type, key, count(*) AS n FROM "
        "(SELECT 'uid' AS node_type, lower(c_customer_no) AS key FROM fx_blacklist_log WHERE c_reason_list IS NOT NULL "
        "UNION ALL SELECT 'phone_num', c_mobile_phone FROM fx_blacklist_log WHERE c_reason_list IS NOT NULL "
        "UNION ALL SELECT 'identity_no', c_identity_no FROM fx_blacklist_log WHERE c_reason_list IS NOT NULL) "
        f"GROUP BY 1, 2) m JOIN ({_LEGACY_NODES}) n ON n.node_type = m.node_type AND n.key = m.key GROUP BY 1"
    ),
)
def g21(spark, sf):
    feeds = raw_feeds(spark, sf)
    edges = legacy.order_edges(feeds["order"])
    nodes = (
        edges.select(F.col("dst_type").alias("node_type"), F.col("dst_key").alias("key"))
        .unionByName(edges.select(F.lit("uid").alias("node_type"), F.col("uid").alias("key")))
        .distinct()
    )
    listed = feeds["blacklist_log"].withColumn("c_customer_no", F.lower("c_customer_no"))
    return legacy.count_updates(nodes, listed)


# -- neighbourhood joins ------------------------------------------------------


@register("J09_neighbours", query("SELECT node_type, key, n_type, n_key, rel, last_seen_ts AS last_seen FROM sides"))
def j09(spark, sf):
    return neighbour_edges(graph(spark, sf).edges)


@register("J10_near_overdue", query("SELECT node_type, key FROM near_overdue"))
def j10(spark, sf):
    return near_overdue_order(graph(spark, sf))


@register(
    "J11_windowed_links",
    query(
        "SELECT e.src_key AS uid, e.dst_type AS node_type, e.dst_key AS key, "
        "CASE e.rel WHEN 'LOGIN_WITH_IP' THEN 'ip' ELSE 'geo' END AS bucket FROM edges e "
        "JOIN nodes n ON n.node_type = e.dst_type AND n.key = e.dst_key WHERE e.rel IN ('LOGIN_WITH_IP', 'LOCATED_AT') "
        "AND e.last_seen_ts BETWEEN n.updated_at - CASE e.rel WHEN 'LOGIN_WITH_IP' THEN INTERVAL 7 DAYS "
        "ELSE INTERVAL 30 DAYS END AND n.updated_at"
    ),
)
def j11(spark, sf):
    return asc.windowed_links(graph(spark, sf))


# -- associations -------------------------------------------------------------


@register("A06_direct_links", query("SELECT node_type, key, uid, latest_ts FROM links"))
def a06(spark, sf):
    return asc.direct_links(graph(spark, sf).edges)


@register(
    "A06_association_maps",
    query(
        "SELECT l.node_type, l.key, l.uid, l.latest_ts, a.associated_uid_count FROM links l "
        "JOIN assoc a ON a.node_type = l.node_type AND a.key = l.key"
    ),
)
def a06_maps(spark, sf):
    return asc.association_entries(graph(spark, sf).edges)


@register("A06_association_counts", query("SELECT node_type, key, associated_uid_count FROM assoc"))
def a06_counts(spark, sf):
    return asc.association_counts(graph(spark, sf).edges)


@register(
    "A07_association_statistics",
    query(
        "SELECT node_type, count(*) AS total_nodes, round(avg(associated_uid_count), 6) AS avg_uid_count, "
        "max(associated_uid_count) AS max_uid_count, min(associated_uid_count) AS min_uid_count FROM assoc GROUP BY 1"
    ),
)
def a07(spark, sf):
    out = asc.association_statistics(asc.association_counts(graph(spark, sf).edges))
    return out.withColumn("avg_uid_count", F.round("avg_uid_count", 6))


@register(
    "A08_association_histogram",
    query(
        "SELECT node_type, uid_count, node_count FROM (SELECT node_type, associated_uid_count AS uid_count, "
        "count(*) AS node_count FROM assoc GROUP BY 1, 2) "
        "QUALIFY row_number() OVER (PARTITION BY node_type ORDER BY uid_count) <= 5"
    ),
)
def a08(spark, sf):
    return asc.association_histogram(asc.association_counts(graph(spark, sf).edges))


@register(
    "T04_most_shared_phones",
    query(
        "SELECT key, associated_uid_count FROM assoc WHERE node_type = 'phone_num' "
        "ORDER BY associated_uid_count DESC, key LIMIT 3"
    ),
)
def t04(spark, sf):
    counts = asc.association_counts(graph(spark, sf).edges).filter(F.col("node_type") == "phone_num")
    return counts.orderBy(F.desc("associated_uid_count"), "key").limit(3).select("key", "associated_uid_count")


@register(
    "R14_nodes_of_uid",
    query(
        "SELECT l.node_type, l.key, l.uid, l.latest_ts, a.associated_uid_count FROM links l "
        "JOIN assoc a ON a.node_type = l.node_type AND a.key = l.key "
        "WHERE l.uid = (SELECT min(uid) FROM c_login)"
    ),
)
def r14(spark, sf):
    first = rows(spark, sf, "login").agg(F.min("uid").alias("u")).scalar()
    return asc.nodes_of_uid(graph(spark, sf).edges, first)


@register(
    "A05_bucket_counts",
    query("SELECT node_type, key, bucket, uid_count FROM bucket_counts"),
)
def a05(spark, sf):
    return asc.bucket_counts(graph(spark, sf))


@register("U05_union_of_paths", query("SELECT bucket, node_type, key, uid FROM bucket_links"))
def u05(spark, sf):
    return asc.bucket_links(graph(spark, sf))
