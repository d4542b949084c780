"""Joins, set operations, rankings and distributions over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave import rules
from riskweave.catalog import register
from riskweave.catalog.cleaning import _CENTS, _CLASS, _risk_lines
from riskweave.catalog.context import feed, graph, rows
from riskweave.catalog.sql import query, quoted
from riskweave.fixtures import derived_linkman, raw_feeds, table
from riskweave.operators import relational as rel
from riskweave.operators.graph import union_all
from riskweave.plans import jobs

_DERIVED = (
    "SELECT cid, CASE WHEN seq % 4 = 0 THEN mobile_phone ELSE mobile_phone || 'x' END AS mobile_phone, seq FROM fx_linkman"
)


@register(
    "J02_found_in_base",
    query(
        f"SELECT d.cid, d.mobile_phone, d.seq, b.cid IS NOT NULL AS found FROM ({_DERIVED}) d "
        "LEFT JOIN (SELECT DISTINCT cid, mobile_phone FROM fx_linkman) b "
        "ON b.cid = d.cid AND b.mobile_phone = d.mobile_phone"
    ),
)
def j02(spark, sf):
    feeds = raw_feeds(spark, sf)
    derived = derived_linkman(feeds).select("cid", "mobile_phone", "seq")
    return rel.with_found_flag(derived, feeds["first_linkman"], ["cid", "mobile_phone"])


@register(
    "J02_containment",
    query(
        "SELECT count(*) AS total, count(b.cid) AS found, count(*) - count(b.cid) AS not_found, "
        "round(count(b.cid) * 1.0 / count(*), 9) AS found_ratio, "
        "round((count(*) - count(b.cid)) * 1.0 / count(*), 9) AS not_found_ratio "
        f"FROM ({_DERIVED}) d LEFT JOIN (SELECT DISTINCT cid, mobile_phone FROM fx_linkman) b "
        "ON b.cid = d.cid AND b.mobile_phone = d.mobile_phone"
    ),
)
def j02_containment(spark, sf):
    feeds = raw_feeds(spark, sf)
    out = rel.containment(derived_linkman(feeds), feeds["first_linkman"], ["cid", "mobile_phone"])
    return out.withColumns({c: F.round(c, 9) for c in ("found_ratio", "not_found_ratio")})


@register(
    "J03_missing_ids",
    query("SELECT DISTINCT cid AS uid FROM fx_company_log WHERE cid NOT IN (SELECT baseid FROM fx_customer_log)"),
)
def j03(spark, sf):
    base = rel.distinct_key(feed(spark, sf, "company_log"), "cid")
    return rel.missing_keys(base, rel.distinct_key(feed(spark, sf, "customer_log"), "baseid"))


@register(
    "A18_completeness",
    query(
        "SELECT (SELECT count(DISTINCT cid) FROM fx_company_log) AS base_ids, "
        "(SELECT count(DISTINCT baseid) FROM fx_customer_log) AS log_ids, "
        "(SELECT count(DISTINCT cid) FROM fx_company_log WHERE cid NOT IN (SELECT baseid FROM fx_customer_log)) AS missing_ids"
    ),
)
def a18(spark, sf):
    base = rel.distinct_key(feed(spark, sf, "company_log"), "cid")
    return rel.completeness(base, rel.distinct_key(feed(spark, sf, "customer_log"), "baseid"))


def _uid_risks(spark, sf):
    """uid and risk text, one line per customer."""
    return rel.parse_risk_lines(_risk_lines(spark, sf), ["device_no", "uid", "risk"])


@register(
    "J04_risks_in_list",
    query(
        "SELECT 'U' || CAST(c_custkey AS VARCHAR) AS uid, "
        f"CASE WHEN c_custkey % 13 = 0 THEN 'NA' ELSE {_CENTS} END AS risk FROM customer "
        "WHERE 'U' || CAST(c_custkey AS VARCHAR) IN (SELECT c_customer_no FROM fx_blacklist_log)"
    ),
)
def j04(spark, sf):
    listed = rel.distinct_key(feed(spark, sf, "blacklist_log"), "c_customer_no")
    return rel.in_list(_uid_risks(spark, sf).select("uid", "risk"), listed)


@register(
    "J05_without_device",
    query(
        "SELECT DISTINCT src_key AS uid FROM edges WHERE src_type = 'uid' AND src_key NOT IN "
        "(SELECT src_key FROM edges WHERE rel = 'LOGIN_WITH_DEVICE' AND dst_key = 'd1')"
    ),
)
def j05(spark, sf):
    edges = graph(spark, sf).edges
    uids = edges.filter(F.col("src_type") == "uid").select(F.col("src_key").alias("uid")).distinct()
    return rel.without_device(uids, edges, "d1")


_CHANNELS = (
    "SELECT device_no, channel FROM (SELECT lower(trim(device_no)) AS device_no, app_channel AS channel, seq FROM fx_login) "
    "WHERE device_no <> '' QUALIFY row_number() OVER (PARTITION BY device_no ORDER BY seq) = 1"
)


@register("A04_first_channel", query(_CHANNELS))
def a04(spark, sf):
    return rel.device_channels(feed(spark, sf, "login"), "device_no", "app_channel")


@register("W03_first_value", query(_CHANNELS))
def w03(spark, sf):
    return rel.device_channels(feed(spark, sf, "login"), "device_no", "app_channel")


@register(
    "J06_channel_lookup",
    query(
        "SELECT d.device_no, coalesce(c.channel, 'UNKNOWN') AS channel FROM "
        "(SELECT DISTINCT 'd' || CAST(k AS VARCHAR) AS device_no FROM fx_ev) d "
        f"LEFT JOIN (SELECT * FROM ({_CHANNELS}) WHERE channel = 'APP') c USING (device_no)"
    ),
)
def j06(spark, sf):
    k = F.regexp_extract("props", "([0-9]+)", 1)
    devices = table(spark, sf, "events").select(F.concat(F.lit("d"), k).alias("device_no")).distinct()
    channels = rel.device_channels(feed(spark, sf, "login"), "device_no", "app_channel")
    return rel.with_channel(devices, channels.filter(F.col("channel") == "APP"))


@register(
    "J07_all_devices",
    query(
        "SELECT n.key AS device_no, coalesce(d.uid_count, 0) AS uid_count FROM nodes n "
        "LEFT JOIN device_users d ON d.device_no = n.key WHERE n.node_type = 'device_no'"
    ),
)
def j07(spark, sf):
    g = graph(spark, sf)
    return rel.all_devices_with_counts(g.nodes, g.edges)


@register(
    "J08_device_uids",
    query(
        "SELECT DISTINCT dst_key AS device_no, src_key AS uid FROM edges WHERE src_type = 'uid' AND dst_type = 'device_no'"
    ),
)
def j08(spark, sf):
    return rel.device_links(graph(spark, sf).edges)


@register("A01_device_user_counts", query("SELECT device_no, uid_count FROM device_users"))
def a01(spark, sf):
    return rel.device_user_counts(graph(spark, sf).edges)


@register(
    "A01_login_device_users",
    query(
        "SELECT device_no, count(DISTINCT uid) AS uid_count FROM c_login WHERE device_no IS NOT NULL GROUP BY 1"
    ),
)
def login_device_users(spark, sf):
    """Distinct users of every device straight from the login feed."""
    pairs = rows(spark, sf, "login").filter(F.col("device_no").isNotNull()).select("device_no", "uid").distinct()
    return pairs.groupBy("device_no").agg(F.count(F.lit(1)).alias("uid_count"))


@register(
    "A02_max_per_key",
    "SELECT 'U' || CAST(o_custkey AS VARCHAR) AS uid, max(floor(o_totalprice)) AS risk FROM orders GROUP BY 1",
)
def a02(spark, sf):
    lines = table(spark, sf, "orders").select(
        F.concat(F.lit("U"), F.col("o_custkey").cast("string")).alias("uid"),
        F.floor("o_totalprice").cast("string").alias("risk"),
    )
    return rel.best_risk_per_uid(lines)


_SUMMARY = (
    "SELECT 'd' || CAST(c_custkey % 50 AS VARCHAR) AS device_no, max(floor(c_acctbal * 100)) AS max_risk, "
    "min(floor(c_acctbal * 100)) AS min_risk, round(avg(floor(c_acctbal * 100)), 4) AS avg_risk "
    "FROM customer WHERE c_custkey % 13 <> 0 GROUP BY 1"
)


def _summary(spark, sf):
    out = rel.device_risk_summary(rel.parse_risk_lines(_risk_lines(spark, sf), ["device_no", "uid", "risk"]))
    return out.withColumn("avg_risk", F.round("avg_risk", 4))


@register("A03_device_risk_summary", _SUMMARY)
def a03(spark, sf):
    return _summary(spark, sf)


@register("W05_group_fold", _SUMMARY)
def w05(spark, sf):
    return _summary(spark, sf)


@register(
    "A09_status_distribution",
    query(
        "WITH t AS (SELECT count(*) AS n FROM fx_order) "
        f"SELECT {_CLASS} AS category, order_status, count(*) AS orders, 'status' AS level, "
        "round(count(*) * 1.0 / (SELECT n FROM t), 9) AS share FROM fx_order GROUP BY 1, 2 UNION ALL "
        f"SELECT {_CLASS}, NULL, count(*), 'category', round(count(*) * 1.0 / (SELECT n FROM t), 9) FROM fx_order GROUP BY 1"
    ).replace(") WITH t AS (", "), t AS ("),
)
def a09(spark, sf):
    return rel.status_distribution(feed(spark, sf, "order")).withColumn("share", F.round("share", 9))


@register(
    "W06_share_of_total",
    query(
        "SELECT event_type AS category, count(*) AS n, round(count(*) * 1.0 / sum(count(*)) OVER (), 9) AS share "
        "FROM fx_ev GROUP BY 1"
    ),
)
def w06(spark, sf):
    counts = table(spark, sf, "events").groupBy(F.col("event_type").alias("category")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("t")).scalar()
    return counts.withColumn("share", F.round(F.col("n") / total, 9))


@register(
    "W02_latest_per_key",
    query("SELECT key AS uid, status, reason_list FROM newest_mark WHERE node_type = 'uid'"),
)
def w02(spark, sf):
    newest = rows(spark, sf, "blacklist_log").groupBy("uid").agg(
        F.max_by(F.struct("status", "reason_list"), F.struct("ts", "seq")).alias("v")
    )
    return newest.filter(F.col("uid").isNotNull()).select("uid", "v.status", "v.reason_list")


@register(
    "T01_top_devices",
    query(f"SELECT device_no, uid_count FROM device_users ORDER BY uid_count DESC, device_no LIMIT {rules.TOP_DEVICES}"),
)
def t01(spark, sf):
    return rel.top_devices(rel.device_user_counts(graph(spark, sf).edges))


@register(
    "T02_top_risks",
    "SELECT uid, max(risk) AS risk FROM (SELECT 'U' || CAST(o_custkey AS VARCHAR) AS uid, floor(o_totalprice) AS risk "
    "FROM orders) GROUP BY 1 "
    f"ORDER BY 2 DESC, 1 LIMIT {rules.TOP_RISKS}",
)
def t02(spark, sf):
    o = table(spark, sf, "orders")
    uid = F.concat(F.lit("U"), F.col("o_custkey").cast("string"))
    lines = o.select("o_orderkey", F.concat_ws("\t", uid, F.floor("o_totalprice").cast("string")).alias("value"))
    return rel.top_risks(lines, ["o_orderkey"])


@register(
    "T03_time_order",
    query("SELECT seq, strftime(login_time, '%Y-%m-%d') AS dt, login_time AS ts FROM fx_login"),
)
def t03(spark, sf):
    login = rows(spark, sf, "login").select("seq", F.date_format("ts", "yyyy-MM-dd").alias("dt"), "ts")
    return login.repartitionByRange("dt", "ts").sortWithinPartitions("dt", "ts")


@register(
    "T05_sorted_ids",
    query(f"SELECT DISTINCT user_id AS uid FROM fx_order WHERE order_status IN ({quoted(rules.ABNORMAL_STATUSES)})"),
)
def t05(spark, sf):
    return rel.users_with_status(feed(spark, sf, "order"), rules.ABNORMAL_STATUSES).orderBy("uid")


@register(
    "U01_union_of_feeds",
    query(
        "SELECT cid, mobile_phone, create_date, seq FROM fx_linkman UNION ALL "
        "SELECT cid, second_mobile_phone, create_date, seq FROM fx_second_linkman"
    ),
)
def u01(spark, sf):
    feeds = raw_feeds(spark, sf)
    second = feeds["second_linkman"].withColumnRenamed("second_mobile_phone", "mobile_phone")
    return union_all([feeds["first_linkman"], second])


_NORMAL = f"SELECT user_id AS uid FROM fx_order WHERE order_status IN ({quoted(rules.NORMAL_STATUSES)})"
_LISTED = "SELECT c_customer_no AS uid FROM fx_blacklist_log"


def _normal_and_listed(spark, sf):
    feeds = raw_feeds(spark, sf)
    return (
        rel.users_with_status(feeds["order"], rules.NORMAL_STATUSES),
        rel.distinct_key(feeds["blacklist_log"], "c_customer_no"),
    )


@register("U02_intersection", query(f"SELECT * FROM ({_NORMAL}) INTERSECT SELECT * FROM ({_LISTED})"))
def u02(spark, sf):
    normal, listed = _normal_and_listed(spark, sf)
    return normal.intersect(listed)


@register("U03_difference", query(f"SELECT * FROM ({_NORMAL}) EXCEPT SELECT * FROM ({_LISTED})"))
def u03(spark, sf):
    normal, listed = _normal_and_listed(spark, sf)
    return normal.subtract(listed)


@register(
    "U03_overlap_ratios",
    query(
        f"SELECT count(DISTINCT a.uid) AS first_ids, (SELECT count(DISTINCT uid) FROM ({_LISTED})) AS second_ids, "
        "count(DISTINCT b.uid) AS overlap_ids, round(count(DISTINCT b.uid) * 1.0 / count(DISTINCT a.uid), 9) AS share_of_first, "
        f"round(count(DISTINCT b.uid) * 1.0 / (SELECT count(DISTINCT uid) FROM ({_LISTED})), 9) AS share_of_second "
        f"FROM ({_NORMAL}) a LEFT JOIN (SELECT DISTINCT uid FROM ({_LISTED})) b USING (uid)"
    ),
)
def u03_ratios(spark, sf):
    out = rel.overlap(*_normal_and_listed(spark, sf))
    return out.withColumns({c: F.round(c, 9) for c in ("share_of_first", "share_of_second")})


@register(
    "U04_newly_listed",
    query(f"SELECT DISTINCT uid FROM ({_LISTED}) WHERE uid NOT IN ({_NORMAL})"),
)
def u04(spark, sf):
    normal, listed = _normal_and_listed(spark, sf)
    return jobs.newly_listed(listed, normal).orderBy("uid")


@register(
    "U06_unclassified_statuses",
    "SELECT DISTINCT o_orderpriority AS order_status FROM orders "
    f"WHERE o_orderpriority NOT IN ({quoted((*rules.NORMAL_STATUSES, *rules.ABNORMAL_STATUSES, *rules.EXCLUDED_STATUSES))})",
)
def u06(spark, sf):
    return rel.unclassified_statuses(
        table(spark, sf, "orders").select(F.col("o_orderpriority").alias("order_status"))
    )


@register(
    "R13_training_cohorts",
    query(
        "SELECT uid, CASE WHEN bool_or(a) AND bool_or(b) THEN 'overlap' WHEN bool_or(b) THEN 'blacklist' ELSE 'normal' END "
        f"AS cohort FROM (SELECT uid, true AS a, false AS b FROM ({_NORMAL}) UNION ALL "
        f"SELECT uid, false, true FROM ({_LISTED})) GROUP BY 1"
    ),
)
def r13(spark, sf):
    feeds = raw_feeds(spark, sf)
    return rel.training_cohorts(feeds["order"], feeds["blacklist_log"])
