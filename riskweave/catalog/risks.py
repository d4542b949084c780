"""Risk scores, anomaly neighbourhoods and evaluation over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave import rules
from riskweave.catalog import register
from riskweave.catalog.context import feed, graph
from riskweave.catalog.sql import query, quoted
from riskweave.fixtures import raw_feeds
from riskweave.operators import association as asc
from riskweave.operators import evaluate
from riskweave.operators import neighbourhood as nb
from riskweave.operators import relational as rel
from riskweave.operators import risk as R
from riskweave.plans import jobs
from riskweave.session import cut_lineage, scratch_path
from riskweave.sources.sinks import write_report

# A hub size that small inputs reach too.
HUB_DEGREE = 300


@register(
    "R01_base_risk",
    query(
        "SELECT node_type, key, status_risk, round(association_risk, 6) AS association_risk, "
        "round(status_risk + association_risk, 6) AS base_risk FROM base"
    ),
)
def r01(spark: SparkSession, sf: str) -> DataFrame:
    out = R.base_risk(graph(spark, sf)).drop("updated_at")
    return out.withColumns({c: F.round(c, 6) for c in ("association_risk", "base_risk")})


@register(
    "R02_association_risk",
    query("SELECT node_type, key, round(association_risk, 6) AS association_risk FROM assoc_risk"),
)
def r02(spark, sf):
    return asc.association_scores(graph(spark, sf)).withColumn("association_risk", F.round("association_risk", 6))


@register(
    "R02_direct_paths_only",
    query(
        "SELECT node_type, key, round(CASE WHEN has_main OR node_type <> 'phone_num' THEN score ELSE 0 END, 6) AS association_risk "
        "FROM (SELECT node_type, key, bool_or(bucket = 'phone_main') AS has_main, "
        "sum((n - 1) * CASE bucket WHEN 'phone_main' THEN 1.0 WHEN 'phone_contact' THEN 0.5 WHEN 'identity' THEN 1.5 "
        "WHEN 'device' THEN 1.2 WHEN 'td_device' THEN 2.0 WHEN 'ip' THEN 0.3 ELSE 0.1 END :: DOUBLE) AS score FROM "
        "(SELECT bucket, node_type, key, count(DISTINCT uid) AS n FROM (SELECT b.* FROM bucket_links b "
        "JOIN edges e ON e.src_type = 'uid' AND e.src_key = b.uid AND e.dst_type = b.node_type AND e.dst_key = b.key) "
        "GROUP BY 1, 2, 3) GROUP BY 1, 2)"
    ).replace(
        "JOIN edges e ON e.src_type = 'uid'",
        "JOIN edges e ON (b.bucket <> 'phone_main' OR e.rel IN ('LOGIN_WITH_PHONE', 'HAS_PHONE')) AND e.src_type = 'uid'",
    ),
)
def r02_direct(spark, sf):
    out = asc.association_scores(graph(spark, sf), via_orders=False)
    return out.withColumn("association_risk", F.round("association_risk", 6))


@register(
    "R03_edge_weights",
    query("SELECT node_type, key, n_type, n_key, rel, round(weight, 9) AS weight FROM weights"),
)
def r03(spark, sf):
    out = R.weighted_edges(graph(spark, sf))
    return out.select("node_type", "key", "n_type", "n_key", "rel", F.round("weight", 9).alias("weight"))


_RISKS: dict[tuple[str, str], str] = {}


def risks(spark, sf) -> DataFrame:
    """Two-hop risk of every node, written once per application and input."""
    known = (spark.sparkContext.applicationId, sf)
    if known not in _RISKS:
        path = scratch_path(spark, "risks")
        R.k_hop_risk(graph(spark, sf), 2).write.parquet(path)
        _RISKS[known] = path
    return spark.read.parquet(_RISKS[known])


@register("R04_k_hop_risk", query("SELECT node_type, key, round(risk, 4) AS risk FROM r2"))
def r04(spark, sf):
    return risks(spark, sf).withColumn("risk", F.round("risk", 4))


@register("R04_one_hop_risk", query("SELECT node_type, key, round(risk, 4) AS risk FROM r1"))
def r04_one(spark, sf):
    return R.k_hop_risk(graph(spark, sf), 1).withColumn("risk", F.round("risk", 4))


def _order_uids(spark, sf) -> DataFrame:
    """Users of overdue orders, and as many names the graph does not hold."""
    late = rel.users_with_status(feed(spark, sf, "order"), rules.ABNORMAL_STATUSES).select(F.lower("uid").alias("uid"))
    return late.unionByName(late.select(F.concat(F.lit("ghost-"), F.col("uid")).alias("uid")))


@register(
    "R05_batch_risk",
    query(
        "SELECT t.uid, round(coalesce(r.risk, 0), 4) AS risk FROM (SELECT DISTINCT lower(user_id) AS uid FROM fx_order "
        "WHERE order_status = 'OVERDUE' UNION ALL SELECT DISTINCT 'ghost-' || lower(user_id) FROM fx_order "
        "WHERE order_status = 'OVERDUE') t LEFT JOIN r2 r ON r.node_type = 'uid' AND r.key = t.uid"
    ),
)
def r05(spark, sf):
    out = jobs.risk_of_uids(graph(spark, sf), _order_uids(spark, sf))
    return out.withColumn("risk", F.round("risk", 4))


_DEVICE_RISKS = (
    "SELECT DISTINCT e.dst_key AS device_no, e.src_key AS uid, r.risk FROM edges e "
    f"JOIN (SELECT * FROM device_users ORDER BY uid_count DESC, device_no LIMIT {rules.TOP_DEVICES}) t "
    "ON t.device_no = e.dst_key JOIN r2 r ON r.node_type = 'uid' AND r.key = e.src_key "
    "WHERE e.src_type = 'uid' AND e.dst_type = 'device_no'"
)


@register("R06_device_uid_risks", query(f"SELECT device_no, uid, round(risk, 4) AS risk FROM ({_DEVICE_RISKS})"))
def r06(spark, sf):
    return jobs.device_uid_risks(graph(spark, sf), risks=risks(spark, sf)).withColumn("risk", F.round("risk", 4))


@register(
    "R07_device_report",
    query(
        "SELECT device_no, coalesce(c.channel, 'UNKNOWN') AS channel, round(max(risk), 4) AS max_risk, "
        f"round(min(risk), 4) AS min_risk, round(avg(risk), 4) AS avg_risk FROM ({_DEVICE_RISKS}) "
        "LEFT JOIN (SELECT device_no, channel FROM (SELECT lower(trim(device_no)) AS device_no, app_channel AS channel, seq "
        "FROM fx_login) QUALIFY row_number() OVER (PARTITION BY device_no ORDER BY seq) = 1) c USING (device_no) GROUP BY 1, 2"
    ),
)
def r07(spark, sf):
    channels = rel.device_channels(feed(spark, sf, "login"), "device_no", "app_channel")
    out = jobs.device_report(jobs.device_uid_risks(graph(spark, sf), risks=risks(spark, sf)), channels)
    return out.withColumns({c: F.round(c, 4) for c in ("max_risk", "min_risk", "avg_risk")})


@register(
    "R08_forecast_hits",
    query(
        f"SELECT uid, round(risk, 4) AS risk FROM (SELECT key AS uid, risk FROM r2 WHERE node_type = 'uid' "
        f"ORDER BY risk DESC, key LIMIT {rules.TOP_RISKS}) WHERE uid IN (SELECT lower(c_customer_no) FROM fx_blacklist_log) "
        "AND uid NOT IN (SELECT uid FROM c_blacklist_log) "
        "AND uid NOT IN (SELECT src_key FROM edges WHERE rel = 'LOGIN_WITH_DEVICE' AND dst_key = 'd1')"
    ),
)
def r08(spark, sf):
    g = graph(spark, sf)
    listed = rel.distinct_key(feed(spark, sf, "blacklist_log"), "c_customer_no").select(F.lower("uid").alias("uid"))
    known = g.nodes.filter((F.col("node_type") == "uid") & F.col("is_blacklisted")).select(F.col("key").alias("uid"))
    scored = risks(spark, sf).filter(F.col("node_type") == "uid").select(F.col("key").alias("uid"), "risk")
    hits = jobs.forecast_hits(scored, jobs.newly_listed(listed, known), g.edges, "d1")
    return hits.withColumn("risk", F.round("risk", 4))


# -- anomaly neighbourhoods ---------------------------------------------------

_COUNTS: dict[tuple[str, str], str] = {}


def members(spark, sf) -> DataFrame:
    """Blacklisted users against users who repaid."""
    feeds = raw_feeds(spark, sf)
    cohorts = rel.training_cohorts(feeds["order"], feeds["blacklist_log"])
    grp = F.when(F.col("cohort") == "normal", "normal").otherwise("blacklist")
    return cohorts.select(F.lower("uid").alias("uid"), grp.alias("grp"))


def counts(spark, sf) -> DataFrame:
    """Anomaly counts of all members, written once per application and input."""
    known = (spark.sparkContext.applicationId, sf)
    if known not in _COUNTS:
        g = graph(spark, sf)
        anomalies = cut_lineage(nb.classify(g))
        found = nb.reach(g, members(spark, sf), anomalies, 3, HUB_DEGREE)
        path = scratch_path(spark, "anomaly-counts")
        nb.anomaly_counts(found, anomalies).write.parquet(path)
        _COUNTS[known] = path
    return spark.read.parquet(_COUNTS[known])


@register(
    "J12_shortest_hops",
    query("SELECT substr(s, 5) AS uid, hop, count(*) AS nodes FROM dist d JOIN (SELECT DISTINCT node_type || '|' || key AS v "
          f"FROM nodes WHERE node_type IN ({quoted(rules.ANOMALY_NODE_TYPES)})) n USING (v) GROUP BY 1, 2"),
)
def j12(spark, sf):
    g = graph(spark, sf)
    ends = g.nodes.filter(F.col("node_type").isin(*rules.ANOMALY_NODE_TYPES)).select(
        nb.node_id("node_type", "key").alias("node"),
        F.lit("any").alias("kind"),
        F.col("node_type").alias("label"),
        F.lit(0).cast("long").alias("assoc"),
    )
    found = nb.reach(g, members(spark, sf), ends, 3, HUB_DEGREE)
    return nb.anomaly_counts(found, ends).groupBy("uid", "hop").agg(F.sum("n").alias("nodes"))


@register("R09_anomaly_nodes", query("SELECT uid, hop, kind, label, key, assoc FROM found WHERE uid IN "
                                     "(SELECT lower(c_customer_no) FROM fx_blacklist_log)"))
def r09(spark, sf):
    g = graph(spark, sf)
    listed = rel.distinct_key(feed(spark, sf, "blacklist_log"), "c_customer_no").select(F.lower("uid").alias("uid"))
    anomalies = cut_lineage(nb.classify(g))
    return nb.anomaly_nodes(nb.reach(g, listed, anomalies, 3, HUB_DEGREE), anomalies)


@register(
    "R09_anomaly_counts",
    query("SELECT uid, hop, kind, label, assoc, count(*) AS n FROM found GROUP BY ALL"),
)
def r09_counts(spark, sf):
    return counts(spark, sf)


@register(
    "R09_anomaly_counts_many_hubs",
    query("SELECT uid, hop, kind, label, assoc, count(*) AS n FROM found GROUP BY ALL"),
)
def r09_many_hubs(spark, sf):
    """The same counts with a third of the hub degree: where hubs begin changes no row."""
    g = graph(spark, sf)
    anomalies = cut_lineage(nb.classify(g))
    return nb.anomaly_counts(nb.reach(g, members(spark, sf), anomalies, 3, HUB_DEGREE // 3), anomalies)


@register(
    "R06_scored_for_devices",
    query(f"SELECT device_no, uid, round(risk, 4) AS risk FROM ({_DEVICE_RISKS})"),
)
def r06_targets(spark, sf):
    """R06 without a table of risks: only the uids of the devices are scored."""
    return jobs.device_uid_risks(graph(spark, sf)).withColumn("risk", F.round("risk", 4))


@register("R10_member_hop_totals", query("SELECT grp, uid, hop, n FROM hop_totals"))
def r10(spark, sf):
    return nb.member_hop_totals(members(spark, sf), counts(spark, sf))


@register("A10_mean_by_hop", query("SELECT grp, hop, round(avg(n), 6) AS mean_nodes FROM hop_totals GROUP BY 1, 2"))
def a10(spark, sf):
    out = nb.mean_by_hop(nb.member_hop_totals(members(spark, sf), counts(spark, sf)))
    return out.withColumn("mean_nodes", F.round("mean_nodes", 6))


@register(
    "A11_type_distribution",
    query(
        "SELECT m.grp, f.hop, f.kind, f.label, round(avg(n), 6) AS mean_nodes, max(n) AS max_nodes, min(n) AS min_nodes, "
        "count(*) AS members_with FROM members m JOIN (SELECT uid, hop, kind, label, count(*) AS n FROM found GROUP BY ALL) f "
        "ON f.uid = m.uid GROUP BY 1, 2, 3, 4"
    ),
)
def a11(spark, sf):
    out = nb.type_distribution(members(spark, sf), counts(spark, sf))
    return out.withColumn("mean_nodes", F.round("mean_nodes", 6))


@register(
    "A12_association_distribution",
    query(
        "SELECT m.grp, f.hop, f.kind, f.label, round(avg(assoc), 6) AS mean_assoc, median(assoc) AS median_assoc, "
        "max(assoc) AS max_assoc, min(assoc) AS min_assoc FROM members m JOIN found f ON f.uid = m.uid "
        "WHERE assoc > 0 GROUP BY 1, 2, 3, 4"
    ),
)
def a12(spark, sf):
    out = nb.association_distribution(nb.association_frequencies(members(spark, sf), counts(spark, sf)))
    return out.withColumn("mean_assoc", F.round("mean_assoc", 6))


@register(
    "A12_association_first",
    query(
        "SELECT m.grp, f.hop, f.kind, f.label, f.assoc, count(*) AS n FROM members m JOIN found f ON f.uid = m.uid "
        "WHERE assoc > 0 GROUP BY 1, 2, 3, 4, 5 QUALIFY row_number() OVER (PARTITION BY m.grp, f.hop, f.kind, f.label ORDER BY f.assoc) <= 10"
    ),
)
def a12_first(spark, sf):
    return nb.association_first(nb.association_frequencies(members(spark, sf), counts(spark, sf)))


def _per_member(spark, sf) -> DataFrame:
    return nb.member_totals(nb.member_hop_totals(members(spark, sf), counts(spark, sf)))


@register(
    "A13_isolation",
    query(
        "SELECT grp, count(*) AS members, count(*) FILTER (WHERE total <= 2) AS isolated, "
        "round(count(*) FILTER (WHERE total <= 2) * 1.0 / count(*), 9) AS isolation_rate, "
        "count(*) FILTER (WHERE total > 2) AS others, round(coalesce(avg(total) FILTER (WHERE total > 2), 0), 6) AS others_avg, "
        "coalesce(max(total) FILTER (WHERE total > 2), 0) AS others_max, "
        "coalesce(min(total) FILTER (WHERE total > 2), 0) AS others_min FROM uid_totals GROUP BY 1"
    ),
)
def a13(spark, sf):
    out = nb.isolation_statistics(_per_member(spark, sf))
    return out.withColumns({"isolation_rate": F.round("isolation_rate", 9), "others_avg": F.round("others_avg", 6)})


@register(
    "A13_member_breakdown",
    query(
        "SELECT grp, uid, sum(n) AS total, sum(n) FILTER (WHERE hop = 1) AS hop_1, sum(n) FILTER (WHERE hop = 2) AS hop_2, "
        "sum(n) FILTER (WHERE hop = 3) AS hop_3 FROM hop_totals GROUP BY 1, 2"
    ),
)
def a13_members(spark, sf):
    out = _per_member(spark, sf)
    return out.select("grp", "uid", "total", *[F.col("by_hop")[h].alias(f"hop_{h}") for h in (1, 2, 3)])


@register(
    "A14_group_comparison",
    query(
        "SELECT hop, round(b, 6) AS first_mean, round(o, 6) AS second_mean, round(b / nullif(o, 0), 6) AS ratio, "
        "CASE WHEN hop IS NULL THEN (SELECT count(*) FILTER (WHERE total <= 2) * 1.0 / count(*) > 0.3 FROM uid_totals "
        "WHERE grp = 'blacklist') END AS high_isolation, "
        "CASE WHEN hop IS NULL THEN coalesce(b / nullif(o, 0) > 2, b > 0) END AS high_association FROM "
        "(SELECT hop, max(m) FILTER (WHERE grp = 'blacklist') AS b, max(m) FILTER (WHERE grp = 'normal') AS o FROM "
        "(SELECT grp, hop, avg(n) AS m FROM hop_totals GROUP BY 1, 2) GROUP BY 1 UNION ALL "
        "SELECT NULL, sum(m) FILTER (WHERE grp = 'blacklist'), sum(m) FILTER (WHERE grp = 'normal') FROM "
        "(SELECT grp, hop, avg(n) AS m FROM hop_totals GROUP BY 1, 2))"
    ),
)
def a14(spark, sf):
    totals = nb.member_hop_totals(members(spark, sf), counts(spark, sf))
    isolation = nb.isolation_statistics(nb.member_totals(totals))
    out = nb.compare_groups(nb.mean_by_hop(totals), isolation, "blacklist", "normal")
    return out.withColumns({c: F.round(c, 6) for c in ("first_mean", "second_mean", "ratio")})


@register("R11_hop_score", query("SELECT grp, uid, round(score, 4) AS score FROM scores"))
def r11(spark, sf):
    out = nb.hop_scores(members(spark, sf), counts(spark, sf))
    return out.select("grp", "uid", F.round("score", 4).alias("score"))


_AUC = (
    "SELECT sum(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0 END * p.c * n.c) "
    "/ (sum(p.c * n.c)) AS auc FROM (SELECT round(score, 4) AS score, count(*) AS c FROM scores WHERE grp = 'blacklist' GROUP BY 1) p "
    "CROSS JOIN (SELECT round(score, 4) AS score, count(*) AS c FROM scores WHERE grp = 'normal' GROUP BY 1) n"
)


def _scored(spark, sf) -> DataFrame:
    """Scores rounded, so that equal scores tie whatever the order of their sums."""
    out = nb.hop_scores(members(spark, sf), counts(spark, sf))
    return out.withColumn("score", F.round("score", 4))


@register("A15_auc", query(f"SELECT round(auc, 9) AS auc FROM ({_AUC})"))
def a15(spark, sf):
    return evaluate.auc(_scored(spark, sf), F.col("grp") == "blacklist").select(F.round("auc", 9).alias("auc"))


@register(
    "R12_score_evaluation",
    query(
        f"SELECT (SELECT round(auc, 9) FROM ({_AUC})) AS auc, count(*) FILTER (WHERE grp = 'blacklist') AS positives, "
        "count(*) FILTER (WHERE grp = 'normal') AS negatives, "
        "round(avg(score) FILTER (WHERE grp = 'blacklist'), 4) AS positive_mean, "
        "round(avg(score) FILTER (WHERE grp = 'normal'), 4) AS negative_mean, "
        "round(stddev_pop(score) FILTER (WHERE grp = 'blacklist'), 4) AS positive_std, "
        "round(stddev_pop(score) FILTER (WHERE grp = 'normal'), 4) AS negative_std FROM (SELECT grp, round(score, 4) AS score FROM scores)"
    ),
)
def r12(spark, sf):
    out = evaluate.evaluate_scores(_scored(spark, sf), F.col("grp") == "blacklist")
    names = [c for c in out.columns if c.endswith(("mean", "std"))]
    return out.withColumns({"auc": F.round("auc", 9), **{c: F.round(c, 4) for c in names}})


@register(
    "R12_predictions",
    query(
        "SELECT uid, (grp = 'blacklist') :: INT AS true_label, round(score, 4) AS risk_score, "
        "CASE grp WHEN 'blacklist' THEN 'blacklisted' ELSE 'normal' END AS status FROM scores"
    ),
)
def r12_predictions(spark, sf):
    return evaluate.predictions(_scored(spark, sf), F.col("grp") == "blacklist")


_REPORT = " UNION ALL ".join(
    [
        "SELECT 'mean_by_hop' AS part, grp, hop, NULL AS kind, NULL AS label, NULL AS uid, round(avg(n), 6) AS value FROM hop_totals GROUP BY 2, 3",
        "SELECT 'isolation', grp, NULL, NULL, NULL, NULL, round(count(*) FILTER (WHERE total <= 2) * 1.0 / count(*), 6) FROM uid_totals GROUP BY 2",
        "SELECT 'types', m.grp, f.hop, f.kind, f.label, NULL, round(avg(n), 6) FROM members m JOIN "
        "(SELECT uid, hop, kind, label, count(*) AS n FROM found GROUP BY ALL) f ON f.uid = m.uid GROUP BY 2, 3, 4, 5",
        "SELECT 'members', grp, NULL, NULL, NULL, uid, total FROM uid_totals",
    ]
)


@register("S12_group_report", query(_REPORT))
def s12_group_report(spark, sf):
    """The report on both groups, written and read again; one figure of each row."""
    path = scratch_path(spark, "group-report")
    write_report(nb.group_report(members(spark, sf), counts(spark, sf)), path)
    schema = "grp string, hop int, kind string, label string, uid string, mean_nodes double, isolation_rate double, total double"
    row = F.from_json("value", schema).alias("r")
    back = spark.read.text(path).select(F.col("part").cast("string").alias("part"), row).select("part", "r.*")
    figure = F.round(F.coalesce("mean_nodes", "isolation_rate", "total"), 6).alias("value")
    return back.select("part", "grp", "hop", "kind", "label", "uid", figure)
