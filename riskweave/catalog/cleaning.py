"""Cleaning rules, data quality and scalar functions over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave import rules
from riskweave.catalog import register
from riskweave.catalog.context import feed, graph, rows
from riskweave.catalog.sql import CUT, FEED_SQL, device, key, query, quoted, txt
from riskweave.fixtures import raw_feeds, table
from riskweave.functions import clean as C
from riskweave.functions import timeparse as TP
from riskweave.functions import weights as W
from riskweave.operators import relational as rel
from riskweave.operators.events import default_labels, event_stream
from riskweave.operators.feeds import FEEDS, invalid_times, prepare, row_accounting, valid_rows
from riskweave.operators.graph import blacklist_marks, duplicate_keys, union_all
from riskweave.operators.legacy import ORDER_RENAMES
from riskweave.sources.files import date_token, file_order
from riskweave.streaming.ingest import checked_events


@register("P01_null_tokens", query(f"SELECT seq, {txt('device_no')} AS device_text FROM fx_login"))
def p01(spark: SparkSession, sf: str) -> DataFrame:
    return feed(spark, sf, "login").select("seq", C.clean_text("device_no").alias("device_text"))


@register("P02_keys", query(f"SELECT seq, {key('cif_user_id')} AS uid, {key('device_no')} AS device_key FROM fx_login"))
def p02(spark, sf):
    return feed(spark, sf, "login").select(
        "seq", C.clean_key("cif_user_id").alias("uid"), C.clean_key("device_no").alias("device_key")
    )


@register(
    "P03_nested_cleaning",
    query(
        f"SELECT seq, {txt('device_no')} AS device_no, {txt('td_device_id')} AS td_device_id, "
        f"{txt('phone_num')} AS first_phone, CAST(NULL AS VARCHAR) AS second_phone FROM fx_login"
    ),
)
def p03(spark, sf):
    login = feed(spark, sf, "login")
    event = F.struct(
        F.create_map(F.lit("device"), F.col("device_no"), F.lit("td"), F.col("td_device_id")).alias("data"),
        F.array(F.col("phone_num"), F.lit(" None ")).alias("phones"),
    )
    nested = login.select("seq", event.alias("e"))
    cleaned = C.clean_nested(F.col("e"), nested.schema["e"].dataType)
    return nested.select("seq", cleaned.alias("e")).select(
        "seq",
        F.col("e.data")["device"].alias("device_no"),
        F.col("e.data")["td"].alias("td_device_id"),
        F.col("e.phones")[0].alias("first_phone"),
        F.col("e.phones")[1].alias("second_phone"),
    )


@register(
    "P04_first_existing_column",
    query(f"SELECT seq, {key('cid')} AS uid, {key('geo_code')} AS geo, create_date AS ts FROM fx_lbs_gps"),
)
def p04(spark, sf):
    gps = feed(spark, sf, "lbs_gps")
    return gps.select(
        "seq",
        C.clean_key(C.first_existing(gps, ("cif_user_id", "cid", "id"))).alias("uid"),
        C.clean_key(C.first_existing(gps, ("adcode", "geo_code"))).alias("geo"),
        TP.first_existing_time(gps, ("login_time", "create_date", "ts")).alias("ts"),
    )


@register(
    "P05_first_value",
    query(
        "SELECT seq, lower(phone) AS phone, ts FROM (SELECT seq, mobile_phone AS phone, create_date AS ts FROM fx_linkman "
        "UNION ALL SELECT seq, second_mobile_phone, create_date FROM fx_second_linkman)"
    ),
)
def p05(spark, sf):
    feeds = raw_feeds(spark, sf)
    both = feeds["first_linkman"].unionByName(feeds["second_linkman"], allowMissingColumns=True)
    return both.select(
        "seq",
        C.first_value(both, ("mobile_phone", "second_mobile_phone", "phone_num")).alias("phone"),
        TP.first_parsed_time(both, ("modify_date", "create_date")).alias("ts"),
    )


@register("P06_device_blocklist", query(f"SELECT seq, {device('device_no')} AS device_no FROM fx_login"))
def p06(spark, sf):
    return feed(spark, sf, "login").select("seq", C.clean_device("device_no").alias("device_no"))


# Feed -> the column whose absence drops a row, besides the time; and a number of its rows.
_KEYS = {
    "customer_log": "baseid",
    "login": "cif_user_id",
    "lbs_gps": "cid",
    "first_linkman": "cid",
    "second_linkman": "cid",
    "first_linkman_derived": "cid",
    "second_linkman_derived": "cid",
    "logout": "cid",
    "order": "id",
    "repay_plan": "id",
    "company_log": "cid",
    "complaint": "c_id",
    "consumer_protection_case": "c_id",
    "blacklist_log": None,
}
_NUMBERS = {
    "repay_plan": "CAST(substr(order_id, 2) AS BIGINT)",
    "complaint": "CAST(c_id AS BIGINT)",
    "consumer_protection_case": "CAST(c_id AS BIGINT)",
}


def _dirty(spark, sf, dataset: str) -> DataFrame:
    """A feed some of whose rows lack the key or a readable time."""
    number = F.expr(_NUMBERS.get(dataset, "seq"))
    time_column, key_column = FEEDS[dataset].event_time, _KEYS[dataset]
    values = {time_column: F.when(number % 17 == 5, "no date").otherwise(F.col(time_column).cast("string"))}
    if key_column is not None:
        values[key_column] = F.when(number % 13 == 3, " NaN ").otherwise(F.col(key_column).cast("string"))
    return feed(spark, sf, dataset).withColumns(values)


def _cut(dataset: str) -> str | None:
    return rules.BLACKLIST_CUT if dataset == "blacklist_log" else None


def _accounting(dataset: str) -> str:
    number = _NUMBERS.get(dataset, "seq")
    no_time = f"{number} % 17 = 5"
    no_key = f"{number} % 13 = 3" if _KEYS[dataset] is not None else "false"
    late = f"(d_begin_date >= {CUT} AND NOT ({no_time}))" if dataset == "blacklist_log" else "false"
    return (
        f"SELECT '{dataset}' AS dataset, count(*) AS total_rows, count(*) FILTER (WHERE NOT bad) AS written_rows, "
        "count(*) FILTER (WHERE bad) AS skipped_rows, count(*) FILTER (WHERE no_key) AS skipped_key, "
        "count(*) FILTER (WHERE no_time) AS skipped_time, count(*) FILTER (WHERE late) AS skipped_late FROM "
        f"(SELECT {no_key} AS no_key, {no_time} AS no_time, {late} AS late, {no_key} OR {no_time} OR {late} AS bad "
        f"FROM {FEED_SQL[dataset]})"
    )


_ACCOUNTING = " UNION ALL ".join(_accounting(d) for d in FEED_SQL)


@register("P07_required_fields", query(f"SELECT dataset, written_rows AS valid_rows FROM ({_ACCOUNTING})"))
def p07(spark, sf):
    """Rows that have all that their feed requires, of all feeds with some dirty rows."""
    return union_all(
        [
            valid_rows(d, _dirty(spark, sf, d), _cut(d))
            .agg(F.count(F.lit(1)).alias("valid_rows"))
            .select(F.lit(d).alias("dataset"), "valid_rows")
            for d in FEEDS
        ]
    )


_TYPE_COUNTS = (
    "SELECT 'customer_update' AS type, count(*) AS events FROM fx_customer_log "
    "UNION ALL SELECT 'login', count(*) FROM fx_login UNION ALL SELECT 'gps', count(*) FROM fx_lbs_gps "
    "UNION ALL SELECT 'contact_edit', count(*) FROM c_contacts UNION ALL SELECT 'logout', count(*) FROM fx_logout "
    "UNION ALL SELECT 'company_update', count(*) FROM fx_company_log "
    "UNION ALL SELECT 'repayment_plan', count(*) FROM fx_repay_plan "
    "UNION ALL SELECT CASE source WHEN 'complaint' THEN 'complaint_case' ELSE 'consumer_case' END, count(*) "
    "FROM fx_cases GROUP BY 1 UNION ALL SELECT 'blacklist', count(*) FROM fx_blacklist_log "
    "UNION ALL SELECT 'order', count(*) FROM fx_order"
)


@register(
    "P08_event_errors",
    query(
        "SELECT type, CASE WHEN type = 'gps' THEN 'Missing required field: data.cid' "
        "WHEN type IN ('customer_update', 'login', 'contact_edit', 'logout', 'order') THEN NULL "
        f"ELSE 'Unsupported event type: ' || type END AS error, events FROM ({_TYPE_COUNTS})"
    ),
)
def p08(spark, sf):
    events = event_stream(raw_feeds(spark, sf)).select("type", F.col("ts").cast("string").alias("ts"), "data")
    no_cid = F.map_filter("data", lambda k, _: k != "cid")
    broken = events.withColumn("data", F.when(F.col("type") == "gps", no_cid).otherwise(F.col("data")))
    full = broken.withColumn("id_type", F.lit(None).cast("string")).withColumn("id_value", F.lit(None).cast("string"))
    return checked_events(full).groupBy("type", "error").agg(F.count(F.lit(1)).alias("events"))


@register(
    "P09_any_identifier",
    query(
        "SELECT count(*) AS with_identifier, count(*) FILTER (WHERE c_reason_list IS NOT NULL) AS with_reason "
        "FROM fx_blacklist_log WHERE coalesce(c_customer_no, c_mobile_phone, c_identity_no) IS NOT NULL"
    ),
)
def p09(spark, sf):
    named = prepare("blacklist_log", feed(spark, sf, "blacklist_log")).filter(
        F.coalesce("uid", "phone_num", "identity_no").isNotNull()
    )
    return named.agg(
        F.count(F.lit(1)).alias("with_identifier"), F.count_if(F.col("reason_list").isNotNull()).alias("with_reason")
    )


@register("P10_time_cut", query("SELECT uid, ts, seq FROM c_blacklist_log"))
def p10(spark, sf):
    return rows(spark, sf, "blacklist_log").select("uid", "ts", "seq")


@register(
    "P11_derived_text",
    query("SELECT uid AS owner, status AS text FROM c_blacklist_log UNION ALL SELECT identity_no, case_key FROM c_cases"),
)
def p11(spark, sf):
    marks = rows(spark, sf, "blacklist_log").select(F.col("uid").alias("owner"), F.col("status").alias("text"))
    cases = [
        rows(spark, sf, d).select(F.col("identity_no").alias("owner"), F.col("case_key").alias("text"))
        for d in ("complaint", "consumer_protection_case")
    ]
    return union_all([marks, *cases])


# The cleaned column that a feed's key column fills.
_KEY_NAMES = {"order": "order_id", "repay_plan": "repay_plan_id", "complaint": "case_key", "consumer_protection_case": "case_key"}


@register("P12_row_accounting", query(_ACCOUNTING))
def p12(spark, sf):
    """Rows written and skipped, by reason, of all feeds with some dirty rows."""
    none, parts = F.lit(0).cast("long"), []
    for d in FEEDS:
        counted = row_accounting(d, _dirty(spark, sf, d), _cut(d))
        names = {
            "skipped_key": f"skipped_missing_{_KEY_NAMES.get(d, 'uid')}",
            "skipped_time": "skipped_missing_ts",
            "skipped_late": "skipped_missing_time_before_cut",
        }
        reasons = [(F.col(c) if c in counted.columns else none).alias(n) for n, c in names.items()]
        parts.append(counted.select("dataset", "total_rows", "written_rows", "skipped_rows", *reasons))
    return union_all(parts)


@register(
    "P14_column_resolution",
    query("SELECT app_channel AS channel, count(*) AS logins FROM fx_login GROUP BY 1"),
)
def p14(spark, sf):
    login = feed(spark, sf, "login")
    channel = C.find_column(login.columns, ["channel", "渠道"])
    return login.groupBy(F.col(channel).alias("channel")).agg(F.count(F.lit(1)).alias("logins"))


_CLASS = (
    f"CASE WHEN order_status IN ({quoted(rules.NORMAL_STATUSES)}) THEN 'normal' "
    f"WHEN order_status IN ({quoted(rules.ABNORMAL_STATUSES)}) THEN 'abnormal' "
    f"WHEN order_status IN ({quoted(rules.EXCLUDED_STATUSES)}) THEN 'excluded' ELSE 'unclassified' END"
)


@register("P15_status_class", query(f"SELECT seq, order_status, {_CLASS} AS category FROM fx_order"))
def p15(spark, sf):
    return feed(spark, sf, "order").select("seq", "order_status", C.status_class("order_status").alias("category"))


@register(
    "P16_users_with_status",
    query(f"SELECT DISTINCT user_id AS uid FROM fx_order WHERE order_status IN ({quoted(rules.NORMAL_STATUSES)})"),
)
def p16(spark, sf):
    return rel.users_with_status(feed(spark, sf, "order"), rules.NORMAL_STATUSES)


@register(
    "P17_key_uniqueness",
    query(
        "SELECT node_type, count(*) AS node_rows, count(DISTINCT key) AS keys, 0 AS repeated_keys FROM nodes GROUP BY 1"
    ),
)
def p17(spark, sf):
    nodes = graph(spark, sf).nodes
    repeated = duplicate_keys(nodes).groupBy("node_type").agg(F.count(F.lit(1)).alias("repeated_keys"))
    per_key = nodes.groupBy("node_type", "key").agg(F.count(F.lit(1)).alias("n"))
    totals = per_key.groupBy("node_type").agg(F.sum("n").alias("node_rows"), F.count(F.lit(1)).alias("keys"))
    return totals.join(repeated, "node_type", "left").withColumn(
        "repeated_keys", F.coalesce("repeated_keys", F.lit(0))
    )


@register(
    "P18_renames",
    query(
        "SELECT id AS order_id, user_id AS uid, apply_loan_tel AS phone_num, apply_ident_no AS identity_no, "
        "apply_card_no AS card_no, apply_bank_mobile AS card_phone_num, repay_bank_mobile AS repay_card_phone_num "
        "FROM fx_order"
    ),
)
def p18(spark, sf):
    renamed = feed(spark, sf, "order").withColumnsRenamed(ORDER_RENAMES)
    return renamed.select(
        "order_id", "uid", "phone_num", "identity_no", "card_no", "card_phone_num", "repay_card_phone_num"
    )


# -- scalar functions ---------------------------------------------------------


def _time_texts(spark, sf) -> DataFrame:
    """Event times written in several ways, some unreadable."""
    ts, n = F.col("ts").cast("timestamp_ntz"), F.col("event_id") % 8
    text = (
        F.when(n == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(n == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(n == 2, F.date_format(ts, "yyyy-MM-dd"))
        .when(n == 3, F.date_format(ts, "yyyy/M/d HH:mm:ss"))
        .when(n == 4, F.date_format(ts, "yyyyMMdd"))
        .when(n == 5, F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit("+08:00")))
        .when(n == 6, F.lit(" NaN "))
        .otherwise(F.lit("not a time"))
    )
    return table(spark, sf, "events").select("event_id", text.alias("t"))


_F01 = (
    "CASE event_id % 8 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts) "
    "WHEN 2 THEN date_trunc('day', ts) WHEN 3 THEN date_trunc('second', ts) WHEN 4 THEN date_trunc('day', ts) "
    "WHEN 5 THEN date_trunc('second', ts) - INTERVAL 8 HOURS END"
)


@register("F01_lenient_time", f"SELECT event_id, CAST({_F01} AS TIMESTAMP) AS parsed FROM events")
def f01(spark, sf):
    return _time_texts(spark, sf).select("event_id", TP.parse_text_time("t").alias("parsed"))


@register(
    "F02_iso_text",
    "SELECT event_id, CASE WHEN epoch_us(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') "
    "ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS iso FROM events",
)
def f02(spark, sf):
    return table(spark, sf, "events").select("event_id", TP.iso_text("ts").alias("iso"))


@register(
    "F03_month_and_day",
    "SELECT strftime(ts, '%Y-%m') AS ym, strftime(ts, '%Y-%m-%d') AS dt, year(ts) AS y, month(ts) AS m, "
    "day(ts) AS d, count(*) AS n FROM events GROUP BY ALL",
)
def f03(spark, sf):
    return (
        table(spark, sf, "events")
        .groupBy(
            TP.month_text("ts").alias("ym"),
            TP.day_text("ts").alias("dt"),
            F.year("ts").alias("y"),
            F.month("ts").alias("m"),
            F.day("ts").alias("d"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


@register(
    "F04_lenient_int",
    query("SELECT event_id, CASE WHEN event_id % 3 = 2 THEN NULL ELSE k END AS whole FROM fx_ev"),
)
def f04(spark, sf):
    k = F.regexp_extract("props", "([0-9]+)", 1)
    n = F.col("event_id") % 3
    text = F.when(n == 0, k).when(n == 1, F.concat(k, F.lit(".7"))).otherwise(F.concat(k, F.lit("x")))
    return table(spark, sf, "events").select("event_id", C.lenient_int(text).alias("whole"))


def _risk_lines(spark, sf) -> DataFrame:
    """Device, uid and risk in one text line; some risks are no number."""
    k = F.col("c_custkey")
    device_no = F.concat(F.lit('"D'), (k % 50).cast("string"), F.lit('"'))
    cents = F.floor(F.col("c_acctbal") * 100).cast("string")
    risk = F.when(k % 13 == 0, "NA").otherwise(cents)
    line = F.concat_ws("\t", device_no, F.concat(F.lit("U"), k.cast("string")), risk)
    return table(spark, sf, "customer").select(k.alias("seq"), line.alias("value"))


_CENTS = "CAST(CAST(floor(c_acctbal * 100) AS BIGINT) AS VARCHAR)"


@register(
    "F05_lenient_double",
    "SELECT c_custkey AS seq, floor(c_acctbal * 100) AS risk FROM customer WHERE c_custkey % 13 <> 0",
)
def f05(spark, sf):
    parsed = rel.parse_risk_lines(_risk_lines(spark, sf), ["device_no", "uid", "risk"])
    return parsed.select("seq", C.lenient_double("risk").alias("risk")).filter(F.col("risk").isNotNull())


@register("F06_strip_quotes", "SELECT c_custkey AS seq, 'd' || CAST(c_custkey % 50 AS VARCHAR) AS device_no FROM customer")
def f06(spark, sf):
    parsed = rel.parse_risk_lines(_risk_lines(spark, sf), ["device_no", "uid", "risk"])
    return parsed.select("seq", F.lower(C.strip_quotes("device_no")).alias("device_no"))


@register(
    "F07_split_line",
    "SELECT c_custkey AS seq, '\"D' || CAST(c_custkey % 50 AS VARCHAR) || '\"' AS device_no, "
    f"'U' || CAST(c_custkey AS VARCHAR) AS uid, CASE WHEN c_custkey % 13 = 0 THEN 'NA' ELSE {_CENTS} END AS risk "
    "FROM customer",
)
def f07(spark, sf):
    return rel.parse_risk_lines(_risk_lines(spark, sf), ["device_no", "uid", "risk"])


def _paths(spark, sf) -> DataFrame:
    ts = F.col("ts").cast("timestamp_ntz")
    dated = F.concat(F.lit("login/"), F.date_format(ts, "yyyy-MM"), F.lit("/"), F.date_format(ts, "yyyy-MM-dd"), F.lit(".csv"))
    path = F.when(F.col("event_id") % 9 == 0, F.concat(F.lit("login/part-"), F.col("event_id") % 7, F.lit(".csv")))
    return table(spark, sf, "events").select(F.coalesce(path, dated).alias("path")).distinct()


_PATHS = (
    "SELECT DISTINCT CASE WHEN event_id % 9 = 0 THEN 'login/part-' || CAST(event_id % 7 AS VARCHAR) || '.csv' "
    "ELSE strftime(ts, 'login/%Y-%m/%Y-%m-%d.csv') END AS path, "
    "CASE WHEN event_id % 9 <> 0 THEN strftime(ts, '%Y%m%d') END AS date_token FROM events"
)


@register("F08_date_token", _PATHS)
def f08(spark, sf):
    return _paths(spark, sf).select("path", date_token(F.col("path")).alias("date_token"))


@register("S18_file_order", _PATHS)
def s18(spark, sf):
    ordered = _paths(spark, sf).orderBy(*file_order(F.col("path")))
    return ordered.select("path", date_token(F.col("path")).alias("date_token"))


@register(
    "F09_null_safe_change",
    query(
        f"SELECT seq, {key('td_device_id')} IS DISTINCT FROM {key('device_no')} AS differs FROM fx_login"
    ),
)
def f09(spark, sf):
    same = C.clean_key("td_device_id").eqNullSafe(C.clean_key("device_no"))
    return feed(spark, sf, "login").select("seq", (~same).alias("differs"))


_RELS = (
    "CASE event_type WHEN 'click' THEN 'LOGIN_WITH_IP' WHEN 'view' THEN 'LOCATED_AT' "
    "WHEN 'signup' THEN 'HAS_PHONE' ELSE 'SOMETHING_ELSE' END"
)


def _relations(spark, sf) -> DataFrame:
    kind = F.col("event_type")
    name = (
        F.when(kind == "click", "LOGIN_WITH_IP")
        .when(kind == "view", "LOCATED_AT")
        .when(kind == "signup", "HAS_PHONE")
        .otherwise("SOMETHING_ELSE")
    )
    seen = F.when(F.col("event_id") % 10 != 0, F.col("ts").cast("timestamp_ntz"))
    return table(spark, sf, "events").select("event_id", name.alias("rel"), seen.alias("seen"))


@register(
    "F10_time_decay",
    "SELECT event_id, round(CASE WHEN event_id % 10 = 0 THEN 1.0 ELSE pow(0.1 :: DOUBLE, greatest(0.0 :: DOUBLE, "
    "epoch_us(TIMESTAMP '2024-01-20 00:00:00') - epoch_us(ts)) / 86400e6 / "
    "CASE event_type WHEN 'click' THEN 7.0 WHEN 'view' THEN 30.0 ELSE 730.0 END) END, 9) AS decay FROM events",
)
def f10(spark, sf):
    now = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    return _relations(spark, sf).select("event_id", F.round(W.time_decay(F.col("rel"), F.col("seen"), now), 9).alias("decay"))


@register(
    "F11_relation_weight",
    f"SELECT {_RELS} AS rel, CASE {_RELS} WHEN 'LOGIN_WITH_IP' THEN 0.2 WHEN 'LOCATED_AT' THEN 0.3 "
    "WHEN 'HAS_PHONE' THEN 0.8 ELSE 0.6 END :: DOUBLE AS weight, count(*) AS n FROM events GROUP BY ALL",
)
def f11(spark, sf):
    rels = _relations(spark, sf).groupBy("rel").agg(F.count(F.lit(1)).alias("n"))
    return rels.select("rel", W.relation_weight(F.col("rel")).alias("weight"), "n")


@register(
    "F12_beyond_first",
    query("SELECT device_no, uid_count, greatest(uid_count - 1, 0) AS adjusted FROM device_users"),
)
def f12(spark, sf):
    return rel.shared_beyond_first(rel.device_user_counts(graph(spark, sf).edges))


@register(
    "F13_status_compare",
    query(
        "SELECT node_type, count(*) FILTER (WHERE upper(coalesce(order_status, '')) = 'OVERDUE') AS overdue, "
        "count(*) FILTER (WHERE upper(coalesce(status, '')) = 'BLACKLISTED') AS plain_mark FROM nodes GROUP BY 1"
    ),
)
def f13(spark, sf):
    def equals(c: str, value: str):
        return F.count_if(F.upper(F.coalesce(c, F.lit(""))) == value)

    return graph(spark, sf).nodes.groupBy("node_type").agg(
        equals("order_status", "OVERDUE").alias("overdue"), equals("status", "BLACKLISTED").alias("plain_mark")
    )


@register(
    "F14_latest_time",
    query(
        "SELECT order_id, max(greatest(current_repay_date, coalesce(repayed_date, current_repay_date))) AS latest "
        "FROM fx_repay_plan GROUP BY 1"
    ),
)
def f14(spark, sf):
    newer = F.greatest("due_date", "repayed_date")
    return rows(spark, sf, "repay_plan").groupBy("order_id").agg(F.max(newer).alias("latest"))


@register(
    "F15_json_maps",
    query(
        "SELECT seq, '{\"cid\":\"' || cid || '\",\"geo_code\":\"' || geo_code || '\"}' AS json, geo_code AS decoded, "
        "2 AS keys, true AS has_cid FROM fx_lbs_gps"
    ),
)
def f15(spark, sf):
    entries = F.array(
        F.struct(F.lit("cid").alias("k"), F.col("cid").alias("v")),
        F.struct(F.lit("geo_code").alias("k"), F.col("geo_code").alias("v")),
    )
    coded = feed(spark, sf, "lbs_gps").select("seq", F.to_json(F.map_from_entries(entries)).alias("json"))
    back = coded.withColumn("m", F.from_json("json", "map<string,string>"))
    return back.select(
        "seq",
        "json",
        F.col("m")["geo_code"].alias("decoded"),
        F.size(F.map_keys("m")).alias("keys"),
        F.map_contains_key("m", "cid").alias("has_cid"),
    )


@register(
    "F16_guarded_ratio",
    query(
        "SELECT uid, count(*) AS logins, count(device_no) AS with_device, "
        "round(count(device_no) * 1.0 / count(*), 9) AS share, "
        "round(CASE WHEN count(td_device_id) = 0 THEN NULL ELSE count(device_no) * 1.0 / count(td_device_id) END, 9) "
        "AS per_td FROM c_login GROUP BY 1"
    ),
)
def f16(spark, sf):
    n = rows(spark, sf, "login").groupBy("uid").agg(
        F.count(F.lit(1)).alias("logins"), F.count("device_no").alias("with_device"), F.count("td_device_id").alias("td")
    )
    return n.select(
        "uid",
        "logins",
        "with_device",
        F.round(F.try_divide("with_device", "logins"), 9).alias("share"),
        F.round(F.try_divide("with_device", "td"), 9).alias("per_td"),
    )


@register(
    "F17_pseudonyms",
    query(f"SELECT seq, sha256({key('cif_user_id')} || 'pepper') AS uid_hash FROM fx_login"),
)
def f17(spark, sf):
    return feed(spark, sf, "login").select("seq", C.pseudonym("cif_user_id", "pepper").alias("uid_hash"))


@register(
    "A17_invalid_times",
    "SELECT count(*) FILTER (WHERE event_id % 8 >= 6) AS invalid_rows, count(*) AS total_rows FROM events",
)
def a17(spark, sf):
    return invalid_times(_time_texts(spark, sf), "t")
