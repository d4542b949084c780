"""Event stream construction and ingest over the test tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.catalog import register
from riskweave.catalog.cleaning import _TYPE_COUNTS
from riskweave.catalog.context import feed, graph, rows
from riskweave.catalog.sql import BLOCKS, query, quoted
from riskweave.fixtures import raw_feeds
from riskweave.functions.timeparse import iso_text
from riskweave.operators import events as E
from riskweave.operators.association import windowed_links
from riskweave.operators.events import REQUIRED_FIELDS
from riskweave.session import scratch_path
from riskweave.sources.files import blank_lines, numbered_lines, parse_events
from riskweave.sources.store import GraphStore
from riskweave.streaming import ingest as I


@register(
    "E01_feed_projection",
    query(
        "SELECT 'login' AS type, login_time AS ts, phone_num, cif_user_id, device_no, remote_ip, td_device_id FROM fx_login"
    ),
)
def e01(spark: SparkSession, sf: str) -> DataFrame:
    rank = [d for d, *_ in E.SOURCES].index("login")
    _, kind, time_column, payload = E.SOURCES[rank]
    events = E.feed_events(feed(spark, sf, "login"), rank, kind, time_column, payload)
    return events.select("type", "ts", *[F.col("data")[c].alias(c) for c in payload])


@register("E02_event_types", query(_TYPE_COUNTS))
def e02(spark, sf):
    return E.source_events(raw_feeds(spark, sf)).groupBy("type").agg(F.count(F.lit(1)).alias("events"))


@register(
    "E03_order_events",
    query(
        "SELECT create_date AS ts, id AS order_id, user_id, apply_loan_tel, apply_ident_no, apply_card_no, "
        "apply_bank_mobile, repay_card_no, repay_bank_mobile, order_status FROM fx_order"
    ),
)
def e03(spark, sf):
    events = E.source_events({"order": feed(spark, sf, "order")})
    names = list(E.SOURCES[E.ORDER_RANK][3])
    return events.select("ts", *[F.col("data")[c].alias(c) for c in names])


_IDS = (
    "SELECT id AS order_id, 'uid' AS id_type, user_id AS id_value FROM fx_order UNION ALL "
    "SELECT id, 'identity_no', apply_ident_no FROM fx_order UNION ALL "
    "SELECT DISTINCT id, 'phone_num', phone FROM (SELECT id, unnest([apply_loan_tel, apply_bank_mobile, repay_bank_mobile]) AS phone "
    "FROM fx_order) WHERE phone IS NOT NULL AND phone <> ''"
)


@register("E04_order_identifiers", query(_IDS))
def e04(spark, sf):
    return E.order_identifiers(feed(spark, sf, "order")).select("order_id", "id_type", "id_value")


_HITS = (
    "SELECT 'uid' AS id_type, c_customer_no AS id_value, 'blacklist' AS source, coalesce(c_reason_list, '') AS tag FROM fx_blacklist_log "
    "UNION ALL SELECT 'identity_no', c_identity_no, 'blacklist', coalesce(c_reason_list, '') FROM fx_blacklist_log "
    "UNION ALL SELECT 'phone_num', c_mobile_phone, 'blacklist', coalesce(c_reason_list, '') FROM fx_blacklist_log "
    "UNION ALL SELECT 'identity_no', c_identity_no, source, c_contact_phone_no FROM fx_cases "
    "UNION ALL SELECT 'phone_num', c_contact_phone_no, source, c_contact_phone_no FROM fx_cases "
    "UNION ALL SELECT 'phone_num', c_register_phone_no, source, c_contact_phone_no FROM fx_cases "
    "WHERE c_register_phone_no <> c_contact_phone_no"
)


@register("J01_two_column_match", query(f"SELECT id_type, id_value, source, tag FROM ({_HITS})"))
def j01(spark, sf):
    records = E.label_records(E.default_labels(raw_feeds(spark, sf)))
    short = F.regexp_replace("source", "_case$", "")
    tag = F.when(F.col("source") == "blacklist", F.col("record.c_reason_list")).otherwise(F.col("record.c_contact_phone_no"))
    return records.select("id_type", "id_value", short.alias("source"), tag.alias("tag"))


@register(
    "E05_risk_labels",
    query(
        "SELECT i.order_id, i.id_type, i.id_value, o.order_status, "
        "coalesce(h.n_blacklist, 0) AS n_blacklist, coalesce(h.n_complaint, 0) AS n_complaint, "
        f"coalesce(h.n_consumer_case, 0) AS n_consumer_case FROM ({_IDS}) i JOIN fx_order o ON o.id = i.order_id LEFT JOIN "
        "(SELECT id_type, id_value, count(*) FILTER (WHERE source = 'blacklist') AS n_blacklist, "
        "count(*) FILTER (WHERE source = 'complaint') AS n_complaint, "
        f"count(*) FILTER (WHERE source = 'consumer') AS n_consumer_case FROM ({_HITS}) GROUP BY 1, 2) h "
        "ON h.id_type = i.id_type AND h.id_value = i.id_value"
    ),
)
def e05(spark, sf):
    feeds = raw_feeds(spark, sf)
    risk = E.risk_rows(feeds["order"], E.default_labels(feeds))
    return risk.select("order_id", "id_type", "id_value", "order_status", "n_blacklist", "n_complaint", "n_consumer_case")


def _stream(spark, sf) -> DataFrame:
    feeds = raw_feeds(spark, sf)
    return E.event_stream(feeds, E.default_labels(feeds))


_ALL_EVENTS = (
    "SELECT 'customer_update' AS type, log_create_date AS ts, 0 AS source_rank, seq, 0 AS sub_seq, '' AS id_value FROM fx_customer_log "
    "UNION ALL SELECT 'login', login_time, 1, seq, 0, '' FROM fx_login "
    "UNION ALL SELECT 'gps', create_date, 2, seq, 0, '' FROM fx_lbs_gps "
    "UNION ALL SELECT 'contact_edit', create_date, 3, seq, 0, '' FROM fx_linkman "
    "UNION ALL SELECT 'contact_edit', create_date, 4, seq, 0, '' FROM fx_second_linkman "
    "UNION ALL SELECT 'contact_edit', create_date, 5, seq, 0, '' FROM fx_linkman_derived "
    "UNION ALL SELECT 'contact_edit', create_date, 6, seq, 0, '' FROM fx_second_linkman_derived "
    "UNION ALL SELECT 'logout', create_date, 7, seq, 0, '' FROM fx_logout "
    "UNION ALL SELECT 'company_update', modify_date, 8, seq, 0, '' FROM fx_company_log "
    "UNION ALL SELECT 'repayment_plan', current_repay_date, 9, NULL, 0, '' FROM fx_repay_plan "
    "UNION ALL SELECT CASE source WHEN 'complaint' THEN 'complaint_case' ELSE 'consumer_case' END, d_update, "
    "CASE source WHEN 'complaint' THEN 10 ELSE 11 END, NULL, 0, '' FROM fx_cases "
    "UNION ALL SELECT 'blacklist', d_begin_date, 12, seq, 0, '' FROM fx_blacklist_log "
    "UNION ALL SELECT 'order', create_date, 13, seq, 0, '' FROM fx_order "
    "UNION ALL SELECT 'risk_assessment', o.create_date, 13, o.seq, row_number() OVER (PARTITION BY o.id ORDER BY "
    "CASE i.id_type WHEN 'uid' THEN 1 WHEN 'identity_no' THEN 2 ELSE 3 END, i.id_value), i.id_value "
    f"FROM fx_order o JOIN ({_IDS}) i ON i.order_id = o.id"
)


# Rows that agree in the order's columns agree in all columns that are shown.
POSITIONS = (
    "SELECT *, row_number() OVER (ORDER BY ts, source_rank, seq NULLS FIRST, sub_seq) - 1 AS position "
    f"FROM ({_ALL_EVENTS})"
)


@register("E06_time_order", query(f"SELECT type, ts, source_rank, seq, sub_seq, id_value, position FROM ({POSITIONS})"))
def e06(spark, sf):
    ordered = E.in_positions(_stream(spark, sf))
    shown = F.coalesce("id_value", F.lit("")).alias("id_value")
    return ordered.select("type", "ts", "source_rank", "seq", "sub_seq", shown, "position")


@register(
    "E07_events_per_month",
    query(f"SELECT strftime(ts, '%Y-%m') AS ym, count(*) AS events FROM ({_ALL_EVENTS}) GROUP BY 1"),
)
def e07(spark, sf):
    return E.events_per_month(raw_feeds(spark, sf))


# -- ingest -------------------------------------------------------------------


HANDLED = tuple(REQUIRED_FIELDS)


def json_lines(spark, sf) -> DataFrame:
    """All events as JSON lines, with a broken, a blank and an unknown-type line for some rows."""
    events = _stream(spark, sf)
    n = F.col("seq") % 40
    kind = F.when(F.col("seq") % 50 == 7, F.lit("surprise")).otherwise(F.col("type"))
    event = F.to_json(F.struct(kind.alias("type"), iso_text("ts").alias("ts"), "data", "id_type", "id_value", "labels"))
    line = F.when(n == 3, F.lit("{broken")).when(n == 5, F.lit("  ")).otherwise(event)
    return events.select("type", "ym", *E.TOTAL_ORDER, line.alias("value"))


_LINES = (
    "SELECT type, ts, source_rank, seq, sub_seq, id_value, CASE WHEN seq % 40 = 3 THEN 'broken' WHEN seq % 40 = 5 THEN 'blank' "
    f"WHEN seq % 50 = 7 THEN 'unknown' WHEN type IN ({quoted(HANDLED)}) THEN 'good' ELSE 'unsupported' END AS state "
    f"FROM ({_ALL_EVENTS})"
)


@register(
    "A16_ingest_counters",
    query(
        "SELECT count(*) FILTER (WHERE state <> 'blank') AS total_lines, count(*) FILTER (WHERE state = 'good') AS success, "
        "count(*) FILTER (WHERE state = 'broken') AS json_errors, "
        "count(*) FILTER (WHERE state IN ('unknown', 'unsupported')) AS event_errors, "
        f"count(*) FILTER (WHERE state = 'blank') AS skipped_empty FROM ({_LINES})"
    ),
)
def a16(spark, sf):
    path = scratch_path(spark, "lines")
    json_lines(spark, sf).select("value").write.text(path)
    return I.ingest_counters(I.checked_events(parse_events(numbered_lines(spark, path))), blank_lines(spark, path))


# An event type that the ingest does not handle would be the first error of all.
_KNOWN = f"SELECT * FROM ({_LINES}) WHERE state <> 'blank' AND type IN ({quoted(HANDLED)})"


@register(
    "W04_until_first_error",
    query(
        f"SELECT count(*) AS kept, max(seq) AS last FROM ({_KNOWN}) l WHERE seq <= "
        f"(SELECT min(seq) FROM ({_KNOWN}) x WHERE x.state IN ('broken', 'unknown'))"
    ),
)
def w04(spark, sf):
    kept = I.until_first_error(_checked(spark, sf).filter(F.col("kind").isin(*HANDLED)), F.col("seq"))
    return kept.agg(F.count(F.lit(1)).alias("kept"), F.max("seq").alias("last"))


_CHECKED: dict[tuple[str, str], str] = {}


def _checked(spark, sf) -> DataFrame:
    """Checked events, written once per application and input."""
    known = (spark.sparkContext.applicationId, sf)
    if known not in _CHECKED:
        path = scratch_path(spark, "checked")
        lines = json_lines(spark, sf).filter(F.trim("value") != "").select(F.col("type").alias("kind"), "seq", "value")
        I.checked_events(parse_events(lines)).write.parquet(path)
        _CHECKED[known] = path
    return spark.read.parquet(_CHECKED[known])


_DATASET = "CASE type " + " ".join(f"WHEN '{t}' THEN '{d}'" for t, (d, *_) in I.EVENT_FEEDS.items()) + " END"


@register(
    "ST2_dispatch",
    query(
        f"SELECT {_DATASET} AS dataset, count(*) AS applied FROM ({_LINES}) WHERE state = 'good' AND type <> 'risk_assessment' GROUP BY 1"
    ),
)
def st2(spark, sf):
    applied = I.feed_rows(I.accepted(_checked(spark, sf)), F.col("seq"))
    return E.union_all([r.agg(F.count(F.lit(1)).alias("applied")).select(F.lit(d).alias("dataset"), "applied") for d, r in applied.items()])


_GOOD = "coalesce(seq % 40 NOT IN (3, 5) AND seq % 50 <> 7, true)"


def _good(block: str) -> str:
    return f"(SELECT * FROM {block} WHERE {_GOOD})"


_CHANGED = BLOCKS["changes"].replace("FROM c_customer_log", f"FROM {_good('c_customer_log')}")


def _set(*columns: str) -> str:
    return " + ".join(f"({c} IS NOT NULL) :: INT" for c in columns)


# Columns of the results after event_type, seq and uid; each kind has some of them.
_RESULT_COLUMNS = {
    "deduplicated": "BOOLEAN",
    "identity_changed": "BOOLEAN",
    "phone_changed": "BOOLEAN",
    "merged_targets": "INT",
    "linked_fields": "INT",
    "card_phone_links": "INT",
    "identity_updated": "BOOLEAN",
    "phone_updated": "BOOLEAN",
    "id_type": "VARCHAR",
    "id_value": "VARCHAR",
    "updated": "BOOLEAN",
    "message": "VARCHAR",
}


def _result(kind: str, source: str, uid: str = "uid", **given: str) -> str:
    columns = ", ".join(f"{given.get(c, 'NULL')} :: {t} AS {c}" for c, t in _RESULT_COLUMNS.items())
    return f"SELECT '{kind}' AS event_type, seq, {uid} :: VARCHAR AS uid, {columns} FROM {source}"


_RESULTS = " UNION ALL ".join(
    [
        _result(
            "customer_update",
            f"({_CHANGED})",
            deduplicated="(NOT identity_changed AND NOT phone_changed)",
            identity_changed="identity_changed",
            phone_changed="phone_changed",
        ),
        _result("login", _good("c_login"), merged_targets=f"({_set('phone_num', 'device_no', 'td_device_id', 'remote_ip')})"),
        _result("gps", _good("c_lbs_gps")),
        _result("contact_edit", _good("c_contacts")),
        _result(
            "order",
            _good("c_order"),
            linked_fields=f"({_set('apply_loan_tel', 'apply_ident_no', 'apply_card_no', 'repay_card_no')})",
            card_phone_links="((apply_card_no IS NOT NULL AND apply_bank_mobile IS NOT NULL) :: INT + "
            "(repay_card_no IS NOT NULL AND repay_bank_mobile IS NOT NULL) :: INT)",
        ),
        _result("logout", _good("c_logout"), identity_updated="(identity_no IS NOT NULL)", phone_updated="(phone_num IS NOT NULL)"),
        _result(
            "risk_assessment",
            f"(SELECT o.seq, i.id_type AS t, i.id_value AS v FROM {_good('fx_order')} o JOIN ({_IDS}) i ON i.order_id = o.id)",
            uid="NULL",
            id_type="t",
            id_value="v",
            updated="false",
            message=f"'{I.RISK_MESSAGE}'",
        ),
    ]
)


@register("ST3_event_results", query(_RESULTS))
def st3(spark, sf):
    good = I.accepted(_checked(spark, sf))
    out = I.event_results(I.feed_rows(good, F.col("seq")), risk=good.filter(F.col("type") == "risk_assessment"))
    return out.select("event_type", "seq", "uid", *_RESULT_COLUMNS)


@register(
    "ST4_error_rows",
    query(
        "SELECT CASE state WHEN 'broken' THEN 'Invalid JSON' WHEN 'unknown' THEN 'Unsupported event type: surprise' "
        "ELSE 'Unsupported event type: ' || type END AS error, "
        f"count(*) AS n FROM ({_LINES}) WHERE state NOT IN ('blank', 'good') GROUP BY 1"
    ),
)
def st4(spark, sf):
    return I.rejected(_checked(spark, sf)).groupBy("error").agg(F.count(F.lit(1)).alias("n"))


_FIRST = "seq % 2 = 1"


_CHANGE_RESULTS = (
    f"SELECT seq, uid, identity_changed, phone_changed FROM ({_CHANGED.replace(_GOOD, _GOOD + ' AND ' + _FIRST)}) "
    f"UNION ALL SELECT seq, uid, identity_changed, phone_changed FROM ({_CHANGED}) WHERE NOT ({_FIRST})"
)


def _change_results(spark, sf, fold: bool) -> DataFrame:
    """Customer changes as two batches report them, each compared with the rows known by then; both are delivered twice."""
    store = GraphStore(spark, scratch_path(spark, "result-store"))
    events = _checked(spark, sf).filter(F.col("kind") == "customer_update").withColumn("line", F.col("seq"))
    for batch, part in enumerate((events.filter(_FIRST), events.filter(f"NOT ({_FIRST})"))):
        for _ in range(2):
            I.apply_batch(store, part.drop("seq", "kind", "error"), batch, results=True)
        if fold and batch == 0:
            store.compact()
    return store.results().select("seq", "uid", "identity_changed", "phone_changed")


@register("ST5_change_results", query(_CHANGE_RESULTS))
def st5(spark, sf):
    return _change_results(spark, sf, fold=False)


@register("ST5_folded_results", query(_CHANGE_RESULTS))
def st5_folded(spark, sf):
    """The rows of the first batch are folded before the second comes."""
    return _change_results(spark, sf, fold=True)


@register(
    "G09_risk_snapshots",
    query(f"SELECT i.id_type, i.id_value, count(*) AS n FROM ({_IDS}) i GROUP BY 1, 2"),
)
def g09(spark, sf):
    feeds = raw_feeds(spark, sf)
    risk = E.risk_events(E.risk_rows(feeds["order"], E.default_labels(feeds)))
    lines = risk.select(F.to_json(F.struct("type", iso_text("ts").alias("ts"), "id_type", "id_value", "labels")).alias("value"))
    kept = I.risk_snapshots(I.accepted(I.checked_events(parse_events(lines))))
    return kept.groupBy("id_type", "id_value").agg(F.count(F.lit(1)).alias("n"))


def _streamed_rows() -> str:
    """Edge rows of the accepted lines: those blocks of the graph's edge rows whose feeds have handled events."""
    out = []
    for part in BLOCKS["edge_rows"].split(" UNION ALL "):
        block = re.search(r"FROM (\w+)", part).group(1)
        if block == "changes":
            out.append(part.replace("FROM changes", f"FROM ({_CHANGED})"))
        elif block in ("c_login", "c_lbs_gps", "c_contacts", "c_order"):
            out.append(part.replace(f"FROM {block}", f"FROM {_good(block)}"))
    return " UNION ALL ".join(out)


#: Bytes of event files that one batch of a replay takes.
REPLAY_BYTES = 2 << 30

_EDGE_COLUMNS = "src_type, src_key, rel, dst_type, dst_key"


@register(
    "ST1_stream_ingest",
    query(
        f"SELECT {_EDGE_COLUMNS}, min(ts) AS first_seen_ts, max(ts) AS last_seen_ts, count(*) AS event_count "
        f"FROM ({_streamed_rows()}) GROUP BY ALL"
    ),
)
def st1(spark, sf):
    """Files of all events read as a stream into the stored graph, some files per batch."""
    path, store_path, checkpoint = (scratch_path(spark, n) for n in ("events-in", "stream-store", "stream-ck"))
    json_lines(spark, sf).select("value").write.text(path)
    store = GraphStore(spark, store_path)
    I.start_ingest(I.read_event_stream(spark, path, max_files=4), store, checkpoint).awaitTermination()
    return store.read().edges


@register(
    "S09_ordered_replay",
    query(
        f"SELECT {_EDGE_COLUMNS}, min(ts) AS first_seen_ts, max(ts) AS last_seen_ts, count(*) AS event_count "
        f"FROM ({_streamed_rows()}) GROUP BY ALL"
    ),
)
def s09_replay(spark, sf):
    """Files of all events in time order, replayed by path, and replayed again."""
    path = scratch_path(spark, "replay-in")
    json_lines(spark, sf).repartitionByRange(*E.TOTAL_ORDER).sortWithinPartitions(*E.TOTAL_ORDER).select("value").write.text(path)
    store = GraphStore(spark, scratch_path(spark, "replay-store"))
    for _ in range(2):
        I.replay(spark, store, path, "events", glob="part-*", batch_bytes=REPLAY_BYTES)
    return store.read().edges


def _late_and_repeated(spark, sf, fold: bool = False) -> DataFrame:
    """All feeds, later rows first, then the earlier ones; every batch delivered twice."""
    store = GraphStore(spark, scratch_path(spark, "late-store"))
    feeds = {d: rows(spark, sf, d) for d in raw_feeds(spark, sf)}
    for batch, late in enumerate((True, False)):
        part = {d: r.filter((F.pmod(F.coalesce("seq", F.xxhash64(*r.columns)), F.lit(3)) == 0) == late) for d, r in feeds.items()}
        store.append("parts", batch, part)
        store.append("parts", batch, part)
        if fold and late:
            store.compact()
    return store.read().edges


@register("ST6_repeated_batches", query("SELECT rel, count(*) AS edges, sum(event_count) AS events FROM edges GROUP BY 1"))
def st6(spark, sf):
    return (
        _late_and_repeated(spark, sf)
        .groupBy("rel")
        .agg(F.count(F.lit(1)).alias("edges"), F.sum("event_count").alias("events"))
    )


@register(
    "ST7_update_window",
    query("SELECT node_type, key, uid_count FROM bucket_counts WHERE bucket IN ('ip', 'geo')"),
)
def st7(spark, sf):
    links = windowed_links(graph(spark, sf)).distinct()
    return links.groupBy("node_type", "key").agg(F.count(F.lit(1)).alias("uid_count"))


@register("ST8_late_data", query(f"SELECT {_EDGE_COLUMNS}, first_seen_ts, last_seen_ts, event_count FROM edges"))
def st8(spark, sf):
    return _late_and_repeated(spark, sf)


@register("ST8_late_after_fold", query(f"SELECT {_EDGE_COLUMNS}, first_seen_ts, last_seen_ts, event_count FROM edges"))
def st8_fold(spark, sf):
    """The later rows are folded before the earlier ones come."""
    return _late_and_repeated(spark, sf, fold=True)
