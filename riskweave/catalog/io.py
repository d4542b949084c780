"""Sources and sinks: the test tables written and read back."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from riskweave import rules
from riskweave.catalog import register
from riskweave.catalog.context import feed, graph, rows
from riskweave.catalog.sql import FEED_SQL, query, quoted
from riskweave.catalog.streams import _ALL_EVENTS, _LINES, HANDLED, POSITIONS, _stream, json_lines
from riskweave.fixtures import raw_feeds, table
from riskweave.functions.timeparse import parse_text_time
from riskweave.operators import events as E
from riskweave.operators import relational as rel
from riskweave.operators.feeds import FEEDS, valid_rows
from riskweave.session import scratch_path
from riskweave.sources import files, sinks


def _write_csv(df: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    (
        text.write.option("header", "true")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("encoding", encoding)
        .csv(path)
    )


@register("S01_csv_scan", query("SELECT uid, phone_num, device_no, td_device_id, remote_ip, ts, seq FROM c_login"))
def s01(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    login = feed(spark, sf, "login")
    _write_csv(login.toDF(*[f" {c.upper()}" for c in login.columns]), f"{path}/2024-01")
    return valid_rows("login", files.read_feed(spark, path))


def gbk_bytes(text: Column) -> Column:
    """The GBK bytes of texts as Latin-1 characters, to write a file in GBK."""

    @F.pandas_udf(StringType())
    def encoded(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t.encode("gbk").decode("latin-1"), na_action="ignore")

    return encoded(text)


@register(
    "S02_mixed_encodings",
    "SELECT n_name || CASE n_nationkey % 3 WHEN 0 THEN ' é' WHEN 1 THEN ' 中' ELSE ' 渠道' END AS name, n_nationkey AS id FROM nation",
)
def s02(spark, sf):
    path = scratch_path(spark, "encodings")
    n = table(spark, sf, "nation")
    key = F.col("n_nationkey")
    latin = n.filter(key % 3 == 0).select(key.alias("id"), F.concat("n_name", F.lit(" é")).alias("name"))
    gbk = n.filter(key % 3 == 2).select(key.alias("id"), gbk_bytes(F.concat("n_name", F.lit(" 渠道"))).alias("name"))
    utf8 = n.filter(key % 3 == 1).select(F.concat("n_name", F.lit(" 中")).alias("name"), key.alias("id"))
    _write_csv(latin, f"{path}/a", "ISO-8859-1")
    _write_csv(utf8, f"{path}/b")
    _write_csv(gbk, f"{path}/c", "ISO-8859-1")
    return files.read_mixed_feed(spark, path).select("name", F.col("id").cast("int").alias("id"))


@register(
    "S03_projected_scan",
    query("SELECT id, user_id, create_date FROM fx_order WHERE seq % 7 <> 0"),
)
def s03(spark, sf):
    text = F.when(F.col("seq") % 7 == 0, "no date").otherwise(F.col("create_date").cast("string"))
    return files.read_month(
        feed(spark, sf, "order").withColumn("create_date", text), ["id", "user_id", "create_date"], "create_date"
    )


@register(
    "S04_labels_and_missing_file",
    query("SELECT c_customer_no, coalesce(c_reason_list, '') AS c_reason_list FROM fx_blacklist_log"),
)
def s04(spark, sf):
    columns = ["c_customer_no", "c_reason_list"]
    absent = files.read_or_empty(spark, scratch_path(spark, "absent"), columns)
    return files.load_labels(feed(spark, sf, "blacklist_log"), columns).unionByName(absent)


@register(
    "S05_day_partitions",
    query(
        "SELECT strftime(login_time, '%Y-%m') AS ym, strftime(login_time, '%Y-%m-%d') AS dt, count(*) AS n, "
        "count(DISTINCT cif_user_id) AS uids FROM fx_login GROUP BY ALL"
    ),
)
def s05(spark, sf):
    path = scratch_path(spark, "days")
    sinks.write_by_day(feed(spark, sf, "login"), "login_time", path)
    back = spark.read.option("header", "true").option("inferSchema", "false").csv(path)
    pairs = back.groupBy("ym", "dt", "cif_user_id").agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy(F.col("ym").cast("string").alias("ym"), F.date_format("dt", "yyyy-MM-dd").alias("dt")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("uids")
    )


@register(
    "S06_months",
    query(
        "SELECT DISTINCT strftime(ts, '%Y-%m') AS ym FROM ("
        + " UNION ALL ".join(f"SELECT {FEEDS[d].event_time} AS ts FROM {source}" for d, source in FEED_SQL.items())
        + ")"
    ),
)
def s06(spark, sf):
    return sinks.months(raw_feeds(spark, sf), {d: feed.event_time for d, feed in FEEDS.items()})


@register(
    "S07_event_months",
    query(f"SELECT strftime(ts, '%Y-%m') AS ym, type, count(*) AS n, max(ts) AS last FROM ({_ALL_EVENTS}) GROUP BY 1, 2"),
)
def s07(spark, sf):
    path = scratch_path(spark, "events")
    sinks.write_events(_stream(spark, sf), path)
    back = spark.read.schema("type string, ts string, ym string").json(path)
    return back.groupBy("ym", "type").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("ts").cast("timestamp_ntz")).alias("last")
    )


@register(
    "S08_event_lines",
    query(f"SELECT state, count(*) AS n FROM ({_LINES}) WHERE state <> 'blank' GROUP BY 1"),
)
def s08(spark, sf):
    path = scratch_path(spark, "lines")
    json_lines(spark, sf).select("value").write.text(path)
    parsed = files.parse_events(files.numbered_lines(spark, path))
    state = F.when(F.col("corrupt").isNotNull(), "broken").when(F.col("type") == "surprise", "unknown")
    state = state.when(F.col("type").isin(*HANDLED), "good").otherwise("unsupported")
    return parsed.groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


# The last line that could be read before this time is the last one done.
_DONE = "2024-01-15 12:00:00"
_IN_FILES = (
    "SELECT *, row_number() OVER (ORDER BY strftime(ts, '%Y-%m'), ts, source_rank, seq NULLS FIRST, sub_seq) AS place "
    f"FROM ({_LINES})"
)


@register(
    "S09_resume",
    query(
        "SELECT strftime(ts, '%Y-%m') AS ym, CASE state WHEN 'broken' THEN NULL WHEN 'unknown' THEN 'surprise' ELSE type END "
        f"AS type, count(*) AS n FROM ({_IN_FILES}) WHERE state <> 'blank' AND place > (SELECT max(place) FROM ({_IN_FILES}) x "
        f"WHERE x.state NOT IN ('broken', 'blank') AND x.ts < TIMESTAMP '{_DONE}') GROUP BY 1, 2"
    ),
)
def s09(spark, sf):
    """All lines in a folder for each month; those after a checkpoint, a file and a line in it."""
    path = scratch_path(spark, "resume")
    order = ["ym", *E.TOTAL_ORDER]
    lines = json_lines(spark, sf).repartitionByRange(*order).sortWithinPartitions(*order)
    lines.select("ym", "value").write.partitionBy("ym").text(path)
    read = files.parse_events(files.numbered_lines(spark, path))
    before = parse_text_time("ts") < F.lit(_DONE).cast("timestamp_ntz")
    done = read.filter(before).agg(F.max(F.struct("file", "line")).alias("p")).first().p
    later = files.after_checkpoint(read, done.file, done.line)
    return later.groupBy(F.regexp_extract("file", "ym=([0-9-]+)/", 1).alias("ym"), "type").agg(F.count(F.lit(1)).alias("n"))


@register("S11_result_lines", query("SELECT device_no, uid_count FROM device_users"))
def s11(spark, sf):
    path = scratch_path(spark, "tsv")
    sinks.write_tsv(rel.device_user_counts(graph(spark, sf).edges), path)
    return spark.read.option("sep", "\t").schema("device_no string, uid_count long").csv(path)


@register(
    "S12_json_report",
    query(
        "SELECT 'statuses' AS part, order_status AS name, count(*) AS n FROM fx_order GROUP BY 2 UNION ALL "
        "SELECT 'channels', app_channel, count(*) FROM fx_login GROUP BY 2"
    ),
)
def s12(spark, sf):
    path = scratch_path(spark, "report")
    feeds = raw_feeds(spark, sf)
    parts = {
        "statuses": feeds["order"].groupBy(F.col("order_status").alias("name")).agg(F.count(F.lit(1)).alias("n")),
        "channels": feeds["login"].groupBy(F.col("app_channel").alias("name")).agg(F.count(F.lit(1)).alias("n")),
    }
    sinks.write_report(parts, path)
    row = F.from_json("value", "name string, n long")
    return spark.read.text(path).select(F.col("part").cast("string").alias("part"), row.alias("r")).select("part", "r.*")


@register(
    "S13_sample_file",
    query("SELECT least(count(*), 1000) AS sampled, least(count(*), 1000) AS known FROM fx_order"),
)
def s13(spark, sf):
    path = scratch_path(spark, "sample")
    order = feed(spark, sf, "order")
    sinks.write_sample(order, path)
    sample = spark.read.option("header", "true").csv(path)
    flagged = sample.join(order.select("id", F.lit(1).alias("k")), "id", "left")
    return flagged.agg(F.count(F.lit(1)).alias("sampled"), F.count("k").alias("known"))


@register(
    "S14_event_slice",
    query(f"SELECT type, ts, seq, sub_seq, position FROM ({POSITIONS}) WHERE position BETWEEN 5000 AND 14999"),
)
def s14(spark, sf):
    return sinks.slice_events(_stream(spark, sf)).select("type", "ts", "seq", "sub_seq", "position")


#: Columns that the delivered files lack.
LACKING = {"order": ("id", "order_status"), "login": ("device_no",), "second_linkman_derived": ("cid",)}


def _delivered(spark, sf) -> str:
    """Every feed as a CSV folder with untidy column names, without the columns that LACKING names."""
    path = scratch_path(spark, "delivered")
    for d, df in raw_feeds(spark, sf).items():
        kept = [c for c in df.columns if c not in LACKING.get(d, ())]
        _write_csv(df.select(*[F.col(c).alias(c.upper() if i % 2 else f" {c}") for i, c in enumerate(kept)]), f"{path}/{d}")
    return path


def _header_sql(dataset: str) -> str:
    """The columns of a feed's rows in the checking SQL, those lacking left out."""
    columns = _CASE_COLUMNS if dataset in ("complaint", "consumer_protection_case") else "*"
    lacking = f"[{quoted(LACKING[dataset])}]" if dataset in LACKING else "[]"
    return (
        f"SELECT '{dataset}' AS dataset, list_filter(json_keys(to_json(t)), lambda x: NOT list_contains({lacking}, x)) AS header "
        f"FROM (SELECT {columns} FROM {FEED_SQL[dataset]}) t LIMIT 1"
    )


_CASE_COLUMNS = "c_id, c_contact_phone_no, c_register_phone_no, c_identity_no, d_update"
_HEADERS = " UNION ALL ".join(f"SELECT * FROM ({_header_sql(d)})" for d in FEED_SQL)


@register(
    "S15_header_catalogue",
    query(
        "SELECT dataset, pos, header[pos + 1] AS \"column\" FROM (SELECT dataset, header, unnest(range(len(header))) AS pos "
        f"FROM ({_HEADERS}))"
    ),
)
def s15(spark, sf):
    headers = files.header_catalogue(spark, _delivered(spark, sf), list(rules.REQUIRED_COLUMNS))
    return headers.select("dataset", F.posexplode("header").alias("pos", "column"))


_RULES = ", ".join(
    f"('{d}', [{quoted(names)}], [{', '.join(f'[{quoted(g)}]' for g in rules.REQUIRED_ANY_OF.get(d, []))}] :: VARCHAR[][])"
    for d, names in rules.REQUIRED_COLUMNS.items()
)


@register(
    "P13_header_rules",
    query(
        "SELECT dataset, missing = '' AND unmet = 0 AS ok, missing, unmet FROM (SELECT dataset, "
        "array_to_string(list_filter(required, lambda x: NOT list_contains(header, x)), ',') AS missing, "
        "len(list_filter(any_of, lambda g: NOT list_has_any(header, g))) AS unmet "
        f"FROM ({_HEADERS}) JOIN (VALUES {_RULES}) r(dataset, required, any_of) USING (dataset))"
    ),
)
def p13(spark, sf):
    path = _delivered(spark, sf)
    parts = [files.file_headers(spark, f"{path}/{d}").withColumn("dataset", F.lit(d)) for d in raw_feeds(spark, sf)]
    checked = files.validate_headers(reduce(DataFrame.unionByName, parts))
    return checked.select(
        "dataset", "ok", F.array_join("missing", ",").alias("missing"), F.size("missing_any_of").alias("unmet")
    ).distinct()


@register(
    "S08_event_roundtrip",
    query("SELECT seq, ts FROM c_lbs_gps"),
)
def s08_roundtrip(spark, sf):
    """Events of one feed through JSON text and back."""
    events = E.source_events({"lbs_gps": feed(spark, sf, "lbs_gps")})
    lines = events.select("seq", F.to_json(F.struct("type", F.col("ts").cast("string").alias("ts"), "data")).alias("value"))
    return files.parse_events(lines).select("seq", F.col("ts").cast("timestamp_ntz").alias("ts"))
