"""Feeds derived from the star-schema test tables, so every job runs on given data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TABLES: dict[tuple[str, str, str], DataFrame] = {}
_FEEDS: dict[tuple[str, str], dict[str, DataFrame]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; the scan is planned once per application."""
    known = (spark.sparkContext.applicationId, sf_dir, name)
    if known not in _TABLES:
        _TABLES[known] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _TABLES[known]


def raw_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Dataset name -> raw feed."""
    known = (spark.sparkContext.applicationId, sf_dir)
    if known not in _FEEDS:
        feeds = _build(spark, sf_dir)
        derived = {"first_linkman_derived": derived_linkman(feeds), "second_linkman_derived": derived_second_linkman(feeds)}
        _FEEDS[known] = feeds | derived
    return dict(_FEEDS[known])


_OWN_PHONE = "concat('p', user_id % 97)"
_OWN_IDENTITY = "concat('i', user_id)"
_CASE = [
    "event_id AS c_id",
    "concat('p', k) AS c_contact_phone_no",
    f"{_OWN_PHONE} AS c_register_phone_no",
    f"{_OWN_IDENTITY} AS c_identity_no",
    "ts AS d_update",
]


def _build(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "CAST(ts AS TIMESTAMP_NTZ) AS ts",
        "user_id",
        "event_type",
        "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k",
    )
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return {
        "customer_log": events.filter("event_type = 'error' AND k >= 5").selectExpr(
            "concat('U', user_id) AS baseid",
            f"CASE WHEN k % 11 <> 0 THEN {_OWN_IDENTITY} END AS identity_no",
            "concat('p', (user_id + k % 3) % 97) AS mobile_phone",
            "ts AS log_create_date",
            "event_id AS seq",
        ),
        "login": events.filter("event_type IN ('click', 'view')").selectExpr(
            f"{_OWN_PHONE} AS phone_num",
            "concat('U', user_id) AS cif_user_id",
            "ts AS login_time",
            "CASE k WHEN 0 THEN 'unknown' WHEN 1 THEN ' D1 ' WHEN 2 THEN 'NaN' ELSE concat('d', k) END AS device_no",
            "concat('ip', event_id % 211) AS remote_ip",
            "CASE WHEN event_type = 'click' THEN 'APP' ELSE 'WEB' END AS app_channel",
            "CASE WHEN k % 10 <> 0 THEN concat('t', k % 25) END AS td_device_id",
            "event_id AS seq",
        ),
        "lbs_gps": events.filter("event_type = 'signup'").selectExpr(
            "concat('U', user_id) AS cid", "concat('g', k % 40) AS geo_code", "ts AS create_date", "event_id AS seq"
        ),
        "first_linkman": events.filter("event_type = 'purchase' AND event_id % 2 = 0").selectExpr(
            "concat('U', user_id) AS cid", "concat('p', k) AS mobile_phone", "ts AS create_date", "event_id AS seq"
        ),
        "second_linkman": events.filter("event_type = 'purchase' AND event_id % 2 = 1").selectExpr(
            "concat('U', user_id) AS cid", "concat('p', k + 50) AS second_mobile_phone", "ts AS create_date", "event_id AS seq"
        ),
        "logout": events.filter("event_type = 'error' AND k < 5").selectExpr(
            "concat('U', user_id) AS cid",
            f"{_OWN_IDENTITY} AS identity_no",
            f"{_OWN_PHONE} AS mobile_phone",
            "ts AS create_date",
            "event_id AS seq",
        ),
        "order": table(spark, sf_dir, "orders").selectExpr(
            "concat('O', o_orderkey) AS id",
            "concat('U', o_custkey) AS user_id",
            "concat('p', o_custkey % 97) AS apply_loan_tel",
            "concat('i', o_custkey) AS apply_ident_no",
            "concat('c', o_custkey % 1201) AS apply_card_no",
            "concat('p', o_custkey % 89) AS apply_bank_mobile",
            "CASE WHEN o_orderkey % 10 <> 0 THEN concat('c', o_orderkey % 997) END AS repay_card_no",
            "concat('p', o_custkey % 83) AS repay_bank_mobile",
            "CASE o_orderstatus WHEN 'P' THEN 'OVERDUE' WHEN 'F' THEN 'REPAYED' ELSE 'REPAYING' END AS order_status",
            "CAST(o_orderdate AS TIMESTAMP_NTZ) AS create_date",
            "o_orderkey AS seq",
        ),
        "repay_plan": table(spark, sf_dir, "lineitem").selectExpr(
            "concat('R', l_orderkey, '-', l_linenumber) AS id",
            "concat('O', l_orderkey) AS order_id",
            "CAST(l_shipdate AS TIMESTAMP_NTZ) AS current_repay_date",
            "CASE WHEN l_returnflag <> 'N' THEN CAST(l_shipdate AS TIMESTAMP_NTZ) END AS repayed_date",
            "l_returnflag AS overdue_mark",
            "l_linestatus AS current_repay_status",
            "CAST(l_shipdate AS TIMESTAMP_NTZ) AS modify_date",
        ),
        "company_log": customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
            "concat('U', c_custkey) AS cid",
            "n_name AS company_name",
            "TIMESTAMP_NTZ '2023-12-01 00:00:00' AS modify_date",
            "c_custkey AS seq",
        ),
        "complaint": events.filter("event_type = 'error' AND k >= 90").selectExpr(*_CASE),
        "consumer_protection_case": events.filter("event_type = 'error' AND k BETWEEN 80 AND 89").selectExpr(*_CASE),
        "blacklist_log": customers.filter("c_acctbal < 0").selectExpr(
            "concat('U', c_custkey) AS c_customer_no",
            "CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS c_reason_list",
            "concat('p', c_custkey % 97) AS c_mobile_phone",
            "concat('i', c_custkey) AS c_identity_no",
            "CASE WHEN c_custkey % 5 = 0 THEN TIMESTAMP_NTZ '2025-12-01 00:00:00' "
            "ELSE TIMESTAMP_NTZ '2023-11-20 00:00:00' END AS d_begin_date",
            "c_custkey AS seq",
        ),
    }


def derived_linkman(feeds: dict[str, DataFrame]) -> DataFrame:
    """A derived contact feed: some rows are in the base feed, the others are not."""
    return feeds["first_linkman"].selectExpr(
        "cid",
        "CASE WHEN seq % 4 = 0 THEN mobile_phone ELSE concat(mobile_phone, 'x') END AS mobile_phone",
        "create_date",
        "seq",
    )


def derived_second_linkman(feeds: dict[str, DataFrame]) -> DataFrame:
    """The same for the second contacts."""
    return feeds["second_linkman"].selectExpr(
        "cid",
        "CASE WHEN seq % 3 = 0 THEN second_mobile_phone ELSE concat(second_mobile_phone, 'y') END AS second_mobile_phone",
        "create_date",
        "seq",
    )
