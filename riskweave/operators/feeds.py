"""Feed registry: how each raw dataset becomes cleaned rows.

``prepare`` keeps every row and names what is missing, ``valid_rows`` keeps the
complete ones, ``row_accounting`` counts both in one pass.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.clean import (
    blacklist_status,
    clean_columns,
    clean_device,
    clean_key,
    clean_text,
    first_existing,
    first_value,
)
from riskweave.functions.timeparse import first_existing_time, first_parsed_time, parse_time

Resolver = Callable[[DataFrame], Column]


def _key(*names: str) -> Resolver:
    return lambda df: clean_key(first_existing(df, names))


def _text(*names: str) -> Resolver:
    return lambda df: clean_text(first_existing(df, names))


def _device(*names: str) -> Resolver:
    return lambda df: clean_device(first_existing(df, names))


def _time(*names: str) -> Resolver:
    return lambda df: first_existing_time(df, names)


def _case_key(prefix: str) -> Resolver:
    return lambda df: F.concat(F.lit(f"{prefix}:"), clean_text(first_existing(df, ["c_id"])))


@dataclass(frozen=True)
class Feed:
    """Cleaned columns of a dataset; rows lacking a required one are skipped."""

    columns: dict[str, Resolver]
    required: tuple[str, ...]
    event_time: str = field(default="")


_UID_ANY = ("cid", "cif_user_id", "user_id", "baseid", "id")

_CONTACT = Feed(
    {
        "uid": _key("cid"),
        "phone_num": partial(
            first_value, candidates=("mobile_phone", "second_mobile_phone", "phone_num")
        ),
        "ts": partial(first_parsed_time, candidates=("create_date", "modify_date", "ts")),
    },
    ("uid", "ts", "phone_num"),
    "create_date",
)


def _case(prefix: str, source: str) -> Feed:
    return Feed(
        {
            "case_key": _case_key(prefix),
            "identity_no": _key("c_identity_no"),
            "register_phone": _key("c_register_phone_no"),
            "contact_phone": _key("c_contact_phone_no"),
            "source": lambda df: F.lit(source),
            "ts": _time("d_update"),
        },
        ("ts", "case_key"),
        "d_update",
    )


FEEDS: dict[str, Feed] = {
    "customer_log": Feed(
        {
            "uid": _key("baseid"),
            "identity_no": _key("identity_no"),
            "phone_num": _key("mobile_phone"),
            "ts": _time("log_create_date"),
        },
        ("uid", "ts"),
        "log_create_date",
    ),
    "login": Feed(
        {
            "uid": _key("cif_user_id", "cid", "baseid", "user_id", "id"),
            "phone_num": _key("phone_num"),
            "device_no": _device("device_no"),
            "td_device_id": _key("td_device_id"),
            "remote_ip": _key("remote_ip"),
            "ts": _time("login_time", "create_date", "modify_date", "ts"),
        },
        ("uid", "ts"),
        "login_time",
    ),
    "lbs_gps": Feed(
        {
            "uid": _key(*_UID_ANY),
            "geo_code": _key("geo_code", "adcode", "geo", "location_code"),
            "ts": _time("create_date", "modify_date", "ts"),
        },
        ("uid", "ts", "geo_code"),
        "create_date",
    ),
    "first_linkman": _CONTACT,
    "second_linkman": _CONTACT,
    "first_linkman_derived": _CONTACT,
    "second_linkman_derived": _CONTACT,
    "logout": Feed(
        {
            "uid": _key("cid"),
            "identity_no": _key("identity_no"),
            "phone_num": _key("mobile_phone"),
            "ts": _time("create_date"),
        },
        ("uid", "ts"),
        "create_date",
    ),
    "order": Feed(
        {
            "order_id": _text("id"),
            "uid": _key("user_id"),
            "order_status": _text("order_status"),
            "apply_loan_tel": _key("apply_loan_tel"),
            "apply_ident_no": _key("apply_ident_no"),
            "apply_card_no": _key("apply_card_no"),
            "apply_bank_mobile": _key("apply_bank_mobile"),
            "repay_card_no": _key("repay_card_no"),
            "repay_bank_mobile": _key("repay_bank_mobile"),
            "ts": _time("create_date"),
        },
        ("order_id", "uid", "ts"),
        "create_date",
    ),
    "repay_plan": Feed(
        {
            "order_id": _text("order_id"),
            "repay_plan_id": _text("id"),
            "due_date": _time("current_repay_date"),
            "repayed_date": _time("repayed_date"),
            "early_mark": _text("early_repay_mark"),
            "overdue_mark": _text("overdue_mark"),
            "overdue_days": _text("overdue_days"),
            "plan_status": _text("current_repay_status"),
            "ts": _time("modify_date"),
        },
        ("ts", "order_id", "repay_plan_id"),
        "modify_date",
    ),
    "company_log": Feed(
        {
            "uid": _key("cid"),
            "company_name": _key("company_name"),
            "ts": _time("modify_date", "create_date", "ts"),
        },
        ("uid", "ts", "company_name"),
        "modify_date",
    ),
    "complaint": _case("complaint", "complaint"),
    "consumer_protection_case": _case("consumer", "consumer_protection_case"),
    "blacklist_log": Feed(
        {
            "uid": _key("c_customer_no"),
            "identity_no": _key("c_identity_no"),
            "phone_num": _key("c_mobile_phone"),
            "reason_list": _text("c_reason_list"),
            "status": lambda df: blacklist_status(clean_text(first_existing(df, ["c_reason_list"]))),
            "ts": _time("d_begin_date"),
        },
        ("ts",),
        "d_begin_date",
    ),
}


def prepare(dataset: str, raw: DataFrame, max_ts: str | None = None) -> DataFrame:
    """Cleaned columns, ``seq`` and ``missing`` (names of absent required columns).

    ``seq`` breaks ties between equal times; a feed without it ties on content.
    ``max_ts`` is the exclusive upper time bound of the blacklist.
    """
    feed = FEEDS[dataset]
    df = clean_columns(raw)
    seq = F.col("seq").cast("long") if "seq" in df.columns else F.lit(None).cast("long")
    out = df.select(*[resolve(df).alias(name) for name, resolve in feed.columns.items()], seq.alias("seq"))
    lacking = [F.when(F.col(c).isNull(), F.lit(c)) for c in feed.required]
    if max_ts is not None:
        lacking.append(F.when(~_before(max_ts), F.lit("time_before_cut")))
    return out.withColumn("missing", F.array_compact(F.array(*lacking)))


def _before(max_ts: str) -> Column:
    return F.col("ts") < F.lit(max_ts).cast("timestamp_ntz")


def valid_rows(dataset: str, raw: DataFrame, max_ts: str | None = None) -> DataFrame:
    rows = prepare(dataset, raw, max_ts).drop("missing")
    for name in FEEDS[dataset].required:
        rows = rows.filter(F.col(name).isNotNull())
    return rows.filter(_before(max_ts)) if max_ts is not None else rows


def backfill_rows(dataset: str, raw: DataFrame) -> DataFrame:
    """Cleaned rows of a status backfill, which need no time.

    Orders need their key and a status, blacklist rows any identifier. A row without a
    time counts as older than all others.
    """
    rows = prepare(dataset, raw).drop("missing")
    rows = rows.withColumn("ts", F.coalesce("ts", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")))
    if dataset == "order":
        return rows.filter(F.col("order_id").isNotNull() & F.col("order_status").isNotNull())
    return rows.filter(F.coalesce("uid", "identity_no", "phone_num").isNotNull())


def row_accounting(dataset: str, raw: DataFrame, max_ts: str | None = None) -> DataFrame:
    """Total, written and skipped rows, and skips per missing field, as one row."""
    rows = prepare(dataset, raw, max_ts)
    skipped = F.size("missing") > 0
    names = (*FEEDS[dataset].required, *(("time_before_cut",) if max_ts is not None else ()))
    reasons = [F.count_if(F.array_contains("missing", c)).alias(f"skipped_missing_{c}") for c in names]
    return rows.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(~skipped).alias("written_rows"),
        F.count_if(skipped).alias("skipped_rows"),
        *reasons,
    ).select(F.lit(dataset).alias("dataset"), "*")


def invalid_times(df: DataFrame, time_column: str) -> DataFrame:
    """Rows whose time does not parse, and all rows."""
    return df.select(parse_time(df, time_column).alias("t")).agg(
        F.count_if(F.col("t").isNull()).alias("invalid_rows"), F.count(F.lit(1)).alias("total_rows")
    )
