"""One time-ordered event stream with risk labels, from all feeds."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.clean import clean_columns
from riskweave.functions.timeparse import month_text, parse_time
from riskweave.operators.graph import union_all
from riskweave.operators.ordinal import with_positions

# Feeds in stream order with event type, time column and payload
# (payload name -> feed column). The position is the tie-break rank.
_CONTACT = ("contact_edit", "create_date")
_CASE_PAYLOAD = ("c_id", "c_contact_phone_no", "c_register_phone_no", "c_customer_name", "c_identity_no")
_ORDER_PAYLOAD = {
    "order_id": "id",
    **{
        c: c
        for c in (
            "user_id",
            "apply_loan_tel",
            "apply_ident_no",
            "apply_card_no",
            "apply_bank_mobile",
            "repay_card_no",
            "repay_bank_mobile",
            "order_status",
        )
    },
}


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


SOURCES: list[tuple[str, str, str, dict[str, str]]] = [
    ("customer_log", "customer_update", "log_create_date", _same("baseid", "identity_no", "mobile_phone")),
    ("login", "login", "login_time", _same("phone_num", "cif_user_id", "device_no", "remote_ip", "td_device_id")),
    ("lbs_gps", "gps", "create_date", _same("cid", "geo_code")),
    ("first_linkman", *_CONTACT, _same("cid", "mobile_phone")),
    ("second_linkman", *_CONTACT, {"cid": "cid", "mobile_phone": "second_mobile_phone"}),
    ("first_linkman_derived", *_CONTACT, _same("cid", "mobile_phone")),
    ("second_linkman_derived", *_CONTACT, {"cid": "cid", "mobile_phone": "second_mobile_phone"}),
    ("logout", "logout", "create_date", _same("cid", "identity_no", "mobile_phone")),
    (
        "company_log",
        "company_update",
        "modify_date",
        _same("cid", "companyid", "company_name", "company_address", "tel_phone"),
    ),
    (
        "repay_plan",
        "repayment_plan",
        "current_repay_date",
        {
            "repay_id": "id",
            **_same(
                "order_id",
                "contract_no",
                "current_repay_status",
                "repayed_date",
                "overdue_mark",
                "overdue_days",
                "early_repay_mark",
            ),
        },
    ),
    ("complaint", "complaint_case", "d_update", _same(*_CASE_PAYLOAD)),
    ("consumer_protection_case", "consumer_case", "d_update", _same(*_CASE_PAYLOAD)),
    (
        "blacklist_log",
        "blacklist",
        "d_begin_date",
        _same("c_customer_no", "c_reason_list", "c_mobile_phone", "c_identity_no", "n_banned_days", "n_duration"),
    ),
    ("order", "order", "create_date", _ORDER_PAYLOAD),
]

ORDER_RANK = len(SOURCES) - 1
TOTAL_ORDER = ["ts", "source_rank", "seq", "sub_seq", "tie"]


def _column(df: DataFrame, name: str) -> Column:
    return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")


def timed(df: DataFrame, time_column: str) -> DataFrame:
    """Rows whose time parses, with ``ts``."""
    return df.withColumn("ts", parse_time(df, time_column)).filter(F.col("ts").isNotNull())


def feed_events(
    df: DataFrame, rank: int, event_type: str, time_column: str, payload: Mapping[str, str]
) -> DataFrame:
    """One feed as ``type, ts, data`` plus the tie-break columns."""
    df = timed(clean_columns(df), time_column)
    entries = [x for out, src in payload.items() for x in (F.lit(out), _column(df, src))]
    data = F.create_map(*entries)
    seq = F.col("seq").cast("long") if "seq" in df.columns else F.lit(None).cast("long")
    return df.select(
        F.lit(event_type).alias("type"),
        "ts",
        data.alias("data"),
        F.lit(rank).alias("source_rank"),
        seq.alias("seq"),
        F.lit(0).alias("sub_seq"),
        F.xxhash64(*[_column(df, src) for src in payload.values()]).alias("tie"),
    )


def source_events(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """Events of every delivered feed, orders included, without risk rows."""
    return union_all(
        [feed_events(feeds[d], i, kind, t, cols) for i, (d, kind, t, cols) in enumerate(SOURCES) if d in feeds]
    )


# -- risk rows ----------------------------------------------------------------


def _typed(id_type: str, values: Column) -> Column:
    return F.transform(values, lambda v: F.struct(F.lit(id_type).alias("id_type"), v.alias("id_value")))


def order_identifiers(orders: DataFrame) -> DataFrame:
    """One row per order and identifier: uid, identity, then distinct phones ascending."""
    df = timed(clean_columns(orders), "create_date")

    def present(c: str) -> Column:
        return F.when(F.col(c).cast("string") != "", F.col(c).cast("string"))

    phones = F.array_sort(
        F.array_distinct(
            F.array_compact(F.array(*[present(c) for c in ("apply_loan_tel", "apply_bank_mobile", "repay_bank_mobile")]))
        )
    )

    ids = F.concat(
        _typed("uid", F.array_compact(F.array(present("user_id")))),
        _typed("identity_no", F.array_compact(F.array(present("apply_ident_no")))),
        _typed("phone_num", phones),
    )
    return df.select(
        F.col("id").cast("string").alias("order_id"),
        "ts",
        F.col("seq").cast("long").alias("seq") if "seq" in df.columns else F.lit(None).cast("long").alias("seq"),
        "order_status",
        F.posexplode(ids).alias("pos", "ident"),
    ).select(
        "order_id", "ts", "seq", "order_status", (F.col("pos") + 1).alias("sub_seq"), "ident.id_type", "ident.id_value"
    )


# The columns of the label tables, and the columns that name an identifier.
_LABEL_FIELDS = {
    "blacklist": ("c_customer_no", "c_reason_list", "c_mobile_phone", "c_identity_no"),
    "complaint": ("c_contact_phone_no", "c_register_phone_no", "c_identity_no"),
    "consumer_case": ("c_contact_phone_no", "c_register_phone_no", "c_identity_no"),
}
_LABEL_KEYS = {
    "blacklist": {"uid": ["c_customer_no"], "identity_no": ["c_identity_no"], "phone_num": ["c_mobile_phone"]},
    "complaint": {"identity_no": ["c_identity_no"], "phone_num": ["c_contact_phone_no", "c_register_phone_no"]},
    "consumer_case": {"identity_no": ["c_identity_no"], "phone_num": ["c_contact_phone_no", "c_register_phone_no"]},
}
_ID = ["id_type", "id_value"]


_ALL_FIELDS = list(dict.fromkeys(f for fields in _LABEL_FIELDS.values() for f in fields))


def label_records(labels: Mapping[str, DataFrame]) -> DataFrame:
    """Label rows by identifier: ``id_type, id_value, source, record``.

    A row whose contact and register phone agree is listed once for that phone, so
    the two-column match is an equi-join on one key.
    """
    parts = []
    for source, table in labels.items():
        df = clean_columns(table)
        absent = F.lit(None).cast("string")
        fields = [
            (F.coalesce(_column(df, f), F.lit("")) if f in _LABEL_FIELDS[source] else absent).alias(f)
            for f in _ALL_FIELDS
        ]
        keyed = [
            _typed(id_type, F.array_distinct(F.array(*[F.col("record")[c] for c in columns])))
            for id_type, columns in _LABEL_KEYS[source].items()
        ]
        record = df.select(F.struct(*fields).alias("record"))
        parts.append(record.select(F.inline(F.concat(*keyed)), F.lit(source).alias("source"), "record"))
    return union_all(parts).filter(F.col("id_value") != "")


def label_counts(labels: Mapping[str, DataFrame]) -> DataFrame:
    """Per identifier: hits per source. The records themselves stay in :func:`label_records`."""
    counters = [F.count_if(F.col("source") == s).alias(f"n_{s}") for s in _LABEL_FIELDS]
    return label_records(labels).groupBy(*_ID).agg(*counters)


def risk_rows(orders: DataFrame, labels: Mapping[str, DataFrame]) -> DataFrame:
    """Every order identifier with its label counts and the order's status.

    The identifier is the key of its records in :func:`label_records`, which hold them
    once and not once per order. The counts are one row per identifier; a busy identifier's
    orders are split by the adaptive skew join.
    """
    rows = order_identifiers(orders).join(label_counts(labels), _ID, "left")
    counts = [F.coalesce(f"n_{s}", F.lit(0)).alias(f"n_{s}") for s in _LABEL_FIELDS]
    return rows.select("order_id", "ts", "seq", "sub_seq", "order_status", *_ID, *counts)


def risk_events(risk: DataFrame) -> DataFrame:
    """Risk rows in the event layout."""
    labels = F.struct(*[f"n_{s}" for s in _LABEL_FIELDS], "order_status")
    return risk.select(
        F.lit("risk_assessment").alias("type"),
        "ts",
        "id_type",
        "id_value",
        labels.alias("labels"),
        F.lit(ORDER_RANK).alias("source_rank"),
        "seq",
        "sub_seq",
        F.xxhash64("id_type", "id_value", "order_id").alias("tie"),
    )


def default_labels(feeds: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Label tables taken from the feeds of the same name."""
    return {
        "blacklist": feeds["blacklist_log"],
        "complaint": feeds["complaint"],
        "consumer_case": feeds["consumer_protection_case"],
    }


def event_stream(feeds: Mapping[str, DataFrame], labels: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """All events with risk rows, unsorted, with the tie-break columns."""
    events = source_events(feeds)
    if "order" in feeds and labels is not None:
        events = union_all([events, risk_events(risk_rows(feeds["order"], labels))])
    return events.withColumn("ym", month_text("ts"))


def in_total_order(events: DataFrame) -> DataFrame:
    """Time order; ties keep feed order, then row order."""
    return events.orderBy(*TOTAL_ORDER)


def in_positions(events: DataFrame) -> DataFrame:
    """Events with ``position``, their place in time order from 0: one range sort and prefix sums, no sort in one task."""
    return with_positions(events, TOTAL_ORDER)


def events_per_month(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """Events per month, risk events included: one for each identifier of an order, labelled or not."""
    parts = [source_events(feeds).select("ts")]
    if "order" in feeds:
        parts.append(order_identifiers(feeds["order"]).select("ts"))
    return union_all(parts).groupBy(month_text("ts").alias("ym")).agg(F.count(F.lit(1)).alias("events"))


# -- event validation ---------------------------------------------------------

# Handled event types and the fields each must carry, in check order.
REQUIRED_FIELDS = {
    "customer_update": ["ts", "data.baseid"],
    "login": ["ts", "data.cif_user_id"],
    "gps": ["ts", "data.cid", "data.geo_code"],
    "contact_edit": ["ts", "data.cid", "data.mobile_phone"],
    "order": ["ts", "data.order_id", "data.user_id"],
    "risk_assessment": ["ts"],
    "logout": ["ts", "data.cid"],
}


def event_error(ts: Column, data: Column, kind: Column) -> Column:
    """Why a cleaned event is rejected, or NULL."""
    known = F.create_map(
        *[x for t, names in REQUIRED_FIELDS.items() for x in (F.lit(t), F.array(*[F.lit(n) for n in names]))]
    )
    given = F.transform(F.map_keys(F.map_filter(data, lambda _, v: v.isNotNull())), lambda k: F.concat(F.lit("data."), k))
    given = F.concat(given, F.when(ts.isNotNull(), F.array(F.lit("ts"))).otherwise(F.array().cast("array<string>")))
    first_missing = F.try_element_at(F.array_except(F.try_element_at(known, kind), given), F.lit(1))
    return (
        F.when(kind.isNull(), F.lit("Missing required field: type"))
        .when(~kind.isin(*REQUIRED_FIELDS), F.concat(F.lit("Unsupported event type: "), kind))
        .otherwise(F.concat(F.lit("Missing required field: "), first_missing))
    )
