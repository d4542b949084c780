
from pyspark.sql import functions as F

from riskweave import rules
from riskweave.functions import clean as C
from riskweave.functions import timeparse as TP
from riskweave.operators.feeds import row_accounting, valid_rows


def values(df, col):
    return [r[0] for r in df.select(col).collect()]


def test_null_tokens_and_keys(spark):
    df = spark.createDataFrame([(v,) for v in ("", "  ", "nan", "NaN", " None ", "null", "　A b\t", None)], "v string")
    assert values(df, C.clean_text("v")) == [None] * 6 + ["A b", None]
    assert values(df, C.clean_key("v"))[6] == "a b"
    assert values(df, C.trim_only("v"))[2:5] == ["nan", "NaN", "None"]


def test_placeholder_devices(spark):
    df = spark.createDataFrame([("Unknown",), ("--",), ("00000000-0000-0000-0000-000000000000",), (" D1 ",)], "v string")
    assert values(df, C.clean_device("v")) == [None, None, None, "d1"]
    assert values(df, C.clean_device("v", placeholders=("d1",)))[3] is None


def test_time_formats(spark):
    texts = {
        "2024-01-02 03:04:05": "2024-01-02 03:04:05",
        "2024-01-02T03:04:05": "2024-01-02 03:04:05",
        "2024-01-02": "2024-01-02 00:00:00",
        "2024/1/2 03:04": "2024-01-02 03:04:00",
        "20240102": "2024-01-02 00:00:00",
        "2024-01-02T03:04:05Z": "2024-01-02 03:04:05",
        "2024-01-02T03:04:05+08:00": "2024-01-01 19:04:05",
        "2024-13-02": None,
        "9999-12-31": None,
        "soon": None,
        "NaN": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [None if r[0] is None else str(r[0]) for r in df.select(TP.parse_text_time("t")).collect()]
    assert got == list(texts.values())


def test_iso_text_drops_zero_fraction(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-02 03:04:05' a, TIMESTAMP_NTZ '2024-01-02 03:04:05.5' b")
    row = df.select(TP.iso_text("a"), TP.iso_text("b")).first()
    assert tuple(row) == ("2024-01-02T03:04:05", "2024-01-02T03:04:05.500000")


def test_column_resolution(spark):
    df = spark.createDataFrame([(None, "x")], "cid string, uid string")
    assert values(df, C.first_existing(df, ("cid", "uid"))) == [None]
    assert values(df, C.first_value(df, ("cid", "uid"))) == ["x"]
    assert C.find_column(["My Channel", "CHANNEL "], ["channel"]) == "CHANNEL "
    assert C.find_column(["app_channel_x"], ["channel"]) == "app_channel_x"
    assert C.find_column(["a"], ["b"]) is None


def test_lenient_numbers_and_quotes(spark):
    df = spark.createDataFrame([("3.9",), ("x",), (None,)], "v string")
    assert values(df, C.lenient_int("v")) == [3, None, None]
    q = spark.createDataFrame([('"a"',), ('"',), (' "b c" ',)], "v string")
    assert values(q, C.strip_quotes("v")) == ["a", '"', "b c"]


def test_dirty_feed_rows(spark):
    raw = spark.createDataFrame(
        [
            (" U1 ", "2024-01-01", "G1"),
            ("nan", "2024-01-01", "g2"),
            ("u2", "bad", None),
            ("U3", "2024-01-01T10:00:00", "null"),
        ],
        "`﻿CID` string, ` Create_Date ` string, GEO_CODE string",
    )
    assert [(r.uid, r.geo_code) for r in valid_rows("lbs_gps", raw).collect()] == [("u1", "g1")]
    row = row_accounting("lbs_gps", raw).first()
    assert (row.total_rows, row.written_rows, row.skipped_rows) == (4, 1, 3)
    assert (row.skipped_missing_uid, row.skipped_missing_ts, row.skipped_missing_geo_code) == (1, 1, 2)


def test_blacklist_cut_is_exclusive(spark):
    raw = spark.createDataFrame(
        [("a", "2025-11-19 23:59:59"), ("b", "2025-11-20 00:00:00")], "c_customer_no string, d_begin_date string"
    )
    kept = valid_rows("blacklist_log", raw, "2025-11-20 00:00:00")
    assert [r.uid for r in kept.collect()] == ["a"]
    assert row_accounting("blacklist_log", raw, "2025-11-20 00:00:00").first().skipped_missing_time_before_cut == 1


def test_quotes_are_dropped_as_by_the_pattern(spark):
    """The pattern is met only by texts that begin with a quote; the values of a map are cleaned the same way."""
    from riskweave.functions.clean import clean_text, strip_quotes
    from riskweave.streaming.ingest import _clean_values

    texts = ['"a"', ' "a" ', '"', '""', 'a"b"', '"a', 'a"', '"NaN"', '" x "', '"a" ', '"a\nb"', '"a"b"', "", "  ", None, "null"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    trimmed = F.btrim("t", F.lit(rules.WHITESPACE))
    whole = F.regexp_replace(trimmed, r'(?s)^"(.*)"$', "$1")
    got = df.select(
        strip_quotes("t").alias("a"), whole.alias("b"), _clean_values(F.create_map(F.lit("k"), "t"))["k"].alias("c"), clean_text(whole).alias("d")
    ).collect()
    assert [(r.a, r.c) for r in got] == [(r.b, r.d) for r in got]
