"""Registered queries agree with their SQL on the small tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from check_queries import TABLES, compare

SF = "/root/testdata/sf0.001"
FAST = ("A01", "A02", "A03", "A04", "A07", "E04", "E05", "F01", "F10", "G02", "G13", "G15", "J02", "P0", "R01", "T0", "U0", "W0")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_entry(spark):
    assert entry.entry(spark).count() > 10


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", [n for n in sorted(entry.queries()) if n.startswith(FAST)])
def test_query(spark, con, name):
    state, note = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SF)
    assert state == "ok", note
