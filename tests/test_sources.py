import os

import pytest

from riskweave import rules
from riskweave.plans import jobs
from riskweave.session import scratch_path
from riskweave.sources import files, sinks
from riskweave.sources.store import GraphStore


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def put(folder, name, data):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)
    return path


def test_encodings_and_header_orders(spark, folder):
    put(folder, "a/2024-01-01.csv", "﻿ID,Name\n1,渠道\n".encode())
    put(folder, "b/2024-01-02.csv", "name,id\n渠道,2\n".encode("gbk"))
    put(folder, "c/none.csv", "id,name\n3,café\n".encode("latin-1"))
    found = {os.path.basename(r.path): r.encoding for r in files.file_encodings(spark, folder).collect()}
    assert found == {"2024-01-01.csv": "UTF-8", "2024-01-02.csv": "GBK", "none.csv": "ISO-8859-1"}
    rows = files.read_mixed_feed(spark, folder).select("id", "name").collect()
    assert sorted(map(tuple, rows)) == [("1", "渠道"), ("2", "渠道"), ("3", "café")]
    ordered = files.list_csv_files(spark, folder).orderBy(*files.file_order(files.F.col("path")))
    assert [r.date_token for r in ordered.collect()] == ["20240101", "20240102", None]


def test_different_header_is_refused(spark, folder):
    put(folder, "a.csv", b"id,name\n1,x\n")
    put(folder, "b.csv", b"name,id\ny,2\n")
    with pytest.raises(Exception):
        files.read_feed(spark, folder).collect()


def test_header_rules(spark, folder):
    good = ",".join(rules.REQUIRED_COLUMNS["logout"]).upper()
    put(folder, "good.csv", f"﻿{good}\n".encode())
    put(folder, "bad.csv", b'"id",cid\n')
    headers = files.file_headers(spark, folder).withColumn("dataset", files.F.lit("logout"))
    out = {os.path.basename(r.path): r for r in files.validate_headers(headers).collect()}
    assert out["good.csv"].ok and not out["bad.csv"].ok
    assert out["bad.csv"].missing == ["identity_no", "mobile_phone", "create_date", "modify_date"]


def test_import_increment(spark, folder):
    header = ",".join(rules.REQUIRED_COLUMNS["logout"])
    put(folder, "ok/x.csv", f"{header}\n1,U1,I1,P1,2024-01-01,\n2,,I2,P2,2024-01-01,\n".encode())
    put(folder, "bad/x.csv", b"id,cid\n1,U1\n")
    store = GraphStore(spark, scratch_path(spark, "increment"))
    refused = jobs.import_increment(spark, store, "logout", f"{folder}/bad", "one")
    assert set(refused) == {"headers"} and store.commits().isEmpty()
    done = jobs.import_increment(spark, store, "logout", f"{folder}/ok", "one")
    row = done["accounting"].first()
    assert (row.total_rows, row.written_rows, row.skipped_missing_uid) == (2, 1, 1)
    assert done["summary"].first().node_count == 3


def test_day_sink_sorts_and_drops_bad_times(spark, folder):
    df = spark.createDataFrame([("a", "2024-01-02 05:00:00"), ("b", "x"), ("c", "2024-01-02 01:00:00")], "id string, t string")
    path = os.path.join(folder, "days")
    sinks.write_by_day(df, "t", path)
    (part,) = [f for f in os.listdir(f"{path}/ym=2024-01/dt=2024-01-02") if f.endswith(".csv")]
    with open(f"{path}/ym=2024-01/dt=2024-01-02/{part}") as f:
        assert f.read().splitlines() == ["id,t", "c,2024-01-02T01:00:00", "a,2024-01-02T05:00:00"]
