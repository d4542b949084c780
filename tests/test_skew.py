import random

from pyspark.sql import functions as F

from riskweave.operators.association import association_entries
from riskweave.operators.events import label_records, risk_rows
from riskweave.operators.skew import hot_keys, previous_value, salted_lookup


def hot_rows(n=3000):
    """One key holds a third of the rows."""
    rnd = random.Random(1)
    return [("hot" if i % 3 == 0 else f"k{rnd.randrange(700)}", i) for i in range(n)]


def test_hot_keys_are_few(spark):
    df = spark.createDataFrame(hot_rows(), "k string, i int")
    assert [r.k for r in hot_keys(df, ["k"], share=0.1).collect()] == ["hot"]


def test_hot_keys_shuffle_no_cold_key(spark):
    """Counted by a hash first: the exchange of keys comes behind the choice of large groups."""
    rows = hot_rows() + [(None, i) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, i int")
    total = len(rows)
    for share in (0.5, 0.1, 0.001):
        want = {k for k in {k for k, _ in rows} if sum(k == x for x, _ in rows) >= share * total}
        assert {r.k for r in hot_keys(df, ["k"], share=share).collect()} == want
    plan = hot_keys(df, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "xxhash64" in plan


def test_salted_lookup_equals_plain_join(spark):
    many = spark.createDataFrame(hot_rows(), "k string, i int")
    one = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 700, 2)], "k string, v int")
    for how in ("left", "inner"):
        salted = salted_lookup(many, one, ["k"], ["i"], how=how).select("k", "i", "v")
        plain = many.join(one, "k", how).select("k", "i", "v")
        assert sorted(salted.collect(), key=str) == sorted(plain.collect(), key=str)


def test_previous_value_crosses_days(spark):
    rnd = random.Random(2)
    rows = [
        (rnd.choice("aab"), f"2024-01-{rnd.randrange(1, 9):02d} {rnd.randrange(24):02d}:00:00", i, rnd.choice(["x", "y", None]))
        for i in range(300)
    ]
    df = spark.createDataFrame(rows, "k string, t string, seq int, v string").withColumn("ts", F.col("t").cast("timestamp_ntz"))
    got = {r.seq: r.prev_v for r in previous_value(df, "k", "ts", ["seq"], ["v"]).collect()}
    last, want = {}, {}
    for k, t, seq, v in sorted(rows, key=lambda r: (r[1], r[2])):
        want[seq] = last.get(k)
        last[k] = v
    assert got == want


def test_busy_identifiers_keep_all_records(spark):
    feeds = {"blacklist": [("U1", f"r{i}", "p1", "i1") for i in range(1500)], "complaint": [("p1", "p2", "i1")] * 1200}
    labels = {
        "blacklist": spark.createDataFrame(feeds["blacklist"], "c_customer_no string, c_reason_list string, c_mobile_phone string, c_identity_no string"),
        "complaint": spark.createDataFrame(feeds["complaint"], "c_contact_phone_no string, c_register_phone_no string, c_identity_no string"),
    }
    orders = [(f"O{i}", "U1", "p1", "i1", "c", "p1", "p2", "2024-01-01", "X") for i in range(20)]
    names = "id user_id apply_loan_tel apply_ident_no apply_card_no apply_bank_mobile repay_bank_mobile create_date order_status".split()
    labels["consumer_case"] = labels["complaint"].limit(0)
    rows = risk_rows(spark.createDataFrame(orders, names), labels).collect()
    got = {(r.id_type, r.id_value): (r.n_blacklist, r.n_complaint, r.n_consumer_case) for r in rows}
    assert len(rows) == 80
    assert got == {("uid", "U1"): (1500, 0, 0), ("identity_no", "i1"): (1500, 1200, 0), ("phone_num", "p1"): (1500, 1200, 0), ("phone_num", "p2"): (0, 1200, 0)}
    assert label_records(labels).count() == 3 * 1500 + 3 * 1200


def test_shared_nodes_keep_all_uids(spark):
    edges = [("uid", f"u{i}", "LOGIN_WITH_IP", "remote_ip", "ip", f"2024-01-01 00:{i % 60:02d}:00") for i in range(1200)]
    df = spark.createDataFrame(edges, "src_type string, src_key string, rel string, dst_type string, dst_key string, t string")
    out = association_entries(df.withColumn("last_seen_ts", F.col("t").cast("timestamp_ntz"))).collect()
    assert len({r.uid for r in out}) == 1200 and {r.associated_uid_count for r in out} == {1200}
