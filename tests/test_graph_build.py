"""Edges and attributes of feeds whose rows belong to one record."""

import datetime as dt
import random

from pyspark.sql import functions as F

from riskweave.operators import graph as G

START = dt.datetime(2024, 1, 1)
ORDER = "order_id string, uid string, order_status string, apply_loan_tel string, apply_ident_no string, apply_card_no string, " \
    "apply_bank_mobile string, repay_card_no string, repay_bank_mobile string, ts timestamp_ntz, seq bigint"
PLAN = "order_id string, repay_plan_id string, due_date timestamp_ntz, repayed_date timestamp_ntz, early_mark string, " \
    "overdue_mark string, overdue_days string, plan_status string, ts timestamp_ntz, seq bigint"


def feeds(spark, seed=1):
    """Orders and plans that come several times, some with missing ends, some plans in two orders."""
    rnd = random.Random(seed)

    def some(prefix, n, rate=0.8):
        return f"{prefix}{rnd.randrange(n)}" if rnd.random() < rate else None

    def when():
        return START + dt.timedelta(hours=rnd.randrange(50))

    orders = [
        (some("o", 20, 1), some("u", 5, 1), some("s", 3), some("p", 4), some("i", 4), some("c", 3), some("p", 4), some("c", 3), some("p", 4), when(), some("", 3))
        for _ in range(120)
    ]
    orders = [(*o[:-1], None if o[-1] is None else int(o[-1])) for o in orders]
    plans = [(some("o", 20, 1), some("r", 40, 1), when(), None, None, some("m", 2), some("", 9), some("t", 3), when(), None) for _ in range(150)]
    return {"order": spark.createDataFrame(orders, ORDER), "repay_plan": spark.createDataFrame(plans, PLAN)}


def bag(df):
    return sorted(map(str, df.collect()))


def test_record_edges_equal_plain_grouping(spark):
    rows = feeds(spark)
    whole = G.aggregate_edges(G.union_all([G.edge_rows(d, r) for d, r in rows.items()]))
    assert bag(G.feed_edges(rows).select(whole.columns)) == bag(whole)
    assert G.feed_edges({}) is None


def test_links_of_an_order_lie_together(spark):
    """Nodes made from the edges are combined before they shuffle."""
    rows = feeds(spark)
    order = F.when(F.col("src_type") == "order", F.col("src_key")).otherwise(F.col("dst_key")).alias("order")
    for rels in (("PLACED_ORDER", "ORDER_APPLY_PHONE", "ORDER_REPAY_CARD"), ("REPAY_PLAN",)):
        found = G.feed_edges(rows).filter(F.col("rel").isin(*rels)).select(order, F.spark_partition_id().alias("p"))
        assert found.groupBy("order").agg(F.countDistinct("p").alias("n")).filter("n > 1").count() == 0


def test_attributes_are_the_newest_of_a_node(spark):
    rows = feeds(spark)
    got = {(r.node_type, r.key): r for r in G.stamped_attributes(rows).collect()}
    want = {}
    for r in rows["repay_plan"].collect():
        want.setdefault(r.repay_plan_id, []).append(r)
    assert {k for t, k in got if t == "repay_plan"} == set(want)
    for key, seen in want.items():
        mine = got["repay_plan", key]
        assert mine.due_date == max(r.due_date for r in seen)
        marks = [(r.ts, r.overdue_mark) for r in seen if r.overdue_mark is not None]
        assert (mine.overdue_mark and (mine.overdue_mark.ts, mine.overdue_mark.value)) == (max(marks) if marks else None)


def test_record_nodes_equal_touches_with_attributes(spark):
    """Nodes of orders and plans from their own rows; rows without a link describe a node, but make none."""
    rows = feeds(spark)
    lone = spark.createDataFrame([("lone", None, "late", None, None, None, "p1", None, None, START, 1), ("o1", None, "late", None, None, None, None, None, None, START + dt.timedelta(days=90), 2)], ORDER)
    unplaced = spark.createDataFrame([(None, "r99", START, None, None, None, None, None, START, None), ("o99", "r98", None, None, None, "x", None, None, None, None)], PLAN)
    cases = {d: r.unionByName(more) for (d, r), more in zip(rows.items(), (lone, unplaced))}
    for some in (cases, {"order": cases["order"]}, {"repay_plan": cases["repay_plan"]}):
        edges = G.build_edges(some)
        want = G.finish_nodes(G.node_touches(edges, some), G.stamped_attributes(some))
        got = G.nodes_from(edges, some)
        assert got.columns == want.columns
        assert bag(got) == bag(want)
        assert "lone" not in {r.key for r in got.collect()}


def test_records_stay_dealt_over_the_partitions(spark):
    """Small shuffled blocks are not joined up to a few tasks, which would group many more rows than they can hold."""
    rows = feeds(spark)
    edges = G.feed_edges(rows).filter(F.col("rel") == "REPAY_PLAN")
    assert edges.select(F.spark_partition_id()).distinct().count() > 1
    nodes = G.nodes_from(G.feed_edges(rows), rows).filter(F.col("node_type") == "repay_plan")
    assert nodes.select(F.spark_partition_id()).distinct().count() > 1
