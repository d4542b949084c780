import datetime as dt
import random
from collections import defaultdict

from pyspark.sql import functions as F

from riskweave import rules
from riskweave.operators import evaluate
from riskweave.operators import neighbourhood as nb
from riskweave.operators import risk as R
from riskweave.operators.association import association_scores
from riskweave.operators.graph import Graph

START = dt.datetime(2024, 1, 1)


def random_graph(spark, seed, users=12, width=5):
    """Users linked to few identifiers; every third login uses the same device."""
    rnd = random.Random(seed)
    edges, touched = {}, defaultdict(list)
    kinds = [
        ("LOGIN_WITH_DEVICE", "device_no"),
        ("LOGIN_WITH_IP", "remote_ip"),
        ("LOCATED_AT", "geo_code"),
        ("HAS_PHONE", "phone_num"),
        ("HAS_CONTACT_PHONE", "phone_num"),
        ("HAS_IDENTITY", "identity_no"),
        ("PLACED_ORDER", "order"),
        ("BELONGS_TO_COMPANY", "company_name"),
    ]

    def add(st, sk, rel, t, k):
        ts = START + dt.timedelta(hours=rnd.randrange(2000))
        first, last, n = edges.get((st, sk, rel, t, k), (ts, ts, 0))
        edges[(st, sk, rel, t, k)] = (min(first, ts), max(last, ts), n + 1)
        touched[(st, sk)].append(ts)
        touched[(t, k)].append(ts)

    for i in range(users * 4):
        rel, t = rnd.choice(kinds)
        key = "hot" if t == "device_no" and i % 3 == 0 else f"{t[:2]}{rnd.randrange(width)}"
        add("uid", f"u{rnd.randrange(users)}", rel, t, key)
    for i in range(width * 2):
        add("order", f"or{rnd.randrange(width)}", "ORDER_APPLY_PHONE", "phone_num", f"ph{rnd.randrange(width)}")
    nodes = [
        (t, k, min(ts), max(ts), rnd.choice(["OVERDUE", "REPAYED", None]) if t == "order" else None, t in rules.BLACKLISTABLE_TYPES and rnd.random() < 0.2)
        for (t, k), ts in touched.items()
    ]
    nodes.append(("uid", "lonely", START, START, None, True))
    nd = spark.createDataFrame(
        nodes, "node_type string, key string, created_at timestamp_ntz, updated_at timestamp_ntz, order_status string, is_blacklisted boolean"
    )
    ed = spark.createDataFrame(
        [(*k, *v) for k, v in edges.items()],
        "src_type string, src_key string, rel string, dst_type string, dst_key string, "
        "first_seen_ts timestamp_ntz, last_seen_ts timestamp_ntz, event_count long",
    )
    return Graph(nd, ed), nodes, edges


class Recursion:
    """The score written as plain recursion over dictionaries."""

    def __init__(self, nodes, edges):
        self.nodes = {(n[0], n[1]): n for n in nodes}
        self.edges = edges
        self.sides = defaultdict(list)
        for (st, sk, rel, t, k), (_, last, _) in edges.items():
            self.sides[(st, sk)].append(((t, k), rel, last))
            self.sides[(t, k)].append(((st, sk), rel, last))

    def uids(self, node, rels, days=None):
        end = self.nodes[node][3]
        out = set()
        for (st, sk, rel, t, k), (_, last, _) in self.edges.items():
            inside = days is None or end - dt.timedelta(days=days) <= last <= end
            if (t, k) == node and rel in rels and st == "uid" and inside:
                out.add(sk)
        return out

    def via(self, node, rels):
        orders = {sk for (st, sk, rel, t, k) in self.edges if (t, k) == node and rel in rels}
        return {sk for (st, sk, rel, t, k) in self.edges if rel == "PLACED_ORDER" and k in orders}

    def association(self, node):
        def more(s):
            return max(len(s) - 1, 0)

        kind = node[0]
        if kind == "phone_num":
            main = self.uids(node, ("LOGIN_WITH_PHONE", "HAS_PHONE")) | self.via(node, ("ORDER_APPLY_PHONE",))
            return more(main) + 0.5 * more(self.uids(node, ("HAS_CONTACT_PHONE",)))
        if kind == "identity_no":
            return 1.5 * more(self.uids(node, ("HAS_IDENTITY",)) | self.via(node, ("ORDER_APPLY_IDENTITY",)))
        if kind == "device_no":
            return 1.2 * more(self.uids(node, ("LOGIN_WITH_DEVICE",)))
        if kind == "remote_ip":
            return 0.3 * more(self.uids(node, ("LOGIN_WITH_IP",), 7))
        if kind == "geo_code":
            return 0.1 * more(self.uids(node, ("LOCATED_AT",), 30))
        return 0.0

    def base(self, node):
        _, _, _, _, status, listed = self.nodes[node]
        near = any(n[0] == "order" and self.nodes[n][4] == "OVERDUE" for n, _, _ in self.sides[node])
        fixed = 100 if listed else 80 if (node[0] == "order" and status == "OVERDUE") or near else 0
        return fixed + self.association(node)

    def risk(self, node, k):
        if k == 0 or not self.sides[node]:
            return self.base(node)
        total = 0.0
        for n, rel, last in self.sides[node]:
            if n[0] in rules.RISK_NODE_TYPES:
                days = max(0.0, (self.nodes[n][3] - last).total_seconds() / 86400)
                decay = 0.1 ** (days / rules.DECAY_DAYS.get(rel, rules.DEFAULT_DECAY_DAYS))
                total += rules.RELATION_WEIGHTS.get(rel, 0.6) * decay * self.risk(n, k - 1)
        return total

    def hops(self, start, k):
        seen, edge = {start: 0}, {start}
        for d in range(1, k + 1):
            edge = {n for v in edge for n, _, _ in self.sides[v]} - set(seen)
            seen.update({n: d for n in edge})
        return seen


def test_k_hop_risk_equals_recursion(spark):
    for seed in (1, 2):
        graph, nodes, edges = random_graph(spark, seed)
        rec = Recursion(nodes, edges)
        for k in (0, 1, 2, 3):
            got = {(r.node_type, r.key): r.risk for r in R.k_hop_risk(graph, k).collect()}
            assert set(got) == {n for n in rec.nodes if n[0] in rules.RISK_NODE_TYPES}
            for node, risk in got.items():
                assert abs(risk - rec.risk(node, k)) < 1e-6 * max(1, abs(risk)), (node, k)


def test_targets_equal_whole_graph(spark):
    graph, nodes, edges = random_graph(spark, 3)
    targets = spark.createDataFrame([("uid", "u1"), ("uid", "u2"), ("uid", "ghost")], "node_type string, key string")
    some = {r.key: round(r.risk, 6) for r in R.k_hop_risk(graph, 2, targets=targets).collect()}
    whole = {r.key: round(r.risk, 6) for r in R.k_hop_risk(graph, 2).filter("node_type = 'uid'").collect()}
    assert some.pop("ghost") == 0.0
    assert all(whole.get(k, 0.0) == v for k, v in some.items())


def test_literal_paths_ignore_contacts_without_main_user(spark):
    ts = START
    edge = "src_type string, src_key string, rel string, dst_type string, dst_key string, first_seen_ts timestamp_ntz, last_seen_ts timestamp_ntz, event_count long"
    rows = [("uid", f"u{i}", "HAS_CONTACT_PHONE", "phone_num", "p", ts, ts, 1) for i in range(3)]
    nodes = spark.createDataFrame([("phone_num", "p", ts)], "node_type string, key string, updated_at timestamp_ntz")
    graph = Graph(nodes, spark.createDataFrame(rows, edge))
    assert association_scores(graph).first().association_risk == 1.0
    assert association_scores(graph, via_orders=False).first().association_risk == 0.0


def test_neighbourhood_equals_breadth_first_search(spark):
    graph, nodes, edges = random_graph(spark, 5, users=10, width=4)
    rec = Recursion(nodes, edges)
    anomalies = nb.classify(graph)
    known = {tuple(r.node.split("|", 1)): (r.kind, r.label, r.assoc) for r in anomalies.collect()}
    starts = graph.nodes.filter("node_type = 'uid'").select(F.col("key").alias("uid"))
    for k in (1, 2, 3):
        want = sorted(
            (t[1], d, *known[n], n[1])
            for t in rec.nodes
            if t[0] == "uid"
            for n, d in rec.hops(t, k).items()
            if d > 0 and n in known
        )
        for hub_degree in (4, 10**6):
            found = nb.reach(graph, starts, anomalies, k, hub_degree)
            listed = sorted((r.uid, r.hop, r.kind, r.label, r.assoc, r.key) for r in nb.anomaly_nodes(found, anomalies).collect())
            assert listed == want, (k, hub_degree)
            counted = defaultdict(int)
            for uid, hop, kind, label, assoc, _ in want:
                counted[(uid, hop, kind, label, assoc)] += 1
            got = {
                (r.uid, r.hop, r.kind, r.label, r.assoc): r.n for r in nb.anomaly_counts(found, anomalies).collect()
            }
            assert got == counted, (k, hub_degree)


def test_counts_by_parts_and_blocks_equal_the_listing(spark):
    """Unions made in blocks of starts and narrow parts of the nodes, classes cut by them included."""
    graph, nodes, _ = random_graph(spark, 7, users=160, width=6)
    marked = graph.nodes.withColumn("is_blacklisted", F.col("node_type").isin(*rules.BLACKLISTABLE_TYPES))
    graph = Graph(marked, graph.edges)
    anomalies = nb.classify(graph)
    starts = graph.nodes.filter("node_type = 'uid'").select(F.col("key").alias("uid"))
    found = nb.reach(graph, starts, anomalies, 3, 5)
    listed = nb.anomaly_nodes(found, anomalies).groupBy("uid", "hop", "kind", "label", "assoc").agg(F.count(F.lit(1)).alias("n"))
    counted = nb.anomaly_counts(found, anomalies, part_bytes=1, block_pairs=100)
    assert counted.count() > len({n[1] for n in nodes if n[0] == "uid"})
    assert sorted(counted.select(listed.columns).collect()) == sorted(listed.collect())


def test_walks_leave_out_types_that_lead_to_no_end(spark):
    """A plan is met at two hops of three and leads back to its order only; with one more hop it counts."""
    ts = START
    rows = [
        ("uid", "u", "PLACED_ORDER", "order", "o", ts, ts, 1),
        ("order", "o", "REPAY_PLAN", "repay_plan", "r", ts, ts, 1),
        ("order", "o", "ORDER_APPLY_PHONE", "phone_num", "p", ts, ts, 1),
    ]
    edge = "src_type string, src_key string, rel string, dst_type string, dst_key string, first_seen_ts timestamp_ntz, last_seen_ts timestamp_ntz, event_count long"
    graph = Graph(spark.createDataFrame([("uid", "u")], "node_type string, key string"), spark.createDataFrame(rows, edge))
    starts = spark.createDataFrame([("u",)], "uid string")
    ends = spark.createDataFrame([("phone_num|p",)], "node string")
    walks = {r.node: r.d for r in nb.reach(graph, starts, ends, 3).walks.collect()}
    assert walks == {"uid|u": 0, "order|o": 1, "phone_num|p": 2}
    assert set(nb.useful_types(graph.edges, ["phone_num"], 4)) == {"uid", "order", "repay_plan", "phone_num"}


def test_what_hubs_reach_is_made_without_rows_of_their_walks(spark):
    """Two users of a phone that is a hub: lists of numbers, and what the hub has behind a node in between."""
    ts = START
    rows = [("uid", f"u{i}", "HAS_PHONE", "phone_num", "p", ts, ts, 1) for i in range(5)]
    rows += [("uid", f"u{i}", "LOGIN_WITH_DEVICE", "device_no", f"d{i % 2}", ts, ts, 1) for i in range(4)]
    edge = "src_type string, src_key string, rel string, dst_type string, dst_key string, first_seen_ts timestamp_ntz, last_seen_ts timestamp_ntz, event_count long"
    touched = sorted({(r[0], r[1]) for r in rows} | {(r[3], r[4]) for r in rows})
    nodes = spark.createDataFrame([(*n, n == ("uid", "u3")) for n in touched], "node_type string, key string, is_blacklisted boolean")
    graph = Graph(nodes, spark.createDataFrame(rows, edge))
    anomalies = nb.classify(graph)
    found = nb.reach(graph, spark.createDataFrame([("u4",), ("u4",)], "uid string"), anomalies, 3, 5)
    named = found.hub_ends.join(found.numbers, "number")
    assert sorted((r.node, r.b) for r in named.collect()) == [("device_no|d0", 2), ("device_no|d1", 2), ("phone_num|p", 2), ("uid|u3", 1)]
    assert found.lists.count() == 1
    assert sorted((r.key, r.hop) for r in nb.anomaly_nodes(found, anomalies).collect()) == [("d0", 3), ("d1", 3), ("p", 1), ("u3", 2)]


def test_auc_with_ties_and_many_ranges(spark):
    rnd = random.Random(9)
    rows = [(float(rnd.randrange(400)) if i % 3 else 7.0, rnd.random() < 0.3) for i in range(3000)]
    df = spark.createDataFrame(rows, "score double, hit boolean")
    pos, neg = [s for s, h in rows if h], [s for s, h in rows if not h]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    for buckets in (1, 7, 256):
        assert abs(evaluate.auc(df, F.col("hit"), buckets).first().auc - want) < 1e-12
    row = evaluate.evaluate_scores(df, F.col("hit")).first()
    assert (row.positives, row.negatives) == (len(pos), len(neg))


def test_hot_keys_of_a_walk_are_counted_once(spark, monkeypatch):
    """Rounds with targets read what is needed as written tables, and do not count the edges again."""
    from riskweave.operators import skew

    counted = []
    plain = skew.hot_keys

    def counting(df, keys, *more):
        counted.append(list(keys))
        return plain(df, keys, *more)

    monkeypatch.setattr(skew, "hot_keys", counting)
    monkeypatch.setattr(R, "hot_keys", counting)
    graph, _, _ = random_graph(spark, 3)
    targets = spark.createDataFrame([("uid", "u1"), ("uid", "u1")], "node_type string, key string")
    assert R.k_hop_risk(graph, 2, targets=targets).count() == 1
    # The walk's edges once, and the links of the association window.
    assert sorted(counted) == sorted([R.NEIGHBOUR, R.NODE])


def test_neighbours_of_some_types(spark):
    """Edges to other types are left out before they are turned."""
    rows = [("uid", "u1", "PLACED_ORDER", "order", "o1"), ("order", "o1", "REPAY_PLAN", "repay_plan", "r1"), ("uid", "u1", "HAS_PHONE", "phone_num", "p1"), ("phone_num", "p1", "SELF", "phone_num", "p1")]
    edges = spark.createDataFrame([(*r, None) for r in rows], "src_type string, src_key string, rel string, dst_type string, dst_key string, last_seen_ts timestamp_ntz")
    types = ["uid", "order", "phone_num"]
    want = R.neighbour_edges(edges).filter(F.col("node_type").isin(types) & F.col("n_type").isin(types))
    got = R.neighbour_edges(edges, types)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.count() == 5
