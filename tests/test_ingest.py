import json

import pytest
from pyspark.sql import functions as F

from riskweave.operators.feeds import backfill_rows
from riskweave.session import scratch_path
from riskweave.sources.files import after_checkpoint, blank_lines, numbered_lines, parse_events
from riskweave.sources.store import GraphStore
from riskweave.streaming import ingest as I

T0 = "2024-01-01T10:00:%02dZ"


def ev(kind, second, **data):
    return json.dumps({"type": kind, "ts": T0 % second, "data": data})


CUSTOMER = [
    ev("customer_update", 1, baseid="U1", identity_no="A", mobile_phone="P1"),
    ev("customer_update", 2, baseid="U1", identity_no="A", mobile_phone="P1"),
    ev("customer_update", 3, baseid="U1", identity_no="B", mobile_phone="P1"),
]
LOGIN = [
    ev("login", 4, cif_user_id="U1", phone_num="P1", device_no="D1", td_device_id="T1", remote_ip="1.1.1.1"),
    ev("login", 5, cif_user_id="U1", phone_num="P1", device_no="", td_device_id=None, remote_ip="1.1.1.1"),
]
OTHER = [
    ev("gps", 6, cid="U1", geo_code="G1"),
    ev("contact_edit", 7, cid="U1", mobile_phone="P9"),
    ev(
        "order",
        8,
        order_id="O1",
        user_id="U1",
        apply_loan_tel="P1",
        apply_ident_no="B",
        apply_card_no="C1",
        apply_bank_mobile="P1",
        repay_card_no="C2",
        repay_bank_mobile="P2",
        order_status="OVERDUE",
    ),
    ev("logout", 9, cid="U1", identity_no="B", mobile_phone="P1"),
]
RISK = [json.dumps({"type": "risk_assessment", "ts": T0 % 10, "id_type": "uid", "id_value": "U1", "labels": {"blacklist": []}})]


def lines(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "line long, value string")


def checked(spark, texts):
    return I.checked_events(parse_events(lines(spark, texts))).persist()


def results(spark, texts):
    good = I.accepted(checked(spark, texts))
    return {r.seq: r for r in I.event_results(I.feed_rows(good, F.col("line"))).collect()}


def test_results_of_single_events(spark):
    got = results(spark, CUSTOMER + LOGIN + OTHER)
    assert (got[0].identity_changed, got[0].phone_changed) == (True, True)
    assert got[1].deduplicated
    assert (got[2].identity_changed, got[2].phone_changed) == (True, False)
    assert (got[3].merged_targets, got[4].merged_targets) == (4, 2)
    assert got[5].event_type == "gps" and got[6].event_type == "contact_edit"
    assert (got[7].linked_fields, got[7].card_phone_links) == (4, 2)
    assert (got[8].identity_updated, got[8].phone_updated) == (True, True)


def test_graph_of_golden_events(spark):
    store = GraphStore(spark, scratch_path(spark, "golden"))
    assert I.apply_batch(store, parse_events(lines(spark, CUSTOMER + LOGIN + OTHER + RISK)), 0)
    graph = store.read()
    edges = {(r.rel, r.src_key, r.dst_key): r.event_count for r in graph.edges.collect()}
    assert edges[("HAS_IDENTITY", "u1", "a")] == 1 and edges[("HAS_IDENTITY", "u1", "b")] == 1
    assert edges[("HAS_PHONE", "u1", "p1")] == 1
    assert edges[("LOGIN_WITH_PHONE", "u1", "p1")] == 2 and edges[("LOGIN_WITH_DEVICE", "u1", "d1")] == 1
    assert edges[("PLACED_ORDER", "u1", "O1")] == 1 and edges[("CARD_BIND_PHONE", "c2", "p2")] == 1
    assert len(edges) == 16
    nodes = {(r.node_type, r.key): r for r in graph.nodes.collect()}
    uid = nodes[("uid", "u1")]
    assert uid.logout_flag and uid.latest_identity == "b" and str(uid.last_login_ts) == "2024-01-01 10:00:05"
    assert nodes[("identity_no", "b")].logout_count == 1 and nodes[("phone_num", "p1")].logout_count == 1
    assert nodes[("phone_num", "p9")].logout_count == 0
    assert nodes[("order", "O1")].order_status == "OVERDUE"
    risk = spark.read.parquet(f"{store.path}/risk")
    assert [(r.id_type, r.id_value) for r in risk.collect()] == [("uid", "U1")]


def test_rejected_events(spark):
    texts = [
        ev("unknown_event", 1, a="b"),
        ev("gps", 1, cid="U1"),
        ev("login", 1),
        json.dumps({"ts": T0 % 1, "data": {}}),
        json.dumps({"type": "logout", "data": {"cid": "U1"}}),
        "{broken",
        '{"type": "gps", "ts": "2024-01-01", "data": {"cid": "U1", "geo_code": NaN}}',
    ]
    errors = {r.line: r.error for r in I.rejected(checked(spark, texts)).collect()}
    assert errors == {
        0: "Unsupported event type: unknown_event",
        1: "Missing required field: data.geo_code",
        2: "Missing required field: data.cif_user_id",
        3: "Missing required field: type",
        4: "Missing required field: ts",
        5: "Invalid JSON",
        6: "Missing required field: data.geo_code",
    }
    row = I.ingest_counters(checked(spark, texts + LOGIN)).first()
    assert (row.total_lines, row.success, row.json_errors, row.event_errors) == (9, 2, 1, 6)


def test_stop_on_error(spark):
    texts = [LOGIN[0], ev("nope", 2), OTHER[0]]
    store = GraphStore(spark, scratch_path(spark, "stop"))
    I.apply_batch(store, parse_events(lines(spark, texts)), 0, stop_on_error=True)
    rels = {r.rel for r in store.read().edges.collect()}
    assert "LOCATED_AT" not in rels and "LOGIN_WITH_IP" in rels
    assert spark.read.parquet(f"{store.path}/errors").count() == 1


def test_stop_on_error_over_files(spark):
    a = [ev("gps", i, cid=f"A{i}", geo_code="g") for i in range(10)]
    b = [ev("nope", 1)] + [ev("gps", i, cid=f"B{i}", geo_code="g") for i in range(5)]
    both = [("a", i, t) for i, t in enumerate(a, 1)] + [("b", i, t) for i, t in enumerate(b, 1)]
    events = parse_events(spark.createDataFrame(both, "file string, line long, value string").repartition(4))
    store = GraphStore(spark, scratch_path(spark, "stop-files"))
    assert I.apply_batch(store, events, 0, stop_on_error=True)
    uids = {r.src_key for r in store.read().edges.filter("rel = 'LOCATED_AT'").collect()}
    assert uids == {f"a{i}" for i in range(10)}
    with pytest.raises(ValueError):
        I.apply_batch(store, events.drop("line"), 1, stop_on_error=True)


def test_sources_do_not_meet(spark):
    """Stream, delivery, stream; then a new checkpoint and a repeated delivery."""
    store = GraphStore(spark, scratch_path(spark, "sources"))
    path, rows = scratch_path(spark, "sources-in"), lambda i: lines(spark, [ev("gps", i, cid=f"U{i}", geo_code="g")])
    checkpoint = scratch_path(spark, "sources-ck")

    def stream(ck):
        I.start_ingest(I.read_event_stream(spark, path), store, ck).awaitTermination()
        return store.read().edges.count()

    def deliver(name, uid):
        good = I.feed_rows(I.accepted(I.checked_events(parse_events(lines(spark, [ev("gps", 9, cid=uid, geo_code="g")])))), F.lit(1))
        return store.append(f"delivery/lbs_gps/{name}", 0, {"lbs_gps": good["lbs_gps"]})

    rows(1).select("value").write.text(f"{path}/1")
    assert stream(checkpoint) == 1
    assert deliver("monday", "D1") and store.read().edges.count() == 2
    rows(2).select("value").write.text(f"{path}/2")
    assert stream(checkpoint) == 3
    store.compact()
    assert not deliver("monday", "D1") and deliver("tuesday", "D2")
    assert store.read().edges.count() == 4
    other = scratch_path(spark, "sources-ck")
    before = {(r.src_key): r.event_count for r in store.read().edges.collect()}
    assert stream(other) == 4  # a new checkpoint reads all files again and counts them again
    after = {(r.src_key): r.event_count for r in store.read().edges.collect()}
    assert after == {k: n + (k in ("u1", "u2")) for k, n in before.items()}


def table(graph):
    return (sorted(map(str, graph.edges.collect())), sorted(map(str, graph.nodes.collect())))


def test_batches_merge_in_any_order(spark):
    one = GraphStore(spark, scratch_path(spark, "one"))
    I.apply_batch(one, parse_events(lines(spark, CUSTOMER + LOGIN + OTHER)), 0)
    split = GraphStore(spark, scratch_path(spark, "split"))
    numbered = lines(spark, CUSTOMER + LOGIN + OTHER)
    late_first = numbered.filter("line % 2 = 1"), numbered.filter("line % 2 = 0")
    for batch, part in enumerate(late_first):
        I.apply_batch(split, parse_events(part), batch)
        assert not I.apply_batch(split, parse_events(part), batch)
        if batch == 0:
            split.compact()
    assert table(split.read()) == table(one.read())
    split.compact()
    assert table(split.read()) == table(one.read())


def test_stream_equals_batch(spark):
    texts = (CUSTOMER + LOGIN + OTHER)[::-1]
    path = scratch_path(spark, "stream-in")
    lines(spark, texts).repartition(3).select("value").write.text(path)
    store = GraphStore(spark, scratch_path(spark, "stream"))
    checkpoint = scratch_path(spark, "stream-checkpoint")
    for _ in range(2):  # the second run resumes and finds nothing new
        I.start_ingest(I.read_event_stream(spark, path, max_files=1), store, checkpoint).awaitTermination()
    batch = GraphStore(spark, scratch_path(spark, "batch"))
    I.apply_batch(batch, parse_events(lines(spark, texts)), 0)
    assert table(store.read()) == table(batch.read())
    assert store.last_batch(I.stream_source(spark, checkpoint)) >= 2


def test_line_numbers_over_splits(spark):
    path = scratch_path(spark, "numbered")
    texts = [f"line {i}" if i % 7 else "" for i in range(1, 2001)]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string").coalesce(1).orderBy("i").select(
        "value"
    ).write.text(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        rows = numbered_lines(spark, path).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r.line: r.value for r in rows} == {i: f"line {i}" for i in range(1, 2001) if i % 7}


def test_resume_after_checkpoint(spark):
    df = spark.createDataFrame([(f, n) for f in ("2024-01", "2024-02") for n in (1, 2, 3)], "file string, line long")
    assert after_checkpoint(df, None).count() == 6
    assert [(r.file, r.line) for r in after_checkpoint(df, "2024-01", 2).orderBy("file", "line").collect()][0] == ("2024-01", 3)


def test_missing_replay_path(spark):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        numbered_lines(spark, scratch_path(spark, "nowhere")).count()


def test_a_batch_committed_while_compacting_counts_once(spark, monkeypatch):
    store = GraphStore(spark, scratch_path(spark, "race"))
    I.apply_batch(store, parse_events(lines(spark, LOGIN)), 0)
    late = [ev("login", 20 + i, cif_user_id="U2", phone_num="P1", device_no="D1", remote_ip="1.1.1.1") for i in range(3)]
    real = store._merged

    def with_a_commit(*args):
        I.apply_batch(GraphStore(spark, store.path), parse_events(lines(spark, late)), 1)
        return real(*args)

    monkeypatch.setattr(store, "_merged", with_a_commit)
    store.compact()
    monkeypatch.undo()
    edge = store.read().edges.filter("src_key = 'u2' AND dst_key = 'd1'").collect()
    assert [r.event_count for r in edge] == [3]
    store.compact()
    assert [r.event_count for r in store.read().edges.filter("src_key = 'u2' AND dst_key = 'd1'").collect()] == [3]


def test_equal_file_names_in_two_folders(spark, tmp_path):
    for folder in ("2024-01", "2024 02"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "part-0.json").write_text("".join(f"line {i}\n" for i in range(10)))
    found = numbered_lines(spark, str(tmp_path))
    assert found.select("file", "line").distinct().count() == 20
    first, second = sorted(r.file for r in found.select("file").distinct().collect())
    assert after_checkpoint(found, first, 10).count() == 10 and after_checkpoint(found, second, 4).count() == 6
    assert {r.file for r in numbered_lines(spark, str(tmp_path / "2024-01" / "part-0.json")).collect()} == {"part-0.json"}


def test_equal_times_go_by_file_then_line(spark):
    """The later file's first line comes after the earlier file's second line: the last value is its."""
    same = lambda v: json.dumps({"type": "customer_update", "ts": T0 % 1, "data": {"baseid": "U1", "identity_no": v}})
    rows = [("a", 1, same("A")), ("a", 2, same("B")), ("b", 1, same("C"))]
    store = GraphStore(spark, scratch_path(spark, "files"))
    I.apply_batch(store, parse_events(spark.createDataFrame(rows, "file string, line long, value string")), 0)
    seq = [r.identity_no for r in store.customers().orderBy("seq").collect()]
    assert seq == ["a", "b", "c"]


def test_positions_are_the_total_order(spark):
    from riskweave.operators.ordinal import with_positions

    rows = [(i * 7919 % 1000 // 3, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(5)
    got = sorted((r.position, r.a, r.b) for r in with_positions(df, ["a", "b"]).collect())
    assert got == [(p, a, b) for p, (a, b) in enumerate(sorted(rows))]
    assert with_positions(df.limit(0), ["a"]).count() == 0


def test_backfills_change_stored_nodes_and_make_none(spark):
    store = GraphStore(spark, scratch_path(spark, "backfill"))

    def order(i, status, second):
        texts = [ev("order", second, order_id=i, user_id="U1", order_status=status)]
        return I.feed_rows(I.accepted(I.checked_events(parse_events(lines(spark, texts)))), F.col("line"))

    def nodes():
        return {(r.node_type, r.key): r for r in store.read().nodes.collect()}

    status = spark.createDataFrame(
        [("O1", "SETTLED", "2024-01-01 00:00:00", 1), ("O1", None, "2024-01-02 00:00:00", 2), ("O9", "SETTLED", None, 3)],
        "id string, order_status string, create_date string, seq long",
    )
    listed = spark.createDataFrame([("U1", None, None, None), ("U7", "x", None, None)], "c_customer_no string, c_reason_list string, d_begin_date string, seq long")
    status, listed = backfill_rows("order", status), backfill_rows("blacklist_log", listed)

    assert store.backfill("status", 0, "order", status, "2024-01-01 10:00:30")
    assert nodes() == {}
    store.append("orders", 0, order("O1", "OVERDUE", 1))
    assert store.backfill("listed", 0, "blacklist_log", listed, "2024-01-01 10:00:30")
    assert not store.backfill("listed", 0, "blacklist_log", listed, "2024-01-01 10:00:30")
    before = nodes()
    assert set(before) == {("uid", "u1"), ("order", "O1")}
    assert before[("order", "O1")].order_status == "SETTLED"
    assert (before[("uid", "u1")].is_blacklisted, before[("uid", "u1")].status) == (True, "BLACKLISTED")
    store.compact()
    assert nodes() == before
    # An order row after the backfill wins; the blacklist mark stays.
    store.append("orders", 1, order("O1", "REPAYED", 59))
    store.compact()
    after = nodes()
    assert after[("order", "O1")].order_status == "REPAYED" and after[("uid", "u1")].status == "BLACKLISTED"
    with pytest.raises(ValueError):
        store.backfill("other", 0, "login", listed, "2024-01-01 10:00:30")


def test_results_are_stored_once_and_only_with_their_batch(spark, monkeypatch):
    store = GraphStore(spark, scratch_path(spark, "results"))
    first, second = (parse_events(lines(spark, t)) for t in (CUSTOMER[:1] + LOGIN, CUSTOMER[1:] + OTHER + RISK))
    assert store.results() is None
    for _ in range(2):
        I.apply_batch(store, first, 0, results=True)
    with monkeypatch.context() as broken:
        broken.setattr(store, "_commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            I.apply_batch(store, second, 1, results=True)
    assert store.results().count() == 3
    I.apply_batch(store, second, 1, results=True)
    got = store.results().collect()
    assert len(got) == len(CUSTOMER + LOGIN + OTHER + RISK)
    # The first customer row of the second batch is compared with the row that the first batch stored.
    changes = {r.seq: (r.deduplicated, r.identity_changed) for r in got if r.event_type == "customer_update" and not r.phone_changed}
    assert changes == {0: (True, False), 1: (False, True)}
    risk = [r for r in got if r.event_type == "risk_assessment"]
    assert [(r.id_type, r.id_value, r.updated) for r in risk] == [("uid", "U1", False)]


def test_counters_with_blank_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text("\n".join([LOGIN[0], "", "  ", "{broken", OTHER[0]]) + "\n")
    read = parse_events(numbered_lines(spark, str(tmp_path)))
    row = I.ingest_counters(I.checked_events(read), blank_lines(spark, str(tmp_path))).first()
    assert (row.total_lines, row.success, row.json_errors, row.skipped_empty) == (3, 2, 1, 2)


def customer(uid, day, seq, identity, phone="P"):
    return (uid, identity, phone, f"2024-01-{day:02d} 10:00:{seq % 60:02d}", seq)


def customers(spark, rows):
    df = spark.createDataFrame(rows, "uid string, identity_no string, phone_num string, ts string, seq long")
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def test_late_customer_rows_across_two_compactions(spark):
    """Folded history equals the lag over all rows; no folded row of another day or uid is read."""
    from riskweave.operators.graph import aggregate_edges, edge_rows

    one = [customer("u1", 1, 1, "A"), customer("u1", 1, 3, "B"), customer("u1", 5, 5, "B"), customer("u2", 2, 6, None), customer("u2", 2, 8, "X", None)]
    # Late ones: between two rows of a folded day, on a new day between, before all, and equal rows twice.
    two = [customer("u1", 1, 2, "A"), customer("u1", 3, 4, "A"), customer("u1", 5, 5, "B"), customer("u3", 1, 9, "C")]
    three = [customer("u1", 1, 0, "Z"), customer("u2", 2, 7, "Y"), customer("u1", 3, 10, None), customer("u3", 2, 11, "C")]
    store = GraphStore(spark, scratch_path(spark, "history"))
    so_far = []
    for batch, part in enumerate((one, two, three)):
        store.append("customers", batch, {"customer_log": customers(spark, part)})
        so_far += part
        if batch == 2:
            whole = edge_rows("customer_log", customers(spark, so_far))
            want = sorted(map(str, aggregate_edges(whole).collect()))
            assert sorted(map(str, store.read().edges.collect())) == want
        store.compact()
    assert sorted(map(str, store.read().edges.collect())) == want
    days = customers(spark, [customer("u1", 1, 0, "?")]).selectExpr("uid", "CAST(ts AS date) AS day")
    assert {(r.uid, r.ts.day) for r in store._folded_rows(days, store._base()).collect()} == {("u1", 1)}
    assert "customer_rows" not in store.read().edges._jdf.queryExecution().toString()
    before = store.customers_before(customers(spark, [customer("u1", 3, 12, "N")])).collect()
    assert sorted((r.uid, r.ts.day) for r in before) == [("u1", 1), ("u1", 3), ("u1", 3), ("u1", 5)]


def test_results_after_a_compaction(spark):
    """A new row is compared with the row before it although that one is folded."""
    store = GraphStore(spark, scratch_path(spark, "results-folded"))
    I.apply_batch(store, parse_events(lines(spark, CUSTOMER[:2])), 0, results=True)
    store.compact()
    late = [CUSTOMER[2], CUSTOMER[2].replace("10:00:03", "10:00:01")]
    I.apply_batch(store, parse_events(lines(spark, late)), 1, results=True)
    got = sorted((r.seq, r.identity_changed) for r in store.results().collect())
    assert got == [(0, True), (0, True), (1, False), (1, True)]


def write_files(folder, files):
    for name, texts in files.items():
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text("".join(t + "\n" for t in texts))


def test_replay_in_path_order_breaks_and_resumes(spark, tmp_path, monkeypatch):
    write_files(tmp_path, {"b/2024-02.json": OTHER, "2024-01.json": CUSTOMER, "a/2024-02.json": ["", *LOGIN]})
    store = GraphStore(spark, scratch_path(spark, "replay"))
    commit = GraphStore._commit
    with monkeypatch.context() as broken:
        # The second file breaks after its tables are written.
        broken.setattr(GraphStore, "_commit", lambda self, s, b: commit(self, s, b) if b == 0 else 1 / 0)
        with pytest.raises(ZeroDivisionError):
            I.replay(spark, store, str(tmp_path), "r", results=True)
    assert [(r.file, r.line) for r in store.progress("replay/r").collect()] == [("2024-01.json", 3)]
    assert I.replay(spark, store, str(tmp_path), "r", results=True) == 2
    assert I.replay(spark, store, str(tmp_path), "r", results=True) == 0
    with open(tmp_path / "a/2024-02.json", "a") as more:
        more.write(OTHER[0].replace("G1", "G2") + "\n")
    assert I.replay(spark, store, str(tmp_path), "r", results=True) == 1
    whole = GraphStore(spark, scratch_path(spark, "replay-whole"))
    I.apply_batch(whole, parse_events(lines(spark, CUSTOMER + LOGIN + OTHER + [OTHER[0].replace("G1", "G2")])), 0)
    assert sorted(map(str, store.read().edges.collect())) == sorted(map(str, whole.read().edges.collect()))
    assert store.results().count() == len(CUSTOMER + LOGIN + OTHER) + 1


def test_replay_halts_until_cleared(spark, tmp_path):
    write_files(tmp_path, {"1.json": [CUSTOMER[0], "{broken", CUSTOMER[2]], "2.json": LOGIN})
    store = GraphStore(spark, scratch_path(spark, "halted"))
    run = lambda: I.replay(spark, store, str(tmp_path), "h", stop_on_error=True, results=True)
    assert run() == 1
    halt = store.halt("replay/h")
    assert (halt.file, halt.line, halt.error) == ("1.json", 2, "Invalid JSON")
    assert store.results().count() == 1 and store.halt("replay/other") is None
    with pytest.raises(I.IngestHalted):
        run()
    store.clear_halt("replay/h")
    assert run() == 2 and store.halt("replay/h") is None
    assert store.results().count() == 2 + len(LOGIN)


def test_replay_takes_files_in_batches_by_bytes(spark, tmp_path):
    """Files share batches; their order, their progress and a halt inside a batch stay by file and line."""
    write_files(tmp_path, {"1.json": CUSTOMER[:1], "2.json": CUSTOMER[1:], "3.json": ["", *LOGIN], "4.json": OTHER})
    plain, grouped, two = (GraphStore(spark, scratch_path(spark, n)) for n in ("replay-plain", "replay-grouped", "replay-two"))
    assert I.replay(spark, plain, str(tmp_path), "r", results=True) == 4
    assert I.replay(spark, grouped, str(tmp_path), "r", results=True, batch_bytes=1 << 20) == 1
    first = sum((tmp_path / f"{i}.json").stat().st_size for i in (1, 2, 3))
    assert I.replay(spark, two, str(tmp_path), "r", results=True, batch_bytes=first) == 2
    for store in (grouped, two):
        for of in (lambda s: s.read().edges, lambda s: s.results().drop("seq"), lambda s: s.progress("replay/r")):
            assert sorted(map(str, of(store).collect())) == sorted(map(str, of(plain).collect()))
        assert I.replay(spark, store, str(tmp_path), "r", results=True, batch_bytes=1 << 20) == 0
    with open(tmp_path / "2.json", "a") as more:
        more.write("{broken\n" + ev("gps", 9, cid="U2", geo_code="G3") + "\n")
    write_files(tmp_path, {"5.json": [OTHER[0].replace("G1", "G4")]})
    halting = lambda: I.replay(spark, grouped, str(tmp_path), "r", stop_on_error=True, batch_bytes=1 << 20)
    assert halting() == 1
    halt = grouped.halt("replay/r")
    assert (halt.file, halt.line) == ("2.json", 3)
    assert {r.file: r.line for r in grouped.progress("replay/r").collect()} == {"1.json": 1, "2.json": 3, "3.json": 3, "4.json": len(OTHER)}
    grouped.clear_halt("replay/r")
    assert halting() == 1 and halting() == 0
    keys = {r.dst_key for r in grouped.read().edges.filter("rel = 'LOCATED_AT'").collect()}
    assert keys == {"g1", "g3", "g4"}


def test_stream_stops_at_the_first_error_of_all_batches(spark, tmp_path):
    import os

    write_files(tmp_path, {"1.json": CUSTOMER, "2.json": [LOGIN[0], "", "{broken", LOGIN[1]], "3.json": OTHER})
    for i in (1, 2, 3):
        os.utime(tmp_path / f"{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    store, checkpoint = GraphStore(spark, scratch_path(spark, "halting")), scratch_path(spark, "halting-ck")

    def run():
        stream = I.start_ingest(I.read_line_stream(spark, str(tmp_path), 1), store, checkpoint, results=True, stop_on_error=True)
        stream.awaitTermination()

    for _ in range(2):
        with pytest.raises(Exception, match="3: Invalid JSON"):
            run()
        assert store.results().count() == len(CUSTOMER) + 1
    store.clear_halt(I.stream_source(spark, checkpoint))
    run()
    assert store.results().count() == len(CUSTOMER) + 1 + len(OTHER)
    with pytest.raises(ValueError):
        I.start_ingest(I.read_event_stream(spark, str(tmp_path)), store, checkpoint, stop_on_error=True)
