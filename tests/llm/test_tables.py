import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from riskweave.llm import fingerprint_tables as P
from riskweave.llm import mixing as M
from riskweave.llm import suffix_dedup as D
from riskweave.llm import toxicity as X
from helpers import frame, prose


def removed_by_brute_force(rows):
    least = {}
    for d, t, _ in rows:
        b = (t or "").encode()
        for i in range(len(b) - 49):
            w = b[i : i + 50]
            key = float("inf") if d is None else d
            least[w] = min(least.get(w, key), key)
    out = []
    for d, t, _ in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - 49):
            if least[b[i : i + 50]] < (float("inf") if d is None else d):
                gone[i : i + 50] = [True] * 50
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((str(d), len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


@pytest.mark.parametrize("seed", range(3))
def test_removed_bytes(spark, monkeypatch, seed):
    rng = random.Random(seed)
    pool = ["".join(rng.choice(["ab", "abc\x00 é", "the of and \n"][seed]) for _ in range(rng.randrange(1, 130))) for _ in range(6)]
    rows = [(d, "".join(rng.choice(pool) for _ in range(rng.randrange(5))), "a") for d in rng.sample(range(1000), 60)]
    monkeypatch.setattr(D, "UNIT_BYTES", 4000)
    monkeypatch.setattr(D, "BUCKET_BYTES", 4000)
    monkeypatch.setattr(D, "RANGE_BYTES", 4000)
    monkeypatch.setattr(D, "PLACES", 2)
    assert found(D.dedup_bytes(frame(spark, rows).repartition(4))) == removed_by_brute_force(rows)


def test_removed_bytes_of_odd_rows(odd, odd_rows, none):
    assert found(D.dedup_bytes(odd)) == removed_by_brute_force(odd_rows)
    assert D.dedup_bytes(none).count() == 0


def test_merge_of_runs():
    rng = random.Random(0)
    for _ in range(50):
        runs = [sorted({bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(1, 9))}) for _ in range(rng.randrange(1, 6))]

        def prefix(a, b):
            return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

        run, at, known = D.merge(runs, [[0] + [prefix(a, b) for a, b in zip(r, r[1:])] for r in runs])
        out = [runs[r][i] for r, i in zip(run, at)]
        assert out == sorted(x for r in runs for x in r)
        assert known[1:] == [prefix(a, b) for a, b in zip(out, out[1:])]


def test_fingerprints(odd, odd_rows, none, monkeypatch):
    monkeypatch.setattr(P, "BUCKET", 2)
    rows = P.document_fingerprints(odd).collect()
    order = sorted(odd_rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    want = []
    for i, (d, t, _) in enumerate(order):
        a, b = t or "", order[(i + 1) % len(order)][1] or ""
        k = len(a) // 3
        want.append((str(d), len(a), hashlib.sha256((a[: len(a) - k] + b[:k]).encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in rows) == sorted(want)
    by = defaultdict(set)
    for r in rows:
        by[next((t or "" for d, t, _ in odd_rows if d == r.doc_id and len(t or "") == r.n_chars))].add(r.fingerprint)
    assert all(len(f) == 1 for f in by.values()) and by[""] == {"0" * 16}
    one = next(r for r in rows if r.doc_id == 8)
    assert one.near_edited == 1 - (int(one.fingerprint, 16) ^ int(one.edited_fingerprint, 16)).bit_count() / 64
    assert P.document_fingerprints(none).count() == 0


def test_edits_stay_near(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, 150), "a") for i in range(60)]
    got = P.document_fingerprints(frame(spark, rows)).collect()
    mean = lambda c: sum(r[c] for r in got) / len(got)
    assert mean("near_edited") > 0.65 and abs(mean("near_next") - 0.5) < 0.08


def test_search_by_tables(spark):
    rng = random.Random(6)
    fps = [rng.getrandbits(63) for _ in range(200)]
    for f in fps[:100]:
        for _ in range(rng.randrange(1, 6)):
            f ^= 1 << rng.randrange(63)
        fps.append(f)
    table = spark.createDataFrame([(f,) for f in set(fps)], "fp long")
    got = {(r.a, r.b): r.bits for r in P.within_radius(table, table).collect()}
    assert got == {(a, b): (a ^ b).bit_count() for a in set(fps) for b in set(fps) if (a ^ b).bit_count() <= 3}


def test_mix(spark):
    rng = random.Random(7)
    rows = [(i, prose(rng, rng.randrange(60)), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(400)]
    rows += [(1000, prose(rng, 3000), "b"), (1001, None, "z"), (7, rows[7][1], rows[7][2])]
    got = M.taken_words(frame(spark, rows), block=64).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    source = {r[0]: r[2] for r in rows}
    size, taken, target = Counter(), Counter(), {}
    for r in got:
        s = source[r.doc_id]
        size[s] += r["size"]
        taken[s] += r.taken
        target[s] = r.target
        assert r.taken <= 2 * r["size"] and (s == "z" or r.source_size > 0)
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
    weight = dict(zip(["a", "b", "c", "z", None], [5, 2, 1, 5, 2]))
    rates = {s: target[s] / weight[s] for s in target if target[s] < 2 * size[s] - 1e-6}
    assert len({round(x, 6) for x in rates.values()}) <= 1
    for s in target:
        assert target[s] <= 2 * size[s] + 1e-6 and abs(taken[s] - target[s]) <= 0.5
        assert s in rates or target[s] / weight[s] <= max(rates.values(), default=1e18)
    again = M.taken_words(frame(spark, rows).repartition(7), block=64).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_schedule_is_even(spark):
    targets = spark.createDataFrame([(0, 64_000.0), (1, 32_000.0), (2, 16_000.0)], "source_no long, target double")
    rows = M.schedule(targets, 64).orderBy("slot").collect()
    assert Counter(r.source_no for r in rows) == {0: 1000, 1: 500, 2: 250}
    for s in range(3):
        assert [r.rank for r in rows if r.source_no == s] == list(range(1000 >> s))
    seen = Counter()
    for i, r in enumerate(rows[:1500], 1):
        seen[r.source_no] += 1
        assert all(abs(seen[s] - i * (4 >> s) / 7) < 8 for s in range(3))


def test_mix_of_odd_rows(odd, odd_rows, none):
    got = M.taken_words(odd).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in odd_rows)
    assert all(r.taken == 0 for r in got if not r["size"])
    copies = M.mixed(odd)
    assert copies.columns == odd.columns
    times = Counter(r.doc_id for r in copies.select("doc_id").collect() if r.doc_id not in (None, 9))
    assert max(times.values()) <= 2 and not {5, 6, 7} & set(times)
    assert M.taken_words(none).count() == 0 and M.mixed(none).count() == 0


def toxic_rows(n, seed):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = prose(rng, rng.randrange(5, 150)).split()
        bad = i % 4 == 0
        for _ in range(3 * bad):
            words.insert(rng.randrange(len(words)), rng.choice(["awfulness", "vileness,", "NASTY!"]))
        rows.append((i, " ".join(words), "a"))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_rows(800, 1)
    rows += [(9000, None, "a"), (9001, "", "b"), (None, "awfulness", "a"), (3, rows[3][1], "a"), (9002, "12 34 --", "c")]
    table = spark.createDataFrame(labels + [(9000, None), (4, 1)], "doc_id long, toxic int")
    got = X.toxicity(frame(spark, rows), table).collect()
    assert len(got) == len(rows)
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert len(held) > 100 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    plain = {r.score for r in got if r.doc_id in (9000, 9001, 9002)}
    assert len(plain) == 1 and plain.pop() < 0.5


def test_toxicity_without_labels(spark, odd, odd_rows, none):
    table = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in X.toxicity(odd, table).collect()] == [0.0] * len(odd_rows)
    assert X.toxicity(none, table).count() == 0


def test_gradients():
    rng = np.random.default_rng(0)
    words = [b"one", b"ab", b"the", b"zzz", b"ones"]
    net = X.Network(words[:3])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    windows = rng.integers(1, 7, (6, X.WINDOW))
    windows[:, 20:] = X.PAD
    label = np.array([0, 1, 0, 1, 1, 0.0])

    def loss():
        mask = (windows.T != X.PAD).astype(float)
        rows = net.inputs(words)[0].astype(np.float64) @ net.p["W"] + net.p["b"]
        logit = net.pooled(net.states(net.gates(rows, windows), mask, False)[0], mask)[3]
        return np.mean(np.logaddexp(0, logit) - label * logit)

    for name, g in net.gradients(words, windows, label).items():
        flat, at = net.p[name].reshape(-1), int(np.abs(g).argmax())
        old = flat[at]
        flat[at] = old + 1e-3
        up = loss()
        flat[at] = old - 1e-3
        assert g.reshape(-1)[at] == pytest.approx((up - loss()) / 2e-3, rel=1e-2, abs=1e-6)
        flat[at] = old
