import random

import numpy as np
import pytest
import xxhash

from riskweave.llm import simhash_trie as S
from riskweave.llm.near_copies import near_copies, one_of_each
from helpers import frame, prose


def fingerprint(text, n=3):
    raw = (text or "").encode()
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in raw).split()
    grams = [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, radius):
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(len(fps)):
                if (fps[i] ^ fps[j]).bit_count() <= radius and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def test_spark_hash_agrees(spark):
    # Spark's xxhash64 is XXH64 with seed 42, so SQL can check single shingles.
    want = xxhash.xxh64_intdigest("one of Grüße".encode(), 42)
    got = spark.sql("SELECT xxhash64('one of Grüße')").first()[0]
    assert got % (1 << 64) == want


def test_rows_against_brute_force(odd, odd_rows):
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in S.near_duplicates(odd).collect())
    fps = [fingerprint(t) for _, t, _ in odd_rows]
    label = components(fps, 3)
    least = {x: min((d for (d, _, _), y in zip(odd_rows, label) if y == x and d is not None), default=None) for x in label}
    want = sorted((str(d), f"{f:016x}", least[x]) for (d, _, _), f, x in zip(odd_rows, fps, label))
    assert got == want
    assert f"{fingerprint(None):016x}" == "0" * 16


def test_trie_join_finds_all_links():
    rng = np.random.default_rng(1)
    for radius, turns in ((3, 2), (8, 3), (3, 1)):
        base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
        flips = rng.integers(0, 64, (40, 6), dtype=np.uint64)
        keys = [base]
        for k in range(1, 7):
            keys.append(base ^ np.bitwise_or.reduce(np.uint64(1) << flips[:, :k], axis=1))
        keys = np.unique(np.concatenate(keys))
        label = S.join_tries(keys, 0, 0, 0, 64, radius, radius)
        assert label.tolist() == components([int(k) for k in keys], radius)


def test_small_cells_give_the_same_links(spark):
    rng = random.Random(4)
    fps = {rng.getrandbits(63) for _ in range(300)}
    fps |= {f ^ 1 << rng.randrange(63) ^ 1 << rng.randrange(63) for f in list(fps)}
    table = spark.createDataFrame([(f,) for f in fps], "fp long")
    fps = sorted(fps)
    label = dict(zip(fps, components(fps, 3)))
    for cell in (50_000, 40):
        roots = {r.node: r.root for r in S.connected_components(S.trie_links(table, 3, cell=cell)).collect()}
        assert {f: roots.get(f, f) for f in fps} == {f: fps[label[f]] for f in fps}


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(5, 5), (100, 90), (100, 90)], "a long, b long")
    got = {r.node: r.root for r in S.connected_components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {90: 90, 100: 90}
    assert S.connected_components(links.filter("a > 1000")).count() == 0


def test_empty_table(none):
    assert S.near_duplicates(none).count() == 0
    assert near_copies(none).count() == 0 and one_of_each(none).count() == 0


def jaccard(a, b, n=5):
    def grams(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())

    x, y = grams(a), grams(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def test_near_copies_against_brute_force(spark):
    rng = random.Random(6)
    rows = []
    for i in range(12):
        words = prose(rng, 150).split()
        for k in range(5):
            some = list(words)
            for _ in range(k):
                some[rng.randrange(150)] = "new" + str(rng.randrange(10**6))
            rows.append((len(rows) * 7 % 61, " ".join(some), "a"))
    label = list(range(len(rows)))
    near = [(i, j) for i, (_, a, _) in enumerate(rows) for j, (_, b, _) in enumerate(rows[:i]) if jaccard(a, b) >= 0.8]
    for _ in rows:
        for i, j in near:
            label[i] = label[j] = min(label[i], label[j])
    want = {d: min(rows[j][0] for j in range(len(rows)) if label[j] == label[i]) for i, (d, _, _) in enumerate(rows)}
    got = {r.doc_id: r.group_id for r in near_copies(frame(spark, rows)).collect()}
    assert got == want


def brute_groups(rows):
    """The smallest doc_id of each row's group, by every pair's exact similarity."""
    label = list(range(len(rows)))
    near = [(i, j) for i, (_, a, _) in enumerate(rows) for j, (_, b, _) in enumerate(rows[:i]) if jaccard(a, b) >= 0.8]
    for _ in rows:
        before = list(label)
        for i, j in near:
            label[i] = label[j] = min(label[i], label[j])
        if label == before:
            break
    return {d: min(rows[j][0] for j in range(len(rows)) if label[j] == label[i]) for i, (d, _, _) in enumerate(rows)}


def cut_and_extended(rng, n, like):
    """Texts of ``n`` words with copies at 5-word similarities just above and below 0.8, and a passage that others have too."""
    rows = []
    passage = prose(rng, n // 5)
    for i in range(25):
        base = f"{prose(rng, n)} {passage if i % 2 else ''}".split()
        more = [f"more{rng.randrange(10**6)}" for _ in range(n)]
        keep = round(like * (len(base) - 4)) + 4
        grow = round((len(base) - 4) * (1 / like - 1))
        middle = len(base) // 2
        inside = base[:middle] + more[: max(1, grow - 4)] + base[middle:]
        for words in (base, base[:keep], base[len(base) - keep :], base + more[:grow], inside):
            rows.append((len(rows) * 7 + i % 3, " ".join(words), "a"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n, like", [(12, 0.82), (40, 0.81), (150, 0.81), (600, 0.805), (150, 0.79), (150, 0.9)])
def test_cut_and_extended_copies_against_brute_force(spark, n, like):
    rows = cut_and_extended(random.Random(n), n, like)
    got = {r.doc_id: r.group_id for r in near_copies(frame(spark, rows)).collect()}
    assert got == brute_groups(rows)


def test_prefixes_connect_every_similar_pair(spark):
    # With no fingerprint within reach, the prefixes alone have to propose.
    rows = cut_and_extended(random.Random(4), 60, 0.81)
    got = {r.doc_id: r.group_id for r in near_copies(frame(spark, rows), radius=0, turns=1).collect()}
    assert got == brute_groups(rows)


def test_one_of_each(odd):
    kept = one_of_each(odd)
    assert kept.columns == odd.columns
    ids = sorted((r.doc_id for r in kept.select("doc_id").collect()), key=lambda d: (d is None, d))
    # 1, 2, 3 and a null id are copies; 5, 6, 7 and a null id have no words; 9 is there twice.
    assert ids == [1, 4, 5, 8, 9, 10, 11, 12, 13, 14, 15]
