"""Spelling variants, the Merkle manifest and the grid order join against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.llm import grid_join as G
from riskweave.llm import merkle as K
from riskweave.llm import spelling as S
from helpers import frame, prose


# -- spelling variants --------------------------------------------------------


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def groups_by_brute_force(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= 3}
    near = {w: [x for x in words if one_apart(w, x)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-words[x], x), default=None)
        if best and words[best] >= 2 * words[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, str(form.get(w)), root(w), n, len(near[w]), str(words.get(form.get(w)))) for w, n in words.items())


def groups_found(df):
    return sorted((r.word, str(r.form), r.root, r.n, r.n_near, str(r.form_n)) for r in df.collect())


def misspelt(rng, n):
    stems = ["colour", "Colour", "colöur", "receive", "recieve", "aaaaa", "aaaaaa", "aaaab", "Übermut", "übermut", "letter", "latter", "lattter"]
    out = []
    for _ in range(n):
        w = rng.choice(stems)
        if rng.random() < 0.5:
            i = rng.randrange(len(w) + 1)
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("aeé×") + w[i:], w[:i] + "e" + w[i + 1 :]])
        out.append(w)
    return " ".join(out) + rng.choice(["", ".", "Ātail", "\n"])


@pytest.mark.parametrize("chunk", [S.CHUNK, 3])
def test_spelling_groups(spark, monkeypatch, chunk):
    rng = random.Random(chunk)
    rows = [(i if i % 9 else None, misspelt(rng, 60) if i % 7 else None, "a") for i in range(60)]
    monkeypatch.setattr(S, "HELD", 20)
    monkeypatch.setattr(S.near_words, "__defaults__", (S.LETTERS, chunk))
    want = groups_by_brute_force(rows)
    assert any(w[1] != w[2] != w[0] for w in want) and any(w[4] > 3 for w in want)
    assert groups_found(S.spelling_groups(frame(spark, rows).repartition(3))) == want


def test_spelling_groups_of_odd_rows(odd, odd_rows, none):
    assert groups_found(S.spelling_groups(odd)) == groups_by_brute_force(odd_rows)
    assert S.spelling_groups(none).count() == 0


def test_position_index():
    rng = random.Random(2)
    for _ in range(300):
        m = rng.randrange(5, 9)
        words = sorted({"".join(rng.choice("ab") for _ in range(m + rng.randrange(2))) for _ in range(30)})
        asked = "".join(rng.choice("ab") for _ in range(m))
        index = S.PositionIndex(words, m)
        got = index.near(asked, 0)
        assert [w for i, w in enumerate(words) if got >> i & 1] == [w for w in words if one_apart(w, asked)]
        got = index.near(asked, m // 2)
        assert [w for i, w in enumerate(words) if got >> i & 1] == [w for w in words if one_apart(w, asked) and w[: m // 2] != asked[: m // 2]]


# -- Merkle manifest ----------------------------------------------------------


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def grown(nodes):
    """(the last node, for each node the (left, right) siblings level by level)"""
    paths, of = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(i, min(i + 8, len(nodes))) for i in range(0, len(nodes), 8)]
        for run in runs:
            for k in run:
                for i in of[k]:
                    paths[i].append(([nodes[x] for x in run if x < k], [nodes[x] for x in run if x > k]))
        nodes, of = [digest(*(nodes[k] for k in run)) for run in runs], [[i for k in run for i in of[k]] for run in runs]
    return nodes[0], paths


def manifest_by_brute_force(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    low = {x: grown([n[2] for n in sorted(trees[x], key=lambda n: n[:3])]) for x in langs}
    root, high = grown([low[x][0] for x in langs])
    out = []
    for x, above in zip(langs, high):
        for (_, _, own, r), path in zip(sorted(trees[x], key=lambda n: n[:3]), low[x][1]):
            folded = own
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
                folded = leaf(r, None if r["text"] is None else lowered(r["text"]))
            for left, right in path + above:
                folded = digest(*left, folded, *right)
            proof = digest(*(s for left, right in path + above for s in left + right))
            out.append((str(r["doc_id"]), own, low[x][0], root, proof, folded, folded == root))
    return sorted(out)


def manifest_found(df):
    return sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect())


MANIFEST = "text string, doc_id long, tree int, lang string, source string, n_chars long, digest string, start long"


def manifest_rows(sizes, seed=0):
    rng = random.Random(seed)
    ids = iter(rng.sample(range(10_000), 2_000))
    out = []
    for lang, n in sizes.items():
        out += [(rng.choice([None, "", "Ab", prose(rng, 9).title()]), next(ids), 1, lang, rng.choice([None, "s", "ß"]), rng.choice([None, 7]), "x", 2) for _ in range(n)]
    return out


@pytest.mark.parametrize(
    "sizes",
    [
        {None: 3, "": 1, "de": 8, "en": 65, "é": 9},
        {"en": 73},
        {None: 1},
        {f"l{i}": 1 + i % 3 for i in range(70)},
    ],
)
def test_manifest(spark, sizes):
    rows = manifest_rows(sizes)
    rows += [rows[0], rows[0], (None, None, 1, next(iter(sizes)), None, None, "x", 2)]
    docs = spark.createDataFrame(rows, MANIFEST).repartition(3)
    want = manifest_by_brute_force([r.asDict() for r in docs.collect()])
    assert manifest_found(K.manifest(docs)) == want
    assert {w[-1] for w in want} == {True, False} or len(want) < 9


def test_manifest_is_read_again(spark, tmp_path, none):
    docs = spark.createDataFrame(manifest_rows({"a": 20, "b": 9}), MANIFEST)
    K.write_manifest(docs, str(tmp_path / "m"))
    leaves, nodes = K.read_manifest(spark, str(tmp_path / "m"))
    assert leaves.count() == 29 and nodes.filter(f"kind = {K.ROOT}").count() == 1 and nodes.filter(f"kind = {K.SUBROOT}").count() == 2
    held = K.climb(leaves, nodes, F.col("digest"))
    assert held.filter("folded_root = root").count() == 29
    wrong = K.climb(leaves, nodes, F.unhex(F.sha2(F.lit("x"), 256)))
    assert wrong.filter("folded_root = root").count() == 0
    assert K.manifest(none).count() == 0


# -- embeddings ---------------------------------------------------------------


def links_by_brute_force(rows, cosine):
    usable = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    links, group = [0] * len(rows), list(range(len(rows)))

    def root(i):
        return i if group[i] == i else root(group[i])

    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows):
            if i != j and usable[i] and usable[j] and len(a) == len(b):
                x, y = np.array(a, dtype=np.float32).astype(float), np.array(b, dtype=np.float32).astype(float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= cosine:
                    links[i] += 1
                    group[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (vec_id, _) in enumerate(rows):
        if vec_id is not None:
            least[root(i)] = min(least.get(root(i), vec_id), vec_id)
    return sorted((str(vec_id), links[i], str(least.get(root(i)))) for i, (vec_id, _) in enumerate(rows))


def vectors_near(n, d, seed):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(8, d))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    out = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.35:  # a hot group of different near copies
            v = base[0] + rng.normal(size=d) * 0.02
        elif kind < 0.5:  # equal vectors, some of another length
            v = base[1] * rng.choice([1, 2])
        elif kind < 0.8:
            v = base[rng.integers(8)] + rng.normal(size=d) * rng.choice([0.05, 0.1, 0.2])
        else:
            v = rng.normal(size=d)
        out.append((i, [float(np.float32(x)) for x in v]))
    odd = [None, [], [0.0] * d, [float("nan")] * d, [float("inf")] + [1.0] * (d - 1), [None] * d, [1.0, 2.0], [1.0, 2.1], [1.0, 2.0] + [0.0] * (d - 2)]
    out += [(n + i, v) for i, v in enumerate(odd)]
    return out + [(None, out[0][1]), (3, out[5][1]), (n + 50, [-0.0] + [1.0] * (d - 1)), (n + 51, [0.0] + [1.0] * (d - 1)), (n + 52, [1e-30] * d), (n + 53, [1e30] * d)]


@pytest.mark.parametrize("d, block, leaf, cosine", [(6, 16, 4, 0.95), (24, 32, 8, 0.95), (6, 4096, 256, 0.8)])
def test_near_vectors(spark, monkeypatch, d, block, leaf, cosine):
    monkeypatch.setattr(G, "BLOCK", block)
    monkeypatch.setattr(G, "LEAF", leaf)
    monkeypatch.setattr(G, "PAIRS", 3)
    rows = vectors_near(220, d, d)
    frame_ = spark.createDataFrame([(v, i, 1, 2) for i, v in rows], "embedding array<float>, vec_id long, cls long, n long").repartition(3)
    got = G.near_vectors(frame_, cosine).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == links_by_brute_force(rows, cosine)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    none = spark.createDataFrame([], frame_.schema)
    assert G.near_vectors(none).count() == 0


def test_whole_intervals_are_taken(spark, monkeypatch):
    """A tight group is decided by its balls, not by multiplying all of its pairs."""
    monkeypatch.setattr(G, "BLOCK", 16)
    monkeypatch.setattr(G, "LEAF", 16)
    rng = np.random.default_rng(1)
    rows = [(i, [1.0 + 1e-3 * float(x) for x in rng.normal(size=8)]) for i in range(300)]
    frame_ = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = []
    real = G.multiplied
    monkeypatch.setattr(G, "multiplied", lambda pairs, *more: asked.append(pairs.count()) or real(pairs, *more))
    got = G.near_vectors(frame_).collect()
    assert asked == [0] and {r.n_links for r in got} == {299} and {r.component_id for r in got} == {0}


def test_pairs_of_blocks_go_to_tasks_in_tiles(spark, monkeypatch):
    """A tile gives each of its vectors once, however many of its pairs the vector has links in."""
    for name, value in (("BLOCK", 16), ("LEAF", 4), ("PAIRS", 9), ("TILES", 1)):
        monkeypatch.setattr(G, name, value)
    rows = vectors_near(200, 6, 3)
    frame_ = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    counts = []
    real = G.multiplied

    def counting(pairs, blocks, *more):
        found = real(pairs, blocks, *more)
        counts.append((found.count(), found.groupBy("cls").count().agg({"count": "max"}).first()[0], blocks.count(), pairs.count()))
        return found

    monkeypatch.setattr(G, "multiplied", counting)
    got = G.near_vectors(frame_, 0.9).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == links_by_brute_force(rows, 0.9)
    ((_, most, blocks, pairs),) = counts
    # A block meets the others in tiles of three.
    assert pairs > 9 * 2 and most <= -(-blocks // 3) < blocks
