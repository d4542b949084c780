"""Embedding near-duplicates by an epsilon grid order join.

Vectors are scaled to length 1, so that a cosine of t is a distance of eps =
sqrt(2 - 2 t). They are turned to their principal axes, which keeps distances, and put in
epsilon grid order: by the cells of width eps on the leading axes, the first axis first.
That order is cut into sequence intervals of equal size; intervals of FAN intervals make
a tree. A pair of intervals, at first the whole order with itself, is

* skipped if it is provably distant: the boxes of the two on the leading axes, or the
  balls around their centres, are more than eps apart;
* taken whole if it is provably near: no two points of the two balls are more than eps
  apart. All its pairs are links then, and only the weights are added;
* else split into the pairs of its parts.

Spark does that level by level as joins with the tree, down to intervals of BLOCK vectors.
The pairs of those that are left go to tasks in square tiles, with the matrices of a tile's
blocks. A task goes on with each pair in the same way by halves and multiplies what remains
in double precision. It returns the number of links and one connecting link for each vector
of the tile, never the pairs.

Equal vectors are one class throughout, with their number as its weight.

Defined results: a vector that is null, zero or empty, or holds a null or a non-finite
component has no links and is its own component; vectors of different lengths never
link; repeated rows and equal ids are rows of their own, that link if their vectors do; a
null id never names a component that has another; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import bounded_batches, connected_components, record_batch, written
from riskweave.operators.ordinal import with_positions

#: Bytes of the vectors of one interval of the lowest level, and the most vectors there.
BLOCK_BYTES, BLOCK = 2 << 20, 4096
#: Intervals that make one of the next level.
FAN = 8
#: Vectors of an interval that a task does not halve again.
LEAF = 256
#: Leading axes in the order and in the boxes.
AXES = 16
#: Pairs of blocks in a square tile at most, and tiles that there are before they grow.
PAIRS, TILES = 256, 256
#: Distances this near to eps are decided by multiplication.
MARGIN = 1e-7
#: Vectors of different lengths lie so far apart on an axis of their own.
LENGTHS = 10.0

SKIP, NEAR, SPLIT = 0, 1, 2


def eps_of(cosine: float) -> float:
    return math.sqrt(max(0.0, 2 - 2 * cosine))


def usable(vector: Column) -> Column:
    """Whether a vector can have links at all."""
    bad = lambda x: x.isNull() | F.isnan(x) | x.isin(float("inf"), float("-inf"))
    whole = F.forall(vector, lambda x: ~bad(x)) & F.exists(vector, lambda x: x != 0)
    return F.coalesce(whole, F.lit(False))


def unit_rows(vectors: pa.Array, size: int) -> np.ndarray:
    """The vectors as rows of length 1 in double precision, shorter ones with zeros behind."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(lengths), size))
    at = np.repeat(np.arange(len(lengths)), lengths)
    out[at, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    out /= np.abs(out).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def with_length(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The points with the length of their vectors as the first coordinate, so that other lengths are distant."""
    return np.concatenate([LENGTHS * sizes[:, None], x], axis=1)


def principal_axes(classes: DataFrame, size: int) -> np.ndarray:
    """The axes, as columns, by the size of their share; ``size`` x ``size`` whatever the rows."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in rows:
            x = unit_rows(batch.column(0), size)
            total += x.T @ x
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_pydict({"i": i.astype(np.int32), "j": j.astype(np.int32), "v": total[i, j]})

    sums = classes.select("vector").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    scatter = np.zeros((size, size))
    for r in sums.toPandas().itertuples():
        scatter[r.i, r.j] = scatter[r.j, r.i] = r.v
    return np.linalg.eigh(scatter)[1][:, ::-1].copy()


def in_grid_order(classes: DataFrame, axes: np.ndarray, eps: float) -> DataFrame:
    """``classes`` (vector, ...) with ``cls``, the place in epsilon grid order, and ``cell``."""
    size = len(axes)
    schema = pa.schema([("vector", pa.list_(pa.float64())), ("least", pa.int64()), ("n", pa.int64()), ("cell", pa.binary())])
    lead = axes[:, :AXES]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            cells = np.floor(unit_rows(batch.column(0), size) @ lead / eps)
            # Big-endian numbers above zero: as bytes they go in the order of the cells.
            keys = (np.clip(cells, -32768, 32767) + 32768).astype(">u2")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array([k.tobytes() for k in keys], pa.binary())], schema=schema)

    keyed = classes.select("vector", "least", "n").mapInArrow(run, "vector array<double>, least long, n long, cell binary")
    order = [F.size("vector"), "cell", F.xxhash64("vector")]
    return with_positions(written(keyed, "grid-cells"), order, "cls")


BOUNDS = "weight long, first long, low array<double>, high array<double>, centre array<double>, radius double"
BOUND = [field.split()[0] for field in BOUNDS.split(", ")]
BLOCKS = "block long, cls array<long>, n array<long>, vectors binary, sizes array<int>"


def packed(placed: DataFrame, block: int, axes: np.ndarray) -> tuple[DataFrame, DataFrame]:
    """(blocks, their tree nodes): each interval of ``block`` vectors as one row, and what bounds it."""
    size = len(axes)
    schema = pa.schema(
        [("block", pa.int64()), ("cls", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())), ("vectors", pa.binary()), ("sizes", pa.list_(pa.int32()))]
        + [("weight", pa.int64()), ("first", pa.int64()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())), ("centre", pa.list_(pa.float64())), ("radius", pa.float64())]
    )

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("cls")
        vectors = table.column("vector").combine_chunks()
        x, sizes = unit_rows(vectors, size) @ axes, np.diff(vectors.offsets.to_numpy())
        points = with_length(x, sizes)
        centre = points.mean(axis=0)
        radius = float(np.sqrt(((points - centre) ** 2).sum(axis=1).max()))
        lead = points[:, : AXES + 1]
        cls, n = table.column("cls").to_pylist(), table.column("n").to_pylist()
        row = [[table.column("block")[0].as_py()], [cls], [n], [x.tobytes()], [sizes], [sum(n)], [cls[0]]]
        row += [[lead.min(axis=0)], [lead.max(axis=0)], [centre], [radius]]
        return pa.Table.from_arrays([pa.array(v, f.type) for v, f in zip(row, schema)], schema=schema)

    rows = placed.select(F.expr(f"cls div {block}").alias("block"), "cls", "n", "vector")
    made = written(rows.groupBy("block").applyInArrow(run, f"{BLOCKS}, {BOUNDS}"), "grid-blocks")
    return made.select("block", "cls", "n", "vectors", "sizes"), made.select(F.col("block").alias("node"), *BOUND)


def above(nodes: DataFrame) -> DataFrame:
    """The tree nodes of the next level: of FAN nodes below at most."""

    def run(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node")
        centres = np.stack(rows["centre"].to_list())
        centre = centres.mean(axis=0)
        radius = float((np.linalg.norm(centres - centre, axis=1) + rows["radius"].to_numpy()).max())
        low, high = np.stack(rows["low"].to_list()).min(axis=0), np.stack(rows["high"].to_list()).max(axis=0)
        one = [group[0], int(rows["weight"].sum()), int(rows["first"].iloc[0]), low, high, centre, radius]
        return pd.DataFrame([one], columns=["node", *BOUND])

    return nodes.groupBy(F.expr(f"node div {FAN}")).applyInPandas(run, f"node long, {BOUNDS}")


def _distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def _judged(pairs: DataFrame, nodes: DataFrame, eps: float) -> DataFrame:
    """(a, b, verdict, weights and first vectors) of the pairs (a, b) of ``nodes`` of one level."""
    side = lambda s: nodes.select(F.col("node").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in BOUND])
    met = pairs.join(side("a"), "a").join(side("b"), "b")
    gaps = F.zip_with(
        F.zip_with("a_low", "b_high", lambda x, y: x - y),
        F.zip_with("b_low", "a_high", lambda x, y: x - y),
        lambda x, y: F.greatest(x, y, F.lit(0.0)),
    )
    apart = F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x * x))
    centres, radii = _distance(F.col("a_centre"), F.col("b_centre")), F.col("a_radius") + F.col("b_radius")
    verdict = (
        F.when((apart > eps + MARGIN) | (centres - radii > eps + MARGIN), SKIP)
        .when(centres + radii < eps - MARGIN, NEAR)
        .otherwise(SPLIT)
    )
    return met.select("a", "b", verdict.alias("verdict"), "a_weight", "b_weight", "a_first", "b_first")


def interval_pairs(nodes: DataFrame, blocks: int, eps: float) -> tuple[DataFrame, DataFrame]:
    """(pairs of blocks (a, b) to multiply, a <= b; whole intervals (level, node, added, first, other) that are near)."""
    levels = [written(nodes, "grid-tree")]
    while blocks > 1:
        blocks = -(-blocks // FAN)
        levels.append(written(above(levels[-1]), "grid-tree"))
    pairs = levels[-1].select(F.col("node").alias("a"), F.col("node").alias("b"))
    near = []
    for level in range(len(levels) - 1, -1, -1):
        judged = written(_judged(pairs, levels[level], eps), "grid-pairs")
        taken = judged.filter(F.col("verdict") == NEAR)
        one = lambda x, y: (F.lit(level).alias("level"), F.col(x).alias("node"), F.col(f"{y}_weight").alias("added"), F.col(f"{x}_first").alias("first"), F.col(f"{y}_first").alias("other"))  # noqa: E731,B023
        near += [taken.select(*one("a", "b")), taken.filter("a < b").select(*one("b", "a"))]
        pairs = judged.filter(F.col("verdict") == SPLIT).select("a", "b")
        if level:
            child = lambda c: F.transform(F.sequence(F.lit(0), F.lit(FAN - 1)), lambda i: F.col(c) * FAN + i)
            parts = pairs.withColumn("_a", F.explode(child("a"))).withColumn("_b", F.explode(child("b")))
            pairs = parts.filter("_a <= _b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    whole = near[0]
    for more in near[1:]:
        whole = whole.union(more)
    return pairs, whole


class Interval:
    """The vectors of a block on their axes, and the boxes of all its halves down to LEAF."""

    def __init__(self, raw: bytes, n: list[int], sizes: list[int], size: int) -> None:
        self.x = np.frombuffer(raw).reshape(-1, size)
        self.n = np.array(n, dtype=np.int64)
        self.sizes = np.array(sizes)
        self.boxes: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def box(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        if (lo, hi) not in self.boxes:
            part = self.x[lo:hi, :AXES]
            self.boxes[lo, hi] = part.min(axis=0), part.max(axis=0)
        return self.boxes[lo, hi]


def merge_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the groups of a[i] and b[i]; a group is labelled with its smallest place."""
    while len(a):
        x, y = label[a], label[b]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            onward = label[label]
            if np.array_equal(onward, label):
                break
            label[:] = onward
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]


def join_intervals(a: Interval, b: Interval, same: bool, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(links of each vector of ``a``, of ``b``, the smallest place in a + b that each is connected to).

    Weights count, and with ``same`` every vector is linked to itself.
    """
    eps = eps_of(cosine)
    to_a, to_b = np.zeros(len(a.n), dtype=np.int64), np.zeros(len(b.n), dtype=np.int64)
    shift = 0 if same else len(a.n)
    label = np.arange(shift + len(b.n))
    todo = [(0, len(a.n), 0, len(b.n))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        (al, ah), (bl, bh) = a.box(a0, a1), b.box(b0, b1)
        gap = np.maximum(np.maximum(al - bh, bl - ah), 0)
        if gap @ gap > (eps + MARGIN) ** 2:
            continue
        if a1 - a0 > LEAF or b1 - b0 > LEAF:
            am, bm = ((a0 + a1) // 2, (b0 + b1) // 2)
            halves_a = [(a0, am), (am, a1)] if a1 - a0 > LEAF else [(a0, a1)]
            halves_b = [(b0, bm), (bm, b1)] if b1 - b0 > LEAF else [(b0, b1)]
            todo += [(*p, *q) for p in halves_a for q in halves_b if not (same and p[0] > q[0])]
            continue
        linked = a.x[a0:a1] @ b.x[b0:b1].T >= cosine
        linked &= a.sizes[a0:a1, None] == b.sizes[None, b0:b1]
        if same and a0 == b0:
            np.fill_diagonal(linked, True)  # a vector is its own, whatever the last bit says
        if not linked.any():
            continue
        to_a[a0:a1] += linked @ b.n[b0:b1]
        if not (same and a0 == b0):
            (to_a if same else to_b)[b0:b1] += a.n[a0:a1] @ linked
        i, j = np.nonzero(linked)
        merge_labels(label, i + a0, j + b0 + shift)
    return to_a, to_b, label


FOUND = pa.schema([("cls", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def multiplied(pairs: DataFrame, blocks: DataFrame, size: int, cosine: float) -> DataFrame:
    """(cls, links, root) of the vectors that have links in the pairs of blocks; a row for each tile and vector.

    A tile is up to PAIRS pairs, of some blocks with as many others: a task gets each of its blocks
    once, so that a block is sent as often as it has tiles, not pairs. Few pairs are tiles of one.
    """
    pairs = written(pairs, "grid-todo")
    side = max(1, math.isqrt(min(PAIRS, pairs.count() // TILES)))

    def run(todo: pa.Table, held: pa.Table) -> pa.Table:
        held = held.sort_by("block")
        # The matrices are read in place.
        raw = [x.as_buffer() for x in held.column("vectors")]
        names, n, sizes = (held.column(c).to_pylist() for c in ("block", "n", "sizes"))
        found = {name: Interval(*x, size) for name, *x in zip(names, raw, n, sizes)}
        ends = np.cumsum([len(x) for x in n])
        at = {name: np.arange(end - len(x), end) for name, x, end in zip(names, n, ends)}
        cls = np.concatenate([np.array(x, dtype=np.int64) for x in held.column("cls").to_pylist()])
        links, label = np.zeros(len(cls), dtype=np.int64), np.arange(len(cls))
        for a, b in zip(todo.column("a").to_pylist(), todo.column("b").to_pylist()):
            same = a == b
            to_a, to_b, root = join_intervals(found[a], found[b], same, cosine)
            links[at[a]] += to_a
            links[at[b]] += to_b
            places = at[a] if same else np.concatenate([at[a], at[b]])
            apart = np.nonzero(root != np.arange(len(root)))[0]
            merge_labels(label, places[apart], places[root[apart]])
        has = np.nonzero(links)[0]
        return pa.Table.from_batches([record_batch(FOUND, cls[has], links[has], cls[label[has]])])

    keys = ["_ta", "_tb"]
    tiled = pairs.select(F.expr(f"a div {side}").alias("_ta"), F.expr(f"b div {side}").alias("_tb"), "a", "b")
    needed = tiled.select(*keys, F.explode(F.array_distinct(F.array("a", "b"))).alias("block")).distinct()
    sent = needed.withColumnsRenamed({"_ta": "_sa", "_tb": "_sb"}).join(blocks, "block")
    return tiled.groupBy(*keys).cogroup(sent.groupBy("_sa", "_sb")).applyInArrow(run, "cls long, links long, root long")


def _whole_links(near: DataFrame, placed: DataFrame, block: int, blocks: int) -> tuple[DataFrame, DataFrame]:
    """(weights (cls, links) and links (a, b)) of the intervals that are near as a whole.

    What is said of an interval goes to its blocks first, so that no key of a join has more
    vectors than a block.
    """
    per_node = near.groupBy("level", "node").agg(F.sum("added").alias("added"), F.min("first").alias("first"))
    top = math.ceil(math.log(max(blocks, 1), FAN)) + 1
    every = near.sparkSession.range(blocks).select(F.col("id").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(top))).alias("level"))
    every = every.withColumn("node", F.floor(F.col("block") / F.pow(F.lit(FAN), F.col("level"))))
    said = every.join(per_node, ["level", "node"]).groupBy("block").agg(F.sum("added").alias("links"), F.min("first").alias("a"))
    hit = placed.select("cls", F.expr(f"cls div {block}").alias("block")).join(said, "block")
    stars = near.select(F.col("first").alias("a"), F.col("other").alias("b")).union(hit.select("a", F.col("cls").alias("b")))
    return hit.select("cls", "links"), stars


def near_vectors(vectors: DataFrame, cosine: float = 0.95) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row (vec_id, embedding) of ``vectors``."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.withColumn("vector", F.when(usable(F.col("vector")), F.col("vector")))
    classes = rows.filter("vector IS NOT NULL").groupBy("vector").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"))
    classes = written(classes, "grid-classes")
    facts = classes.agg(F.max(F.size("vector")).alias("size"), F.count(F.lit(1)).alias("n")).first()
    if not facts["n"]:
        return alone_rows(rows)
    size, eps = facts["size"], eps_of(cosine)
    block = max(LEAF, min(BLOCK, BLOCK_BYTES // (8 * size)))
    axes = principal_axes(classes, size)
    placed = in_grid_order(classes, axes, max(eps, MARGIN))
    blocks, bounds = packed(placed, block, axes)
    many = -(-facts["n"] // block)
    pairs, near = interval_pairs(bounds, many, eps)
    found = written(multiplied(pairs, blocks, size, cosine), "grid-links")
    more, stars = _whole_links(near, placed, block, many)
    added = found.select("cls", "links").union(more)
    links = found.select(F.col("root").alias("a"), F.col("cls").alias("b")).union(stars)
    roots = connected_components(links.filter("a != b"))
    named = placed.select("cls", "vector", "least", "n").join(added.groupBy("cls").agg(F.sum("links").alias("links")), "cls", "left")
    named = named.join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    components = named.groupBy("root").agg(F.min("least").alias("component_id"))
    known = named.join(components, "root").select("vector", "component_id", (F.coalesce("links", "n") - 1).alias("n_links"))
    # Rows of one vector are many at most on this side, which the adaptive skew join splits.
    linked = rows.filter("vector IS NOT NULL").join(known, "vector")
    linked = linked.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
    return linked.union(alone_rows(rows))


def alone_rows(rows: DataFrame) -> DataFrame:
    """The rows without a usable vector, each for itself."""
    own = F.col("vec_id")
    return rows.filter("vector IS NULL").select(own, F.lit(0).cast("long").alias("n_links"), own.alias("component_id"), F.lit(True).alias("kept"))
