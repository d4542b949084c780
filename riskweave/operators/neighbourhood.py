"""Anomalous nodes within k hops of many users at once.

Walking out of a hub (an identifier shared by very many nodes) would repeat the
hub's neighbours for every user linked to it. So hubs are never walked through.
They are walked from, once each, and a user's distance through hubs is looked up:
``min over hubs h of dist(user, h) + dist(h, node)``. Hubs and anomalous nodes are
numbered; the nodes behind a hub are bitmaps, which users merge. Counts stay exact; no
(user, neighbour of hub) pair is ever built.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave import rules
from riskweave.functions.weights import lookup
from riskweave.operators.association import association_counts
from riskweave.operators.graph import Graph, dealt, union_all
from riskweave.operators.ordinal import with_positions
from riskweave.operators.risk import neighbour_edges
from riskweave.operators.skew import salted_lookup
from riskweave.session import written_table

MIN_HUB_DEGREE = 1000
#: Hubs or listed nodes that are sent to every task, by names of some twenty bytes; more are joined.
BROADCAST_NODES = 200_000
#: Facts of an end that counts go by.
_FACTS = {"kind": "string", "label": "string", "assoc": "long"}
#: Bytes of one bitmap at most, 32,768 nodes, so that two bytes are a place in it.
BUCKET_BYTES = 4096
#: Listed nodes are a bitmap in the merge if that is not this much longer.
DENSE = 32
#: Bytes of hub bitmaps that a task holds, and (start, hub) pairs of the starts that it merges.
PART_BYTES = 64 << 20
BLOCK_PAIRS = 2 << 20
MIN_BLOCK_PAIRS = 1 << 18
#: Bytes of bitmaps of the starts that a task lists the nodes of, and rows that it lists at once.
BLOCK_BYTES = 128 << 20
LISTED_ROWS = 1 << 16


def node_id(node_type: Column | str, key: Column | str) -> Column:
    return F.concat_ws("|", node_type, key)


def _uid(start: str) -> Column:
    return F.substr(start, F.lit(len("uid|") + 1)).alias("uid")


def classify(graph: Graph) -> DataFrame:
    """Anomalous nodes: ``node, kind, label, assoc``.

    ``blacklisted`` for a marked uid, phone or identity, else ``shared`` for a
    non-uid identifier of more than one uid.
    """
    counts = association_counts(graph.edges)
    marked = F.col("is_blacklisted") & F.col("node_type").isin(*rules.BLACKLISTABLE_TYPES)
    shared = (F.col("node_type") != "uid") & (F.col("assoc") > 1)
    return (
        graph.nodes.filter(F.col("node_type").isin(*rules.ANOMALY_NODE_TYPES))
        .select("node_type", "key", "is_blacklisted")
        .join(counts, ["node_type", "key"], "left")
        .withColumn("assoc", F.coalesce("associated_uid_count", F.lit(0)))
        .withColumn("kind", F.when(marked, "blacklisted").when(shared, "shared"))
        .filter(F.col("kind").isNotNull())
        .select(
            node_id("node_type", "key").alias("node"), "kind", F.col("node_type").alias("label"), "assoc"
        )
    )


@dataclass(frozen=True)
class Reach:
    """Walks that pass through no hub, from the starts and from the hubs, with hubs and ends as numbers.

    ``lists``: start, codes (see :func:`code`) of the hubs and ends that its walks meet. ``hubs``: hub, hub_no.
    ``hub_ends``: hub_no, b, number. ``between``: hub_no, other_no (a hub), b. ``numbers`` and
    ``classes`` of the ends by :func:`numbered_nodes`. ``steps``: start, node, d of the nodes
    that are walked through, maybe at larger distances too. ``k``: hops.
    """

    lists: DataFrame
    hubs: DataFrame
    hub_ends: DataFrame
    between: DataFrame
    numbers: DataFrame
    classes: DataFrame
    steps: DataFrame
    k: int

    @property
    def walks(self) -> DataFrame:
        """start, node, d (shortest) of all nodes that walks from the starts meet."""
        coded = self.lists.select("start", F.explode("codes").alias("code"))
        value, d = F.expr(f"code div {2 * (self.k + 1)}"), F.expr(f"cast(code div 2 % {self.k + 1} AS int)")
        met = coded.select("start", value.alias("number"), d.alias("d"), (F.col("code") % 2 == 1).alias("is_hub"))
        ends = met.filter("NOT is_hub").join(self.numbers, "number").select("start", "node", "d")
        hubs = met.filter("is_hub").join(self.hubs, F.col("number") == F.col("hub_no")).select("start", F.col("hub").alias("node"), "d")
        return self.steps.unionByName(ends).unionByName(hubs).groupBy("start", "node").agg(F.min("d").alias("d"))


def code(value: Column | str, d: int, k: int, is_hub: bool) -> Column:
    """A hub's or an end's number with its distance, as one number."""
    value = F.col(value) if isinstance(value, str) else value
    return (value.cast("long") * (k + 1) + d) * 2 + int(is_hub)


def useful_types(edges: DataFrame, end_types: list[str], k: int) -> list[str]:
    """Node types that a walk of ``k`` hops from a uid, or of ``k - 1`` from a hub, can pass or end at.

    The links between types are a table of a few rows, whatever the data. A type counts when
    the hops that are left on first meeting it can still lead to a type of ``end_types``.
    """
    linked = edges.select("src_type", "dst_type").distinct().collect()
    around: dict[str, set[str]] = {}
    for a, b in linked:
        around.setdefault(a, set()).add(b)
        around.setdefault(b, set()).add(a)

    def hops(sources: list[str]) -> dict[str, int]:
        far, edge = dict.fromkeys(sources, 0), set(sources)
        while edge:
            edge = {n for t in edge for n in around.get(t, ())} - set(far)
            far.update(dict.fromkeys(edge, max(far.values()) + 1))
        return far

    met, left = hops(["uid"]), hops(end_types)
    return [t for t in around if t in left and left[t] <= max(k - met.get(t, k), k - 2) or t == "uid"]


def _adjacency(edges: DataFrame, numbers: DataFrame, k: int) -> DataFrame:
    """(node, next, number) of the links that walks can use, with the number of ``next`` if it is an end.

    Links by several relations are several rows. Only links to a type that ends have are looked up.
    """
    # A value for each node type.
    end_types = [r.t for r in numbers.select(F.substring_index("node", "|", 1).alias("t")).distinct().collect()]
    types = useful_types(edges, end_types, k)
    sides = neighbour_edges(edges, types)
    pairs = sides.select(node_id("node_type", "key").alias("node"), node_id("n_type", "n_key").alias("next"), "n_type")
    ends = numbers.select(F.col("node").alias("next"), "number")
    to_ends = pairs.filter(F.col("n_type").isin(end_types))
    looked = salted_lookup(to_ends, ends, ["next"], ["node"]).select("node", "next", "number")
    others = pairs.filter(~F.col("n_type").isin(end_types)).select("node", "next", F.lit(None).cast("long").alias("number"))
    return looked.unionByName(others)


def hubs_of(adjacency: DataFrame, min_degree: int = MIN_HUB_DEGREE) -> DataFrame:
    """Nodes with at least ``min_degree`` links, however large the graph is."""
    degrees = adjacency.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    return degrees.filter(F.col("degree") >= min_degree).select("node")


def _links(adjacency: DataFrame, hubs: DataFrame) -> DataFrame:
    """(node, hubs, ends, others): the links of each node that is no hub, fewer than the least degree of a hub.

    Hubs and ends are their numbers; only other nodes, which walks go on to, keep their names.
    """
    inner = adjacency.join(hubs.select(F.col("hub").alias("node")), "node", "left_anti")
    return inner.groupBy("node").agg(
        F.collect_set("hub_no").alias("hubs"),
        F.collect_set("number").alias("ends"),
        F.collect_set(F.when(F.col("hub_no").isNull(), F.col("next"))).alias("others"),
    )


def reach(
    graph: Graph, starts: DataFrame, ends: DataFrame, k: int = 3, min_hub_degree: int = MIN_HUB_DEGREE
) -> Reach:
    """Walk ``k`` hops from every uid in ``starts`` (column ``uid``) and ``k - 1`` from every hub.

    ``ends`` (column ``node``, distinct, with the facts of :func:`classify` if they are to be
    counted) and hubs are numbered. Nodes on the way are walked through by their links, one row
    for each; hubs and ends are met as numbers. A node of fewer than ``min_hub_degree``
    neighbours is walked through, so a walk of ``k`` hops from one uid meets fewer than
    ``min_hub_degree ** (k - 1)`` nodes before its last hop. What a hub reaches in two hops
    is met at the node between, which has both in its links.

    A node can be met again at a larger distance: whoever reads the walks takes the least.
    """
    facts = [c if c in ends.columns else F.lit(0).cast(t).alias(c) for c, t in _FACTS.items()]
    numbers, classes = numbered_nodes(ends.select("node", *facts))
    numbers = written_table(numbers, "node-numbers")
    plain = written_table(_adjacency(graph.edges, numbers, k), "adjacency")
    hubs = with_positions(hubs_of(plain, min_hub_degree).withColumnRenamed("node", "hub"), ["hub"], "hub_no")
    hubs = written_table(hubs.withColumn("hub_no", F.col("hub_no").cast("int")), "hubs")
    few = F.broadcast(hubs) if hubs.count() <= BROADCAST_NODES else hubs
    adjacency = plain.join(few.select(F.col("hub").alias("next"), "hub_no"), "next", "left")
    links = written_table(_links(adjacency, few), "links")

    uids = graph.nodes.filter(F.col("node_type") == "uid").select(node_id("node_type", "key").alias("start"))
    asked = starts.select(node_id(F.lit("uid"), "uid").alias("start")).distinct().join(uids, "start", "left_semi")
    asked = written_table(asked.distinct(), "starts")
    own = asked.join(numbers, asked["start"] == numbers["node"]).select("start", F.array(code("number", 0, k, False)).alias("codes"))
    first = adjacency.filter(F.col("node").startswith("uid|")).withColumnRenamed("node", "start").join(asked, "start", "left_semi")
    first = written_table(first.filter("next != start").select("start", "next", "hub_no", "number"), "first-hop")

    def codes(hub: Column, end: Column, d: int) -> Column:
        """What a hop meets; hubs of the last one lead nowhere."""
        return F.concat(hub, end) if d < k else end

    one = lambda c, is_hub: F.array_compact(F.array(code(c, 1, k, is_hub)))
    met = [own, first.select("start", codes(one("hub_no", True), one("number", False), 1).alias("codes"))]
    frontier = first.filter("hub_no IS NULL").select("start", F.col("next").alias("node"))
    steps = [asked.select("start", F.col("start").alias("node"), F.lit(0).alias("d"))]
    for d in range(2, k + 1):
        steps.append(frontier.withColumn("d", F.lit(d - 1)))
        hub = F.transform("hubs", lambda h: code(h, d, k, True))  # noqa: B023
        end = F.transform("ends", lambda e: code(e, d, k, False))  # noqa: B023
        # Dealt out by rows: the few files of a short table would be as few tasks, each with many links to add.
        step = dealt(frontier, "node").join(links, "node").select("start", codes(hub, end, d).alias("codes"), "others")
        if d < k:
            step = written_table(step, "step")
            frontier = step.select("start", F.explode("others").alias("node")).filter("node != start").distinct()
        met.append(step.select("start", "codes"))
    rows = union_all([m.filter(F.size("codes") > 0) for m in met])
    lists = rows.groupBy("start").agg(F.array_distinct(F.flatten(F.collect_list("codes"))).alias("codes"))

    by_hub = adjacency.join(few.select(F.col("hub").alias("node"), F.col("hub_no").alias("of")), "node")
    return Reach(
        written_table(lists, "start-lists"), hubs, *_hub_walks(by_hub, links, k), numbers, classes, union_all(steps), k
    )


def _hub_walks(by_hub: DataFrame, links: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(hub_no, b, number) of the ends and (hub_no, other_no, b) of the hubs that each hub's walks meet."""
    ends = [by_hub.filter("number IS NOT NULL").select(F.col("of").alias("hub_no"), F.lit(1).alias("b"), "number")]
    others = [by_hub.filter("hub_no IS NOT NULL").select(F.col("of").alias("hub_no"), F.col("hub_no").alias("other_no"), F.lit(1).alias("b"))]
    # A node's hubs are the hubs that it is one hop from.
    step = links.select("node", F.explode("hubs").alias("hub_no"), F.col("hubs").alias("met"), "ends", "others")
    for b in range(2, k):
        ends.append(step.select("hub_no", F.lit(b).alias("b"), F.explode("ends").alias("number")))
        if b <= k - 2:
            others.append(step.select("hub_no", F.explode("met").alias("other_no"), F.lit(b).alias("b")))
        if b < k - 1:
            frontier = step.select("hub_no", F.explode("others").alias("node")).distinct()
            step = written_table(
                dealt(frontier, "node").join(links, "node").withColumnRenamed("hubs", "met"), "hub-step"
            )
    ends, others = (ends, others) if k > 1 else ([e.limit(0) for e in ends], [o.limit(0) for o in others])
    shortest = union_all(ends).groupBy("hub_no", "number").agg(F.min("b").alias("b"))
    near = union_all(others).filter("hub_no != other_no").groupBy("hub_no", "other_no").agg(F.min("b").alias("b"))
    near = near.filter(F.col("b") <= max(k - 2, 0))
    return written_table(shortest, "hub-ends"), written_table(near, "between-hubs")


def numbered_nodes(anomalies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, number), and the classes (kind, label, assoc, class, low, high) with their bytes in a bitmap of all numbers.

    Nodes of one kind, type and association count have consecutive numbers from a whole byte
    on, so that a count of a class is a count of the bits of some bytes.
    """
    facts = list(_FACTS)
    placed = with_positions(anomalies.select("node", *facts), [*facts, "node"], "at")
    classes = placed.groupBy(*facts).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    classes = with_positions(classes, ["first"], "class")
    # A byte is left free before each class, which is room enough to round up.
    start = F.ceil(F.col("first") / 8) * 8 + F.col("class") * 8
    classes = written_table(classes.withColumn("start", start), "node-classes")
    numbers = placed.join(classes.select(*facts, "first", "start"), facts)
    low, high = F.col("start") / 8, F.ceil((F.col("start") + F.col("n")) / 8)
    return (
        numbers.select("node", (F.col("start") + F.col("at") - F.col("first")).alias("number")),
        classes.select(*facts, "class", low.cast("long").alias("low"), high.cast("long").alias("high")),
    )


def _rows_of(lists: pa.ChunkedArray) -> list[np.ndarray]:
    """The lists of a column as arrays, without a copy of their values; a null is empty."""
    none = np.zeros(0, dtype=np.int64)
    return [x.values.to_numpy(zero_copy_only=False) if x.is_valid else none for chunk in lists.chunks for x in chunk]


def _bits(places: list[np.ndarray], width: int) -> np.ndarray:
    flags = np.zeros(width * 8, dtype=bool)
    for at in places:
        flags[at] = True
    return np.packbits(flags, bitorder="little")


#: Rows of :func:`_close_hubs` by kind: numbers that a hub meets, hubs that it meets, hops that are asked of it.
_ENDS, _HUBS, _ASKED = 0, 1, 2
_CLOSED = "part long, hub_no int, d int, few boolean, nodes binary"


def _close_hubs(k: int, width: int):
    """The nodes of one part that each asked hub reaches within a number of hops, also through hubs behind it.

    A few are listed by their places, more are a bitmap.
    """

    def close(rows: pa.Table) -> pa.Table:
        hub, b, kind = (rows.column(c).to_pylist() for c in ("hub_no", "b", "kind"))
        at = _rows_of(rows.column("at"))
        own: dict[tuple[int, int], np.ndarray] = {}
        links: dict[int, list[tuple[int, list[int]]]] = {}
        asked: dict[int, int] = {}
        for i, h in enumerate(hub):
            if kind[i] == _ASKED:
                asked[h] = b[i]
            elif kind[i] == _ENDS:
                own[b[i], h] = at[i]
            else:
                links.setdefault(h, []).append((b[i], at[i].tolist()))
        known: dict[tuple[int, int], np.ndarray] = {}

        def within(d: int, h: int) -> np.ndarray:
            """Bitmap of the nodes that are at most ``d`` hops behind ``h``."""
            places = [own[c, h] for c in range(1, d + 1) if (c, h) in own]
            further = []
            for step, others in links.get(h, ()):
                if step == d - 1:
                    places += [own[1, o] for o in others if (1, o) in own]
                elif step < d:
                    further += [(d - step, o) for o in others]
            bits = _bits(places, width)
            for key in further:
                if key not in known:
                    known[key] = within(*key)
                np.bitwise_or(bits, known[key], out=bits)
            return bits

        out: dict[str, list] = {"hub_no": [], "d": [], "few": [], "nodes": []}
        for h, hops in asked.items():
            for d in range(1, hops + 1):
                bits = within(d, h)
                n = int(np.bitwise_count(bits).sum())
                if n:
                    few = 2 * n < width
                    nodes = np.flatnonzero(np.unpackbits(bits, bitorder="little")).astype(np.uint16) if few else bits
                    for name, value in zip(out, (h, d, few, nodes.tobytes())):
                        out[name].append(value)
        part = pa.array([rows.column("part")[0].as_py()] * len(out["d"]), pa.int64())
        types = {"hub_no": pa.int32(), "d": pa.int32(), "few": pa.bool_(), "nodes": pa.binary()}
        return pa.table({"part": part} | {name: pa.array(out[name], t) for name, t in types.items()})

    return close


def _held(part: pa.Table, used: int) -> dict[tuple[int, int], tuple[np.ndarray | None, np.ndarray]]:
    """What each hub has within a number of hops, by both: a bitmap of the part, or the places of a few nodes."""
    pieces: dict[tuple[int, int], list] = {}
    for h, d, at, few, nodes in zip(*(part.column(c).to_pylist() for c in ("hub_no", "d", "at", "few", "nodes"))):
        if nodes is not None:
            pieces.setdefault((d, h), []).append((at, few, nodes))
    out = {}
    for key, found in pieces.items():
        if any(not few for _, few, _ in found) or DENSE * sum(len(nodes) for _, _, nodes in found) >= used:
            row = np.zeros(used, dtype=np.uint8)
            for at, few, nodes in found:
                if few:
                    place = np.frombuffer(nodes, dtype=np.uint16).astype(np.int64) + at * 8
                    np.bitwise_or.at(row, place >> 3, np.left_shift(1, place & 7).astype(np.uint8))
                else:
                    end = min(used, at + len(nodes))
                    row[at:end] = np.frombuffer(nodes, dtype=np.uint8)[: end - at]
            out[key] = row.view(np.uint64), None
        else:
            out[key] = None, np.concatenate([np.frombuffer(nodes, dtype=np.uint16).astype(np.int64) + at * 8 for at, _, nodes in found])
    return out


def _unions(starts: pa.Table, part: pa.Table, k: int, used: int) -> Iterator[tuple[str, list[np.ndarray]]]:
    """(start, bitmaps of what it has within 0 to ``k`` hops) of each start of a block."""
    within = _held(part, used)
    for start, hubs, own in zip(starts.column("start").to_pylist(), _rows_of(starts.column("hubs")), _rows_of(starts.column("own"))):
        by_a = [(hubs[hubs % (k + 1) == a] // (k + 1)).tolist() for a in range(k)]
        at_d, number = own % (k + 1), own // (k + 1)
        now, found = np.zeros(used, dtype=np.uint8), []
        for hop in range(k + 1):
            now = now.copy()
            words = now.view(np.uint64)
            few = [number[at_d == hop]]
            for a in range(1, hop):
                for h in by_a[a]:
                    row, places = within.get((hop - a, h), (None, None))
                    if row is not None:
                        np.bitwise_or(words, row, out=words)
                    elif places is not None:
                        few.append(places)
            bits = np.concatenate(few)
            np.bitwise_or.at(now, bits >> 3, np.left_shift(1, bits & 7).astype(np.uint8))
            found.append(now)
        yield start, found


def _segments(part: pa.Table) -> tuple[np.ndarray, np.ndarray, int]:
    """(first bytes, classes) of the classes of a part, and its bytes up to the last one's end in whole words."""
    hub, d, at = (part.column(c).to_pylist() for c in ("hub_no", "d", "at"))
    rows = sorted((at[i], d[i], at[i] - hub[i]) for i in range(len(hub)) if hub[i] < 0)
    first, classes = np.array([r[0] for r in rows], dtype=np.int64), np.array([r[1] for r in rows], dtype=np.int32)
    # Bytes behind the last class are zero.
    return first, classes, -(-max((r[2] for r in rows), default=0) // 8) * 8


_MERGED = "start string, class array<int>, hop array<int>, n array<int>"
_LISTED = "start string, part long, nodes array<binary>"


def _merge_block(k: int):
    """Counts per start of a block of starts by the bitmaps of one part of the numbers, as arrays."""

    def lists(rows: list) -> pa.ListArray:
        offsets = np.zeros(len(rows) + 1, dtype=np.int32)
        np.cumsum([len(r) for r in rows], out=offsets[1:])
        values = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))

    def merge(starts: pa.Table, part: pa.Table) -> pa.Table:
        first, classes, used = _segments(part)
        out: dict[str, list] = {"start": [], "class": [], "hop": [], "n": []}
        for start, found in _unions(starts, part, k, used) if used else ():
            n = [np.add.reduceat(np.bitwise_count(bits), first, dtype=np.int32) for bits in found]
            merged = [np.zeros(0, dtype=np.int32)] * 3
            for hop in range(1, k + 1):
                fresh = n[hop] - n[hop - 1]
                some = np.flatnonzero(fresh)
                rows = (classes[some], np.full(len(some), hop, dtype=np.int32), fresh[some])
                merged = [np.concatenate(c) for c in zip(merged, rows)]
            if len(merged[0]):
                for name, values in zip(out, [start, *merged]):
                    out[name].append(values)
        counted = {name: lists(out[name]) for name in ("class", "hop", "n")}
        return pa.table({"start": pa.array(out["start"], pa.string()), **counted})

    return merge


def _list_block(k: int):
    """Bitmaps of the nodes at 1 to ``k`` hops per start of a block, by those of one part of the numbers."""

    def merge(starts: pa.Table, part: pa.Table) -> pa.Table:
        used = _segments(part)[2]
        out: tuple[list, list] = ([], [])
        for start, found in _unions(starts, part, k, used) if used else ():
            out[0].append(start)
            out[1].append([(found[hop] & ~found[hop - 1]).tobytes() for hop in range(1, k + 1)])
        at = pa.array([part.column("part")[0].as_py()] * len(out[0]) if out[0] else [], pa.int64())
        return pa.table({"start": pa.array(out[0], pa.string()), "part": at, "nodes": pa.array(out[1], pa.list_(pa.binary()))})

    return merge


@dataclass(frozen=True)
class _Blocks:
    """What the merge of starts reads: ``left`` (block, part, start, hubs, own), ``right`` (block, part, hub_no, d, few, nodes, at)."""

    left: DataFrame
    right: DataFrame
    classes: DataFrame
    width: int
    parts: int


def _blocks(found: Reach, part_bytes: int, block_pairs: int, block_bytes: int = 0) -> _Blocks:
    """Starts in blocks and the numbers of ends in parts.

    What the hubs that starts have reach is made once, in narrow parts that are joined up to at
    most about ``part_bytes`` of bitmaps; those of a part go to every block. A block has about
    ``block_pairs`` (start, hub) pairs, with ``block_bytes`` no more starts than have so many
    bytes of bitmaps.
    """
    k, classes = found.k, found.classes
    step = 2 * (k + 1)
    is_hub = lambda c: c % 2 == 1
    pairs = found.lists.select(F.explode(F.filter("codes", is_hub)).alias("code"))
    asked = pairs.select(F.expr(f"cast(code div {step} AS int)").alias("hub_no"), F.expr(f"code div 2 % {k + 1}").alias("a"))
    asked = written_table(asked.groupBy("hub_no").agg(F.min("a").alias("a"), F.count(F.lit(1)).alias("n")), "asked-hubs")
    none = lambda t: F.lit(None).cast(t)
    # Hubs are closed in narrow parts, each in a task.
    bucket = 8
    while bucket < BUCKET_BYTES and 2 * bucket <= part_bytes:
        bucket *= 2
    total = (classes.agg(F.max("high")).first()[0] or 0) + 1
    buckets = -(-total // bucket)
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long")))
    columns = ["part", "hub_no", "b", "kind", "at"]
    places = found.hub_ends.groupBy(F.expr(f"number div {bucket * 8}").alias("part"), "hub_no", "b").agg(
        F.collect_list((F.col("number") % (bucket * 8)).cast("int")).alias("at")
    )
    places = places.withColumn("kind", F.lit(_ENDS)).select(columns)
    behind = found.between.groupBy("hub_no", "b").agg(F.collect_list("other_no").alias("at"))
    behind = behind.withColumn("kind", F.lit(_HUBS)).withColumn("part", every).select(columns)
    wanted = asked.filter(F.col("a") < k).withColumn("part", every).withColumn("kind", F.lit(_ASKED))
    wanted = wanted.withColumn("b", (k - F.col("a")).cast("int")).withColumn("at", none("array<int>")).select(columns)
    by_part = dealt(union_all([places, behind, wanted]), "part")
    closed = written_table(by_part.groupBy("part").applyInArrow(_close_hubs(k, bucket), _CLOSED), "hub-bitmaps")

    # Three numbers lay out the work. A listed node counts for the bitmap that it may become.
    held = F.when(F.col("few"), F.least(DENSE * F.length("nodes"), F.lit(bucket))).otherwise(F.lit(bucket))
    held = closed.agg(F.coalesce(F.sum(held), F.lit(0))).first()[0]
    pairs = asked.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    width = bucket * -(-buckets // min(buckets, max(1, -(-held // part_bytes))))
    parts = -(-total // width)
    # Small bitmaps are cheap to hand to many blocks.
    blocks = max(1, -(-pairs // min(block_pairs, max(MIN_BLOCK_PAIRS, held // parts // 32))))
    if block_bytes:
        blocks = max(blocks, -(-found.lists.count() * width * (k + 1) // block_bytes))
    at = (F.col("part") * bucket % width).cast("int").alias("at")
    closed = closed.select(F.expr(f"part * {bucket} div {width}").alias("part"), "hub_no", "d", "few", "nodes", at)
    bits = width * 8

    low_part, high_part = F.expr(f"low div {width}"), F.expr(f"(high - 1) div {width}")
    # A class has the negative of its bytes in the place of a hub's number.
    begin = F.greatest(F.col("low") - F.col("part") * width, F.lit(0))
    segments = classes.withColumn("part", F.explode(F.sequence(low_part, high_part))).select(
        "part",
        (begin - F.least(F.col("high") - F.col("part") * width, F.lit(width))).cast("int").alias("hub_no"),
        F.col("class").cast("int").alias("d"),
        none("boolean").alias("few"),
        none("binary").alias("nodes"),
        begin.cast("int").alias("at"),
    )
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    right = closed.unionByName(segments).withColumn("block", every_block)

    # A hub's number and distance, or an end's, as one number.
    far = F.transform(F.filter("codes", is_hub), lambda c: F.floor(c / 2).cast("int"))
    near = F.transform(F.filter("codes", lambda c: ~is_hub(c)), lambda c: F.floor(c / 2))
    every_part = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))
    lists = found.lists.select("start", F.pmod(F.xxhash64("start"), F.lit(blocks)).cast("int").alias("block"), far.alias("hubs"), near.alias("near"))
    left = lists.withColumn("part", every_part).select(
        "block",
        "part",
        "start",
        "hubs",
        F.expr(f"transform(filter(near, x -> x div {bits * (k + 1)} = part), x -> x - part * {bits * (k + 1)})").alias("own"),
    )
    return _Blocks(left, right, classes.withColumn("cut", low_part != high_part), width, parts)


def anomaly_counts(
    found: Reach, anomalies: DataFrame, part_bytes: int = PART_BYTES, block_pairs: int = BLOCK_PAIRS
) -> DataFrame:
    """Per start: ``hop, kind, label, assoc, n`` over its anomalous nodes, exact.

    ``n`` nodes of that kind, type and association count lie at that shortest hop. ``anomalies``
    are the ends that ``found`` was made with; their numbers lie by class. What a start has
    within a number of hops is the union of its hubs' bitmaps and of that of its own walks;
    what it has at a hop is that union less the one before, counted by the bytes of a class.
    The start itself is at hop 0.

    A task merges a block of starts, as lists of hub numbers, with the bitmaps of their hubs of
    one part of the nodes. Unions of a start are never written or shuffled, only its counts.
    The work in tasks stays starts by hubs of a start by nodes / 64.
    """
    made = _blocks(found, part_bytes, block_pairs)
    keys = ["block", "part"]
    left, right = (dealt(side, *keys).groupBy(*keys) for side in (made.left, made.right))
    merged = left.cogroup(right).applyInArrow(_merge_block(found.k), _MERGED)
    merged = written_table(merged, "start-counts")
    rows = merged.select("start", F.inline(F.arrays_zip("class", "hop", "n")))
    # A row for each kind, type and association count that occurs.
    named = F.broadcast(made.classes.select(F.col("class").cast("int"), *_FACTS, "cut"))
    rows = rows.join(named, "class")
    facts = ["start", "hop", *_FACTS]
    summed = rows.filter("cut").groupBy(*facts).agg(F.sum("n").alias("n"))
    whole = rows.filter("NOT cut").select(*facts, F.col("n").cast("long").alias("n"))
    out = whole.unionByName(summed) if made.parts > 1 else whole
    return out.select(_uid("start"), "hop", *_FACTS, "n")


def anomaly_nodes(found: Reach, anomalies: DataFrame, part_bytes: int = PART_BYTES, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """The anomalous nodes themselves, one row per start and node at its shortest hop.

    The listing is as large as the answer, but only bitmaps of a start leave the tasks that
    merge, as in :func:`anomaly_counts`; they become rows where they are read, and no pair
    of a start and a node is shuffled but to look up a node. Reports use :func:`anomaly_counts`.
    """
    made = _blocks(found, part_bytes, block_pairs, BLOCK_BYTES)
    keys, bits = ["block", "part"], made.width * 8
    left, right = (dealt(side, *keys).groupBy(*keys) for side in (made.left, made.right))
    merged = left.cogroup(right).applyInArrow(_list_block(found.k), _LISTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, part, hops in zip(*(batch.column(c).to_pylist() for c in range(3))):
                for hop, nodes in enumerate(hops, 1):
                    at = np.flatnonzero(np.unpackbits(np.frombuffer(nodes, dtype=np.uint8), bitorder="little")) + part * bits
                    for i in range(0, len(at), LISTED_ROWS):
                        some = at[i : i + LISTED_ROWS]
                        names = pa.DictionaryArray.from_arrays(np.zeros(len(some), dtype=np.int32), pa.array([start])).cast(pa.string())
                        yield pa.RecordBatch.from_arrays([names, pa.array(np.full(len(some), hop, dtype=np.int32)), pa.array(some)], names=["start", "hop", "number"])

    rows = merged.mapInArrow(run, "start string, hop int, number long")
    known = written_table(found.numbers.join(anomalies.select("node", *_FACTS), "node"), "listed-nodes")
    known = F.broadcast(known) if known.count() <= BROADCAST_NODES else known
    return rows.join(known, "number").select(
        _uid("start"), "hop", "kind", "label", F.expr("substr(node, length(label) + 2)").alias("key"), "assoc"
    )


# -- reports over members (uid, grp) and their anomaly counts -----------------


def _hops(members: DataFrame, k: int) -> DataFrame:
    return members.select("grp", "uid", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("hop"))


def member_hop_totals(members: DataFrame, counts: DataFrame, k: int = 3) -> DataFrame:
    """Anomalous nodes per member and hop, zero included."""
    totals = counts.groupBy("uid", "hop").agg(F.sum("n").alias("n"))
    return _hops(members, k).join(totals, ["uid", "hop"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def mean_by_hop(totals: DataFrame) -> DataFrame:
    return totals.groupBy("grp", "hop").agg(F.avg("n").alias("mean_nodes"))


def type_distribution(members: DataFrame, counts: DataFrame) -> DataFrame:
    """Per group, hop and type: mean, max, min count over the members that have it."""
    per_member = counts.groupBy("uid", "hop", "kind", "label").agg(F.sum("n").alias("n"))
    return (
        members.join(per_member, "uid")
        .groupBy("grp", "hop", "kind", "label")
        .agg(
            F.avg("n").alias("mean_nodes"),
            F.max("n").alias("max_nodes"),
            F.min("n").alias("min_nodes"),
            F.count(F.lit(1)).alias("members_with"),
        )
    )


def association_frequencies(members: DataFrame, counts: DataFrame) -> DataFrame:
    """Per group, hop and type: how often each association count above zero occurs."""
    return (
        members.join(counts.filter(F.col("assoc") > 0), "uid")
        .groupBy("grp", "hop", "kind", "label", "assoc")
        .agg(F.sum("n").alias("n"))
    )


def association_distribution(frequencies: DataFrame) -> DataFrame:
    """Mean, median, max and min association count, from the frequency table."""
    return frequencies.groupBy("grp", "hop", "kind", "label").agg(
        (F.sum(F.col("assoc") * F.col("n")) / F.sum("n")).alias("mean_assoc"),
        F.percentile("assoc", 0.5, F.col("n")).alias("median_assoc"),
        F.max("assoc").alias("max_assoc"),
        F.min("assoc").alias("min_assoc"),
    )


def association_first(frequencies: DataFrame, first: int = 10) -> DataFrame:
    """The ``first`` smallest association counts with their frequency."""
    w = Window.partitionBy("grp", "hop", "kind", "label").orderBy("assoc")
    return frequencies.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= first).drop("_r")


def member_totals(totals: DataFrame) -> DataFrame:
    """Total anomalous nodes per member, with the breakdown by hop (k entries)."""
    entries = F.sort_array(F.collect_list(F.struct("hop", "n")))
    return totals.groupBy("grp", "uid").agg(
        F.sum("n").alias("total"), F.map_from_entries(entries).alias("by_hop")
    )


def isolated_members(per_member: DataFrame, threshold: int = rules.ISOLATION_THRESHOLD) -> DataFrame:
    return per_member.filter(F.col("total") <= threshold)


def isolation_statistics(per_member: DataFrame, threshold: int = rules.ISOLATION_THRESHOLD) -> DataFrame:
    """Per group: members, isolated members and rate, totals of the others."""
    alone = F.col("total") <= threshold
    other = F.when(~alone, F.col("total"))
    return per_member.groupBy("grp").agg(
        F.count(F.lit(1)).alias("members"),
        F.count_if(alone).alias("isolated"),
        F.try_divide(F.count_if(alone), F.count(F.lit(1))).alias("isolation_rate"),
        F.count(other).alias("others"),
        F.coalesce(F.avg(other), F.lit(0.0)).alias("others_avg"),
        F.coalesce(F.max(other), F.lit(0)).alias("others_max"),
        F.coalesce(F.min(other), F.lit(0)).alias("others_min"),
    )


def compare_groups(means: DataFrame, isolation: DataFrame, first: str, second: str) -> DataFrame:
    """Mean per hop of two groups with their ratio, a total row (hop null), and alerts."""
    wide = means.groupBy("hop").agg(
        F.max(F.when(F.col("grp") == first, F.col("mean_nodes"))).alias("first_mean"),
        F.max(F.when(F.col("grp") == second, F.col("mean_nodes"))).alias("second_mean"),
    )
    total = wide.agg(F.sum("first_mean").alias("first_mean"), F.sum("second_mean").alias("second_mean"))
    both = wide.unionByName(total.select(F.lit(None).cast("int").alias("hop"), "first_mean", "second_mean"))
    rate = isolation.filter(F.col("grp") == first).agg(F.max("isolation_rate").alias("r")).scalar()
    ratio = F.try_divide("first_mean", F.nullif(F.col("second_mean"), F.lit(0.0)))
    whole = F.col("hop").isNull()
    return both.select(
        "hop",
        "first_mean",
        "second_mean",
        ratio.alias("ratio"),
        F.when(whole, rate > rules.ISOLATION_RATE_ALERT).alias("high_isolation"),
        F.when(whole, F.coalesce(ratio > rules.GROUP_RATIO_ALERT, F.col("first_mean") > 0)).alias("high_association"),
    )


def hop_scores(members: DataFrame, counts: DataFrame) -> DataFrame:
    """Hop-weighted anomaly score per member; members without anomalies score zero."""
    weights = {
        f"{hop}|{kind}|{label}": w for hop, kinds in rules.HOP_WEIGHTS.items() for (kind, label), w in kinds.items()
    }
    weight = lookup(weights, F.concat_ws("|", F.col("hop").cast("string"), "kind", "label"), 0.0)
    flat = (F.col("kind") == "blacklisted") & (F.col("label") == "uid")
    term = weight * F.when(flat, F.lit(1)).otherwise(F.col("assoc") - 1) * F.col("n")
    scores = counts.groupBy("uid").agg(F.sum(term).alias("score"))
    return members.join(scores, "uid", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))


def graph_cohort(graph: Graph) -> DataFrame:
    """All uids of the graph in two groups by their blacklist mark."""
    grp = F.when(F.col("is_blacklisted"), "blacklist").otherwise("normal")
    return graph.nodes.filter(F.col("node_type") == "uid").select(F.col("key").alias("uid"), grp.alias("grp"))


def group_report(members: DataFrame, counts: DataFrame, k: int = 3) -> dict[str, DataFrame]:
    """The parts of the report on both groups: means by hop, isolation, types by hop, members with their totals by hop."""
    totals = member_hop_totals(members, counts, k)
    per_member = member_totals(totals)
    return {
        "mean_by_hop": mean_by_hop(totals),
        "isolation": isolation_statistics(per_member),
        "types": type_distribution(members, counts),
        "members": per_member.select("grp", "uid", "total", *[F.col("by_hop")[h].alias(f"hop_{h}") for h in range(1, k + 1)]),
    }
