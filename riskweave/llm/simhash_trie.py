"""SimHash near-duplicates by a self-join of binary tries.

Fingerprints are 64 bits. The links, pairs at ``radius`` or fewer differing bits,
come from a trie over the distinct fingerprints that is joined with itself: node
pairs descend together, each carries the bits in which its two prefixes differ so
far, and a pair is dropped as soon as that exceeds the budget.

Of ``turns`` equal parts of the bits, at least one has radius // turns or fewer
differences. So the trie is built once per part, with that part's bits first and
with the smaller budget on them, which prunes early at any size. Spark deals the
subtree pairs to tasks: one cell for each pair of top prefixes within the budget.

Defined results: a null text counts as empty, an empty one has the fingerprint 0 and
links like any other; equal fingerprints always belong together; repeated rows each
get a row; a null doc_id gets a component but never names one (a component that has
only null ids has a null id); an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import batches, connected_components, record_batch, text_bytes, written

#: Fingerprints that one cell holds before it is dealt out in chunks.
CELL = 50_000
#: Node pairs or leaf pairs that a task works on at a time.
FRONT = 1 << 17
#: Node pairs of at most so many leaf pairs are compared leaf by leaf.
LEAVES = 64

FP = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])


def shingles(words: list[bytes], n: int) -> list[bytes]:
    """The n-word shingles, or the whole sequence if it is shorter; none of no words."""
    if len(words) <= n:
        return [b" ".join(words)] if words else []
    return [b" ".join(s) for s in zip(*(words[i:] for i in range(n)))]


def majority(hashes: list[int], counts: list[int]) -> np.ndarray:
    """One fingerprint for each group of ``counts`` hashes: the bits set in over half of it."""
    n = np.asarray(counts, dtype=np.int64)
    out = np.zeros(len(n), dtype=np.int64)
    full = np.nonzero(n)[0]
    if len(full):
        bits = np.unpackbits(np.array(hashes, dtype=np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = np.concatenate([[0], np.cumsum(n[full])[:-1]])
        votes = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        out[full] = np.packbits(2 * votes > n[full, None], axis=1, bitorder="little").view(np.int64)[:, 0]
    return out


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp) of each row: SimHash over the XXH64 (seed 42) of lower-cased word shingles."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for ids, raw in batches(rows):
            hashes: list[int] = []
            counts = []
            for b in raw:
                s = shingles(b.lower().split(), words)
                counts.append(len(s))
                hashes += [digest(x, 42) for x in s]
            yield record_batch(FP, ids, majority(hashes, counts))

    return text_bytes(docs).mapInArrow(run, "doc_id long, fp long")


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def join_tries(keys: np.ndarray, low: int, high: int, depth: int, part: int, most: int, radius: int) -> np.ndarray:
    """The smallest index that each of the sorted ``keys`` is linked to, itself included.

    The roots are the nodes of the ``depth``-bit prefixes ``low`` and ``high``. Over the
    first ``part`` bits a node pair may differ in ``most`` bits, in all in ``radius``.
    """
    label = np.arange(len(keys), dtype=np.int64)

    def link(a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = label[a], label[b]
            lo, hi = np.minimum(ra, rb), np.maximum(ra, rb)
            np.minimum.at(label, hi, lo)
            while True:
                to = label[label]
                if np.array_equal(to, label):
                    break
                label[:] = to
            apart = label[a] != label[b]
            a, b = a[apart], b[apart]

    def leaves(xl, xh, yl, yh) -> None:
        n = (xh - xl) * (yh - yl)
        ends = np.cumsum(n)
        first = 0
        while first < len(n):
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + FRONT, "right")))
            m, wide = n[first:last], (yh - yl)[first:last]
            at = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            a = np.repeat(xl[first:last], m) + at // np.repeat(wide, m)
            b = np.repeat(yl[first:last], m) + at % np.repeat(wide, m)
            near = (a < b) & (np.bitwise_count(keys[a] ^ keys[b]) <= radius)
            link(a[near], b[near])
            first = last

    def span(prefix: int) -> tuple[int, int]:
        if depth == 0:
            return 0, len(keys)
        start = np.uint64(prefix << (64 - depth))
        stop = prefix + 1 << (64 - depth)
        return int(np.searchsorted(keys, start)), len(keys) if stop >> 64 else int(np.searchsorted(keys, np.uint64(stop)))

    (a0, a1), (b0, b1) = span(low), span(high)
    if a0 == a1 or b0 == b1:
        return label
    one = lambda v: np.array([v], dtype=np.int64)
    todo = [(depth, one(a0), one(a1), one(b0), one(b1), one((low ^ high).bit_count()))]
    while todo:
        d, xl, xh, yl, yh, off = todo.pop()
        small = (xh - xl) * (yh - yl) <= LEAVES
        if d == 64:
            small[:] = True
        leaves(xl[small], xh[small], yl[small], yh[small])
        xl, xh, yl, yh, off = (v[~small] for v in (xl, xh, yl, yh, off))
        if not len(xl):
            continue
        bit = np.uint64(1) << np.uint64(63 - d)
        above = ~((bit << np.uint64(1)) - np.uint64(1)) if d else np.uint64(0)
        split = lambda lo, hi: np.clip(np.searchsorted(keys, (keys[lo] & above) | bit), lo, hi)
        xm, ym = split(xl, xh), split(yl, yh)
        same = xl == yl
        budget = most if d < part else radius
        parts = []
        for left, right, differs in (((xl, xm), (yl, ym), 0), ((xm, xh), (ym, yh), 0), ((xl, xm), (ym, yh), 1), ((xm, xh), (yl, ym), 1)):
            keep = (left[0] < left[1]) & (right[0] < right[1]) & (off + differs <= budget)
            if differs and left[0] is xm:
                keep &= ~same  # the mirror of the pair before
            parts.append([v[keep] for v in (*left, *right, off + differs)])
        front = [np.concatenate(v) for v in zip(*parts)]
        for i in range(0, len(front[0]), FRONT):
            todo.append((d + 1, *(v[i : i + FRONT] for v in front)))
    return label


def _rotated(fp: Column | str, by: Column | int) -> Column:
    """``fp`` with its first ``by`` bits moved to the end."""
    by = by if isinstance(by, Column) else F.lit(by)
    left = F.call_function("shiftleft", fp, by)
    right = F.call_function("shiftrightunsigned", fp, (F.lit(64) - by) % 64)
    return F.when(by == 0, fp).otherwise(left.bitwiseOR(right))


def trie_links(distinct: DataFrame, radius: int, turns: int = 2, cell: int = CELL) -> DataFrame:
    """Links (a, b) that connect what fingerprints ``fp`` within ``radius`` connect.

    ``distinct`` has each fingerprint once. Every cell returns a spanning star of each
    group that it connects, never all pairs. Cells of more than ``cell`` fingerprints
    are dealt out as pairs of chunks, so that none is too large for a task.
    """
    total = distinct.count()
    part, most = 64 // turns, radius // turns
    depth = min(part, max(0, math.ceil(math.log2(max(1, total) / (cell / 4)))))
    masks = [sum(1 << i for i in c) for k in range(most + 1) for c in combinations(range(depth), k)]
    turned = distinct.select("fp", F.explode(F.array(*[F.lit(t) for t in range(turns)])).alias("turn"))
    turned = turned.withColumn("key", _rotated(F.col("fp"), F.col("turn") * part))
    prefix = F.call_function("shiftrightunsigned", F.col("key"), F.lit(64 - depth)) if depth else F.lit(0).cast("long")
    dealt = turned.withColumn("at", prefix).withColumn("mask", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])))
    other = F.col("at").bitwiseXOR(F.col("mask"))
    dealt = dealt.select("key", "turn", F.least("at", other).alias("low"), F.greatest("at", other).alias("high"))
    sizes = dealt.groupBy("turn", "low", "high").agg(F.count(F.lit(1)).alias("n"))
    large = sizes.select("turn", "low", "high", F.ceil(F.col("n") / cell).cast("int").alias("chunks")).filter("chunks > 1")
    dealt = dealt.join(large, ["turn", "low", "high"], "left").fillna(1, ["chunks"])
    own = F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: F.struct(F.least(own, c).alias("i"), F.greatest(own, c).alias("j")))
    dealt = dealt.select("key", "turn", "low", "high", F.explode(pairs).alias("c")).select("key", "turn", "low", "high", "c.i", "c.j")

    def run(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        turn, low, high = (int(v) for v in group[:3])
        keys = np.sort(rows["key"].to_numpy().view(np.uint64))
        label = join_tries(keys, low, high, depth, part, most, radius)
        at = np.nonzero(label != np.arange(len(label)))[0]
        by = np.uint64(turn * part)
        back = (keys >> by | keys << (np.uint64(64) - by)) if turn else keys
        return pd.DataFrame({"a": back[label[at]].view(np.int64), "b": back[at].view(np.int64)})

    return dealt.groupBy("turn", "low", "high", "i", "j").applyInPandas(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id, n_same) of each row of ``docs``.

    ``component_id`` is the smallest doc_id that links reach; ``n_same`` counts the rows
    with the same fingerprint.
    """
    prints = written(fingerprints(docs, words), "simhash")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n_same"))
    roots = connected_components(trie_links(classes.select("fp"), radius))
    named = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    named = named.withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    found = named.join(least, "root").select("fp", "component_id", "n_same")
    out = prints.join(found, "fp")
    return out.select("doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id", "n_same")
