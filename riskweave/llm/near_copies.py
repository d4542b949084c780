"""Near copies by word shingles: SimHash and a prefix filter propose, exact Jaccard similarity decides.

One pass over the texts makes, for each, the fingerprint of its distinct longer words and
the first of the sorted hashes of its shingles, its prefix; texts of the same words are one
class from then on. Classes are proposed in stars around a hub: the binary trie
join of :mod:`riskweave.llm.simhash_trie` connects what differs in RADIUS bits or fewer,
and all classes that have a prefix shingle in common are a star around the smallest of
them, which covers every pair of the asked similarity (:func:`prefix_stars`). Within each
star the exact similarity of shingle sets decides, by an inverted index over its texts, so
that no pair is ever a row; every similar pair meets in some star. Stars of more than CHUNK
texts are dealt out as pairs of chunks. Components are made once, of what has been verified.

Defined results: texts with equal lower-cased words are copies, those without words
included; a null text counts as empty; rows of equal doc_id and text are one document
here; a null doc_id never names a group that has another; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import batches, connected_components, record_batch, text_bytes, texts, written
from riskweave.llm.simhash_trie import majority, trie_links

RADIUS, TURNS = 3, 2
#: Words of fewer letters say nothing of a text unless it has no others.
LONG = 4
#: Texts, and their words, of a chunk; a task indexes the shingles of two chunks at a time.
CHUNK = 1500
CHUNK_WORDS = 500_000
#: A similar pair has at least one shingle more in common, among those that are compared, for so many of its shingles.
SPARE = 20

PRINTS = pa.schema(
    [("doc_id", pa.int64()), ("mark", pa.int64()), ("whole", pa.int64()), ("fp", pa.int64()), ("size", pa.int64())]
    + [("spare", pa.int32()), ("keys", pa.list_(pa.int64()))]
)


def mark_of(text: str) -> Column:
    """A hash of a text, null or empty ones alike."""
    return F.xxhash64(F.coalesce(F.col(text).cast("binary"), F.lit("").cast("binary")))


def _signed(x: int) -> int:
    return x - ((x >> 63) << 64)


def shared_least(size: int) -> int:
    """The common shingles that a pair has among the compared ones, if both texts have ``size`` or more."""
    return 1 + size // SPARE


def hashed_shingles(words: list[bytes], n: int) -> np.ndarray:
    """The sorted distinct hashes of the n-word shingles, from one hash for each word."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    one = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    n = min(n, len(words))
    out = np.full(len(words) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        out = (out ^ one[k : len(one) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def prints(docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """(doc_id, mark, whole, fp, size, spare, keys) of each row.

    Hashes of the text and of its words, the fingerprint of its distinct longer words, the
    number of its words, and its prefix shingles ``keys``, of which ``spare`` can be left out.
    """

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for ids, raw, marks in batches(rows):
            votes: list[int] = []
            counts, wholes, sizes, spare, keys = [], [], [], [], []
            for b in raw:
                ws = b.lower().split()
                long_ = {w for w in ws if len(w) >= LONG} or set(ws)
                sizes.append(len(ws))
                counts.append(len(long_))
                votes += [digest(w, 42) for w in long_]
                wholes.append(_signed(digest(b" ".join(ws))))
                all_ = hashed_shingles(ws, words)
                common = math.ceil(similarity * len(all_) - 1e-6)
                spare.append(shared_least(common) - 1)
                keys.append(all_[: len(all_) - common + shared_least(len(all_))].view(np.int64))
            yield record_batch(PRINTS, ids, marks, wholes, majority(votes, counts), sizes, spare, keys)

    marked = text_bytes(docs).withColumn("mark", mark_of("text"))
    return marked.mapInArrow(run, "doc_id long, mark long, whole long, fp long, size long, spare int, keys array<long>")


def shingle_sets(docs: DataFrame, heads: DataFrame, words: int) -> DataFrame:
    """(whole, set): the hashes of the shingles of the texts that ``heads`` (whole, head) name; no others travel."""
    schema = pa.schema([("whole", pa.int64()), ("set", pa.binary())])

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, raw in batches(found):
            yield record_batch(schema, whole, [hashed_shingles(b.lower().split(), words).tobytes() for b in raw])

    marked = text_bytes(docs).withColumn("mark", mark_of("text"))
    heads = heads.select("whole", F.col("head.doc_id").alias("_id"), F.col("head.mark").alias("_mark"))
    asked = marked.join(heads, marked["doc_id"].eqNullSafe(heads["_id"]) & (marked["mark"] == heads["_mark"])).select("whole", "text")
    # Rows of equal doc_id and text come out alike.
    return asked.mapInArrow(run, "whole long, set binary")


def prefix_stars(classes: DataFrame) -> DataFrame:
    """(hub, whole) that bring every two similar texts of ``classes`` (whole, spare, keys) together at some hub.

    Of two similar texts the larger, of n shingles, has at least ceil(similarity * n) in
    common with the other. In the order of the hashes, the first of those, shared_least of
    them, lie among the first n - ceil(similarity * n) + shared_least(n) of either text: only
    these prefixes are compared. Of the common ones the rarest has all others behind it when
    a prefix goes by frequency, so that the most frequent ones of a prefix, one fewer than it
    surely shares, can be left out. What passages are made of mostly goes that way. Texts that
    share one of the rest meet at the smallest text that has it.
    """
    rows = classes.select("whole", "spare", F.explode("keys").alias("key"))
    often = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    rank = F.dense_rank().over(Window.partitionBy("whole").orderBy(F.desc("n"), "key"))
    left = rows.join(often, "key").withColumn("_rank", rank).filter("_rank > spare").select("key", "whole")
    left = written(left, "copy-keys")
    least = left.groupBy("key").agg(F.min("whole").alias("hub"), F.max("whole").alias("_last")).filter("hub < _last")
    return left.join(least.select("key", "hub"), "key").select("hub", "whole").distinct()


def print_stars(classes: DataFrame, radius: int, turns: int) -> DataFrame:
    """(hub, whole) of ``classes`` (whole, fp) whose fingerprints the trie connects; the hub is a fingerprint."""
    links = trie_links(classes.select("fp").distinct(), radius, turns)
    hubs = links.select(F.col("b").alias("fp"), F.col("a").alias("hub"))
    own = classes.select(F.col("fp").alias("hub"), "whole")
    return own.union(classes.join(hubs, "fp").select("hub", "whole")).distinct()


def similar(sets: list[np.ndarray], fresh: int, similarity: float) -> np.ndarray:
    """The smallest text that each text is linked to.

    Common shingles are counted text by text through the index, against later texts. With
    ``fresh`` only pairs of a text before that place and one from there on count.
    """
    n = len(sets)
    label = np.arange(n)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    flat = np.concatenate(sets) if n else np.zeros(0, dtype=np.uint64)
    owner = np.repeat(np.arange(n), size)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    first = np.searchsorted(flat, flat, side="left")
    last = np.searchsorted(flat, flat, side="right")
    # The places of each text's shingles in the index.
    place = np.argsort(owner, kind="stable")
    cuts = np.cumsum(size) - size

    def root(i: int) -> int:
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for i in range(fresh or n):
        mine = place[cuts[i] : cuts[i] + size[i]]
        a, b = first[mine], last[mine]
        many = b - a > 1
        a, b = a[many], b[many]
        if not len(a):
            continue
        lengths = b - a
        at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(a, lengths)
        common = np.bincount(owner[at], minlength=n)
        common[: fresh or i + 1] = 0
        near = np.nonzero(common)[0]
        near = near[common[near] >= similarity * (size[i] + size[near] - common[near]) - 1e-9]
        for j in near.tolist():
            x, y = root(i), root(j)
            if x != y:
                label[max(x, y)] = min(x, y)
    return np.array([root(i) for i in range(n)], dtype=np.int64)


def near_copies(docs: DataFrame, words: int = 5, similarity: float = 0.8, radius: int = RADIUS, turns: int = TURNS) -> DataFrame:
    """(doc_id, mark, group_id, group_mark) of each distinct (doc_id, text).

    The group's names are those of its smallest doc_id; ``mark`` is :func:`mark_of` the text.
    """
    table = written(prints(docs, words, similarity), "copies")
    least = F.struct(F.col("doc_id").isNull(), "doc_id", "mark")
    # All rows of a class agree in what comes from its words.
    same = [F.first(c).alias(c) for c in ("fp", "size", "spare", "keys")]
    classes = table.groupBy("whole").agg(F.min(least).alias("head"), *same)
    classes = written(classes, "copy-classes")
    stars = print_stars(classes.select("whole", "fp"), radius, turns).withColumn("by", F.lit(0))
    stars = stars.union(prefix_stars(classes.select("whole", "spare", "keys")).withColumn("by", F.lit(1)))
    stars = written(stars.join(classes.select("whole", "size"), "whole"), "copy-stars")
    sizes = stars.groupBy("by", "hub").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words")).filter("n > 1")
    chunks = F.greatest(F.ceil(F.col("n") / CHUNK), F.ceil(F.col("words") / CHUNK_WORDS), F.lit(1)).cast("int")
    # Only texts that have a proposed partner travel.
    asked = stars.join(sizes.select("by", "hub", chunks.alias("chunks")), ["by", "hub"]).select("by", "hub", "whole", "chunks")
    asked = written(asked, "copies-asked")
    sets = shingle_sets(docs, classes.select("whole", "head").join(asked.select("whole").distinct(), "whole"), words)
    own = F.pmod(F.xxhash64("whole"), F.col("chunks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: F.struct(F.least(own, c).alias("i"), F.greatest(own, c).alias("j")))
    dealt = asked.select("by", "hub", "whole", own.alias("own"), F.explode(pairs).alias("c"))
    dealt = dealt.join(sets, "whole").select("by", "hub", "whole", "own", "c.i", "c.j", "set")

    def run(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        i, j = int(group[2]), int(group[3])
        rows = rows.sort_values(["own", "whole"], kind="stable")
        fresh = int((rows["own"] == i).sum()) if i != j else 0
        label = similar([np.frombuffer(s, dtype=np.uint64) for s in rows["set"]], fresh, similarity)
        whole = rows["whole"].to_numpy()
        at = np.nonzero(label != np.arange(len(label)))[0]
        return pd.DataFrame({"a": whole[label[at]], "b": whole[at]})

    links = dealt.groupBy("by", "hub", "i", "j").applyInPandas(run, "a long, b long")
    roots = connected_components(links)
    named = classes.select("whole", "head").join(roots.withColumnRenamed("node", "whole"), "whole", "left")
    named = named.withColumn("root", F.coalesce("root", "whole"))
    groups = named.groupBy("root").agg(F.min("head").alias("keep"))
    found = named.join(groups, "root").select("whole", F.col("keep.doc_id").alias("group_id"), F.col("keep.mark").alias("group_mark"))
    return table.select("doc_id", "mark", "whole").distinct().join(found, "whole").select("doc_id", "mark", "group_id", "group_mark")


def one_of_each(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are: of each group of near copies the one of the smallest doc_id.

    Of rows that are equal in doc_id and text one stays.
    """
    copies = near_copies(docs, words, similarity)
    stay = copies.filter(F.col("doc_id").eqNullSafe(F.col("group_id")) & (F.col("mark") == F.col("group_mark")))
    stay = stay.select(F.col("doc_id").alias("_stay_id"), F.col("mark").alias("_stay_mark"))
    marked = docs.withColumn("_mark", mark_of("text"))
    same = marked["doc_id"].cast("long").eqNullSafe(stay["_stay_id"]) & (marked["_mark"] == stay["_stay_mark"])
    kept = marked.join(stay, same, "left_semi")
    again = texts(docs).groupBy("doc_id", F.xxhash64("text").alias("mark")).count().filter("count > 1")
    if not again.isEmpty():
        kept = kept.dropDuplicates(["doc_id", "_mark"])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
