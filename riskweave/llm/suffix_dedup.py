"""Suffix-array deduplication of bytes by a distributed, prefix-aware merge sort.

Every 50-byte string that also starts in a document with a smaller id is to go. Not all
suffixes need sorting. Of the 24-byte strings in a 50-byte window at least one has the
smallest hash; its place is an *anchor* of the window, and equal windows have equal
anchors. So it is enough to sort, for the anchors, the 50 bytes from there on, and beside
them the 26 bytes before.

1. Documents are dealt into units. Each unit reports its anchors' hashes; what only one
   document of the corpus has needs no sorting (a filter: it may let too much through).
2. Each unit sorts the remaining suffixes, keeps equal ones once with their smallest
   doc_id, and front-codes the run: shared prefix length and rest. Runs are cut at the
   range borders and exchanged.
3. Each range merges its runs with a loser tree whose players know the prefix they share
   with the last winner, and compare only what lies behind it. The merge yields the
   suffixes in order with their common prefixes, which is a suffix array with its LCP
   array: neighbours that share 50 - k bytes, and whose k bytes before are equal, share
   the window that begins k bytes before the anchor.
4. Each unit learns which of its windows start in a smaller document, and cuts them out.

Defined results: null and empty texts stay as they are, and so do texts under 50 bytes; rows
with equal doc_id do not remove from each other; a null doc_id counts as larger than all
others; repeated rows each get a row; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import batches, text_bytes

WINDOW = 50
GRAM = 24
#: Bytes before an anchor at which its windows begin, at most; bytes of a sort key.
BEFORE = WINDOW - GRAM
KEY = WINDOW
#: Bytes of text of a unit; of text for each bucket of hashes and each range, roughly.
UNIT_BYTES = 2 << 20
BUCKET_BYTES = 32 << 20
RANGE_BYTES = 16 << 20
#: Keys that the range borders are drawn from, at most; a text gives about one in
#: BORDER_BYTES bytes, and so many texts are asked as give twice the keys.
BORDER_KEYS = 20_000
BORDER_BYTES = 850
#: Places of one context that a unit sends along with it; if there are more it sends the
#: first, and finds the others again when the answer is there.
PLACES = 32
NO_DOC = np.iinfo(np.int64).max

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)


def pack(**arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob."""
    head = ";".join(f"{k}:{v.dtype.str}" for k, v in arrays.items()).encode()
    raw = [np.ascontiguousarray(v).tobytes() for v in arrays.values()]
    body = b"".join(x for r in raw for x in (len(r).to_bytes(8, "little"), r))
    return zstandard.compress(len(head).to_bytes(4, "little") + head + body, 1)


def unpack(blob: bytes) -> dict[str, np.ndarray]:
    raw = zstandard.decompress(blob)
    at = 4 + int.from_bytes(raw[:4], "little")
    out = {}
    for item in raw[4:at].decode().split(";"):
        name, kind = item.split(":")
        n = int.from_bytes(raw[at : at + 8], "little")
        out[name] = np.frombuffer(raw, dtype=kind, count=n // np.dtype(kind).itemsize, offset=at + 8)
        at += 8 + n
    return out


class Unit:
    """The documents of a unit in a fixed order, as one run of bytes."""

    def __init__(self, doc_ids: list, raw: list[bytes]) -> None:
        order = sorted(range(len(raw)), key=lambda i: (doc_ids[i] is None, doc_ids[i] or 0, raw[i]))
        self.doc_ids = [doc_ids[i] for i in order]
        self.raw = [raw[i] for i in order]
        self.docs = np.array([NO_DOC if d is None else d for d in self.doc_ids], dtype=np.int64)
        sizes = np.array([len(b) for b in self.raw], dtype=np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.bytes = np.frombuffer(b"".join(self.raw), dtype=np.uint8)

    def grams(self) -> np.ndarray:
        """A hash of the GRAM bytes from each place on; places too near a text's end have the largest."""
        n = len(self.bytes) - GRAM + 1
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        h = self.bytes.astype(np.uint64)
        h += np.uint64(1)
        h *= MULTIPLIER
        size, of = 1, {1: h}
        while size * 2 <= GRAM:
            a = of[size]
            b = a[: len(a) - size] * MIX
            b += a[size:]
            b ^= b >> np.uint64(29)
            b *= MULTIPLIER
            size *= 2
            of = {size: b} | {k: v for k, v in of.items() if GRAM & k}
        # GRAM = 16 + 8: join the parts of its binary digits.
        out, at = None, 0
        for k in sorted((k for k in of if GRAM & k), reverse=True):
            part = of[k][at : at + n]
            out = part.copy() if out is None else (out * MIX + part) * MULTIPLIER
            at += k
        out ^= out >> np.uint64(32)
        np.minimum(out, ~np.uint64(0) - np.uint64(1), out=out)
        for end in self.ends[:-1]:
            out[max(0, end - GRAM + 1) : end] = ~np.uint64(0)
        return out

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """(places, hashes) of the anchors of all windows."""
        h = self.grams()
        span = BEFORE + 1
        if len(h) < span:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        low = sliding(h, span, np.minimum)
        # A place is an anchor if it is the smallest of one of the windows around it. No
        # window lies across two texts, and such a stretch may only add places.
        padded = np.concatenate([np.zeros(span - 1, np.uint64), low, np.zeros(span - 1, np.uint64)])
        at = np.nonzero((sliding(padded, span, np.maximum) == h) & (h != ~np.uint64(0)))[0]
        return at, h[at]


def sliding(a: np.ndarray, span: int, best) -> np.ndarray:
    """The best of each ``span`` neighbours."""
    size, out = 1, a
    while size * 2 <= span:
        out = best(out[:-size], out[size:])
        size *= 2
    rest = span - size
    return best(out[: len(out) - rest], out[rest:]) if rest else out


def unit_of(table: pa.Table) -> Unit:
    return Unit(table.column("doc_id").to_pylist(), table.column("text").to_pylist())


def parts_of(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, 32 more bits) of hashes; ``buckets`` is a power of two."""
    bits = buckets.bit_length() - 1
    top = (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), dtype=np.int64)
    return top, (h << np.uint64(bits) >> np.uint64(32)).astype(np.uint32)


def report(unit: Unit, buckets: int) -> list[tuple[int, bytes]]:
    """(bucket, blob): the unit's distinct anchor hashes, and which of them two of its documents have."""
    at, h = unit.anchors()
    doc = np.searchsorted(unit.ends, at, side="right")
    owner = unit.docs[doc]
    order = np.argsort(h, kind="stable")
    h, owner = h[order], owner[order]
    if not len(h):
        return []
    first = np.nonzero(np.concatenate([[True], h[1:] != h[:-1]]))[0]
    several = np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first)
    top, low = parts_of(h[first], buckets)
    cuts = np.searchsorted(top, np.arange(buckets + 1))
    return [(b, pack(low=low[i:j], several=several[i:j])) for b, (i, j) in enumerate(zip(cuts, cuts[1:])) if i < j]


def shared(blobs: list[tuple[int, bytes]]) -> list[tuple[int, bytes]]:
    """(unit, blob): the hashes of a bucket that more than one document may have, to each unit that has them."""
    found = [(u, unpack(b)) for u, b in blobs]
    low = np.concatenate([f["low"] for _, f in found])
    several = np.concatenate([f["several"] for _, f in found])
    values, inverse, counts = np.unique(low, return_inverse=True, return_counts=True)
    many = (counts > 1) | (np.bincount(inverse, weights=several, minlength=len(values)) > 0)
    keep = many[inverse]
    out, at = [], 0
    for u, f in found:
        n = len(f["low"])
        some = f["low"][keep[at : at + n]]
        at += n
        if len(some):
            out.append((u, pack(low=some)))
    return out


class Contexts:
    """The distinct contexts of a unit's shared anchors, in order, and where they are."""

    def __init__(self, unit: Unit, wanted: dict[int, np.ndarray], buckets: int) -> None:
        at, h = unit.anchors()
        top, low = parts_of(h, buckets)
        keep = np.zeros(len(at), dtype=bool)
        for b, values in wanted.items():
            inside = np.nonzero(top == b)[0] if buckets > 1 else np.arange(len(at))
            keep[inside] = np.isin(low[inside], values)
        at = at[keep]
        doc = np.searchsorted(unit.ends, at, side="right")
        after = np.minimum(unit.ends[doc] - at, KEY)
        before = np.minimum(at - unit.starts[doc], BEFORE)
        # Bytes plus one, which UTF-8 leaves free, so that 0 can stand for the end.
        plus = np.concatenate([np.zeros(BEFORE, np.uint8), unit.bytes + np.uint8(1), np.zeros(KEY, np.uint8)])
        wide = np.lib.stride_tricks.sliding_window_view(plus, KEY + BEFORE)[at]
        right = wide[:, BEFORE:].copy()
        right[np.arange(KEY) >= after[:, None]] = 0
        left = wide[:, BEFORE - 1 :: -1].copy() if BEFORE else wide[:, :0]
        left[np.arange(BEFORE) >= before[:, None]] = 0
        whole = np.concatenate([right, left], axis=1)
        order = np.argsort(np.ascontiguousarray(whole).view(f"S{KEY + BEFORE}")[:, 0], kind="stable")
        whole, doc, at = whole[order], doc[order], at[order]
        new = np.ones(len(at), dtype=bool)
        if len(at):
            new[1:] = (whole[1:] != whole[:-1]).any(axis=1)
        first = np.nonzero(new)[0]
        self.unit = unit
        self.at, self.doc = at, doc
        self.group = np.cumsum(new) - 1
        self.right, self.left = whole[first][:, :KEY], whole[first][:, KEY:]
        owner = unit.docs[doc]
        self.least = np.minimum.reduceat(owner, first) if len(first) else owner
        self.most = np.maximum.reduceat(owner, first) if len(first) else owner
        self.first = first


def common_prefixes(rows: np.ndarray) -> np.ndarray:
    """For each sorted key the bytes it shares with the one before; ends count as no byte."""
    out = np.zeros(len(rows), dtype=np.uint8)
    if len(rows) > 1:
        same = (rows[1:] == rows[:-1]) & (rows[1:] != 0)
        out[1:] = np.where(same.all(axis=1), rows.shape[1], np.argmin(same, axis=1))
    return out


def runs(c: Contexts, borders: np.ndarray) -> list[tuple[int, bytes]]:
    """(range, blob): the unit's contexts as front-coded runs, cut at the borders."""
    if not len(c.right):
        return []
    keys = np.ascontiguousarray(c.right).view(f"S{KEY}")[:, 0]
    to = np.searchsorted(borders, keys, side="right")
    cuts = np.searchsorted(to, np.arange(len(borders) + 2))
    places = np.append(c.first, len(c.at))
    out = []
    for r, (i, j) in enumerate(zip(cuts, cuts[1:])):
        if i == j:
            continue
        right, left = c.right[i:j], c.left[i:j]
        size = (right != 0).sum(axis=1).astype(np.uint8)
        lcp = common_prefixes(right)
        rest = right[(np.arange(KEY) >= lcp[:, None]) & (right != 0)]
        before = (left != 0).sum(axis=1).astype(np.uint8)
        n = np.diff(places[i : j + 1])
        hot = n > PLACES
        nth = np.arange(places[j] - places[i]) - np.repeat(places[i:j] - places[i], n)
        inside = places[i] + np.nonzero(~np.repeat(hot, n) | (nth == 0))[0]
        out.append((r, pack(
            lcp=lcp, size=size, rest=rest, before=before, left=left[left != 0], least=c.least[i:j], most=c.most[i:j],
            hot=hot, n=np.where(hot, 1, n).astype(np.int32), doc=c.doc[inside].astype(np.int32), at=(c.at - c.unit.starts[c.doc])[inside].astype(np.int32),
        )))
    return out


def merge(strings: list[list[bytes]], prefixes: list[list[int]]) -> tuple[list[int], list[int], list[int]]:
    """Merge sorted runs with a loser tree that never compares a known prefix again.

    ``prefixes`` has each string's common prefix with the one before it in its run. Returns
    the winners' runs, their places in them, and their common prefixes with the winner before.
    Every player in the tree knows the length of the prefix that it shares with the last
    winner. In a game the longer one wins; only at equal lengths are bytes compared, from
    there on, and the loser then knows what it shares with the winner.
    """
    runs_ = len(strings)
    size = 1 << max(0, runs_ - 1).bit_length()
    head = [0] * size
    length = [len(s) for s in strings] + [0] * (size - runs_)
    current: list[bytes | None] = [s[0] if s else None for s in strings] + [None] * (size - runs_)
    known = [0] * size
    tree = [-1] * size

    def game(a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two players with equal known prefixes."""
        s, t = current[a], current[b]
        if s is None or t is None:
            return (a, b) if t is None else (b, a)
        if s == t:
            known[b] = len(s)
            return a, b
        i, low = known[a], min(len(s), len(t))
        if s[i:low] == t[i:low]:
            i = low
        else:
            step = 8
            while s[i : i + step] == t[i : i + step]:
                i += step
            while s[i] == t[i]:
                i += 1
        if i == low:
            a, b = (a, b) if len(s) < len(t) else (b, a)
        elif s[i] > t[i]:
            a, b = b, a
        known[b] = i
        return a, b

    # Play the first round from the leaves up.
    winners = list(range(size))
    level = size
    while level > 1:
        level //= 2
        following = []
        for k in range(level):
            a, b = game(winners[2 * k], winners[2 * k + 1])
            tree[level + k] = b
            following.append(a)
        winners = following
    top = winners[0]
    out_run, out_at, out_known = [], [], []
    total = sum(length)
    for _ in range(total):
        out_run.append(top)
        out_at.append(head[top])
        out_known.append(known[top])
        # The winner's successor shares a prefix with it that its run knows.
        place = head[top] = head[top] + 1
        if place < length[top]:
            current[top] = strings[top][place]
            known[top] = prefixes[top][place]
        else:
            current[top] = None
            known[top] = -1
        node = (size + top) >> 1
        while node:
            other = tree[node]
            if known[other] > known[top]:
                tree[node], top = top, other
            elif known[other] == known[top]:
                top, tree[node] = game(top, other)
            node >>= 1
    return out_run, out_at, out_known


def decode(run: dict[str, np.ndarray]) -> tuple[list[bytes], list[int]]:
    """The keys of a front-coded run, and their common prefixes."""
    lcp, size = run["lcp"].tolist(), run["size"].tolist()
    rest, at, last, out = run["rest"].tobytes(), 0, b"", []
    for shared_, n in zip(lcp, size):
        last = last[:shared_] + rest[at : at + n - shared_]
        at += n - shared_
        out.append(last)
    return out, lcp


def answers(blobs: list[tuple[int, bytes]]) -> list[tuple[int, bytes]]:
    """(unit, blob): for each context of a range the smallest document that has it, and its windows that a smaller one has."""
    found = [(u, unpack(b)) for u, b in sorted(blobs)]
    decoded = [decode(f) for _, f in found]
    run, at, lcp = merge([d[0] for d in decoded], [d[1] for d in decoded])
    del decoded
    base = np.cumsum([0] + [len(f["lcp"]) for _, f in found])
    entry = base[np.array(run)] + np.array(at)
    lcp = np.array(lcp, dtype=np.int64)
    joined = lambda k: np.concatenate([f[k] for _, f in found])
    size, before, least, most = (joined(k).astype(np.int64)[entry] for k in ("size", "before", "least", "most"))
    n = len(entry)
    left = np.zeros((base[-1], BEFORE), dtype=np.uint8)
    left[np.arange(BEFORE) < joined("before")[:, None]] = joined("left")
    left = left[entry]
    # Equal contexts: equal keys, neighbours in the order, with equal bytes before.
    marks = np.zeros((n, BEFORE + 1), dtype=np.uint64)
    for k in range(BEFORE):
        marks[:, k + 1] = (marks[:, k] * MIX + left[:, k]) * MULTIPLIER + np.uint64(k)
        marks[:, k + 1] ^= marks[:, k + 1] >> np.uint64(31)
    same_key = np.concatenate([[False], (lcp[1:] == size[1:]) & (size[1:] == size[:-1])])
    key = np.cumsum(~same_key) - 1
    by = np.lexsort((least, marks[:, BEFORE], before, key))
    new = np.concatenate([[True], (key[by][1:] != key[by][:-1]) | (before[by][1:] != before[by][:-1]) | (marks[by, BEFORE][1:] != marks[by, BEFORE][:-1])])
    context = np.empty(n, dtype=np.int64)
    context[by] = np.cumsum(new) - 1
    heads = by[new]
    lowest, highest = least[heads], np.maximum.reduceat(most[by], np.nonzero(new)[0])
    # Of each context one entry goes on; contexts whose GRAM bytes stand alone have no others.
    heads_sorted = np.sort(heads)
    of = context[heads_sorted]
    # The common prefix of a head with the head before it is the least of those between.
    between = np.minimum.reduceat(lcp, heads_sorted) if len(heads_sorted) == 1 else _least_between(lcp, heads_sorted)
    gram = np.cumsum(np.concatenate([[True], between[1:] < GRAM])) - 1
    crowded = np.bincount(gram)[gram] > 1
    rows, share = heads_sorted[crowded], between[crowded]
    windows = np.zeros(len(heads), dtype=np.int64)
    if len(rows):
        low, doc = lowest[of[crowded]], np.zeros(len(rows), dtype=np.int64)
        gram_start = np.concatenate([[True], gram[crowded][1:] != gram[crowded][:-1]])
        for k in range(BEFORE + 1):
            able = (before[rows] >= k) & (size[rows] >= WINDOW - k)
            block = np.cumsum(gram_start | (share < WINDOW - k))
            idx = np.nonzero(able)[0]
            if len(idx) < 2:
                continue
            b, m, d = block[idx], marks[rows[idx], k], low[idx]
            by = np.lexsort((d, m, b))
            fresh = np.concatenate([[True], (b[by][1:] != b[by][:-1]) | (m[by][1:] != m[by][:-1])])
            lead = d[by][np.maximum.accumulate(np.where(fresh, np.arange(len(by)), 0))]
            hit = np.zeros(len(idx), dtype=bool)
            hit[by] = lead < d[by]
            doc[idx] |= hit.astype(np.int64) << k
        windows[of[crowded]] = doc
    # Tell each unit about its entries that lose something.
    first_doc, mask = lowest[context], windows[context]
    tell = (mask != 0) & (least == first_doc) | (most > first_doc)
    back_doc, back_mask = np.zeros(base[-1], dtype=np.int64), np.zeros(base[-1], dtype=np.int64)
    said = np.zeros(base[-1], dtype=bool)
    back_doc[entry], back_mask[entry], said[entry] = first_doc, mask, tell
    out = []
    for i, (u, f) in enumerate(found):
        mine = np.nonzero(said[base[i] : base[i + 1]])[0]
        if not len(mine):
            continue
        places = np.repeat(np.arange(len(f["n"])), f["n"])
        use = said[base[i] : base[i + 1]][places]
        of_place = places[use] + base[i]
        out.append((u, pack(doc=f["doc"][use], at=f["at"][use], hot=f["hot"][places[use]], first=back_doc[of_place], mask=back_mask[of_place])))
    return out


def _least_between(lcp: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """For each head the smallest common prefix on the way from the head before it."""
    # reduceat over [heads[i-1] + 1, heads[i] + 1).
    starts = np.concatenate([[0], heads[:-1] + 1])
    return np.minimum.reduceat(lcp[: heads[-1] + 1], starts)


def everywhere(unit: Unit, f: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The answers with all places of the contexts of which only the first was sent."""
    hot = np.nonzero(f["hot"])[0]
    if not len(hot):
        return f
    whole = unit.bytes.tobytes()
    doc, at, source = [f["doc"][~f["hot"]]], [f["at"][~f["hot"]]], [np.nonzero(~f["hot"])[0]]
    around = lambda place, d: (min(place - int(unit.starts[d]), BEFORE), min(int(unit.ends[d]) - place, KEY))
    for i in hot.tolist():
        d = int(f["doc"][i])
        place = int(unit.starts[d]) + int(f["at"][i])
        before, after = around(place, d)
        context, found, next_ = whole[place - before : place + after], [], 0
        while (next_ := whole.find(context, next_)) >= 0:
            found.append(next_ + before)
            next_ += 1
        places = np.array(found, dtype=np.int64)
        docs = np.searchsorted(unit.ends, places, side="right")
        same = (np.minimum(places - unit.starts[docs], BEFORE) == before) & (np.minimum(unit.ends[docs] - places, KEY) == after)
        doc.append(docs[same])
        at.append((places - unit.starts[docs])[same])
        source.append(np.full(int(same.sum()), i))
    by = np.concatenate(source)
    return {"doc": np.concatenate(doc), "at": np.concatenate(at), "first": f["first"][by], "mask": f["mask"][by]}


def cut(unit: Unit, told: list[bytes]) -> list[tuple]:
    """(doc_id, n_bytes, n_removed, n_spans, kept bytes) of each document of the unit."""
    edge = np.zeros(len(unit.bytes) + 1, dtype=np.int32)
    for blob in told:
        f = everywhere(unit, unpack(blob))
        owner = unit.docs[f["doc"]]
        at = unit.starts[f["doc"]] + f["at"]
        size = unit.ends[f["doc"]] - at
        every = owner > f["first"]
        for k in range(BEFORE + 1):
            hit = every | ((owner == f["first"]) & (f["mask"] >> k & 1).astype(bool))
            hit &= (f["at"] >= k) & (size >= WINDOW - k)
            start = at[hit] - k
            np.add.at(edge, start, 1)
            np.add.at(edge, start + WINDOW, -1)
    gone = np.cumsum(edge[:-1]) > 0
    out = []
    for d, b, i, j in zip(unit.doc_ids, unit.raw, unit.starts.tolist(), unit.ends.tolist()):
        g = gone[i:j]
        if not g.any():
            out.append((d, len(b), 0, 0, b))
            continue
        spans = int(g[0]) + int((g[1:] & ~g[:-1]).sum())
        out.append((d, len(b), int(g.sum()), spans, unit.bytes[i:j][~g].tobytes()))
    return out


def sample_keys(docs: DataFrame, every: int) -> np.ndarray:
    """Sorted keys of some anchors of one text in ``every``; at most BORDER_KEYS reach the driver."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, raw in batches(rows):
            unit = Unit(ids, raw)
            at, h = unit.anchors()
            at = at[h % np.uint64(64) == 0]
            keys = [(unit.bytes[i : i + GRAM] + np.uint8(1)).tobytes() for i in at.tolist()]
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.binary())})

    some = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(every)) == 0).select("doc_id", "text")
    found = some.mapInArrow(run, "key binary").orderBy(F.xxhash64("key")).limit(BORDER_KEYS).collect()
    return np.sort(np.array([bytes(r["key"]) for r in found], dtype=f"S{KEY}"))


def _spread(name: str, parts: int) -> Column:
    return F.pmod(F.col(name), F.lit(parts))


def removed(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary) of each row."""
    rows = text_bytes(docs)
    facts = rows.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    total = facts["bytes"] or 0
    units = max(1, math.ceil(total / UNIT_BYTES))
    buckets = 1 << max(0, math.ceil(math.log2(max(1, total / BUCKET_BYTES))))
    ranges = max(1, math.ceil(total / RANGE_BYTES))
    borders = np.zeros(0, dtype=f"S{KEY}")
    if ranges > 1:
        keys = sample_keys(rows, max(1, total // (2 * BORDER_KEYS * BORDER_BYTES)))
        borders = np.unique(keys[np.linspace(0, len(keys) - 1, ranges + 1).astype(int)[1:-1]]) if len(keys) else borders
    dealt = rows.withColumn("unit", F.pmod(F.xxhash64("doc_id", "text"), F.lit(units)).cast("int"))

    def blobs(rows_: list[tuple[int, int, bytes]], a: str, b: str) -> pa.Table:
        x, y, z = zip(*rows_) if rows_ else ((), (), ())
        return pa.table({a: pa.array(x, pa.int32()), b: pa.array(y, pa.int32()), "blob": pa.array(z, pa.binary())})

    def tell_hashes(key: tuple, table: pa.Table) -> pa.Table:
        u = key[0].as_py()
        return blobs([(b, u, x) for b, x in report(unit_of(table), buckets)], "bucket", "unit")

    def find_shared(key: tuple, table: pa.Table) -> pa.Table:
        b = key[0].as_py()
        pairs = list(zip(table.column("unit").to_pylist(), table.column("blob").to_pylist()))
        return blobs([(u, b, x) for u, x in shared(pairs)], "unit", "bucket")

    def sort_runs(key: tuple, table: pa.Table, wanted: pa.Table) -> pa.Table:
        if not table.num_rows or not wanted.num_rows:
            return blobs([], "range", "unit")
        want = {b: unpack(x)["low"] for b, x in zip(wanted.column("bucket").to_pylist(), wanted.column("blob").to_pylist())}
        u = key[0].as_py()
        return blobs([(r, u, x) for r, x in runs(Contexts(unit_of(table), want, buckets), borders)], "range", "unit")

    def merge_runs(key: tuple, table: pa.Table) -> pa.Table:
        r = key[0].as_py()
        pairs = list(zip(table.column("unit").to_pylist(), table.column("blob").to_pylist()))
        return blobs([(u, r, x) for u, x in answers(pairs)], "unit", "range")

    def remove(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        out = cut(unit_of(table), told.column("blob").to_pylist()) if table.num_rows else []
        columns = list(zip(*out)) if out else [()] * 5
        kinds = [pa.int64()] * 4 + [pa.binary()]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, kinds)})

    reported = dealt.groupBy("unit").applyInArrow(tell_hashes, "bucket int, unit int, blob binary")
    wanted = reported.groupBy("bucket").applyInArrow(find_shared, "unit int, bucket int, blob binary")
    sorted_ = dealt.groupBy("unit").cogroup(wanted.groupBy("unit")).applyInArrow(sort_runs, "range int, unit int, blob binary")
    told = sorted_.groupBy("range").applyInArrow(merge_runs, "unit int, range int, blob binary")
    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    return dealt.groupBy("unit").cogroup(told.groupBy("unit")).applyInArrow(remove, ddl)


def dedup_bytes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row."""
    return removed(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
