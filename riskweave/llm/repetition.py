"""Quality rules on repetition, from suffix arrays over the words of each text.

The suffixes of all texts of a batch are ordered by prefix doubling; the ranks of each
doubling give the longest common prefixes of neighbours. An interval of neighbours that
share ``least`` or more words is a repeated substring, maximal to the right; the union of
the places where those begin is what a text repeats. A text fails if that covers too large
a share of its words, or if its longest repeat is too long.

Defined results: a null text has no words; texts of no words or fewer than 20 fail the
base rules; rows are judged one by one, so that repeated rows, ties and null ids keep
their rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from riskweave.llm.common import batches, record_batch, text_bytes

#: Fixed values of the base rules.
MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"

#: The method's rules: repeats of LEAST words or more may cover MAX_COVERED of the words,
#: and the longest may have MAX_LONGEST of them or LONGEST_FREE words, whichever is more.
LEAST = 5
MAX_COVERED = 0.3
MAX_LONGEST = 0.15
LONGEST_FREE = 25

FIELDS = {
    "doc_id": pa.int64(),
    "n_words": pa.int64(),
    "word_chars": pa.int64(),
    "n_symbols": pa.int64(),
    "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(),
    "base_failed": pa.bool_(),
    "kept": pa.bool_(),
    "n_covered": pa.int64(),
    "longest_repeat": pa.int64(),
}
SCHEMA = pa.schema(list(FIELDS.items()))
DDL = ", ".join(f"{k} {'boolean' if v == pa.bool_() else 'long'}" for k, v in FIELDS.items())


def suffix_order(words: np.ndarray, doc: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of the texts, and the ranks after each doubling (prefixes of 1, 2, 4, ... words).

    Suffixes of different texts never share a rank. A rank is the place in the order at
    which the suffixes that share the prefix begin, so that later rounds only touch ties.
    """
    n = len(words)
    first = doc.astype(np.int64) * (int(words.max()) + 1) + words
    order = np.argsort(first, kind="stable")
    sorted_first = first[order]
    starts = np.concatenate([[True], sorted_first[1:] != sorted_first[:-1]])
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
    levels, k = [rank.copy()], 1
    place = np.arange(n)
    while True:
        new = np.concatenate([[True], rank[order[1:]] != rank[order[:-1]]])
        tied = ~(new & np.concatenate([new[1:], [True]]))
        slots = place[tied]
        if not len(slots):
            return order, levels
        at = order[slots]
        after = at + k
        second = np.where(after < end[at], rank[np.minimum(after, n - 1)] + 1, 0)
        key = rank[at] * (n + 1) + second
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[slots] = at
        begin = np.concatenate([[True], key[1:] != key[:-1]])
        rank[at] = slots[np.maximum.accumulate(np.where(begin, np.arange(len(key)), 0))]
        levels.append(rank.copy())
        k *= 2


def longest_repeats(words: np.ndarray, doc: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each place, the words of the longest string there that its text holds elsewhere too."""
    out = np.zeros(len(words), dtype=np.int64)
    if len(words) < 2:
        return out
    order, levels = suffix_order(words, doc, end)
    a, b = order[:-1], order[1:]
    near = levels[0][a] == levels[0][b]
    a, b = a[near], b[near]
    shared = np.zeros(len(a), dtype=np.int64)
    last = len(words) - 1
    for level in range(len(levels) - 1, -1, -1):
        x, y = a + shared, b + shared
        inside = (x < end[a]) & (y < end[b])
        rank = levels[level]
        shared += (inside & (rank[np.minimum(x, last)] == rank[np.minimum(y, last)])).astype(np.int64) << level
    np.maximum.at(out, a, shared)
    np.maximum.at(out, b, shared)
    return out


def covered(lengths: np.ndarray, least: int, size: int) -> np.ndarray:
    """Which places the spans [i, i + lengths[i]) of at least ``least`` words cover."""
    at = np.nonzero(lengths >= least)[0]
    edge = np.zeros(size + 1, dtype=np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + lengths[at], -1)
    return np.cumsum(edge[:-1]) > 0


def judge(raw: list[bytes]) -> list[np.ndarray]:
    """The columns after doc_id for a batch of texts."""
    split = [b.split() for b in raw]
    n = np.array([len(w) for w in split], dtype=np.int64)
    flat = [w for ws in split for w in ws]
    ends = np.cumsum(n)
    total = len(flat)
    doc = np.repeat(np.arange(len(raw)), n)
    if total:
        ids = pd.factorize(np.array(flat, dtype=object))[0].astype(np.int64)
        lengths = longest_repeats(ids, doc, ends[doc])
    else:
        lengths = np.zeros(0, dtype=np.int64)

    def by_text(hit: np.ndarray) -> np.ndarray:
        return np.bincount(doc[hit], minlength=len(raw)).astype(np.int64)

    # A window of WINDOW words is repeated where the longest repeat is as long.
    repeated = by_text(covered(np.where(lengths >= WINDOW, WINDOW, 0), WINDOW, total))
    spans = by_text(covered(lengths, LEAST, total))
    longest = np.zeros(len(raw), dtype=np.int64)
    np.maximum.at(longest, doc, lengths)
    word_chars, symbols, dup_lines = [], [], []
    for b in raw:
        packed = b.translate(None, SPACES)
        word_chars.append(len(packed.decode()))
        symbols.append(len(b) - len(b.translate(None, SYMBOLS)))
        lines = [x for x in b.split(b"\n") if x.strip(SPACES)]
        dup_lines.append(len(lines) - len(set(lines)))
    failed = (n < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n)
    good = (spans <= MAX_COVERED * n) & (longest <= np.maximum(LONGEST_FREE, MAX_LONGEST * n))
    return [n, word_chars, symbols, dup_lines, repeated, failed, ~failed & good, spans, longest]


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row of counts and the verdict ``kept`` for each row of ``docs``."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, raw in batches(rows):
            yield record_batch(SCHEMA, ids, *judge(raw))

    return text_bytes(docs).mapInArrow(run, DDL)


def kept_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns and order of columns as they are, that the rules keep."""
    from pyspark.sql import functions as F

    columns = docs.schema
    names = columns.fieldNames()

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for batch in rows:
            raw = [(t or "").encode() for t in batch.column(at).to_pylist()]
            keep = judge(raw)[6]
            yield batch.filter(pa.array(keep, type=pa.bool_()))

    from riskweave.llm.common import bounded_batches

    bounded_batches(docs.sparkSession)
    return docs.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(run, columns)
