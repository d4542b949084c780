"""Spelling variants grouped by a bit-sliced position index.

Words are counted over all documents: each task counts its documents, then counts are
summed. Words that are one letter apart share their first or their last half: of two
words, the shorter of m letters, the first or the last m // 2 letters agree. So every word
goes to the groups of its halves, for itself as the shorter and as the longer word.

A group is searched by a bit-sliced index: for each position and letter one bitset over
the group's words, a whole number whose bit i is the i-th word. For a word asked for, two
recurrences run along its letters at once: ``exact``, the words that agree so far, and the
words with one error so far, which is a replaced letter (``other``) or a letter too many
(``longer``; from there on the letters are looked up one position further). Each step is a
handful of operations on whole bitsets. A letter too few is the same pair seen from the
longer word. In the groups of last halves, words that also agree in the first half are
left out, for they meet in the other group.

Groups of more than CHUNK words are dealt out as pairs of chunks, so that a task never
holds more than two. Near words are counted and the best one kept where they are found;
pairs do not leave the task.

Defined results: a null text has no words; a null doc_id counts as an empty string in the
hash; rows of equal doc_id count each; words are compared by code points, letters beyond
A-Z are not lower-cased; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import batches, record_batch, texts, written

#: Code points of a word at least; occurrences at least; one word in so many is changed.
LETTERS, TIMES, CHANGED = 5, 3, 97
#: A form is so many times as frequent as its variant.
RATIO = 2
#: Words of a group that a task holds at a time, in each of two roles.
CHUNK = 16_384
#: Words that a task counts before it hands them on.
HELD = 400_000

# The letters of a word as Latin-1 bytes, lower-cased from A to Z; all else separates.
LETTER = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))

DEALT = "array<struct<i:int,j:int,asked:boolean>>"
COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])
NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def changed_words(doc_id: int | None, text: str, least: int = LETTERS, changed: int = CHANGED) -> Iterator[tuple[bytes, int]]:
    """(word, occurrences) of a text as Latin-1 bytes, some of them with a letter deleted."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(text.encode("latin-1", "replace").translate(LETTER).split()).items():
        if len(run) < least:
            continue
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % changed == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < least:
                continue
        yield run, n


def word_counts(docs: DataFrame, least: int = LETTERS, times: int = TIMES, changed: int = CHANGED) -> DataFrame:
    """(word, n) of the words of at least ``least`` letters that occur ``times`` times or more."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def counted() -> pa.RecordBatch:
            return record_batch(COUNTS, [w.decode("latin-1") for w in held], list(held.values()))

        for ids, found in batches(rows):
            for doc_id, text in zip(ids, found):
                for word, n in changed_words(doc_id, text, least, changed):
                    held[word] += n
            if len(held) > HELD:
                yield counted()
                held.clear()
        yield counted()

    counts = texts(docs).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= times)


def dealt_words(words: DataFrame, least: int = LETTERS, chunk: int = CHUNK) -> DataFrame:
    """(last, m, half, i, j, asked, n, word): every word in its groups, as one to find and, in the shorter role, as one to ask for.

    ``last`` tells the groups of last halves from those of first ones; ``i`` and ``j`` are
    the chunks asked for and searched.
    """
    size = F.length("word")
    shorter = F.when(size > least, F.array(size, size - 1)).otherwise(F.array(size))
    roles = words.select("word", "n", size.alias("size"), F.explode(shorter).alias("m"))
    halves = F.array(*[F.struct(F.lit(i).alias("last"), h.alias("half")) for i, h in enumerate((F.expr("left(word, m div 2)"), F.expr("right(word, m div 2)")))])
    roles = roles.select("word", "n", "size", "m", F.inline(halves))
    group = ["last", "m", "half"]
    large = roles.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("chunks")).filter("chunks > 1")
    roles = roles.join(large, group, "left").fillna(1, ["chunks"])
    own = F.pmod(F.xxhash64("word"), F.col("chunks")).cast("int")
    each = F.sequence(F.lit(0), F.col("chunks") - 1)
    there = F.transform(each, lambda c: F.struct(c.alias("i"), own.alias("j"), F.lit(False).alias("asked")))
    here = F.transform(each, lambda c: F.struct(own.alias("i"), c.alias("j"), F.lit(True).alias("asked")))
    both = F.concat(there, F.when(F.col("size") == F.col("m"), here).otherwise(F.array().cast(DEALT)))
    return roles.select(*group, "n", "word", F.inline(both))


class PositionIndex:
    """Bitsets over ``words``, of m or m + 1 letters: for each position and letter, and for each length."""

    def __init__(self, words: list[str], m: int) -> None:
        self.m = m
        self.same = self.more = 0
        self.at: list[dict[str, int]] = [{} for _ in range(m + 1)]
        for i, word in enumerate(words):
            bit = 1 << i
            if len(word) == m:
                self.same |= bit
            else:
                self.more |= bit
            for place, letter in zip(self.at, word):
                place[letter] = place.get(letter, 0) | bit

    def near(self, word: str, half: int) -> int:
        """The bitset of the words that ``word``, of m letters, becomes by one letter replaced or put in.

        With ``half`` those that agree in so many first letters are left out.
        """
        exact, other, longer, met = self.same | self.more, 0, 0, 0
        here = self.at[0].get(word[0], 0)
        for i, letter in enumerate(word):
            further = self.at[i + 1].get(letter, 0)
            other = other & here | exact & ~here
            longer = (longer | exact) & further
            exact &= here
            if i + 1 == half:
                met = exact
            if i + 1 < self.m:
                here = self.at[i + 1].get(word[i + 1], 0)
        return (other & self.same | (longer | exact) & self.more) & ~met


def near_in_group(last: int, m: int, asked: list[tuple[int, str]], words: list[tuple[int, str]]) -> dict[str, list]:
    """word -> [near words, (-n, word) of the best one] of a group or a pair of chunks; all lists as (n, word)."""
    found: dict[str, list] = {}

    def add(word: str, count: int, best: tuple[int, str]) -> None:
        known = found.setdefault(word, [0, best])
        known[0] += count
        if best < known[1]:
            known[1] = best

    ranked = sorted((-n, w) for n, w in words)  # the best one has the lowest bit
    index = PositionIndex([w for _, w in ranked], m)
    for n, word in asked:
        hits = index.near(word, m // 2 if last else 0)
        if not hits:
            continue
        add(word, hits.bit_count(), ranked[(hits & -hits).bit_length() - 1])
        hits &= index.more  # the longer words are not asked for: this is their pair, too
        while hits:
            low = hits & -hits
            add(ranked[low.bit_length() - 1][1], 1, (-n, word))
            hits ^= low
    return found


def near_words(words: DataFrame, least: int = LETTERS, chunk: int = CHUNK) -> DataFrame:
    """(word, n_near, best_n, best) of the words (word, n) that have near words."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, asked, kept = None, [], []

        def finished() -> Iterator[pa.RecordBatch]:
            if asked and (len(kept) > 1 or key[3] != key[4]):
                found = near_in_group(key[0], key[1], asked, kept)
                if found:
                    counts, bests = [v[0] for v in found.values()], [v[1] for v in found.values()]
                    yield record_batch(NEAR, list(found), counts, [-b[0] for b in bests], [b[1] for b in bests])

        for columns in batches(rows):
            for last, m, half, i, j, is_asked, n, word in zip(*columns):
                if (last, m, half, i, j) != key:
                    if key is not None:
                        yield from finished()
                    key, asked, kept = (last, m, half, i, j), [], []
                (asked if is_asked else kept).append((n, word))
        if key is not None:
            yield from finished()

    group = ["last", "m", "half", "i", "j"]
    dealt = dealt_words(words, least, chunk).select(*group, "asked", "n", "word")
    lined = dealt.repartition(*group).sortWithinPartitions(*group)
    found = lined.mapInArrow(run, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("first")
    whole = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return whole.select("word", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.best").alias("best"))


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form): the form that has none, by doubling.

    A form is at least twice as frequent as its word, so that there are no circles and few rounds.
    """
    step = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        jump = written(step.join(ahead, "root", "left").select("word", "root", "_next"), "word-roots")
        step = jump.select("word", F.coalesce("_next", "root").alias("root"))
        if jump.filter("_next IS NOT NULL").isEmpty():
            return step


def spelling_groups(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs``."""
    words = written(word_counts(docs), "words")
    near = written(near_words(words), "near-words")
    joined = words.join(near, "word", "left")
    has = F.col("best_n") >= RATIO * F.col("n")
    named = joined.select(
        "word",
        F.when(has, F.col("best")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has, F.col("best_n")).alias("form_n"),
    )
    named = written(named, "word-forms")
    roots = last_forms(named.filter("form IS NOT NULL"))
    found = named.join(roots, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
