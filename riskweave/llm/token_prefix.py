"""Exact token counts by dynamic programming over prefixes.

A byte-pair encoding of a prefix ends in exactly one piece that may follow the encoding
of what stands before it: the pair of pieces is its own encoding. So one pass over the
characters gives the last piece and the token count of *every* prefix, and truncation or
budget questions need no second encoding.

No piece of the vocabulary spans the start of a new word (a space after something else),
so the pass runs on chunks, a run of spaces with the word behind it, once for each
distinct chunk, and in their order, so that chunks share the states of common prefixes.
The count at a chunk's end plus the count inside the next is the count of a text prefix.

Defined results: null and empty texts have 0 bytes and 0 tokens; rows are judged one by
one, so that repeated rows, ties and null ids keep their rows; strings of control tokens
inside a text are ordinary text, as in the library; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from riskweave.llm.common import batches, record_batch, texts

#: Chunk counts, or pairs of pieces, that a task keeps before it starts anew.
STATES = 400_000
#: Texts whose new chunks are sorted together.
LEARN = 500
MARK = "▁"
NORMAL, USER_DEFINED, UNUSED = 1, 4, 5

COUNTS = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_()), ("fit_chars", pa.int64())]
)


class PrefixCounter:
    """Token counts of all prefixes of a text under a SentencePiece BPE model."""

    def __init__(self, model_file: str) -> None:
        model = model_pb2.ModelProto()
        with open(model_file, "rb") as f:
            model.ParseFromString(f.read())
        norm = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces:
            raise ValueError("only BPE models without a normaliser table are supported")
        if any(p.type in (USER_DEFINED, UNUSED) for p in model.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.scores = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        if any(re.search(f"[^{MARK}]{MARK}|\n.|.\n", p) for p in self.scores):
            raise ValueError("a piece spans two words")
        self.dummy = MARK if norm.add_dummy_prefix else ""
        self.longest = max(map(len, self.scores))
        self.fallback = model.trainer_spec.byte_fallback
        # A line feed that no piece holds is encoded on its own.
        self.chunk = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+" if "\n" not in self.scores else f"{MARK}*[^{MARK}]+|{MARK}+")
        #: Lengths over 1 of the pieces that end in two given characters, longest first.
        tails: dict[str, set[int]] = {}
        for piece in self.scores:
            if len(piece) > 1:
                tails.setdefault(piece[-2:], set()).add(len(piece))
        self.tails = {k: tuple(sorted(v, reverse=True)) for k, v in tails.items()}
        self.counts: dict[str, int] = {}
        self.valid: dict[tuple[str, str], bool] = {}

    def merged(self, text: str) -> list[str]:
        """The encoding by definition: merge the best pair, the leftmost of equals."""
        score, none = self.scores.get, -math.inf
        parts = list(text)
        pairs = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs:
            best = max(pairs)
            if best == none:
                break
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = score(parts[i - 1] + parts[i], none)
            if i < len(pairs):
                pairs[i] = score(parts[i] + parts[i + 1], none)
        return parts

    def follows(self, last: str, piece: str) -> bool:
        """Whether the two are their own encoding; with nothing before, whether ``piece`` is."""
        if len(self.valid) >= STATES:
            self.valid.clear()
        ok = self.valid[last, piece] = self.merged(last + piece) == ([last, piece] if last else [piece])
        return ok

    def tokens_of(self, char: str) -> int:
        return 1 if char in self.scores or not self.fallback else len(char.encode())

    def extend(self, chunk: str, found: list[tuple[str, int]]) -> list[tuple[str, int]]:
        """``found`` with the states (last piece, count) of the further prefixes of ``chunk``."""
        scores, tails, valid = self.scores, self.tails, self.valid
        for i in range(len(found), len(chunk) + 1):
            for size in tails.get(chunk[i - 2 : i], ()) if i > 1 else ():
                if size > i:
                    continue
                piece = chunk[i - size : i]
                if piece not in scores:
                    continue
                last, n = found[i - size]
                ok = valid.get((last, piece))
                if self.follows(last, piece) if ok is None else ok:
                    found.append((piece, n + 1))
                    break
            else:
                piece = chunk[i - 1]
                found.append((piece, found[i - 1][1] + self.tokens_of(piece)))
        return found

    def prefixes(self, chunk: str) -> list[tuple[str, int]]:
        """(last piece, count) of each prefix of ``chunk``, the empty one first."""
        return self.extend(chunk, [("", 0)])

    def learn(self, chunks: set[str]) -> None:
        """Counts of new chunks, in order, so that each starts from what it shares with the one before."""
        before, found = "", [("", 0)]
        for chunk in sorted(chunks):
            k = 0
            for x, y in zip(before, chunk):
                if x != y:
                    break
                k += 1
            del found[k + 1 :]
            before = chunk
            self.counts[chunk] = self.extend(chunk, found)[-1][1]

    def chunks(self, text: str) -> list[str]:
        return self.chunk.findall(self.dummy + text.replace(" ", MARK)) if text else []

    def every_prefix(self, text: str) -> np.ndarray:
        """The token count of text[:i] for each i from 0 to its length."""
        out, base = [], 0
        for chunk in self.chunks(text):
            inside = [n for _, n in self.prefixes(chunk)]
            out += [base + n for n in inside[1:]]
            base += inside[-1]
        return np.array([0, *out[len(self.dummy) :]], dtype=np.int64)

    def count(self, found: list[str], limit: int) -> Iterator[tuple[int, int]]:
        """For each text its tokens, and the characters of its longest prefix of at most ``limit`` tokens."""
        if len(self.counts) >= STATES:
            self.counts.clear()
        get = self.counts.get
        for first in range(0, len(found), LEARN):
            split = [self.chunks(t) for t in found[first : first + LEARN]]
            new = set().union(*split).difference(self.counts)
            if new:
                self.learn(new)
            for text, chunks in zip(found[first : first + LEARN], split):
                total = sum(map(get, chunks))
                yield total, len(text) if total <= limit else self.fit(chunks, limit)

    def fit(self, chunks: list[str], limit: int) -> int:
        ends = np.cumsum([self.counts[c] for c in chunks])
        k = int(np.searchsorted(ends, limit, side="right"))
        left = limit - (int(ends[k - 1]) if k else 0)
        fits = max(i for i, (_, n) in enumerate(self.prefixes(chunks[k])) if n <= left)
        return max(0, sum(map(len, chunks[:k])) + fits - len(self.dummy))


def token_counts(docs: DataFrame, model_file: str, limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, fit_chars) of each row.

    ``fit_chars``: characters of the longest prefix of the text that has ``limit`` tokens
    or fewer, counted as the encoding of that prefix alone.
    """

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter(model_file)
        for ids, found in batches(rows):
            counts = list(counter.count(found, limit))
            n = [c[0] for c in counts]
            yield record_batch(COUNTS, ids, [len(t.encode()) for t in found], n, [x > limit for x in n], [c[1] for c in counts])

    return texts(docs).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long")


def library_counts(model_file: str, found: list[str]) -> list[int]:
    """What the library itself says, for tests."""
    return [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=model_file).encode(found, num_threads=1)]
