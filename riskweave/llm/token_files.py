"""Token ids as flat binary files that are memory-mapped.

Each partition of the ascending doc_id order writes one set of files: ``ids`` (flat
unsigned integers of the smallest width that holds the vocabulary, little-endian),
``offsets`` (64-bit, one more than documents) and ``docs`` (64-bit doc_ids). A manifest has
the counts of each set; prefix sums over it give the base of each, so that the sets read
as one long sequence. Files are written under a name of their own and then renamed, so
that a task that is run again replaces them whole.

Defined results: null and empty texts have only the end id; repeated rows and null ids
are kept, ordered by (doc_id, XXH64 of the text, text), nulls first; an empty table writes a manifest of
no sets and reads as an empty result.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from math import ceil
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskweave.llm.common import batches, record_batch, texts
from riskweave.session import cut_lineage, scratch_path

#: Words whose ids a worker keeps, in each of two halves.
WORDS = 350_000
#: Characters that may hold words apart.
APART = "~^|§"
#: Marks that often follow a word.
MARKS = ".,;:!?)"
#: Words that the library encodes together.
GROUP = 256
#: Bytes of text that one set of files holds, roughly.
SET_BYTES = 48 << 20
#: Documents read from a set at a time.
READ_DOCS = 2000

NO_DOC = -(1 << 63)
MANIFEST = "part int, n_docs long, n_ids long, stem string"
ROWS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


class WordEncoder:
    """Ids of whole texts by the tokenizers library, each distinct word encoded once.

    Right where no token holds white space and the text is split there before the
    merges, as when the normaliser drops white space. New words go to the library
    in groups. Where tokens that end a word say so by a suffix, words of letters alone are
    cut there; other groups are held apart by a character that is one token of its own
    between spaces, and a word that holds that character goes alone. Where the normaliser
    lower-cases, ASCII words are encoded once for all their cases; where a mark after
    letters is a part of its own before the merges, letters with a mark are their ids and
    the mark's.
    """

    def __init__(self, tokenizer_file: str) -> None:
        self.library = Tokenizer.from_file(tokenizer_file)
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.between, self.apart = "", -1
        for mark in APART:
            ids = self._ids(f"a {mark} a")
            if len(ids) == 3 and ids[0] == ids[2] != ids[1]:
                self.between, self.apart = mark, ids[1]
                break
        self.folds = self._ids(" ".join(ascii_uppercase)) == self._ids(" ".join(ascii_lowercase))
        suffix = getattr(self.library.model, "end_of_word_suffix", None)
        self.ends = np.zeros(self.library.get_vocab_size() + 1, dtype=bool)
        if suffix:
            self.ends[[i for token, i in self.library.get_vocab().items() if token.endswith(suffix)]] = True
        self.marks = {m: self._ids(m) for m in MARKS if self.ends.any() and self._stands_alone(m)}

    def _ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _stands_alone(self, mark: str) -> bool:
        parts = self.library.pre_tokenizer.pre_tokenize_str(f"ab{mark}") if self.library.pre_tokenizer else []
        return [span for _, span in parts] == [(0, 2), (2, 3)] and self._ids(f"ab{mark}") == self._ids("ab") + self._ids(mark)

    def _groups(self, words: list[str], between: str, kind: np.dtype) -> dict[str, bytes]:
        """The ids of the words, which go in groups; no ids of the words of a group that cannot be cut."""
        found = {}
        groups = [words[first : first + GROUP] for first in range(0, len(words), GROUP)]
        joined = self.library.encode_batch_fast([between.join(g) for g in groups], add_special_tokens=False)
        for group, whole in zip(groups, joined):
            ids = np.array(whole.ids, dtype=kind)
            raw, size = ids.tobytes(), kind.itemsize
            if between == " ":
                cuts = (np.nonzero(self.ends[ids])[0] + 1).tolist()
                spans = zip([0, *cuts], cuts)
            else:
                cuts = [*np.nonzero(ids == self.apart)[0].tolist(), len(ids)]
                spans = zip([0, *(c + 1 for c in cuts)], cuts)
            if len(cuts) == len(group):
                found.update(zip(group, (raw[a * size : b * size] for a, b in spans)))
        return found

    def learn(self, words: list[str], kind: np.dtype) -> None:
        folded = [w.lower() if w.isascii() else w for w in words] if self.folds else words
        alpha, marked, other = [], [], []
        for w in dict.fromkeys(folded):
            if w.isalpha():
                alpha.append(w)
            elif w[-1:] in self.marks and w[:-1].isalpha():
                alpha.append(w[:-1])
                marked.append(w)
            else:
                other.append(w)
        found = {}
        if self.ends.any():
            stems = dict.fromkeys(alpha)
            for held in (self.before, self.known):
                found.update((w, held[w]) for w in stems.keys() & held.keys())
            found |= self._groups([w for w in stems if w not in found], " ", kind)
        tails = {m: np.array(ids, dtype=kind).tobytes() for m, ids in self.marks.items()}
        found.update((w, found[w[:-1]] + tails[w[-1]]) for w in marked if w[:-1] in found)
        if self.between:
            found |= self._groups([w for w in other if w and self.between not in w], f" {self.between} ", kind)
        rest = [w for w in dict.fromkeys(folded) if w not in found]
        for word, one in zip(rest, self.library.encode_batch(rest, add_special_tokens=False)):
            found[word] = np.array(one.ids, dtype=kind).tobytes()
        self.known.update(zip(words, map(found.__getitem__, folded)))

    def encode(self, texts_: list[str], kind: np.dtype) -> list[bytes]:
        """The ids of each text as bytes of ``kind``."""
        if len(self.known) >= WORDS:
            # Words in use come back from the older half, so that only rare ones are learnt anew.
            self.known, self.before = {}, self.known
        split = [t.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") for t in texts_]
        new = set().union(*split).difference(self.known)
        again = new & self.before.keys()
        self.known.update((w, self.before[w]) for w in again)
        self.learn(list(new - again), kind)
        get = self.known.__getitem__
        return [b"".join(map(get, words)) for words in split]


@lru_cache(maxsize=2)
def word_encoder(tokenizer_file: str) -> WordEncoder:
    """The encoder of this Python worker, which keeps what it has learnt for the next task."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    return WordEncoder(tokenizer_file)


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else os.path.abspath(uri))


def width(ids: int) -> np.dtype:
    return np.dtype("<u2") if ids <= 1 << 16 else np.dtype("<u4")


def write_token_files(docs: DataFrame, tokenizer_file: str, end_id: int, path: str) -> DataFrame:
    """Write the files under ``path``; returns the manifest (part, n_docs, n_ids, stem, base, first_doc)."""
    rows = texts(docs)
    size = rows.agg(F.sum(F.octet_length("text"))).scalar()
    total = rows.sparkSession.range(1).select(size.alias("n")).first()["n"] or 0
    parts = max(1, ceil(total / SET_BYTES))
    # Rows of equal doc_id are dealt and ordered by a hash of the text: whole texts are no sampling keys.
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order, "text")

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        files, root = _open(path)
        files.create_dir(root, recursive=True)
        stem = f"part-{part:06d}"
        own = f"{root}/.{stem}-{uuid.uuid4().hex}"
        encoder = word_encoder(tokenizer_file)
        kind = width(max(encoder.library.get_vocab_size(), end_id + 1))
        last = np.array([end_id], dtype=kind).tobytes()
        n_docs = n_ids = 0
        names = ("ids", "offsets", "docs")
        out = {n: files.open_output_stream(f"{own}.{n}") for n in names}
        out["offsets"].write(np.zeros(1, dtype="<i8").tobytes())
        for doc_ids, text in batches(found):
            encoded = encoder.encode(text, kind)
            lengths = np.array([len(e) // kind.itemsize + 1 for e in encoded], dtype=np.int64)
            out["ids"].write(b"".join(x for e in encoded for x in (e, last)))
            out["offsets"].write((n_ids + np.cumsum(lengths)).astype("<i8").tobytes())
            out["docs"].write(np.array([NO_DOC if d is None else d for d in doc_ids], dtype="<i8").tobytes())
            n_docs += len(encoded)
            n_ids += int(lengths.sum())
        for n in names:
            out[n].close()
            files.move(f"{own}.{n}", f"{root}/{stem}.{n}")
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "n_docs": [n_docs], "n_ids": [n_ids], "stem": [stem]})

    manifest = cut_lineage(ordered.mapInArrow(run, MANIFEST).filter("n_docs > 0"))
    return prefix_sums(manifest)


def prefix_sums(manifest: DataFrame) -> DataFrame:
    """The manifest, one row for each set of files, with the ids and documents of all sets before."""
    from pyspark.sql import Window

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumns(
        {"base": F.coalesce(F.sum("n_ids").over(before), F.lit(0)), "first_doc": F.coalesce(F.sum("n_docs").over(before), F.lit(0))}
    )


def mapped(path: str, stem: str, name: str, kind: np.dtype) -> np.ndarray:
    """A file as an array: memory-mapped where the file system is local, else read."""
    files, root = _open(path)
    if isinstance(files, fs.LocalFileSystem):
        if not os.path.getsize(f"{root}/{stem}.{name}"):
            return np.zeros(0, dtype=kind)
        return np.memmap(f"{root}/{stem}.{name}", dtype=kind, mode="r")
    with files.open_input_file(f"{root}/{stem}.{name}") as f:
        return np.frombuffer(f.read(), dtype=kind)


def read_token_files(spark: SparkSession, manifest: DataFrame, path: str, kind: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for row in batch.to_pylist():
                ids = mapped(path, row["stem"], "ids", np.dtype(kind))
                offsets = mapped(path, row["stem"], "offsets", np.dtype("<i8"))
                doc_ids = mapped(path, row["stem"], "docs", np.dtype("<i8"))
                for first in range(0, len(doc_ids), READ_DOCS):
                    last = min(len(doc_ids), first + READ_DOCS)
                    at = [int(x) for x in offsets[first : last + 1]]
                    crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(at, at[1:])]
                    names = [None if d == NO_DOC else int(d) for d in doc_ids[first:last]]
                    yield record_batch(ROWS, names, [row["base"] + a for a in at[:-1]], [b - a for a, b in zip(at, at[1:])], crc)

    each = manifest.select("stem", "base").repartition(max(1, manifest.count()), "stem")
    return each.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer_file: str, end_id: int = 2, path: str | None = None) -> DataFrame:
    """Write the token files of ``docs`` and return what they hold, read back."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    manifest = cut_lineage(write_token_files(docs, tokenizer_file, end_id, path))
    kind = width(max(Tokenizer.from_file(tokenizer_file).get_vocab_size(), end_id + 1)).str
    return read_token_files(spark, manifest, path, kind)
