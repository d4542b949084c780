"""SentencePiece encoding and decoding on the tokenizers library.

The model file's protobuf is parsed and its parts are rebuilt: the normaliser (a mark
before the text, spaces as marks, a table of character maps if the model has one), the
scores (for a unigram model as they are; for a BPE model as merges in score order) and
the byte fallback. Texts are split where no piece can reach across, and the library
encodes each distinct part once, in multithreaded batches. Encoders compare themselves
with the sentencepiece library on probe texts when they are built.

Defined results: null and empty texts have no ids and decode to an empty text; rows are
encoded one by one, so that repeated rows, ties and null ids keep their rows; an empty
table gives an empty result. A literal mark in a text decodes to a space, as in the
sentencepiece library; ``round_trip`` tells.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as model_pb2
from tokenizers import AddedToken, Tokenizer, decoders, models, normalizers

from riskweave.llm.common import batches, bounded_batches, texts

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Parts whose ids a task keeps.
PARTS = 100_000
#: Bytes of a batch of texts; their ids are several times as large on the way back.
BATCH_BYTES = 1 << 20
#: Texts that are split into parts at a time.
TEXTS = 250
#: Threads of the library in a task; each keeps memory of its own.
THREADS = 2
#: Ids in memory.
IDS = np.dtype("<i4")
#: New parts that the library encodes together, held apart by a token of our own.
GROUP = 256
APART = "\uE000\uE001"

PROBES = (
    "The quick brown fox jumps over the lazy dog.",
    "  Spaces   lead,  repeat and trail   ",
    "Grüße, élève, año, naïve, Привет, 日本語, \U0001f600 é",
    "tabs\tand\nlines\r\n\nend\n",
    "</s> <s> <unk> <0x0A> ▁ literal",
    "x" * 70 + " " * 35 + "1234567890 3.14159 aaaaaaaaab",
)


def read_model(model_file: str) -> model_pb2.ModelProto:
    model = model_pb2.ModelProto()
    with open(model_file, "rb") as f:
        model.ParseFromString(f.read())
    return model


def rebuilt(model: model_pb2.ModelProto) -> Tokenizer:
    """The model as a tokenizer of the tokenizers library, for text whose spaces are marks already."""
    unk = next((i for i, p in enumerate(model.pieces) if p.type == UNKNOWN), None)
    fallback = model.trainer_spec.byte_fallback
    if model.trainer_spec.model_type == UNIGRAM:
        library = Tokenizer(models.Unigram([(p.piece, p.score) for p in model.pieces], unk, fallback))
    elif model.trainer_spec.model_type == BPE:
        ids = {p.piece: i for i, p in enumerate(model.pieces)}
        usable = {p.piece for p in model.pieces if p.type in (NORMAL, USER_DEFINED)}
        merges = []
        for piece in usable:
            for cut in range(1, len(piece)):
                if piece[:cut] in usable and piece[cut:] in usable:
                    merges.append((-model.pieces[ids[piece]].score, -cut, ids[piece], piece[:cut], piece[cut:]))
        # Among equal scores the library of the model merges leftmost first, which lets the
        # left part grow: longer left parts come first.
        merges = [(a, b) for *_, a, b in sorted(merges)]
        unk_piece = None if unk is None else model.pieces[unk].piece
        library = Tokenizer(models.BPE(ids, merges, unk_token=unk_piece, fuse_unk=True, byte_fallback=fallback))
    else:
        raise ValueError("only unigram and BPE models are supported")
    if model.normalizer_spec.precompiled_charsmap:
        library.normalizer = normalizers.Precompiled(model.normalizer_spec.precompiled_charsmap)
    return library


class PieceCodec:
    """Encode and decode whole texts as the SentencePiece model would."""

    def __init__(self, model_file: str) -> None:
        self.model = read_model(model_file)
        norm = self.model.normalizer_spec
        if not norm.escape_whitespaces or self.model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models that mark spaces before words are supported")
        if any(p.type in (USER_DEFINED, UNUSED) for p in self.model.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.library = rebuilt(self.model)
        self.map = self.library.normalizer if norm.precompiled_charsmap else None
        self.library.normalizer = None
        self.library.add_special_tokens([AddedToken(APART, normalized=False)])
        self.apart = self.library.token_to_id(APART)
        self.dummy = MARK if norm.add_dummy_prefix else ""
        self.strip = norm.remove_extra_whitespaces
        normal = [p.piece for p in self.model.pieces if p.type == NORMAL]
        crossing = [p for p in normal if re.search(f"[^{MARK}]{MARK}", p)]
        lines = any("\n" in p for p in normal)
        # A unigram model fuses unknown neighbours, so only its word starts are borders.
        alone = not lines and self.model.trainer_spec.byte_fallback
        pattern = f"\n|{MARK}*[^{MARK}\n]+|{MARK}+" if alone else f"{MARK}*[^{MARK}]+|{MARK}+"
        self.parts = re.compile("(?s:.+)" if crossing else pattern)
        self.bytes = {i: int(p.piece[3:-1], 16) for i, p in enumerate(self.model.pieces) if p.type == BYTE}
        self.spell = {b: i for i, b in self.bytes.items()}
        self.pieces = [p.piece for p in self.model.pieces]
        self.pieces_set = frozenset(self.pieces)
        self.silent = {i for i, p in enumerate(self.model.pieces) if p.type == CONTROL}
        self.decoder = decoders.Sequence([decoders.ByteFallback(), decoders.Fuse()])
        self.known: dict[str, bytes] = {}
        own = sentencepiece.SentencePieceProcessor(model_file=model_file)
        if [np.frombuffer(b, dtype=IDS).tolist() for b in self.encode(list(PROBES))] != own.encode(list(PROBES), num_threads=1):
            raise ValueError("the rebuilt encoder differs from the model's library")

    def marked(self, text: str) -> str:
        if self.map is not None:
            text = self.map.normalize_str(text)
        if self.strip:
            text = re.sub(" +", " ", text).strip(" ")
        return self.dummy + text.replace(" ", MARK) if text else ""

    def learn(self, parts: list[str]) -> None:
        joined = [p for p in parts if APART[0] not in p and APART[1] not in p]
        groups = [joined[i : i + GROUP] for i in range(0, len(joined), GROUP)]
        found = self.library.encode_batch([APART.join(g) for g in groups], add_special_tokens=False)
        for group, one in zip(groups, found):
            ids = np.array(one.ids, dtype=IDS)
            cuts = np.nonzero(ids == self.apart)[0].tolist()
            self.known.update(zip(group, (ids[a:b].tobytes() for a, b in zip([0, *(c + 1 for c in cuts)], [*cuts, len(ids)]))))
        rest = list(set(parts).difference(joined))
        self.known.update((p, np.array(self.alone(p), dtype=IDS).tobytes()) for p in rest)

    def alone(self, part: str) -> list[int]:
        """A part that holds the characters of APART, which are then ordinary ones."""
        out: list[int] = []
        for piece in re.split(f"({APART[0]}|{APART[1]})", part):
            if piece in APART and piece and piece not in self.pieces_set and self.spell:
                out += [self.spell[b] for b in piece.encode()]
            elif piece:
                out += self.library.encode(piece, add_special_tokens=False).ids
        return out

    def encode(self, found: list[str]) -> list[bytes]:
        """The ids of each text as bytes of IDS."""
        out = []
        for first in range(0, len(found), TEXTS):
            split = [self.parts.findall(self.marked(t)) for t in found[first : first + TEXTS]]
            if len(self.known) >= PARTS:
                self.known.clear()
            self.learn(list(set().union(*split).difference(self.known)))
            get = self.known.__getitem__
            out += [b"".join(map(get, parts)) for parts in split]
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``: byte pieces join to characters, marks become spaces."""
        if self.bytes.keys().isdisjoint(ids):
            text = "".join(map(self.pieces.__getitem__, ids))
        else:
            text = self.decoder.decode([self.pieces[i] for i in ids if i not in self.silent])
        if self.dummy and text.startswith(MARK):
            text = text[1:]
        return text.replace(MARK, " ")


def encoded(docs: DataFrame, model_file: str, check: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip) of each row; ``round_trip``: the ids decode to the text."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("round_trip", pa.bool_())])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        codec = PieceCodec(model_file)
        for doc_ids, found in batches(rows):
            raw = codec.encode(found)
            sizes = np.array([len(b) // IDS.itemsize for b in raw], dtype=np.int32)
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(raw), dtype=IDS)))
            same = [codec.decode(np.frombuffer(b, dtype=IDS).tolist()) == t for b, t in zip(raw, found)] if check else [None] * len(raw)
            columns = [pa.array(doc_ids, pa.int64()), pa.array(sizes.astype(np.int64)), ids, pa.array(same, pa.bool_())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    rows = texts(docs)
    bounded_batches(docs.sparkSession, BATCH_BYTES)
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, round_trip boolean")


def decoded(tokens: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, text) of rows of (doc_id, ids); null ids decode to an empty text."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = PieceCodec(model_file)
        for doc_ids, ids in batches(rows):
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array([codec.decode(i or []) for i in ids], pa.string())], schema=schema
            )

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
