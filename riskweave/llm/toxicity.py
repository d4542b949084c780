"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

Words are runs of letters, lower-cased. The input at a word joins an embedding of the
word, from a vocabulary counted on the training rows, with the mean embedding of its
character trigrams, so that unknown spellings count too. Two gated recurrent layers read a
window of WINDOW words in both directions, attention weighs their states, and a logistic
unit gives the window's score. Windows overlap; all of a text are scored and the
highest score is the text's.

The network is trained in the driver on at most SAMPLE labelled rows of the given table,
taken in hash order; the parameters, a few hundred kilobytes whatever the corpus, go to
the tasks. Labels come only from rows whose crc32(doc_id as text) mod 5 is not 0.

Defined results: null and empty texts, and texts without letters, have one empty window;
rows are scored one by one, so that repeated rows, ties and null ids keep their rows (a
null id is not held out and trains nothing); labels that disagree on a doc_id count as
toxic if one says so; without a labelled row of each kind all scores are 0; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import batches, record_batch, text_bytes

#: Labelled rows that the network is fitted on, at most.
SAMPLE = 6000
#: Vocabulary size at most, and in how many training rows a word of it is at least.
VOCABULARY, LEAST = 20_000, 5
#: Standard deviations up to which a word's leaning counts.
LEAN = 8
WINDOW, STRIDE = 32, 24
WORD_DIM = CHAR_DIM = HIDDEN = 8
TRIGRAMS = 4096
#: Rounds of training, epochs of each, windows of a step, rate and weight decay.
ROUNDS, EPOCHS, BATCH, RATE, DECAY = 5, 1, 256, 0.01, 3e-4
#: Highest windows of a text that later rounds take, and other windows drawn for each toxic one.
TOP, OTHERS = 2, 3
#: Windows scored at a time.
CHUNK = 4096
UNKNOWN, PAD = 0, 1

LETTERS = bytes(c if chr(c).isalpha() or c >= 128 else 32 for c in range(256)).lower()
SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(LETTERS).split()


def trigrams_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character trigrams of all words, borders included, and where each word's begin."""
    flat = np.frombuffer(b"".join(b"^" + w + b"$" for w in words), dtype=np.uint8).astype(np.int64)
    sizes = np.array([len(w) + 2 for w in words], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    keep = np.ones(len(flat), dtype=bool)
    keep[starts + sizes - 1] = keep[starts + sizes - 2] = False
    codes = (flat[:-2] * 961 + flat[1:-1] * 31 + flat[2:]) * 2654435761 % (1 << 32) >> 20
    return codes[keep[:-2]], starts - 2 * np.arange(len(words))


def windows_of(ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(windows, text of each): overlapping windows over the texts' words, padded at the end."""
    n = np.maximum(1, -(-(counts - (WINDOW - STRIDE)) // STRIDE))
    text = np.repeat(np.arange(len(counts)), n)
    first = np.cumsum(counts) - counts
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = (nth * STRIDE)[:, None] + np.arange(WINDOW)
    inside = at < counts[text][:, None]
    at = np.where(inside, at + first[text][:, None], len(ids))
    return np.append(ids, PAD)[at], text


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Network:
    """Parameters, training and scoring; words are rows of a table that is built for each use."""

    def __init__(self, vocabulary: list[bytes], lean: np.ndarray | None = None, seed: int = 7) -> None:
        """``lean``: for each word how far it leans to the label, the start of its first coordinate."""
        rng = np.random.default_rng(seed)
        self.index = {w: i + 2 for i, w in enumerate(vocabulary)}
        h, d = HIDDEN, WORD_DIM + CHAR_DIM
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[-2]), shape).astype(np.float32)
        self.p = {
            "words": rng.normal(0, 0.1, (len(vocabulary) + 2, WORD_DIM)).astype(np.float32),
            "chars": rng.normal(0, 0.3, (TRIGRAMS, CHAR_DIM)).astype(np.float32),
            "W": draw(2, d, 3 * h),
            "b": np.zeros((2, 1, 3 * h), dtype=np.float32),
            "U": draw(2, h, 2 * h),
            "V": draw(2, h, h),
            "A": draw(2 * h, h),
            "a": np.zeros(h, dtype=np.float32),
            "v": draw(h, 1)[:, 0],
            "w": draw(2 * h, 1)[:, 0],
            "o": np.zeros(1, dtype=np.float32),
        }
        if lean is not None:
            self.p["words"][2:, 0] = lean

    def inputs(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Input rows of ``words`` after the two for no known word and for padding, and what made them."""
        known = np.array([UNKNOWN, PAD, *(self.index.get(w, UNKNOWN) for w in words)])
        codes, starts = trigrams_of([b"", b"", *words])
        sizes = np.diff(np.append(starts, len(codes))).astype(np.float32)
        # A border pair without a letter has no trigram.
        some = sizes > 0
        mean = np.zeros((len(known), CHAR_DIM), dtype=np.float32)
        if len(codes):
            mean[some] = np.add.reduceat(self.p["chars"][codes], starts[some], axis=0) / sizes[some, None]
        return np.concatenate([self.p["words"][known], mean], axis=1), known, codes, sizes

    def states(self, gates: np.ndarray, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """States (T, B, 2H) of both directions from input gates (2, T, B, 3H); what backward needs."""
        _, t, b, _ = gates.shape
        h = np.zeros((2, b, HIDDEN), dtype=np.float32)
        out = np.empty((t, b, 2 * HIDDEN), dtype=np.float32)
        tape = []
        u, v = self.p["U"], self.p["V"]
        for i in range(t):
            m = np.stack([mask[i], mask[t - 1 - i]])[:, :, None]
            g = gates[:, i]
            zr = sigmoid(g[:, :, : 2 * HIDDEN] + h @ u)
            z, r = zr[:, :, :HIDDEN] * m, zr[:, :, HIDDEN:]
            c = np.tanh(g[:, :, 2 * HIDDEN :] + (r * h) @ v)
            new = h + z * (c - h)
            if keep:
                tape.append((h, zr, z, r, c, m))
            h = new
            out[i, :, :HIDDEN], out[t - 1 - i, :, HIDDEN:] = h[0], h[1]
        return out, tape

    def pooled(self, states: np.ndarray, mask: np.ndarray):
        energy = np.tanh(states @ self.p["A"] + self.p["a"])
        weight = energy @ self.p["v"]
        weight = np.where(mask > 0, weight, -1e9)
        weight = np.exp(weight - weight.max(axis=0))
        weight *= mask
        weight /= np.maximum(weight.sum(axis=0), 1e-9)
        pool = (weight[:, :, None] * states).sum(axis=0)
        return energy, weight, pool, pool @ self.p["w"] + self.p["o"][0]

    def gates(self, rows: np.ndarray, windows: np.ndarray) -> np.ndarray:
        """Input gates (2, T, B, 3H); the second direction reads from the end."""
        return np.stack([rows[0][windows.T], rows[1][windows.T[::-1]]])

    def score(self, words: list[bytes], windows: np.ndarray) -> np.ndarray:
        """The score of each window; windows index ``words`` from 2 on."""
        x = self.inputs(words)[0]
        rows = x @ self.p["W"] + self.p["b"]
        out = np.empty(len(windows), dtype=np.float64)
        for i in range(0, len(windows), CHUNK):
            part = windows[i : i + CHUNK]
            mask = (part.T != PAD).astype(np.float32)
            states, _ = self.states(self.gates(rows, part), mask, False)
            out[i : i + CHUNK] = sigmoid(self.pooled(states, mask)[3])
        return out

    def gradients(self, words: list[bytes], windows: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        p, h = self.p, HIDDEN
        x, known, codes, sizes = self.inputs(words)
        mask = (windows.T != PAD).astype(np.float32)
        states, tape = self.states(self.gates(x @ p["W"] + p["b"], windows), mask, True)
        energy, weight, pool, logit = self.pooled(states, mask)
        d_logit = ((sigmoid(logit) - label) / len(label)).astype(np.float32)
        grad = {"w": pool.T @ d_logit, "o": d_logit.sum(keepdims=True)}
        d_pool = d_logit[:, None] * p["w"]
        d_weight = (states * d_pool).sum(axis=2)
        d_weight = weight * (d_weight - (weight * d_weight).sum(axis=0))
        grad["v"] = np.einsum("tbh,tb->h", energy, d_weight)
        d_energy = d_weight[:, :, None] * p["v"] * (1 - energy * energy)
        grad["A"] = np.einsum("tbi,tbh->ih", states, d_energy)
        grad["a"] = d_energy.sum(axis=(0, 1))
        d_states = weight[:, :, None] * d_pool + d_energy @ p["A"].T

        t = len(tape)
        grad["U"], grad["V"] = np.zeros_like(p["U"]), np.zeros_like(p["V"])
        d_gates = np.empty((2, t, len(label), 3 * h), dtype=np.float32)
        d_h = np.zeros((2, len(label), h), dtype=np.float32)
        ut, vt = p["U"].transpose(0, 2, 1), p["V"].transpose(0, 2, 1)
        for i in range(t - 1, -1, -1):
            before, zr, z, r, c, m = tape[i]
            d_h = d_h + np.stack([d_states[i, :, :h], d_states[t - 1 - i, :, h:]])
            d_c = d_h * z * (1 - c * c)
            d_rh = d_c @ vt
            raw_z = zr[:, :, :h]
            d_z = d_h * (c - before) * m * raw_z * (1 - raw_z)
            d_r = d_rh * before * r * (1 - r)
            d_zr = np.concatenate([d_z, d_r], axis=2)
            grad["U"] += before.transpose(0, 2, 1) @ d_zr
            grad["V"] += (r * before).transpose(0, 2, 1) @ d_c
            d_gates[:, i, :, : 2 * h], d_gates[:, i, :, 2 * h :] = d_zr, d_c
            d_h = d_h * (1 - z) + d_zr @ ut + d_rh * r
        at = [windows.T.ravel(), windows.T[::-1].ravel()]
        flat = d_gates.reshape(2, -1, 3 * h)
        d_rows = np.zeros((2, len(x), 3 * h), dtype=np.float32)
        for k in range(2):
            np.add.at(d_rows[k], at[k], flat[k])
        grad["W"] = x.T @ d_rows
        grad["b"] = d_rows.sum(axis=1, keepdims=True)
        d_x = (d_rows @ p["W"].transpose(0, 2, 1)).sum(axis=0)
        grad["words"], grad["chars"] = np.zeros_like(p["words"]), np.zeros_like(p["chars"])
        np.add.at(grad["words"], known, d_x[:, :WORD_DIM])
        share = d_x[:, WORD_DIM:] / np.maximum(sizes, 1)[:, None]
        np.add.at(grad["chars"], codes, np.repeat(share, sizes.astype(np.int64), axis=0))
        return grad

    def fit(self, found: list[list[bytes]], labels: np.ndarray, seed: int = 11) -> None:
        """Adam on windows, in rounds.

        A label says that some window of the text is toxic, not which. The first round takes
        every window of a labelled text for toxic; each later round only those that the
        network so far scores highest in their text, against the highest of the other
        texts and a random draw of their windows.
        """
        rng = np.random.default_rng(seed)
        every: dict[bytes, int] = {}
        ids = np.array([every.setdefault(w, len(every) + 2) for ws in found for w in ws], dtype=np.int64)
        words = list(every)
        windows, text = windows_of(ids, np.array([len(w) for w in found], dtype=np.int64))
        toxic = labels[text] == 1
        state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        step = 0
        for turn in range(ROUNDS):
            if turn:
                score = self.score(words, windows)
                order = np.lexsort((-score, text))
                first = np.concatenate([[True], text[order][1:] != text[order][:-1]])
                place = np.arange(len(order)) - np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
                top = np.zeros(len(order), dtype=bool)
                top[order[place < TOP]] = True
                positive = np.nonzero(toxic & top)[0]
                hard = np.nonzero(~toxic & top)[0]
            else:
                positive, hard = np.nonzero(toxic)[0], np.zeros(0, dtype=np.int64)
            others = rng.permutation(np.nonzero(~toxic)[0])[: OTHERS * max(len(positive), 1)]
            use = np.unique(np.concatenate([positive, hard, others]))
            for _ in range(EPOCHS):
                order = rng.permutation(use)
                for i in range(0, len(order), BATCH):
                    step += 1
                    self.descend(words, windows[order[i : i + BATCH]], toxic[order[i : i + BATCH]].astype(np.float32), state, step)

    def descend(self, words: list[bytes], windows: np.ndarray, label: np.ndarray, state: dict, step: int) -> None:
        near, at = np.unique(windows, return_inverse=True)
        near_words = near[near > PAD]
        # Local numbers: 0 and 1 stay, the batch's words follow.
        local = np.where(near > PAD, np.arange(len(near)) - (len(near) - len(near_words)) + 2, near)
        grad = self.gradients([words[k - 2] for k in near_words], local[at].reshape(windows.shape), label)
        for k, g in grad.items():
            mean, power = state[k]
            g = g + DECAY * self.p[k]
            mean += 0.1 * (g - mean)
            power += 0.001 * (g * g - power)
            self.p[k] -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(power / (1 - 0.999**step)) + 1e-8)


def train(rows: list[tuple[bytes, int]]) -> Network | None:
    """A network fitted on (text, label) rows; None without rows of both labels."""
    labels = np.array([y for _, y in rows], dtype=np.int64)
    if not len(rows) or labels.min() == labels.max():
        return None
    found = [words_of(t) for t, _ in rows]
    counts = Counter(w for ws in found for w in set(ws))
    common = sorted((w for w, n in counts.items() if n >= LEAST), key=lambda w: (-counts[w], w))[:VOCABULARY]
    toxic = Counter(w for ws, y in zip(found, labels) if y for w in set(ws))
    expected = np.array([counts[w] for w in common]) * labels.mean()
    # Standard deviations by which rows with the word are more often toxic than others.
    lean = (np.array([toxic[w] for w in common]) - expected) / np.sqrt(expected + 1)
    network = Network(common, np.clip(lean, -LEAN, LEAN) / 4)
    network.fit(found, labels)
    return network


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[tuple[bytes, int]]:
    """At most ``sample`` labelled rows that are not held out, in hash order."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("toxic IN (0, 1)")
    known = known.filter(remainder(F.col("doc_id")) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    few = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = text_bytes(docs).join(F.broadcast(few), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    return [(bytes(r["text"]), r["toxic"]) for r in rows.orderBy("doc_id").select("text", "toxic").collect()]


def score_texts(network: Network, raw: list[bytes]) -> np.ndarray:
    """The highest window score of each text."""
    found = [words_of(b) for b in raw]
    every: dict[bytes, int] = {}
    number = every.setdefault
    ids = np.array([number(w, len(every) + 2) for ws in found for w in ws], dtype=np.int64)
    windows, text = windows_of(ids, np.array([len(w) for w in found], dtype=np.int64))
    best = np.zeros(len(raw))
    np.maximum.at(best, text, network.score(list(every), windows))
    return best


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of ``docs``."""
    model = train(training_rows(docs, labels, sample))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, raw in batches(rows):
            score = np.zeros(len(raw)) if model is None else score_texts(model, raw)
            yield record_batch(SCORES, ids, score)

    scored = text_bytes(docs).mapInArrow(run, "doc_id long, score double")
    held_out = F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
