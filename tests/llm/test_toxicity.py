"""The network's scores against a plain loop, word by word and window by window."""

import math
import random

import numpy as np

from helpers import prose
from riskweave.llm import toxicity as X


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


def grams(word):
    framed = b"^" + word + b"$"
    return [((framed[i] * 961 + framed[i + 1] * 31 + framed[i + 2]) * 2654435761 % (1 << 32)) >> 20 for i in range(len(framed) - 2)]


def row(net, word):
    """The input of one word: its embedding and the mean of its trigrams'."""
    known = net.p["words"][net.index.get(word, X.UNKNOWN)].astype(float)
    codes = grams(word)
    mean = sum(net.p["chars"][c].astype(float) for c in codes) / len(codes) if codes else np.zeros(X.CHAR_DIM)
    return np.concatenate([known, mean])


def pass_over(net, rows, k):
    """States of one direction, step by step."""
    p = {n: net.p[n][k].astype(float) for n in ("W", "b", "U", "V")}
    h, out, n = np.zeros(X.HIDDEN), [], X.HIDDEN
    for x in rows:
        g = x @ p["W"] + p["b"][0]
        zr = [sigmoid(v) for v in g[: 2 * n] + h @ p["U"]]
        z, r = np.array(zr[:n]), np.array(zr[n:])
        c = np.tanh(g[2 * n :] + (r * h) @ p["V"])
        h = (1 - z) * h + z * c
        out.append(h)
    return out


def window_score(net, words):
    rows = [row(net, w) for w in words]
    forth, back = pass_over(net, rows, 0), pass_over(net, rows[::-1], 1)[::-1]
    states = [np.concatenate(s) for s in zip(forth, back)]
    p = {n: net.p[n].astype(float) for n in ("A", "a", "v", "w", "o")}
    weights = [math.exp(float(np.tanh(s @ p["A"] + p["a"]) @ p["v"])) for s in states]
    pool = sum((w * s for w, s in zip(weights, states)), np.zeros(2 * X.HIDDEN)) / max(sum(weights), 1e-9)
    return sigmoid(float(pool @ p["w"] + p["o"][0]))


def plain(net, raw):
    """The highest score of the windows that begin every STRIDE words, until one reaches the end."""
    words = [w for w in raw.translate(X.LETTERS).split() if w]
    best, start = 0.0, 0
    while True:
        best = max(best, window_score(net, words[start : start + X.WINDOW]))
        if start + X.WINDOW >= len(words):
            return best
        start += X.STRIDE


def test_scores_equal_a_plain_loop():
    rng = random.Random(5)
    sizes = [0, 1, 2, 24, 31, 32, 33, 55, 56, 57, 80, 81, 300]
    raw = [prose(rng, n).encode() for n in sizes] + ["Grüße an ÄLLE, x1y".encode(), b" \n 12 !", prose(rng, 40).upper().encode()]
    vocabulary = sorted({w for b in raw[3:8] for w in X.words_of(b)})[::2]
    net = X.Network(vocabulary, np.array([rng.uniform(-2, 2) for _ in vocabulary]))
    for name in ("b", "a", "o"):
        net.p[name] = np.random.default_rng(1).normal(0, 0.5, net.p[name].shape).astype(np.float32)
    together = X.score_texts(net, raw)
    want = np.array([plain(net, b) for b in raw])
    np.testing.assert_allclose(together, want, atol=2e-5)
    # Scores do not depend on which texts share a batch.
    np.testing.assert_allclose([X.score_texts(net, [b])[0] for b in raw], together, atol=2e-5)
