"""Toxicity scores from a bidirectional gated recurrent network with attention pooling.

A step of the network is a word, given by an embedding of the word and the embeddings of its
characters' n-grams, both hashed. Two gated recurrent units read a window forwards and backwards,
attention pools their states, and a logistic unit gives the score of the window. Windows overlap
by a third and cover the whole text; a document scores as its worst window.

Everything is numpy: training on a bounded sample on the driver, scoring in batches inside tasks,
where each document lies, without a shuffle. The input side of the gates depends on the word
alone, so a task works it out once per distinct word.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, release_memory, sample_per_class, texts_as_bytes

WINDOW = 48
STRIDE = 32
WORD_ROWS, CHAR_ROWS = 1 << 13, 1 << 15
WORD_DIM, CHAR_DIM, HIDDEN = 4, 10, 8
GRAMS = (3, 4, 5)
DOCS_PER_CLASS = 800  # bound of the training sample
EPOCHS = 6  # at least; a small sample gets more, up to LEAST_STEPS batches or MOST_EPOCHS
LEAST_STEPS, MOST_EPOCHS, BATCH = 250, 40, 128
# Against learning documents by heart, where class 1 has few of them: it counts up to so often, words are replaced
# by others, words of one document alone are blanked, and in the first part of the epochs a document of
# class 1 shows any of its windows. With more than FEW such documents each of these fades in proportion.
FEW, MOST_REPEATS, REPLACED, ANY_WINDOW = 40, 4, 0.2, 0.6
THRESHOLD = 0.7
MAX_KNOWN_WORDS = 200_000
BLOCK = 4096  # windows in one pass of the network
FRESH = 8192  # words whose n-grams are looked up at a time, in training and in scoring
_WORDS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
PAD = b""


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


@dataclass
class Features:
    """For some words: the row of each in the word table, and the rows of its n-grams in the character table."""

    words: np.ndarray
    grams: np.ndarray
    counts: np.ndarray  # n-grams of each word; none for padding

    @classmethod
    def of(cls, words: list[bytes]) -> Features:
        """N-grams are those of the whole word and include its borders."""
        text = np.frombuffer(b"".join(b"^" + w + b"$" for w in words), np.uint8).astype(np.int64)
        size = np.array([len(w) + 2 for w in words], np.int64)
        last = np.repeat(np.cumsum(size), size)  # where the word of each byte ends
        owner, at = np.repeat(np.arange(len(words)), size), np.arange(len(text))
        rows, owners = [], []
        for n in GRAMS:
            h = np.full(max(len(text) - n + 1, 0), n, np.int64)
            for k in range(n):
                h = (h * 1_000_003 + text[k : k + len(h)]) & 0xFFFFFFFF
            inside = at[: len(h)] + n <= last[: len(h)]
            rows.append((h ^ (h >> 15))[inside] % CHAR_ROWS)
            owners.append(owner[: len(h)][inside])
        grams, owners = np.concatenate(rows), np.concatenate(owners)
        counts = np.bincount(owners, minlength=len(words))
        pad = np.array([w == PAD for w in words], bool)
        grams, owners = grams[~pad[owners]], owners[~pad[owners]]
        counts[pad] = 0
        return cls(np.array([zlib.crc32(w) % WORD_ROWS for w in words], np.int64), grams[np.argsort(owners, kind="stable")].astype(np.int32), counts)

    @classmethod
    def joined(cls, parts: list[Features]) -> Features:
        return cls(*(np.concatenate([getattr(p, name) for p in parts]) for name in ("words", "grams", "counts")))

    def slices(self, size: int) -> Iterator[Features]:
        """Runs of so many words."""
        ends = np.append(0, np.cumsum(self.counts))
        for i in range(0, len(self.words), size):
            j = min(i + size, len(self.words))
            yield Features(self.words[i:j], self.grams[ends[i] : ends[j]], self.counts[i:j])

    def some(self, which: np.ndarray) -> Features:
        first = np.cumsum(self.counts) - self.counts
        counts = self.counts[which]
        at = np.repeat(first[which] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        return Features(self.words[which], self.grams[at], counts)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _sums(values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Rows of ``values`` summed by number."""
    return np.stack([np.bincount(at, column, n) for column in values.T], axis=1).astype(np.float32)


def windows_of(numbers: np.ndarray, pad: int = 0) -> np.ndarray:
    """Overlapping windows of a text's word numbers; the last one ends with it, a short text is padded."""
    n = len(numbers)
    if n <= WINDOW:
        out = np.full((1, WINDOW), pad, numbers.dtype)
        out[0, :n] = numbers
        return out
    starts = np.unique(np.append(np.arange(0, n - WINDOW, STRIDE), n - WINDOW))
    return numbers[starts[:, None] + np.arange(WINDOW)]


class Words:
    """Numbers of the words met so far; padding is 0."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {}
        self.fresh: list[bytes] = []  # not yet taken by ``take``
        self.of([PAD])

    def of(self, words: list[bytes]) -> np.ndarray:
        new = [*{*words}.difference(self.numbers)]
        self.numbers.update(zip(new, range(len(self.numbers), len(self.numbers) + len(new)), strict=True))
        self.fresh += new
        return np.array([self.numbers[w] for w in words], np.int32)

    def take(self, most: int | None = None) -> Features:
        """Features of the words that are new, or of the first so many of them."""
        new = self.fresh[:most]
        self.fresh = self.fresh[len(new) :]
        return Features.of(new)


class Network:
    """Parameters, forward pass and gradients. ``p`` has float32 arrays by name."""

    def __init__(self, seed: int = 7):
        g = np.random.default_rng(seed)
        n_in = WORD_DIM + CHAR_DIM
        make = lambda *shape, scale: (g.standard_normal(shape) * scale).astype(np.float32)
        self.p = {"word": make(WORD_ROWS, WORD_DIM, scale=0.1), "char": make(CHAR_ROWS, CHAR_DIM, scale=0.1)}
        for side in "fb":
            self.p |= {f"W{side}": make(n_in, 3 * HIDDEN, scale=0.4), f"U{side}": make(HIDDEN, 3 * HIDDEN, scale=0.3), f"c{side}": np.zeros(3 * HIDDEN, np.float32)}
        self.p |= {"A": make(2 * HIDDEN, HIDDEN, scale=0.3), "a": make(HIDDEN, scale=0.5), "v": make(2 * HIDDEN, scale=0.5), "b": np.full(1, -2.0, np.float32)}

    def embed(self, f: Features) -> tuple[np.ndarray, np.ndarray]:
        """Input vectors of words, and the weight of each n-gram."""
        weight = np.repeat(1 / np.sqrt(np.maximum(f.counts, 1)), f.counts).astype(np.float32)
        chars = np.zeros((len(f.words), CHAR_DIM), np.float32)
        if len(f.grams):
            full = np.flatnonzero(f.counts)
            chars[full] = np.add.reduceat(self.p["char"][f.grams] * weight[:, None], (np.cumsum(f.counts) - f.counts)[full])
        out = np.concatenate([self.p["word"][f.words], chars], axis=1)
        out[f.counts == 0] = 0  # padding
        return out, weight

    def inputs(self, f: Features) -> np.ndarray:
        """Input vectors of any number of words; the vectors of n-grams are held for a slice at a time."""
        return np.concatenate([self.embed(some)[0] for some in f.slices(FRESH)])

    def gates(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What a word adds to the gates of either direction."""
        return x @ self.p["Wf"] + self.p["cf"], x @ self.p["Wb"] + self.p["cb"]

    def _unit(self, side: str, table: np.ndarray, columns: np.ndarray, states: np.ndarray, keep: bool) -> list:
        """Fill ``states`` (step, state, window); with ``keep`` return what the gradient needs."""
        recurrent = np.ascontiguousarray(self.p[f"U{side}"].T)
        h, memory = np.zeros(states.shape[1:], np.float32), []
        for c, out in zip(columns, states, strict=True):
            into = table[c].T
            back = recurrent @ h
            gate = back[: 2 * HIDDEN] + into[: 2 * HIDDEN]
            gate *= 0.5
            np.tanh(gate, out=gate)
            gate += 1
            gate *= 0.5
            z, r, nb = gate[:HIDDEN], gate[HIDDEN:], back[2 * HIDDEN :]
            n = r * nb
            n += into[2 * HIDDEN :]
            np.tanh(n, out=n)
            if keep:
                memory.append((h, z, r, n, nb))
            h = h - n
            h *= z
            h += n
            out[:] = h
        return memory

    def forward(self, tables: tuple[np.ndarray, np.ndarray], windows: np.ndarray, keep: bool = False):
        """Logits of windows of word numbers (0 is padding)."""
        columns = np.ascontiguousarray(windows.T)
        states = np.empty((len(columns), 2 * HIDDEN, len(windows)), np.float32)
        mf = self._unit("f", tables[0], columns, states[:, :HIDDEN], keep)
        mb = self._unit("b", tables[1], columns[::-1], states[::-1, HIDDEN:], keep)
        key = np.matmul(self.p["A"].T, states)
        np.tanh(key, out=key)
        worth = np.where(columns > 0, self.p["a"] @ key, np.float32(-1e9))
        worth = np.exp(worth - worth.max(axis=0))
        worth /= worth.sum(axis=0)
        pooled = np.einsum("thb,tb->hb", states, worth)
        logit = self.p["v"] @ pooled + self.p["b"][0]
        return (logit, (states, key, worth, pooled, mf, mb)) if keep else logit

    def gradients(self, features: Features, windows: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Mean gradient of the logistic loss over some windows."""
        used, local = np.unique(windows, return_inverse=True)
        if used[0] != 0:  # padding keeps number 0
            used, local = np.concatenate([[0], used]), local + 1
        local = local.reshape(windows.shape)
        f = features.some(used)
        x, weight = self.embed(f)
        tables = self.gates(x)
        logit, (states, key, worth, pooled, mf, mb) = self.forward(tables, local, keep=True)
        d_logit = ((_sigmoid(logit) - labels) / len(labels)).astype(np.float32)
        g = {"v": pooled @ d_logit, "b": d_logit.sum(keepdims=True)}
        d_pooled = self.p["v"][:, None] * d_logit
        d_states = worth[:, None] * d_pooled
        d_worth = np.einsum("thb,hb->tb", states, d_pooled)
        d_worth = worth * (d_worth - (worth * d_worth).sum(axis=0))
        d_key = d_worth[:, None] * self.p["a"][:, None] * (1 - key**2)
        g["a"] = np.einsum("thb,tb->h", key, d_worth)
        g["A"] = np.einsum("tib,tjb->ij", states, d_key)
        d_states = d_states + np.matmul(self.p["A"], d_key)
        d_x = np.zeros_like(x)
        columns = local.T
        for side, memory, d_out, at in (("f", mf, d_states[:, :HIDDEN], columns), ("b", mb, d_states[::-1, HIDDEN:], columns[::-1])):
            recurrent = self.p[f"U{side}"]
            g[f"U{side}"] = np.zeros_like(recurrent)
            d_gates = np.empty((len(memory), 3 * HIDDEN, len(windows)), np.float32)
            d_h = np.zeros_like(d_out[0])
            for t in range(len(memory) - 1, -1, -1):
                h, z, r, n, nb = memory[t]
                d_h = d_h + d_out[t]
                d_n = d_h * (1 - z) * (1 - n**2)
                d_z = d_h * (h - n) * z * (1 - z)
                d_r = d_n * nb * r * (1 - r)
                d_back = np.concatenate([d_z, d_r, d_n * r])
                d_gates[t] = np.concatenate([d_z, d_r, d_n])
                g[f"U{side}"] += h @ d_back.T
                d_h = d_h * z + recurrent @ d_back
            d_table = _sums(d_gates.transpose(0, 2, 1).reshape(-1, 3 * HIDDEN), at.ravel(), len(x))
            g[f"W{side}"], g[f"c{side}"] = x.T @ d_table, d_table.sum(axis=0)
            d_x += d_table @ self.p[f"W{side}"].T
        d_x[0] = 0
        g["word"] = _sums(d_x[:, :WORD_DIM], f.words, WORD_ROWS)
        g["char"] = _sums(np.repeat(d_x[:, WORD_DIM:], f.counts, axis=0) * weight[:, None], f.grams, CHAR_ROWS)
        return g


class Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float = 0.02):
        self.p, self.rate, self.t = p, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.s = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, g: dict[str, np.ndarray]) -> None:
        self.t += 1
        norm = float(np.sqrt(sum(float((v**2).sum()) for v in g.values())))
        scale = min(1.0, 5.0 / max(norm, 1e-12))
        for k, v in g.items():
            v = v * scale
            self.m[k] += 0.1 * (v - self.m[k])
            self.s[k] += 0.01 * (v**2 - self.s[k])
            rate = self.rate / (1 - 0.9**self.t) * np.sqrt(1 - 0.99**self.t)
            self.p[k] -= (rate * self.m[k] / (np.sqrt(self.s[k]) + 1e-7)).astype(np.float32)


def fit(texts: list[bytes], labels: list[int], seed: int = 7) -> Network:
    """Train on labelled documents, of which only the label of the whole is known.

    Each epoch takes windows of every document: for class 0 the worst one, found with the network so far, and
    another; for class 1 any ones at first and the worst one later. The first epoch takes all windows
    of short documents. A word is replaced now and then by one of class 0, so that a score rests on
    what documents of class 1 share and not on the company it keeps.
    """
    g, words, net = np.random.default_rng(seed), Words(), Network(seed)
    cut = [windows_of(words.of(words_of(t))) for t in texts]
    if not cut:
        return net
    parts = []
    while words.fresh:
        parts.append(words.take(FRESH))
    features = Features.joined(parts)
    first = np.cumsum([0, *map(len, cut)])
    windows, owner = np.concatenate(cut), np.repeat(np.arange(len(cut)), np.diff(first))
    y = np.array(labels, np.float32)
    bad_rows, good_rows = int((y == 1).sum()), int((y == 0).sum())
    fading = min(1.0, FEW / max(bad_rows, 1))
    repeats = 1 + round((min(MOST_REPEATS, max(1, good_rows // max(bad_rows, 1))) - 1) * fading)
    seen_in = np.bincount(np.concatenate([np.unique(c) for c in cut]), minlength=len(features.words))
    windows[(seen_in[windows] < 2) & (g.random(windows.shape) < fading)] = 0
    harmless = windows[y[owner] == 0]
    harmless = harmless[harmless > 0]
    some_of_each = lambda: first[:-1] + (g.random(len(cut)) * np.diff(first)).astype(np.int64)
    adam = Adam(net.p)
    epochs = min(MOST_EPOCHS, max(EPOCHS, LEAST_STEPS * BATCH // (2 * len(cut))))
    for epoch in range(epochs):
        if epoch:
            tables = net.gates(net.inputs(features))
            logit = np.concatenate([net.forward(tables, windows[i : i + BLOCK]) for i in range(0, len(windows), BLOCK)])
            worst = np.lexsort((-logit, owner))[first[:-1]]
            bad = [(some_of_each() if epoch < ANY_WINDOW * fading * epochs else worst)[y == 1] for _ in range(repeats)]
            pick = np.concatenate([*bad, worst[y == 0], some_of_each()[y == 0]])
        else:
            pick = np.flatnonzero(np.diff(first)[owner] <= 12)
            pick = pick if len(pick) else np.arange(len(windows))
            pick = np.concatenate([pick, *[pick[y[owner[pick]] == 1]] * (repeats - 1)])
        adam.rate = 0.02 if epoch < epochs - 2 else 0.005
        g.shuffle(pick)
        for i in range(0, len(pick), BATCH):
            some = pick[i : i + BATCH]
            shown = windows[some]
            if len(harmless):
                other = (g.random(shown.shape) < REPLACED * fading) & (shown > 0)
                shown[other] = g.choice(harmless, other.sum())
            adam.step(net.gradients(features, shown, y[owner[some]]))
    return net


class Scorer:
    """Scores texts with a trained network; keeps the gate inputs of the words it has met."""

    def __init__(self, net: Network):
        self.net = net
        self._clear()

    def _clear(self) -> None:
        self.words = Words()
        self.tables = [np.zeros((0, 3 * HIDDEN), np.float32)] * 2

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return np.concatenate([np.zeros(0), *[self._some(texts[a:b]) for a, b in chunks(texts)]])

    def _some(self, texts: list[bytes]) -> np.ndarray:
        if len(self.words.numbers) > MAX_KNOWN_WORDS:
            self._clear()
        words = [words_of(t) for t in texts]
        numbers = self.words.of([w for own in words for w in own])
        parts = [self.tables]
        while self.words.fresh:
            parts.append(self.net.gates(self.net.embed(self.words.take(FRESH))[0]))
        if len(parts) > 1:
            self.tables = [np.concatenate(side) for side in zip(*parts, strict=True)]
        end = np.cumsum([len(own) for own in words])
        out = np.zeros(len(texts))
        full = [i for i, own in enumerate(words) if own]
        if not full:
            return out
        cut = [windows_of(numbers[end[i] - len(words[i]) : end[i]]) for i in full]
        windows = np.concatenate(cut)
        logit = np.concatenate([self.net.forward(self.tables, windows[i : i + BLOCK]) for i in range(0, len(windows), BLOCK)])
        first = np.cumsum([0, *map(len, cut)])[:-1]
        out[full] = _sigmoid(np.maximum.reduceat(logit, first).astype(np.float64))
        return out


def train(df: DataFrame, text_col: str = "text", label_col: str = "toxic", key_col: str = "doc_id", per_class: int = DOCS_PER_CLASS) -> Network:
    """A network from about ``per_class`` labelled rows of each class, chosen by a hash of the key.

    Rows without a text, a label or a key are left out; without rows the network stays untrained.
    The sample comes to the driver, which its size allows: it doesn't grow with the table.
    """
    rows = df.select(F.col(text_col).alias("t"), F.col(label_col).cast("int").alias("y"), F.col(key_col).cast("string").alias("k"))
    rows = sample_per_class(rows.filter("t is not null and y in (0, 1) and k is not null"), "y", "k", per_class)
    found = sorted((r["k"], r["y"], r["t"].encode()) for r in rows.collect())
    net = fit([t for _, _, t in found], [y for _, y, _ in found])
    found = None
    release_memory()  # the driver goes on
    return net


def scorer(spark, net: Network):
    """A column function from a text to its score in 0 to 1; NULL and texts without words score 0."""
    shared = spark.sparkContext.broadcast(net)

    @F.arrow_udf(T.DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Scorer(shared.value)
        for text in batches:
            yield pa.array(own.scores(texts_as_bytes(text)))
        own = text = None
        release_memory()

    def of(text: Column | str) -> Column:
        return score(F.col(text) if isinstance(text, str) else text)

    return of
