"""Benchmark decontamination with an FM-index for each shard of the training texts.

A shard is one Arrow batch of documents. Words of the benchmark get numbers, any other word is a
separator, and runs of numbered words that are too short for any window are left out; what remains
is the shard's text. Its suffix array gives the Burrows-Wheeler transform, held as a wavelet tree.
Every benchmark window is then searched backwards, all windows at once, by ranks in that tree;
occurrences are located through sampled suffix positions, and their spans merged per document.

The benchmark is the stated query set: it goes to the tasks in blocks of bounded size, and the
documents are neither shuffled nor compared with one another.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import texts_as_bytes

WINDOW = 13
BLOCK_BYTES = 16_000_000
SAMPLE_EVERY = 16
# A-Z to lower case; all that is neither a letter, a digit nor beyond ASCII to a space.
_NORMAL = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))

HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


@dataclass
class Phrases:
    """Distinct windows as rows of word numbers from 1 on, padded with 0, and the items of each."""

    vocabulary: dict[bytes, int]
    rows: np.ndarray
    lengths: np.ndarray
    items: list[list[str]]

    @classmethod
    def of(cls, items: list[tuple[str, bytes]], window: int = WINDOW) -> Phrases:
        vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for name, text in items:
            numbers = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
            for i in range(max(1, len(numbers) - window + 1) if numbers else 0):
                found.setdefault(tuple(numbers[i : i + window]), set()).add(name)
        rows = np.zeros((len(found), window), np.int32)
        for i, phrase in enumerate(found):
            rows[i, : len(phrase)] = phrase
        return cls(vocabulary, rows, np.array([len(p) for p in found], np.int64), [sorted(v) for v in found.values()])


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling of a text that ends in a symbol of its own."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        key = (rank + 1) * (n + 2)
        key[: n - width] += rank[width:] + 1
        order = np.argsort(key, kind="stable")
        fresh = np.empty(n, np.int64)
        fresh[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        if fresh[order[-1]] == n - 1:
            return order
        rank, width = fresh, width * 2


class WaveletTree:
    """Ranks of symbols in a sequence, one array of zero counts for each bit of the alphabet."""

    def __init__(self, sequence: np.ndarray, bits: int):
        self.levels = []
        for b in range(bits - 1, -1, -1):
            bit = (sequence >> b) & 1
            zeros = np.concatenate([[0], np.cumsum(1 - bit)]).astype(np.int64)
            self.levels.append((b, zeros))
            sequence = np.concatenate([sequence[bit == 0], sequence[bit == 1]])

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        start = np.zeros_like(at)
        for b, zeros in self.levels:
            one = ((symbols >> b) & 1).astype(bool)
            total = zeros[-1]
            at = np.where(one, total + at - zeros[at], zeros[at])
            start = np.where(one, total + start - zeros[start], zeros[start])
        return at - start


class FMIndex:
    """Index of a text of numbers from 0 on; 0 never occurs in a phrase."""

    def __init__(self, text: np.ndarray, alphabet: int):
        # The closing symbol is smaller than all others, so every symbol moves up by one.
        self.text = np.concatenate([text.astype(np.int64) + 1, [0]])
        order = suffix_array(self.text)
        self.last = self.text[order - 1]
        self.tree = WaveletTree(self.last, max(1, int(alphabet + 1).bit_length()))
        self.before = np.concatenate([[0], np.cumsum(np.bincount(self.text, minlength=alphabet + 2))])
        self.sampled = order % SAMPLE_EVERY == 0
        self.sample_rank = np.cumsum(self.sampled) - 1
        self.samples = order[self.sampled]

    def search(self, rows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, low, high) of the phrases that occur: their suffixes are those from low to high."""
        alive = np.arange(len(rows))
        low, high = np.zeros(len(rows), np.int64), np.full(len(rows), len(self.text), np.int64)
        for step in range(rows.shape[1]):
            going = lengths[alive] > step
            now = alive[going]
            symbols = rows[now, lengths[now] - 1 - step].astype(np.int64) + 1
            low[now] = self.before[symbols] + self.tree.rank(symbols, low[now])
            high[now] = self.before[symbols] + self.tree.rank(symbols, high[now])
            alive = alive[low[alive] < high[alive]]
            if not len(alive):
                break
        return alive, low[alive], high[alive]

    def locate(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Text positions of the suffixes of all ranges, one range after the other."""
        count = high - low
        row = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
        steps = np.zeros(len(row), np.int64)
        open_ = np.flatnonzero(~self.sampled[row])
        while len(open_):
            symbols = self.last[row[open_]]
            row[open_] = self.before[symbols] + self.tree.rank(symbols, row[open_])
            steps[open_] += 1
            open_ = open_[~self.sampled[row[open_]]]
        return self.samples[self.sample_rank[row]] + steps


def shard_hits(texts: list[bytes], phrases: Phrases) -> tuple[np.ndarray, list[list[dict]], list[list[str]]]:
    """Words, merged hit spans (in words) and items with occurring windows, for each text."""
    get = phrases.vocabulary.get
    numbers: list[int] = []
    n_words = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        own = words_of(text)
        n_words[i] = len(own)
        numbers += [get(w, 0) for w in own]
        numbers.append(0)  # windows never reach into the next text
    first = np.concatenate([[0], np.cumsum(n_words + 1)])
    spans: list[list[dict]] = [[] for _ in texts]
    items: list[set[str]] = [set() for _ in texts]
    words = np.array(numbers, np.int32)
    edge = np.diff(np.concatenate([[0], (words > 0).astype(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long_enough = end - start >= (phrases.lengths.min() if len(phrases.lengths) else np.inf)
    start, end = start[long_enough], end[long_enough]
    if len(start):
        size = end - start + 1  # with the separator behind each run
        at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
        index = FMIndex(words[at], len(phrases.vocabulary) + 1)
        phrase, low, high = index.search(phrases.rows, phrases.lengths)
        if len(phrase):
            place = at[index.locate(low, high)]
            phrase = np.repeat(phrase, high - low)
            document = np.searchsorted(first, place, "right") - 1
            for d, p in {*zip(document.tolist(), phrase.tolist(), strict=True)}:
                items[d].update(phrases.items[p])
            cover = np.zeros(len(words) + 1, np.int32)
            np.add.at(cover, place, 1)
            np.add.at(cover, place + phrases.lengths[phrase], -1)
            edge = np.diff(np.concatenate([[0], (np.cumsum(cover) > 0).astype(np.int8)]))
            begin, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            for d, b, e in zip((np.searchsorted(first, begin, "right") - 1).tolist(), begin.tolist(), stop.tolist(), strict=True):
                spans[d].append({"start": b - int(first[d]), "end": e - int(first[d])})
    return n_words, spans, [sorted(i) for i in items]


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_bytes: int) -> Iterator[Phrases]:
    named = benchmark.select(F.col(item_col).cast("string").alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    for b in range(blocks):
        rows = named.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).collect()
        yield Phrases.of([(r["item"], r["text"].encode()) for r in rows if r["item"] is not None], window)


def _searcher(spark, phrases: Phrases) -> Callable:
    shared = spark.sparkContext.broadcast(phrases)

    @F.arrow_udf(HITS)
    def search(text: pa.Array) -> pa.Array:
        n_words, spans, items = shard_hits(texts_as_bytes(text), shared.value)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.StructArray.from_arrays([pa.array(n_words), pa.array(spans, kind), pa.array(items, pa.list_(pa.string()))], ["n_words", "spans", "items"])

    return search


def _merge(spans):
    """Union of spans from several blocks, in order."""
    step = lambda acc, s: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= s["start"]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end")))),
    ).otherwise(F.concat(acc, F.array(s)))
    return F.aggregate(F.array_sort(spans), F.slice(spans, 1, 0), step)


def with_hits(
    df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", as_col: str = "hits", window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``df`` with a struct column: n_words, spans (word numbers, end exclusive), items, n_hit, contaminated.

    A document is contaminated when it has a hit and at least a twentieth of its words are hit. NULL
    and empty texts have no words. An item of fewer than ``window`` words is one window; items
    without an id or without words never occur. Rows and other columns of ``df`` stay as they are; a
    column that is named like ``as_col`` is replaced.
    Runs a job for the size of the benchmark and one for each block of it.
    """
    parts = [_searcher(df.sparkSession, p)(F.col(text_col)) for p in _blocks(benchmark, item_col, item_text_col, window, block_bytes)]
    stem = "__block"
    while any(c.startswith(stem) for c in df.columns):
        stem += "_"
    names = [f"{stem}{i}" for i in range(len(parts))]
    out = df.withColumns(dict(zip(names, parts, strict=True)))
    spans, items = F.col(f"{names[0]}.spans"), F.col(f"{names[0]}.items")
    if len(names) > 1:
        spans = _merge(F.flatten(F.array(*[F.col(f"{n}.spans") for n in names])))
        items = F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(f"{n}.items") for n in names]))))
    n_words = F.col(f"{names[0]}.n_words")
    n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    out = out.withColumn(as_col, F.struct(n_words.alias("n_words"), spans.alias("spans"), items.alias("items"), n_hit.alias("n_hit")))
    verdict = (F.col(f"{as_col}.n_hit") > 0) & (F.col(f"{as_col}.n_hit") * 20 >= F.col(f"{as_col}.n_words"))
    return out.withColumn(as_col, F.col(as_col).withField("contaminated", verdict)).drop(*names)
