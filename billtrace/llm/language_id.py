"""Language identification by multilingual mixtures.

Each language has likelihoods of letter trigrams, learned from labelled texts. A document is a
mixture: every word comes from one of the languages, with the trigram likelihood of its letters.
Expectation-maximisation finds the proportions. The set of languages is then chosen by penalised
likelihood (BIC) among the nested sets of the likeliest ones, and the prediction is the language
with the largest share in that set.

Words are scored once per task and looked up after that. Documents are handled where they lie:
no shuffle, whole texts of any length.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import sample_per_class, texts_as_bytes

DOCS_PER_LANGUAGE = 800  # bound of the training sample, for each language
UNKNOWN = "und"
STEPS = 12  # rounds of expectation-maximisation over all languages, at most
SET_STEPS = 4  # rounds for each smaller set
MIN_SHARE = 0.02  # a second language below this share is not tried
MAX_KNOWN_WORDS = 300_000
_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))

GUESS = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("shares", T.MapType(T.StringType(), T.DoubleType()))])


def words_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters in lower case and of bytes beyond ASCII."""
    return text.translate(_LETTERS).split()


def _grams(word: bytes) -> list[str]:
    padded = f"^{word.decode(errors='replace')}$"
    return [padded[i : i + 3] for i in range(len(padded) - 2)]


def has_letter(word: bytes) -> bool:
    return word[0] < 0x80 or word[-1] < 0x80 or any(c.isalpha() for c in word.decode(errors="replace"))


@dataclass
class Model:
    """Logarithms of trigram likelihoods, one column for each language in ``languages``."""

    languages: list[str]
    grams: dict[str, int]
    table: np.ndarray  # the last row is for trigrams never seen
    known: dict[bytes, int] = field(default_factory=dict)
    scores: np.ndarray | None = None  # a row for each known word

    @classmethod
    def train(cls, rows: list[tuple[str, bytes]]) -> Model:
        languages = sorted({lang for lang, _ in rows})
        counts = {lang: Counter() for lang in languages}
        words = {lang: Counter() for lang in languages}
        for lang, text in rows:
            words[lang].update(words_of(text))
        for lang, own in words.items():
            for word, n in own.items():
                for g in _grams(word):
                    counts[lang][g] += n
        grams = {g: i for i, g in enumerate(sorted(set().union(*counts.values())))}
        table = np.full((len(grams) + 1, len(languages)), 0.5)
        for j, lang in enumerate(languages):
            for g, n in counts[lang].items():
                table[grams[g], j] += n
        return cls(languages, grams, np.log(table / table.sum(axis=0)).astype(np.float32))

    def score(self, word: bytes) -> np.ndarray:
        """Likelihood of a word in each language relative to the best; zeros for what holds no letter."""
        if not has_letter(word):
            return np.zeros(len(self.languages), np.float32)
        rows = [self.grams.get(g, -1) for g in _grams(word)]
        total = self.table[rows].sum(axis=0)
        return np.exp(np.maximum(total - total.max(), -30.0))

    def numbers(self, words: list[bytes]) -> list[int]:
        known = self.known
        if self.scores is None or len(known) > MAX_KNOWN_WORDS:
            known.clear()
            self.scores = np.zeros((0, len(self.languages)), np.float32)
        fresh = [*{*words}.difference(known)]
        if fresh:
            known.update(zip(fresh, range(len(known), len(known) + len(fresh)), strict=True))
            self.scores = np.concatenate([self.scores, np.array([self.score(w) for w in fresh], np.float32)])
        return [known[w] for w in words]


def _maximise(like: np.ndarray, times: np.ndarray, start: np.ndarray, document: np.ndarray, shares: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """(shares, logarithm of the likelihood) for each document after some rounds."""
    total = np.add.reduceat(times, start)[:, None]
    for step in range(steps + 1):
        part = shares[document] * like
        whole = part.sum(axis=1)
        if step == steps:
            break
        new = np.add.reduceat(part * (times / np.maximum(whole, 1e-30))[:, None], start) / total
        done = np.abs(new - shares).max() < 1e-3
        shares = new
        if done:
            part = shares[document] * like
            whole = part.sum(axis=1)
            break
    return shares, np.add.reduceat(times * np.log(np.maximum(whole, 1e-30)), start)


def _entries(document: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries of the chosen documents: which, their documents numbered anew, and where each begins."""
    pick = np.flatnonzero(chosen[document])
    renumbered = (np.cumsum(chosen) - 1)[document[pick]]
    return pick, renumbered, np.concatenate([[0], np.flatnonzero(np.diff(renumbered)) + 1])


def mixtures(texts: list[bytes], model: Model) -> list[dict]:
    """Language, score and shares of each text."""
    n_langs = len(model.languages)
    out = [{"lang": UNKNOWN, "score": 0.0, "shares": []} for _ in texts]
    if not n_langs:
        return out
    words = [words_of(t) for t in texts]
    sizes = np.array([len(w) for w in words])
    numbers = np.array(model.numbers([w for own in words for w in own]), np.int64)
    if not len(numbers):
        return out
    scores = model.scores
    key, times = np.unique(np.repeat(np.arange(len(texts)), sizes) * len(scores) + numbers, return_counts=True)
    document, word = key // len(scores), key % len(scores)
    like = scores[word]
    letters = like.any(axis=1)  # what holds no letter says nothing
    document, like, times = document[letters], like[letters], times[letters].astype(np.float32)
    if not len(document):
        return out
    present, document = np.unique(document, return_inverse=True)
    start = np.concatenate([[0], np.flatnonzero(np.diff(document)) + 1])
    shares, _ = _maximise(like, times, start, document, np.full((len(present), n_langs), 1 / n_langs, np.float32), STEPS)
    order = np.argsort(-shares, axis=1, kind="stable")
    total = np.add.reduceat(times, start)
    best = np.zeros_like(shares)
    best[np.arange(len(present)), order[:, 0]] = 1
    cost = -2 * _maximise(like, times, start, document, best, 0)[1]
    for k in range(2, n_langs + 1):
        chosen = np.take_along_axis(shares, order[:, k - 1 : k], 1)[:, 0] >= MIN_SHARE
        if not chosen.any():
            break
        pick, own, begin = _entries(document, chosen)
        allowed = np.zeros_like(shares[chosen])
        np.put_along_axis(allowed, order[chosen, :k], 1, 1)
        tried = shares[chosen] * allowed
        tried, value = _maximise(like[pick], times[pick], begin, own, tried / tried.sum(axis=1, keepdims=True), SET_STEPS)
        value = -2 * value + (k - 1) * np.log(total[chosen] + 1)
        better = value < cost[chosen]
        which = np.flatnonzero(chosen)[better]
        cost[which], best[which] = value[better], tried[better]
    for i, row in zip(present.tolist(), best, strict=True):
        j = int(row.argmax())
        out[i] = {"lang": model.languages[j], "score": min(1.0, float(row[j])), "shares": [(model.languages[k], float(s)) for k, s in enumerate(row) if s > 0]}
    return out


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id", per_language: int = DOCS_PER_LANGUAGE) -> Model:
    """A model from about ``per_language`` rows of each language, chosen by a hash of the key.

    Rows without a language, a text or a key are left out. The sample comes to the driver; it is
    bounded by the parameter and the number of languages.
    """
    rows = df.select(F.col(lang_col).alias("l"), F.col(text_col).alias("t"), F.col(key_col).cast("string").alias("k"))
    rows = sample_per_class(rows.filter("l is not null and t is not null and k is not null"), "l", "k", per_language)
    return Model.train([(r["l"], r["t"].encode()) for r in rows.select("l", "t").toLocalIterator()])


def identifier(spark, model: Model):
    """A column function from a text to (lang, score, shares).

    ``und`` with score 0 for a text that is NULL or has no letter, or without any training row.
    Ties go to the first language in order of name.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(GUESS)
    def guess(text: pa.Array) -> pa.Array:
        return pa.array(mixtures(texts_as_bytes(text), shared.value), pa.struct([("lang", pa.string()), ("score", pa.float64()), ("shares", pa.map_(pa.string(), pa.float64()))]))

    def of(text: Column | str) -> Column:
        return guess(F.col(text) if isinstance(text, str) else text)

    return of
