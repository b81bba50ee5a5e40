"""Importance resampling towards a target set, with exact weights from bit-sliced counts.

Features are runs of words, hashed to buckets. A bucket's gain is the logarithm of how much more
often it is met in the target than in the corpus, as an integer. A document's bucket counts become
bit planes of as many bits as there are buckets, and so do the gains, signed by the top plane. The
sum of the gains over a document is then the sum, over pairs of planes, of a power of two times the
number of bits that both planes have: an AND, a count of bits and a shift, without rounding.

Documents are drawn by weight plus Gumbel noise of a hash of their id, in order of that score. The order
is global but only the drawn part is sorted, in ranges: a histogram of scores finds the cut.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import field, map_rows, staged, texts_as_bytes

BUCKETS = 10_000
LONGEST = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
# Digits, letters and everything beyond ASCII; bytes of longer UTF-8 sequences are all beyond.
WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
ROWS_PER_RANGE = 500_000


def words(text: bytes) -> list[bytes]:
    """Words of a text, A-Z lower-cased."""
    return WORD.findall(text.lower())


def bucket_counts(found: list[bytes], longest: int, buckets: int) -> np.ndarray:
    """How many features, runs of up to ``longest`` words, fall into each bucket."""
    counts = np.zeros(buckets, "int64")
    for n in range(1, longest + 1):
        runs = found if n == 1 else [b" ".join(found[i : i + n]) for i in range(len(found) - n + 1)]
        if runs:
            hashes = np.fromiter(map(crc32, runs), "int64", len(runs))
            counts += np.bincount(hashes % buckets, minlength=buckets)
    return counts


def planes(values: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes of integers (two's complement where negative), lowest first, each packed in 64-bit words."""
    width = -(-len(values) // 64) * 8
    packed = np.zeros((bits, width), "uint8")
    for i in range(bits):
        row = np.packbits(((values >> i) & 1).astype("uint8"))
        packed[i, : len(row)] = row
    return packed.view("uint64")


class Gains:
    """Signed integers by bucket, as bit planes; the top plane counts negative."""

    def __init__(self, values: np.ndarray):
        bits = int(np.abs(values).max(initial=0)).bit_length() + 1
        self.planes = planes(values.astype("int64"), bits)
        self.power = [1 << i for i in range(bits - 1)] + [-(1 << (bits - 1))]

    def total(self, counts: np.ndarray) -> int:
        """The sum of gain times count, exact."""
        bits = int(counts.max(initial=0)).bit_length()
        out = 0
        for i, plane in enumerate(planes(counts, bits)):
            both = np.bitwise_count(self.planes & plane).sum(axis=1, dtype="int64")
            out += (1 << i) * sum(n * p for n, p in zip(both.tolist(), self.power, strict=True))
        return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket: a thousand times the logarithm of the smoothed ratio, floored."""
    buckets, s, t = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((tb + 1.0) * (s + buckets) / ((sb + 1.0) * (t + buckets)))) for sb, tb in zip(corpus.tolist(), target.tolist(), strict=True)], "int64")


def corpus_counts(df: DataFrame, text_col: str, longest: int, buckets: int) -> np.ndarray:
    """Features of all texts in each bucket: added up in every task, then by bucket. The driver gets one row a bucket."""

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        total = np.zeros(buckets, "int64")
        for batch in batches:
            for text in texts_as_bytes(batch.column(0)):
                total += bucket_counts(words(text), longest, buckets)
        met = np.flatnonzero(total)
        yield {"bucket": met, "n": total[met]}

    added = map_rows(df.select(text_col), T._parse_datatype_string("bucket int, n long"), step)
    out = np.zeros(buckets, "int64")
    for bucket, n in added.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def weigh(df: DataFrame, gain: np.ndarray, id_col: str, text_col: str, longest: int) -> DataFrame:
    """Per row: doc_id, n_words, n_features, and the floored mean of its features' gains (0 without features)."""
    schema = T.StructType([field(df, id_col, "doc_id"), *T._parse_datatype_string("n_words long, n_features long, weight long")])
    buckets = len(gain)

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        table = Gains(gain)
        for batch in batches:
            n_words, n_features, weight = [], [], []
            for text in texts_as_bytes(batch.column(1)):
                found = words(text)
                counts = bucket_counts(found, longest, buckets)
                n = int(counts.sum())
                n_words.append(len(found))
                n_features.append(n)
                weight.append(table.total(counts) // n if n else 0)
            yield {"doc_id": batch.column(0), "n_words": n_words, "n_features": n_features, "weight": weight}

    return map_rows(df.select(id_col, text_col), schema, step)


def noise(id_col: str, seed: int) -> Column:
    """Gumbel noise of an id, times a thousand and floored. A NULL id counts as an empty one."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(
    df: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """Every row's doc_id, n_features, weight, score and rank, the last NULL where the row isn't drawn.

    Of the rows with ``least_words`` words, ``percent`` in a hundred are drawn, highest scores first,
    ties to the smaller id (NULL last, equal ids in any order). A NULL text has no words. Rows that
    repeat are rows of their own: they count in the corpus and may be drawn each. Empty tables are fine: no
    rows give no rows, no target gives all buckets its smoothed share. Other columns are ignored.
    Runs jobs: counts of both tables, weights, a histogram of scores, ranges of the drawn rows.
    """
    gain = gains(corpus_counts(df, text_col, longest, buckets), corpus_counts(target, target_text_col, longest, buckets))
    weighed = weigh(df, gain, id_col, text_col, longest)
    # The tie number is written with the row, so it stays the same however often a task runs.
    scored = staged(
        weighed.select("doc_id", "n_features", "weight", (F.col("weight") + noise("doc_id", seed)).alias("score"), (F.col("n_words") >= least_words).alias("fit"), F.monotonically_increasing_id().alias("tie")),
        "scores",
    )
    # Scores lie between bounds that follow from the gains and 32 bits of noise, so there are few of them at any size.
    counts = scored.filter("fit").groupBy("score").count().orderBy(F.desc("score")).collect()
    drawn = percent * sum(r["count"] for r in counts) // 100
    result = lambda rows, rank: rows.select("doc_id", "n_features", "weight", "score", rank.cast("long").alias("rank"))
    if not drawn:
        return result(scored, F.lit(None))
    reach, cut = 0, None
    for r in counts:
        if reach < drawn:
            reach, cut = reach + r["count"], r["score"]
    high = F.col("fit") & (F.col("score") >= cut)
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last(), F.col("tie")]
    parts = max(1, -(-reach // ROWS_PER_RANGE))
    ranged = scored.filter(high).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # The id counts the rows of a sorted range from 0, below bit 33.
    ranged = staged(ranged.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id() % (1 << 33)), "drawn")
    sizes = dict(ranged.groupBy("part").count().collect())
    starts, before = [], 0
    for part in sorted(sizes):
        starts.append((part, before))
        before += sizes[part]
    offsets = df.sparkSession.createDataFrame(starts, "part int, before long")
    ranged = ranged.join(offsets, "part")
    rank = F.col("before") + F.col("at") + 1
    return result(ranged, F.when(rank <= drawn, rank)).unionByName(result(scored.filter(~high), F.lit(None)))


__all__ = ["Gains", "bucket_counts", "gains", "planes", "resample", "words"]
