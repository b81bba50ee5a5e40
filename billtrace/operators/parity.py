"""Block keys by which similar sets meet, and a filter of ids: what the joins of sets share.

The keys are those of parity sketches; ``llm.parity_join`` says why similar sets have one in common.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..arrow import map_rows

BLOCK_BITS = 31  # a block has 2 ** 31 bits, of which codes alone are kept
BAND_GROWTH = 1.5
SPARE_SHARE = 4  # blocks beyond those that may differ: one for so many of these
MARKS = 4  # bits of a filter that an id sets
MARK_BITS = 16  # bits of a filter for each id, at least
MAX_FILTER_BITS = 1 << 27  # 16 MB; with more ids than it has room for, a filter passes more rows and is as right
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers; one to one."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Bands:
    """Size bands for a threshold of ``num`` / ``den``."""

    def __init__(self, num: int, den: int):
        self.num, self.den, self.edges = num, den, [1]

    def _edge(self, j: int) -> int:
        while len(self.edges) <= j:
            self.edges.append(max(self.edges[-1] + 1, int(self.edges[-1] * BAND_GROWTH)))
        return self.edges[j]

    def difference(self, a: int, b: int) -> int:
        """Most elements in which sets of these sizes may differ at the threshold."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def blocks(self, j: int) -> tuple[int, int]:
        """(blocks of a sketch, how many of them are equal in a pair at the threshold at least)."""
        largest = self._edge(j + 1) - 1
        d = self.difference(largest, largest * self.den // self.num)
        spare = 1 + -(-d // SPARE_SHARE)
        return d + spare, spare

    def of(self, size: int) -> list[int]:
        """The set's own band and the lower ones that may hold a partner."""
        j = 0
        while self._edge(j + 1) <= size:
            j += 1
        least = -(-size * self.num // self.den)
        out = [j]
        while j > 0 and self._edge(j) - 1 >= least:
            j -= 1
            out.append(j)
        return out


def block_keys(own: np.ndarray, bands: Bands) -> np.ndarray:
    """Codes of the blocks of a set's sketches that hold elements. Sets that only equal sets can match have none.

    Two sets that have too many empty blocks, both of them, may agree in those alone; such a set gives these as well.
    """
    out = []
    codes = mix((own & _U((1 << BLOCK_BITS) - 1)) + _U(1))  # a code for each bit
    for j in bands.of(len(own)):
        k, spare = bands.blocks(j)
        if k == 1:
            continue
        block = ((own >> _U(32)) * _U(k)) >> _U(32)  # ascending, as the set is
        first = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1])
        parity = np.zeros(k, np.uint64)
        parity[block[first].astype(np.int64)] = np.bitwise_xor.reduceat(codes, first)
        keys = mix(parity ^ mix(np.arange(k, dtype=np.uint64) + _U(j << 40) + _U(1)))
        out.append(keys[block[first].astype(np.int64)] if k - len(first) < spare else keys)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def strong_keys(own: np.ndarray, bands: Bands) -> np.ndarray:
    """Codes of the fullest blocks of a set's sketches; similar sets have one in common.

    A pair at the threshold has ``spare`` equal blocks at least. In an order that their content alone decides, the last of
    these comes behind all others of them, so no set needs its first ``spare - 1`` blocks. First come those with few
    elements, in which strangers that share a common element would meet.
    """
    out = []
    codes = mix((own & _U((1 << BLOCK_BITS) - 1)) + _U(1))
    for j in bands.of(len(own)):
        k, spare = bands.blocks(j)
        if k == 1:
            continue
        block = (((own >> _U(32)) * _U(k)) >> _U(32)).astype(np.int64)  # ascending, as the set is
        first = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1])
        parity = np.zeros(k, np.uint64)
        parity[block[first]] = np.bitwise_xor.reduceat(codes, first)
        keys = mix(parity ^ mix(np.arange(k, dtype=np.uint64) + _U(j << 40) + _U(1)))
        out.append(keys[np.lexsort((keys, np.bincount(block, minlength=k)))[spare - 1 :]])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _marks(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Places that ids of these hashes have in a filter of ``bits`` bits, a power of two; a row for each of ``MARKS``."""
    h = hashes.astype(np.int64).view(np.uint64)
    return (h + np.arange(MARKS, dtype=np.uint64)[:, None] * ((h >> _U(32)) | _U(1))) & _U(bits - 1)


def perhaps(ids: DataFrame, id_col: str, most_bits: int = MAX_FILTER_BITS) -> Callable[[Column], Column]:
    """A condition on ids that holds for all of these and for few others (a Bloom filter).

    Tasks make it, so no id comes to the driver; it holds a filter of ``most_bits`` at most.
    """
    bits = 1 << 13
    wanted = min(MARK_BITS * ids.count(), most_bits)
    while bits < wanted:
        bits *= 2

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        own = np.zeros(bits // 64, np.uint64)
        for batch in batches:
            for at in _marks(batch.column(0).to_numpy(zero_copy_only=False), bits):
                np.bitwise_or.at(own, (at >> _U(6)).astype(np.int64), _U(1) << (at & _U(63)))
        used = np.flatnonzero(own)
        for i in range(0, len(used), 1 << 16):
            yield {"word": used[i : i + (1 << 16)], "set": own[used[i : i + (1 << 16)]].view(np.int64)}

    schema = T.StructType([T.StructField("word", T.LongType()), T.StructField("set", T.LongType())])
    made = map_rows(ids.select(F.xxhash64(id_col)), schema, step).groupBy("word").agg(F.bit_or("set").alias("set")).toArrow()
    filled = np.zeros(bits // 64, np.uint64)
    filled[made.column("word").to_numpy()] = made.column("set").to_numpy().view(np.uint64)
    shared = ids.sparkSession.sparkContext.broadcast(filled)

    @F.arrow_udf("boolean")
    def holds(hashes: pa.Array) -> pa.Array:
        at = _marks(hashes.to_numpy(zero_copy_only=False), bits)
        return pa.array(((shared.value[(at >> _U(6)).astype(np.int64)] >> (at & _U(63))) & _U(1)).all(axis=0))

    return lambda column: holds(F.xxhash64(column))
