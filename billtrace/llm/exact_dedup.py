"""Exact dedup over a cuckoo-filter index of live digests.

Each task keeps an index of the digests it has seen. A slot holds a short fingerprint and the
number of a stored entry; a fingerprint that matches counts only if the stored digest is the same.
When a row with a larger id takes over a text, the live entry is deleted from the index and the
new one is inserted. When an insertion finds no place, the index is built anew at twice the size
from the stored keys.

The index runs twice: over the rows as they lie, which leaves one row for each digest and task,
and, after a shuffle by digest, over those. So a text that holds a third of all rows sends one
row per task. An index that reaches ``max_entries`` in the first pass is emptied downstream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_rows, staged, texts_as_bytes

SLOTS = 4
MAX_KICKS = 200


class CuckooIndex:
    """Digests with insertion, deletion and verified lookup; digests are 32 uniform bytes."""

    def __init__(self, buckets: int = 1024):
        self.entries: dict[int, tuple[bytes, object, int]] = {}  # number -> digest, id, rows
        self._next = 0
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self._mask = buckets - 1
        self._table: list[list[tuple[int, int]]] = [[] for _ in range(buckets)]

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[:2], "big")
        first = int.from_bytes(digest[2:10], "big") & self._mask
        return mark, first, self._other(first, mark)

    def _other(self, place: int, mark: int) -> int:
        return place ^ ((mark * 0x5BD1E995 + 1) & self._mask)

    def find(self, digest: bytes) -> int | None:
        """Number of the live entry of a digest; a fingerprint alone is no hit."""
        mark, first, second = self._places(digest)
        for place in (first, second):
            for slot_mark, number in self._table[place]:
                if slot_mark == mark and self.entries[number][0] == digest:
                    return number
        return None

    def insert(self, digest: bytes, key: object, rows: int) -> None:
        number, self._next = self._next, self._next + 1
        self.entries[number] = (digest, key, rows)
        if not self._place(digest, number):
            self._grow()

    def _place(self, digest: bytes, number: int) -> bool:
        mark, first, second = self._places(digest)
        for place in (first, second):
            if len(self._table[place]) < SLOTS:
                self._table[place].append((mark, number))
                return True
        place, item = second, (mark, number)
        for kick in range(MAX_KICKS):
            bucket = self._table[place]
            bucket[kick % SLOTS], item = item, bucket[kick % SLOTS]
            place = self._other(place, item[0])
            if len(self._table[place]) < SLOTS:
                self._table[place].append(item)
                return True
        return False

    def _grow(self) -> None:
        buckets = len(self._table)
        while True:
            buckets *= 2
            self._clear(buckets)
            if all(self._place(digest, n) for n, (digest, _, _) in self.entries.items()):
                return

    def delete(self, number: int) -> None:
        digest = self.entries.pop(number)[0]
        mark, first, second = self._places(digest)
        for place in (first, second):
            if (mark, number) in self._table[place]:
                self._table[place].remove((mark, number))
                return

    def offer(self, digest: bytes, key: object, rows: int) -> None:
        """Count ``rows`` more of a digest; the larger key becomes or stays the live one."""
        number = self.find(digest)
        if number is None:
            self.insert(digest, key, rows)
            return
        _, live, before = self.entries[number]
        if key is not None and (live is None or key > live):
            self.delete(number)
            self.insert(digest, key, before + rows)
        else:
            self.entries[number] = (digest, live, before + rows)


def _merged(rows: DataFrame, max_entries: int | None) -> DataFrame:
    """(digest, keep_id, n): one row per digest, task and filling of the index."""

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        index = CuckooIndex()

        def out() -> dict:
            live = list(index.entries.values())
            return {name: [e[i] for e in live] for i, name in enumerate(("digest", "keep_id", "n"))}

        for batch in batches:
            for digest, key, n in zip(*(batch.column(c).to_pylist() for c in ("digest", "keep_id", "n")), strict=True):
                index.offer(digest, key, n)
            if max_entries and len(index.entries) >= max_entries:
                yield out()
                index = CuckooIndex()
        yield out()

    return map_rows(rows.select("digest", "keep_id", "n"), rows.select("digest", "keep_id", "n").schema, step)


@F.arrow_udf(T.BinaryType())
def _digest(text: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256(t.lower()).digest() for t in texts_as_bytes(text)], pa.binary())


def text_digest(text: Column | str) -> Column:
    """SHA-256 of the UTF-8 bytes with A-Z lower-cased; NULL counts as empty."""
    return _digest(F.col(text) if isinstance(text, str) else text)


def keepers(digests: DataFrame, max_entries: int = 500_000) -> DataFrame:
    """(digest, keep_id, n) with one row per digest, from rows (id, digest)."""
    rows = digests.select("digest", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("n"))
    return staged(_merged(_merged(rows, max_entries).repartition("digest"), None), "keepers")


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_entries: int = 500_000) -> DataFrame:
    """Each row's group of equal texts: id, digest, keep_id, group_size, kept.

    Texts are equal when identical after lower-casing A-Z; NULL equals the empty text. The row with
    the largest id stays; a NULL id is smaller than any other. Rows that repeat both id and text
    are one document: each is returned, each counts in ``group_size``, and ``kept`` is the same for
    all. Other columns are ignored. Runs two jobs (digests, keepers).
    """
    digests = staged(df.select(F.col(id_col).alias("id"), text_digest(text_col).alias("digest")), "digests")
    live = keepers(digests, max_entries).withColumnRenamed("n", "group_size")
    return digests.join(live, "digest").select("id", "digest", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"))


def drop_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_entries: int = 500_000) -> DataFrame:
    """The rows of ``df`` that stay, with all their columns.

    The join is on digest and id together, so a text that holds a third of all rows spreads.
    """
    named = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    named = named.select("row", F.col("row")[id_col].alias("id"), text_digest(F.col("row")[text_col]).alias("digest"))
    live = keepers(staged(named.select("id", "digest"), "digests"), max_entries).select(F.col("digest").alias("kd"), "keep_id")
    return named.join(live, (F.col("digest") == F.col("kd")) & F.col("id").eqNullSafe(F.col("keep_id")), "left_semi").select("row.*")


__all__ = ["CuckooIndex", "drop_duplicates", "exact_duplicates", "keepers", "text_digest"]
