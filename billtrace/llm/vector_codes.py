"""Vector codes by integer k-means whose assignments keep adaptive distance bounds.

A vector is cut into equal parts; each part position has a small codebook. Between rounds every part
keeps its entry with an upper bound of the distance, its ``b`` next closest entries in order with a
lower bound each, and one outer bound for all further entries. When the entries move, the bounds
move with them; only parts whose upper bound reaches a lower bound are looked at again, and only as
deep as the first lower bound that is out of reach. These distances are exact integers, and equal
ones go to the lower index, so the result is that of plain rounds over all entries. ``b`` shrinks
for each part position to the depth that nearly all parts were settled within.

Rows are never shuffled: a round is one pass over the state, written to the shared folder, and one
sum over it, which leaves a row for each entry. Driver and tasks see the codebooks only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, field, map_rows, scratch_path, staged

SCALE = 4096
# Components reach this as integers; sums of squares of 64 differences then fit 64 bits.
LIMIT = 1 << 27
# Parts of a position that may be left to a full search when b shrinks.
LEFT_OVER = 0.01


def usable(vector: Column) -> Column:
    """Not NULL, and no NULL, NaN or infinite component."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def same_length(df: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int]:
    """The usable vectors of one length (the most frequent; of equally frequent ones the longest), and that length."""
    fine = df.filter(usable(F.col(vec_col).cast("array<double>")))
    lengths = fine.groupBy(F.size(vec_col).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = 0 if lengths is None else lengths["size"]
    return fine.filter(F.size(vec_col) == size), size


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype("float32"), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype("float32"), np.float32(-np.inf))


def _squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    return np.square(x - entries).sum(axis=-1)


class Bounds:
    """What a batch knows of one part position: entry, upper bound, next entries with lower bounds, outer bound."""

    def __init__(self, n: int, b: int):
        self.assigned, self.upper = np.zeros(n, "int8"), np.zeros(n, "float32")
        self.near, self.lower = np.zeros((n, b), "int8"), np.zeros((n, b), "float32")
        self.outer, self.depth = np.zeros(n, "float32"), np.zeros(n, "int8")

    def search(self, rows: np.ndarray, x: np.ndarray, book: np.ndarray) -> None:
        """All distances of these rows."""
        b = self.near.shape[1]
        d = _squares(x[rows, None, :], book[None])
        order = np.argsort(d, axis=1, kind="stable")
        root = np.sqrt(np.take_along_axis(d, order, 1).astype("float64"))
        self.assigned[rows], self.upper[rows] = order[:, 0], _up(root[:, 0])
        self.near[rows], self.lower[rows] = order[:, 1 : b + 1], _down(root[:, 1 : b + 1])
        self.outer[rows] = _down(root[:, b + 1]) if b + 1 < len(book) else np.inf
        self.depth[rows] = b + 1

    def moved(self, drift: np.ndarray, b: int) -> None:
        """Bounds after the entries moved, for the ``b`` nearest: what falls off the list joins the outer bound."""
        self.upper = _up(self.upper + drift[self.assigned])
        lower = _down(self.lower - drift[self.near])
        outer = _down(self.outer - drift.max())
        bound = np.minimum.accumulate(np.column_stack([lower, outer])[:, ::-1], axis=1)[:, ::-1]
        self.near, self.lower, self.outer = self.near[:, :b].copy(), bound[:, :b].copy(), bound[:, b].copy()
        self.depth[:] = 0

    def _reach(self, rows: np.ndarray) -> np.ndarray:
        """How many of the next entries may be as near as the entry; one more where those beyond may be."""
        bounds = np.column_stack([self.lower[rows], self.outer[rows]])
        return (bounds <= self.upper[rows, None]).sum(axis=1)

    def settle(self, x: np.ndarray, book: np.ndarray) -> None:
        """The nearest entry of every row again."""
        b = self.near.shape[1]
        rows = np.flatnonzero(self._reach(np.arange(len(x))))
        self.upper[rows] = _up(np.sqrt(_squares(x[rows], book[self.assigned[rows]]).astype("float64")))
        reach = self._reach(rows)
        for z in range(1, b + 1):
            at = rows[reach == z]
            if len(at):
                entries = np.column_stack([self.assigned[at], self.near[at, :z]])
                d = _squares(x[at, None, :], book[entries])
                order = np.lexsort((entries, d), axis=-1)
                entries = np.take_along_axis(entries, order, 1)
                root = np.sqrt(np.take_along_axis(d, order, 1).astype("float64"))
                self.assigned[at], self.upper[at] = entries[:, 0], _up(root[:, 0])
                self.near[at, :z], self.lower[at, :z] = entries[:, 1:], _down(root[:, 1:])
                self.depth[at] = z
        self.search(rows[reach > b], x, book)


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


STATE = [("assigned", "array<tinyint>"), ("upper", "array<float>"), ("near", "array<tinyint>"), ("lower", "array<float>"), ("outer", "array<float>"), ("depth", "array<tinyint>")]


def _lists(rows: np.ndarray) -> pa.ListArray:
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype="int32") * width), pa.array(rows.reshape(-1)))


def assign(points: DataFrame, books: np.ndarray, drift: np.ndarray | None, widths: list[int], before: list[int] | None) -> DataFrame:
    """One assignment of all parts. ``drift`` is how far each entry moved; None searches everything.

    ``widths`` is b of each part position, ``before`` that of the state that ``points`` holds.
    """
    parts, _, size = books.shape
    base = T.StructType([points.schema[c] for c in ("id", "label", "x")])
    schema = T.StructType([*base, *T._parse_datatype_string(", ".join(f"{n} {t}" for n, t in STATE))])

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = _matrix(batch.column("x"), n).astype("int64").reshape(n, parts, size)
            old = {} if drift is None else {name: _matrix(batch.column(name), n) for name, _ in STATE}
            ends = np.cumsum([0, *(before or widths)])
            done = []
            for p in range(parts):
                part = Bounds(n, widths[p])
                if drift is None:
                    part.search(np.arange(n), x[:, p], books[p])
                else:
                    cut = slice(ends[p], ends[p + 1])
                    part.assigned, part.upper, part.outer = (old[c][:, p].copy() for c in ("assigned", "upper", "outer"))
                    part.near, part.lower = old["near"][:, cut], old["lower"][:, cut]
                    part.moved(drift[p], widths[p])
                    part.settle(x[:, p], books[p])
                done.append(part)
            stack = {c: np.column_stack([getattr(part, c) for part in done]) for c, _ in STATE}
            yield {c: batch.column(c) for c in base.names} | {c: _lists(stack[c]) for c, _ in STATE}

    return map_rows(points, schema, step)


def _totals(state: DataFrame, parts: int, entries: int, size: int) -> list:
    """Of each entry: parts it has, their sums, and how deep they were looked at. Added up in each task first."""
    deepest = entries + 1
    schema = T._parse_datatype_string("part int, entry int, n long, sums array<long>, depths array<long>")

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        sums, depths = np.zeros((parts * entries, size), "int64"), np.zeros((parts * entries, deepest), "int64")
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = _matrix(batch.column("x"), n).astype("int64").reshape(n * parts, size)
            key = (_matrix(batch.column("assigned"), n).astype("int64") + np.arange(parts) * entries).reshape(-1)
            order = np.argsort(key, kind="stable")
            starts = np.flatnonzero(np.diff(key[order], prepend=-1))
            sums[key[order][starts]] += np.add.reduceat(x[order], starts, axis=0)
            depth = _matrix(batch.column("depth"), n).astype("int64").reshape(-1)
            depths += np.bincount(key * deepest + depth, minlength=depths.size).reshape(depths.shape)
        count = depths.sum(axis=1)
        used = np.flatnonzero(count)
        yield {"part": used // entries, "entry": used % entries, "n": count[used], "sums": _lists(sums[used]), "depths": _lists(depths[used])}

    added = map_rows(state.select("x", "assigned", "depth"), schema, step)
    return added.groupBy("part", "entry").agg(
        F.sum("n").alias("n"),
        F.array(*[F.sum(F.col("sums")[j]) for j in range(size)]).alias("sums"),
        F.array(*[F.sum(F.col("depths")[j]) for j in range(deepest)]).alias("depths"),
    ).collect()


def _narrowed(depths: np.ndarray, b: int, least: int) -> int:
    """The depth within which all parts but a few were settled, ``least`` at least and ``b`` at most."""
    within = np.cumsum(depths[: b + 1])
    enough = np.flatnonzero(within >= (1 - LEFT_OVER) * depths.sum())
    return b if not len(enough) else min(b, max(least, int(enough[0])))


def compress(
    df: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = SCALE,
) -> DataFrame:
    """Codes of all usable vectors: id, code, error, label_error, codebooks_sha256.

    Codebooks start as the parts of the ``entries`` smallest ids (NULL ids last, repeated ids by
    their components; fewer, where there are fewer vectors). Vectors that are NULL or hold a NULL or
    non-finite component are left out, and so are those of another length than most or of one that
    ``parts`` doesn't divide. Rows that repeat an id are coded each; equal vectors get equal codes.
    A component of ``LIMIT / scale`` or more raises an error, as its squares don't fit. An
    empty table gives no rows. NULL labels count as one label. Other columns are ignored, whatever
    their names. Runs jobs: two passes a round.
    """
    spark = df.sparkSession
    own = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"), F.col(label_col).alias("label"))
    kept, size = same_length(own, "id", "v")
    if size == 0 or size % parts:
        kept, size = kept.limit(0), parts

    def whole(v: Column) -> Column:
        v = v.cast("double") * float(scale)
        return F.when(F.abs(v) < LIMIT, F.floor(v).cast("int")).otherwise(F.raise_error(F.lit(f"a component is beyond {LIMIT // scale}")).cast("int"))

    points = staged(kept.select("id", "label", F.transform("v", whole).alias("x")), "points")
    first = points.select("id", "x").orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).collect()
    out = T.StructType([field(points, "id"), field(points, "label"), *T._parse_datatype_string("code string, error long")])
    if not first:
        return spark.createDataFrame([], out).select("id", "code", "error", F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))

    books = np.array([r["x"] for r in first], "int64").reshape(len(first), parts, size // parts).transpose(1, 0, 2)
    entries = len(first)
    widths, before, drift = [min(entries // 4, entries - 1)] * parts, None, None
    least, state, path = entries // 8, points, None
    for turn in range(rounds + 1):
        fresh = scratch_path(spark, "bounds")
        table = assign(state, books, drift, widths, before)
        table.write.parquet(fresh)
        state, stale, path = spark.read.schema(table.schema).parquet(fresh), path, fresh
        if stale:
            discard(spark, stale)
        if turn == rounds:
            break
        moved, depths = books.copy(), np.zeros((parts, entries + 1), "int64")
        for r in _totals(state, parts, entries, size // parts):
            moved[r["part"], r["entry"]] = np.array(r["sums"], "int64") // r["n"]
            depths[r["part"]] += np.array(r["depths"], "int64")
        before = widths
        if turn:
            widths = [_narrowed(depths[p], widths[p], least) for p in range(parts)]
        drift = np.sqrt(np.square(moved - books).sum(axis=2).astype("float64")) * (1 + 1e-12)
        books = moved

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = _matrix(batch.column("x"), n).astype("int64").reshape(n, parts, -1)
            entry = _matrix(batch.column("assigned"), n)
            error = _squares(x, books[np.arange(parts), entry]).sum(axis=1)
            yield {"id": batch.column("id"), "label": batch.column("label"), "code": [e.tobytes().hex() for e in entry], "error": error}

    coded = staged(map_rows(state, out, step), "codes")
    discard(spark, path)
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    by_label = staged(coded.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error")), "label_errors")
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("__label")), "left")
    return joined.select("id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


__all__ = ["compress", "same_length", "usable"]
