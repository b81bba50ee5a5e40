"""Repeated passages by a hash-compared suffix sort, spread over buckets of suffixes.

Every byte that lies in a string of ``length`` bytes which starts anywhere else too is found.
Windows of that length that are equal have the same minimiser: the place of the smallest hash
among their k-mers. So a window's suffix belongs to the bucket (hash of its minimiser), at the
offset of the minimiser, and equal windows always meet. Three steps, each over what is left:

1. Consecutive windows with the same minimiser form a run. Runs with equal bytes are repeated as
   a whole. A bucket whose runs are all alike, or that has one run, needs no more.
2. For the others, the bytes around one run of each kind go to the bucket's task. There the
   suffixes are put in order by a mergesort; two suffixes are compared by prefix polynomial
   hashes and a binary search for their common extension, some thousand at a time. Neighbours
   that agree over the whole length are compared byte by byte before they count.
3. A bucket of more than ``most_runs`` runs is split; windows of its parts meet by their hashes.

Texts that are equal as a whole count once in these steps, so a large group of copies costs one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_rows, staged, texts_as_bytes

LENGTH = 400
MOST_RUNS = 4096
BLOCK = 1 << 20  # bytes handled at a time
MAX_SEEN = 500_000
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_SECOND = 0xC2B2AE3D27D4EB4F | 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_CODES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)


class PrefixHashes:
    """Polynomial hashes modulo 2**64 of all substrings of a text, from hashes of its prefixes."""

    _tables: dict[tuple[int, int], np.ndarray] = {}

    def __init__(self, text: np.ndarray, base: int = _BASE, room: int = 4 * BLOCK):
        if len(text) >= room:
            raise ValueError("text too long for the table of powers")
        if (base, room) not in self._tables:
            self._tables[base, room] = _powers(base, room)
        powers = self._tables[base, room]
        self.sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(_CODES[text] * powers[: len(text)], out=self.sums[1:])
        self.lift = powers[::-1]  # makes the hash of a string the same wherever it stands

    def of(self, at: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return (self.sums[at + size] - self.sums[at]) * self.lift[at]

    def all(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return (self.sums[size:] - self.sums[:n]) * self.lift[:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def runs_of(text: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one minimiser in a block of texts that end at ``ends``.

    (hash of the minimiser, its place, first window, last window), all as places in the block.
    """
    k = max(1, length // 3)
    nothing = (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)
    if len(text) < length:
        return nothing
    hashes = _mix(PrefixHashes(text).all(k))
    places = np.arange(len(hashes), dtype=np.uint64)
    mask = _U((BLOCK << 2) - 1)
    least = (_sliding_min((hashes & ~mask) | places, length - k + 1) & mask).astype(np.int64)
    owner = np.repeat(np.arange(len(ends)), np.diff(np.append(0, ends)))
    n = len(least)
    starts = np.flatnonzero(np.arange(n) + length <= ends[owner[:n]])
    if not len(starts):
        return nothing
    least = least[starts]
    new = np.append(True, (np.diff(least) != 0) | (np.diff(starts) != 1))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    place = least[first]
    return hashes[place], place, starts[first], starts[last]


_LONGS = ("h", "c1", "c2", "d1", "d2")
_RUN = T.StructType([*[T.StructField(n, T.LongType()) for n in _LONGS], *[T.StructField(n, T.IntegerType()) for n in ("p", "lo", "hi")]])


def _pair(digest: bytes) -> tuple[int, int]:
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def text_key(text: bytes) -> tuple[int, int]:
    return _pair(xxhash.xxh3_128_digest(text))


def _blocks(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Blocks of (number of the text, place in it, bytes); a longer text is cut with overlaps."""
    block, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), BLOCK - length + 1):
            part = text if len(text) <= BLOCK else text[at : at + BLOCK]
            if block and size + len(part) > BLOCK:
                yield block
                block, size = [], 0
            block.append((i, at, part))
            size += len(part)
            if len(text) <= BLOCK:
                break
    if block:
        yield block


def _runs(df: DataFrame, text_col: str, length: int) -> DataFrame:
    """Runs of all distinct texts: minimiser, digest of the run's bytes, text, and the places."""

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            if len(seen) > MAX_SEEN:
                seen.clear()
            texts, keys = [], []
            for t in texts_as_bytes(batch.column("text")):
                if len(t) >= length and (key := text_key(t)) not in seen:
                    seen.add(key)
                    texts.append(t)
                    keys.append(key)
            for block in _blocks(texts, length):
                joined = b"".join(part for _, _, part in block)
                ends = np.cumsum([len(part) for _, _, part in block])
                h, place, lo, hi = runs_of(np.frombuffer(joined, np.uint8), ends, length)
                if not len(h):
                    continue
                owner = np.searchsorted(ends, lo, "right")
                shift = np.array([at for _, at, _ in block])[owner] - (ends - np.array([len(part) for _, _, part in block]))[owner]
                digest = xxhash.xxh3_128_digest
                c = np.frombuffer(b"".join([digest(joined[a:b]) for a, b in zip(lo.tolist(), (hi + length).tolist(), strict=True)]), ">i8").reshape(-1, 2)
                d = np.array([keys[i] for i, _, _ in block], np.int64)[owner]
                yield {
                    "h": h.view(np.int64), "c1": c[:, 0].astype(np.int64), "c2": c[:, 1].astype(np.int64), "d1": d[:, 0], "d2": d[:, 1],
                    "p": (place + shift).astype(np.int32), "lo": (lo + shift).astype(np.int32), "hi": (hi + shift).astype(np.int32),
                }

    return map_rows(df.select(F.col(text_col).alias("text")), _RUN, step)


_SORTED = T.StructType([*_RUN.fields, T.StructField("repeated", T.BooleanType()), T.StructField("wanted", T.BooleanType())])


def _told_apart(runs: DataFrame) -> DataFrame:
    """Runs that are repeated as a whole, and one run of each kind in buckets of several kinds (``wanted``)."""
    names = _RUN.names

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        held: np.ndarray | None = None  # rows of the last kind that are not settled: its first and, if another, its last
        kinds_before = False  # whether the bucket of the held rows had another kind before

        def settle(rows: np.ndarray, before: bool, final: bool):
            """Split sorted distinct rows into those settled and those held back."""
            n = len(rows)
            same_kind = (np.diff(rows[:, :3], axis=0) == 0).all(axis=1)
            head = np.append(True, ~same_kind)
            heads = np.flatnonzero(head)
            bucket = rows[heads, 0]
            earlier = np.append(before, np.diff(bucket) == 0)
            later = np.append(np.diff(bucket) == 0, False)
            repeated = np.append(False, same_kind) | np.append(same_kind, False)
            wanted = np.zeros(n, bool)
            wanted[heads] = earlier | later
            stop = n if final else heads[-1]
            return repeated, wanted, stop, bool(earlier[-1])

        def out(rows: np.ndarray, repeated: np.ndarray, wanted: np.ndarray, sent: np.ndarray) -> dict:
            take = (repeated & ~sent) | wanted
            rows = rows[take]
            return {n: rows[:, i] if i < 5 else rows[:, i].astype(np.int32) for i, n in enumerate(names)} | {"repeated": (repeated & ~sent)[take], "wanted": wanted[take]}

        sent_first = False
        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(len(names))], axis=1)
            if held is not None:
                rows = np.concatenate([held, rows])
            if not len(rows):
                continue
            fresh = np.append(True, (np.diff(rows[:, :6], axis=0) != 0).any(axis=1))
            sent = np.zeros(len(rows), bool)
            sent[0] = sent_first
            if held is not None and len(held) == 2:
                sent[1] = True
            rows, sent = rows[fresh], sent[fresh]
            repeated, wanted, stop, earlier = settle(rows, kinds_before, False)
            if stop:
                yield out(rows[:stop], repeated[:stop], wanted[:stop], sent[:stop])
            # Of the open kind, all rows but the first are certainly repeated, and so is the first if there is another.
            open_, open_sent = rows[stop:], sent[stop:]
            if len(open_) > 1:
                yield out(open_, np.ones(len(open_), bool), np.zeros(len(open_), bool), open_sent)
                held, sent_first = open_[[0, -1]], True
            else:
                held, sent_first = open_, bool(open_sent[0])
            kinds_before = earlier
        if held is not None and len(held):
            repeated, wanted, _, _ = settle(held, kinds_before, True)
            sent = np.array([sent_first, True][: len(held)])
            yield out(held, repeated, wanted, sent)

    return map_rows(runs.repartition("h").sortWithinPartitions(*names[:6]), _SORTED, step)


class SuffixSorter:
    """Order of suffixes of a block of texts by their first ``length`` bytes."""

    def __init__(self, text: np.ndarray, length: int):
        self.text, self.length = text, length
        self.hashes = PrefixHashes(text)

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 as suffix ``a`` comes before, equals or comes after ``b``.

        The length of the common extension is found by binary search over prefix hashes.
        """
        out = np.zeros(len(a), np.int64)
        differ = np.flatnonzero(self.hashes.of(a, self.length) != self.hashes.of(b, self.length))
        a, b = a[differ], b[differ]
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.length - 1, np.int64)  # the extension is in [low, high]
        while (low < high).any():
            middle = (low + high + 1) >> 1
            same = self.hashes.of(a, middle) == self.hashes.of(b, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        out[differ] = np.where(self.text[a + low] < self.text[b + low], -1, 1)
        return out

    def sort(self, suffixes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Suffixes ordered within each group; groups begin at ``first``. A bottom-up mergesort whose merges run side by side."""
        size = np.diff(np.append(first, len(suffixes)))
        group = np.repeat(np.arange(len(first)), size)
        place = np.arange(len(suffixes)) - first[group]
        order, width = suffixes.copy(), 1
        while (size > width).any():
            run = place // width
            mine = first[group] + run * width
            other = np.where(run % 2 == 0, mine + width, mine - width)
            end = first[group] + size[group]
            low, high = np.minimum(other, end), np.minimum(other + width, end)
            begin = low.copy()
            left = run % 2 == 0
            open_ = np.flatnonzero(low < high)
            while len(open_):  # where each suffix falls in the run beside its own
                middle = (low[open_] + high[open_]) >> 1
                compared = self.ahead(order[open_], order[middle])
                after = (compared > 0) | ((compared == 0) & ~left[open_])
                low[open_] = np.where(after, middle + 1, low[open_])
                high[open_] = np.where(after, high[open_], middle)
                open_ = open_[low[open_] < high[open_]]
            target = np.minimum(mine, np.where(left, mine, other)) + (np.arange(len(order)) - mine) + (low - begin)
            fresh = np.empty_like(order)
            fresh[target] = order
            order, width = fresh, width * 2
        return order

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether suffixes agree over the whole length, by hashes and then byte by byte."""
        out = self.hashes.of(a, self.length) == self.hashes.of(b, self.length)
        at = np.flatnonzero(out)
        steps = np.arange(self.length)
        for i in range(0, len(at), 4096):
            some = at[i : i + 4096]
            out[some] = (self.text[a[some, None] + steps] == self.text[b[some, None] + steps]).all(axis=1)
        return out


def repeated_windows(contexts: list[bytes], bucket: np.ndarray, offset: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, SuffixSorter, np.ndarray]:
    """Windows of run contexts that occur in another context of the same bucket.

    ``offset`` is the place of the minimiser in each context. Returns, for every window in sorted
    order, its context, its place in it, and whether it is repeated; then the sorter, and whether
    the window is the first of its kind.
    """
    text = np.frombuffer(b"".join(contexts), np.uint8)
    sizes = np.array([len(c) for c in contexts])
    base = np.cumsum(sizes) - sizes
    count = sizes - length + 1
    context = np.repeat(np.arange(len(contexts)), count)
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    suffix = base[context] + within
    sorter = SuffixSorter(text, length)
    # Equal windows agree in bucket, offset of the minimiser, and their first and last bytes.
    ends = min(8, length)
    key = _mix(bucket[context].astype(np.uint64) * _U(0x9E3779B97F4A7C15) + (offset[context] - within).astype(np.uint64))
    key = _mix(key ^ sorter.hashes.of(suffix, ends)) ^ sorter.hashes.of(suffix + length - ends, ends) * _U(_SECOND)
    by = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.append(True, np.diff(key[by]) != 0)) if len(by) else np.zeros(0, np.int64)
    position = np.empty(len(text), np.int64)
    position[suffix] = np.arange(len(suffix))
    ordered = sorter.sort(suffix[by], first)
    same = np.zeros(max(len(ordered) - 1, 0), bool)
    inner = np.ones(len(ordered), bool)
    inner[first] = False
    pairs = np.flatnonzero(inner) - 1
    same[pairs] = sorter.equal(ordered[pairs], ordered[pairs + 1])
    repeated = np.append(False, same) | np.append(same, False) if len(ordered) else np.zeros(0, bool)
    which = position[ordered]
    return context[which], within[which], repeated, sorter, np.append(True, ~same)[: len(ordered)]


_CONTEXT = T.StructType([T.StructField("h", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("split", T.BooleanType()), T.StructField("d1", T.LongType()), T.StructField("d2", T.LongType()), T.StructField("p", T.IntegerType()), T.StructField("lo", T.IntegerType()), T.StructField("bytes", T.BinaryType())])
_FOUND = T.StructType([T.StructField("d1", T.LongType()), T.StructField("d2", T.LongType()), T.StructField("lo", T.IntegerType()), T.StructField("hi", T.IntegerType()), T.StructField("w1", T.LongType()), T.StructField("w2", T.LongType())])


def _contexts(texts: DataFrame, length: int) -> DataFrame:
    """Bytes of the wanted runs, from rows (text, wanted: array of runs)."""

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for text, wanted in zip(texts_as_bytes(batch.column("text")), batch.column("wanted").to_pylist(), strict=True):
                own = text_key(text)
                rows = [w for w in wanted if (w["d1"], w["d2"]) == own]
                if rows:
                    yield {n: [w[n] for w in rows] for n in _CONTEXT.names if n != "bytes"} | {"bytes": [text[w["lo"] : w["hi"] + length] for w in rows]}

    return map_rows(texts, _CONTEXT, step)


def _sorted_buckets(contexts: DataFrame, length: int) -> DataFrame:
    """Repeated windows of each bucket as (text, first, last); of split buckets also the windows' own hashes."""

    def solve(rows: list[dict]) -> Iterator[dict]:
        rows = list({(r["h"], r["part"], r["d1"], r["d2"], r["lo"]): r for r in rows}.values())
        names: dict[tuple[int, int], int] = {}
        bucket = np.array([names.setdefault((r["h"], r["part"]), len(names)) for r in rows])
        at = np.array([r["lo"] for r in rows], np.int64)
        offset = np.array([r["p"] for r in rows], np.int64) - at
        context, within, repeated, sorter, kind = repeated_windows([r["bytes"] for r in rows], bucket, offset, length)
        d = np.array([(r["d1"], r["d2"]) for r in rows], np.int64)
        c, w = context[repeated], within[repeated]
        by = np.lexsort((w, c))
        c, w = c[by], w[by]
        if len(c):
            first = np.flatnonzero(np.append(True, (np.diff(c) != 0) | (np.diff(w) != 1)))
            last = np.append(first[1:], len(c)) - 1
            nulls = pa.nulls(len(first), pa.int64())
            yield {"d1": d[c[first], 0], "d2": d[c[first], 1], "lo": (at[c[first]] + w[first]).astype(np.int32), "hi": (at[c[first]] + w[last]).astype(np.int32), "w1": nulls, "w2": nulls}
        split = np.array([r["split"] for r in rows])
        pick = kind & split[context] if len(context) else np.zeros(0, bool)
        if pick.any():
            c, w = context[pick], within[pick]
            sizes = np.array([len(r["bytes"]) for r in rows])
            place = (np.cumsum(sizes) - sizes)[c] + w
            two = PrefixHashes(sorter.text, _SECOND).of(place, length)
            start = (at[c] + w).astype(np.int32)
            yield {"d1": d[c, 0], "d2": d[c, 1], "lo": start, "hi": start, "w1": sorter.hashes.of(place, length).view(np.int64), "w2": two.view(np.int64)}

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        rows, size = [], 0
        for batch in batches:
            for r in batch.to_pylist():
                if size > BLOCK and (r["h"], r["part"]) != (rows[-1]["h"], rows[-1]["part"]):
                    yield from solve(rows)
                    rows, size = [], 0
                rows.append(r)
                size += len(r["bytes"])
        if rows:
            yield from solve(rows)

    return map_rows(contexts.repartition("h", "part").sortWithinPartitions("h", "part"), _FOUND, step)


_RESULT = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))), T.StructField("kept_sha256", T.StringType())])


def _cut(text: bytes, found: list[dict] | None, copied: bool, length: int) -> dict:
    spans: list[list[int]] = []
    if copied and len(text) >= length:
        spans = [[0, len(text)]]
    else:
        for f in sorted(found or [], key=lambda f: f["lo"]):
            start, end = f["lo"], f["hi"] + length
            if spans and start <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], end)
            else:
                spans.append([start, end])
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at:start])
        at = end
    kept.append(text[at:])
    return {"n_bytes": len(text), "n_removed": sum(e - s for s, e in spans), "spans": [{"start": s, "end": e} for s, e in spans], "kept_sha256": hashlib.sha256(b"".join(kept)).hexdigest()}


@F.arrow_udf(T.StructType([T.StructField("d1", T.LongType()), T.StructField("d2", T.LongType())]))
def _text_key(text: pa.Array) -> pa.Array:
    keys = np.array([text_key(t) for t in texts_as_bytes(text)], np.int64).reshape(-1, 2)
    return pa.StructArray.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1])], ["d1", "d2"])


def repeated_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, most_runs: int = MOST_RUNS) -> DataFrame:
    """Each row's repeated bytes: id, n_bytes, n_removed, spans (byte offsets, end exclusive), kept_sha256.

    A byte is removed when a string of ``length`` bytes around it starts anywhere else too, in the
    same text or another; overlaps count, and texts are judged as they come. NULL counts as empty;
    texts shorter than ``length`` keep all. Repeated rows are copies of each other. Other columns
    are ignored. Texts, runs and windows across split buckets are told apart by 128-bit hashes.
    Runs jobs: text keys, runs, contexts, sorted buckets.
    """
    named = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    keyed = named.select("id", "text", _text_key("text").alias("k")).select("id", "text", "k.d1", "k.d2")
    texts = staged(keyed.groupBy("d1", "d2").agg(F.min("id").alias("one"), F.count("*").alias("rows")), "texts")
    apart = staged(_told_apart(_runs(named, "text", length)), "runs")
    wanted = apart.filter("wanted")
    crowded = staged(wanted.groupBy("h").count().filter(F.col("count") > most_runs), "crowded")
    wanted = wanted.join(crowded, "h", "left").withColumn("parts", F.ceil(F.coalesce("count", F.lit(1)) / most_runs))
    wanted = wanted.withColumn("part", F.pmod(F.xxhash64("c1", "c2"), F.col("parts")).cast("int")).withColumn("split", F.col("parts") > 1)
    # The runs of one text: bounded by its length.
    by_text = wanted.groupBy("d1", "d2").agg(F.collect_list(F.struct("h", "part", "split", "d1", "d2", "p", "lo", "hi")).alias("wanted"))
    by_text = staged(by_text.join(texts, ["d1", "d2"]).select("one", "wanted"), "wanted")
    bytes_of = named.join(by_text, F.col("id").eqNullSafe(F.col("one"))).select("text", "wanted")
    found = staged(_sorted_buckets(_contexts(bytes_of, length), length), "found")
    across = found.filter(F.col("w1").isNotNull())
    twice = across.groupBy("w1", "w2").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    parts = [apart.filter("repeated").select("d1", "d2", "lo", "hi"), found.filter(F.col("w1").isNull()).select("d1", "d2", "lo", "hi"), across.join(twice, ["w1", "w2"], "left_semi").select("d1", "d2", "lo", "hi")]
    spans = parts[0].union(parts[1]).union(parts[2]).groupBy("d1", "d2").agg(F.collect_list(F.struct("lo", "hi")).alias("found"))
    copied = texts.filter("rows > 1").select("d1", "d2", F.lit(True).alias("copied"))
    marks = staged(spans.join(copied, ["d1", "d2"], "full").select("d1", "d2", "found", F.coalesce("copied", F.lit(False)).alias("copied")), "marks")

    @F.arrow_udf(_RESULT)
    def cut(text: pa.Array, found: pa.Array, copied: pa.Array) -> pa.Array:
        rows = zip(texts_as_bytes(text), found.to_pylist(), copied.to_pylist(), strict=True)
        kind = pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_sha256", pa.string())])
        return pa.array([_cut(t, f, bool(c), length) for t, f, c in rows], kind)

    return keyed.join(marks, ["d1", "d2"], "left").select("id", cut("text", "found", "copied").alias("r")).select("id", "r.*")
