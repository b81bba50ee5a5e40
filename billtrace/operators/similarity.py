"""Text distance, similar amendments and their clusters.

Similarity is complete at its threshold. Exact copies fold to one text. Each set of the others gives codes of the blocks
of its parity sketches (``operators.parity``): two sets that are similar enough have a block in common, others only by
a rare chance, however many elements all texts share. Only codes and ids are sent for this; sets are made again
where they are asked for, and written for pairs that sketches leave open. Texts that meet in a block are settled by exact similarity in rounds:
a pivot of each block that still spans several clusters is checked against the members of other clusters and then
leaves it, so that a block whose members are linked costs one check for each. When a round joins little, what is
left is compared in tiles.

A pair is judged in two steps: sketches that grow with the set (at most two bits for an element of 64) go with the
pairs, and sets move for what is still open. In tiles short sketches of one size go with the members before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.texts import collapse_space, fingerprint
from ..session import staged
from .joins import attach
from .parity import Bands, mix, perhaps, strong_keys

SKETCH_WORDS = 8  # of 64 bits
TILE = 512
STAR_SHARE = 0.1  # rounds of stars go on while they add links for this share of the open texts


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once, not once for each use."""
    return F.transform(F.array(value), body)[0]


def _runs(text: Column | str, n: int, of) -> Column:
    words = F.split(F.lower(collapse_space(text)), " ")

    def all_runs(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(w) - (n - 1), F.lit(1)))
        return F.array_distinct(F.transform(starts, lambda i: of(F.slice(w, i, n))))

    return _bind(words, all_runs)


def shingles(text: Column | str, n: int = 3) -> Column:
    """Distinct hashes of the runs of ``n`` words; a shorter text is one run."""
    return _runs(text, n, lambda run: F.xxhash64(run))


def ngrams(text: Column | str, n: int = 3) -> Column:
    """Distinct runs of ``n`` words as text; a shorter text is one run."""
    return _runs(text, n, lambda run: F.array_join(run, " "))


def jaccard(a: Column | str, b: Column | str) -> Column:
    """Shared part of two sets given as arrays without repeats."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))

    def share(p: Column) -> Column:
        both = F.size(F.array_intersect(p["a"], p["b"])).cast("double")
        return _bind(both, lambda n: F.try_divide(n, F.size(p["a"]) + F.size(p["b"]) - n))

    return _bind(F.struct(a.alias("a"), b.alias("b")), share)


def text_distance(pairs: DataFrame, a: str, b: str, n: int = 3) -> DataFrame:
    """Add the Jaccard similarity of the word runs of two text columns to each row."""
    return pairs.withColumn("similarita", jaccard(ngrams(a, n), ngrams(b, n)))


def _saved(df: DataFrame, rows: int | None = None) -> DataFrame:
    return staged(df, "rows", rows)


def _copies(marked: DataFrame) -> DataFrame:
    leaders = marked.groupBy("__f").agg(F.min("id").alias("a"))
    return attach(marked.select("id", "__f"), leaders, ["__f"], "inner").filter("id <> a").select("a", F.col("id").alias("b"))


def exact_copies(df: DataFrame, key: str, text: str) -> DataFrame:
    """(leader, copy) for texts equal up to white space; the smallest key leads."""
    return _copies(_saved(df.select(F.col(key).alias("id"), fingerprint(text).alias("__f"))))


def _scored(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with their intersection and sizes. Only sets that are in a pair move."""
    ids = staged(pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "id"), "ids")
    sets = sets.join(ids, "id", "left_semi")
    left = sets.select(F.col("id").alias("a"), F.col("s").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("s").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb")).cast("long").alias("both")
    return pairs.join(right, "b").join(left, "a").select("a", "b", both, F.size("sa").alias("na"), F.size("sb").alias("nb"))


def _sketcher():
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, ends = np.asarray(batch.column("s").values), np.asarray(batch.column("s").offsets)
            out = []
            for start, end in zip(ends[:-1], ends[1:], strict=True):
                bits = 64 << max(0, int(end - start - 1).bit_length() - 6)  # the next power of two, at least 64
                flips = np.zeros(bits, np.uint8)
                np.bitwise_xor.at(flips, values[start:end] & (bits - 1), 1)
                out.append(np.packbits(flips, bitorder="little").view(np.int64))
            lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, out)], dtype=np.int32), pa.array(np.concatenate([np.zeros(0, np.int64), *out])))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.diff(ends), pa.int32()), lists], names=["id", "n", "k"])

    return run


def _sketches(sets: DataFrame) -> DataFrame:
    """(id, n, k): size of each set and a sketch of at least as many bits. An element flips one bit."""
    return sets.select("id", "s").mapInArrow(_sketcher(), f"id {sets.schema['id'].dataType.simpleString()}, n int, k array<bigint>")


def _open(pairs: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) that their sizes and sketches leave open. The longer of two sketches is folded to the shorter one's length."""
    met = pairs.join(_named(sketches, "b_"), F.col("b") == F.col("b_id")).join(_named(sketches, "a_"), F.col("a") == F.col("a_id"))

    def folded(own: str, other: str) -> Column:
        half = (F.size(own) / 2).cast("int")
        fold = F.zip_with(F.slice(own, 1, half), F.slice(own, half + 1, half), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(own) > F.size(other), fold).otherwise(F.col(own))

    p = F.struct(folded("a_k", "b_k").alias("x"), folded("b_k", "a_k").alias("y"))
    # Sketches further apart say nothing.
    bits = _bind(p, lambda p: F.when(F.size(p["x"]) == F.size(p["y"]), F.aggregate(F.zip_with(p["x"], p["y"], lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, b: n + b)).otherwise(0))
    met = met.filter(F.least("a_n", "b_n") * den >= F.greatest("a_n", "b_n") * num)
    return met.filter(bits * (den + num) <= (F.col("a_n") + F.col("b_n")) * (den - num)).select("a", "b")


def _keyer(num: int, den: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(num, den)
        for batch in batches:
            # Ascending as signed numbers, and with the first bit turned as unsigned ones.
            values, ends = np.asarray(batch.column("s").values).view(np.uint64) ^ np.uint64(1 << 63), np.asarray(batch.column("s").offsets)
            out = []
            for start, end in zip(ends[:-1], ends[1:], strict=True):
                own = values[start:end]
                # The set as a whole: sets so small that only equal ones match have no other key.
                out += [mix(np.bitwise_xor.reduce(mix(own), keepdims=True)), strong_keys(own, bands)]
            counts = np.array([len(k) for k in out], np.int64).reshape(-1, 2).sum(axis=1)
            keys = np.concatenate([np.zeros(0, np.uint64), *out]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column("id").take(pa.array(np.repeat(np.arange(len(counts)), counts)))], names=["key", "id"])

    return run


def _shared_blocks(sets: DataFrame, num: int, den: int) -> DataFrame:
    """(key, id): blocks that at least two sets have. The rows are sent once and without their sets."""
    rows = sets.mapInArrow(_keyer(num, den), f"key bigint, id {sets.schema['id'].dataType.simpleString()}")
    block = Window.partitionBy("key")
    rows = rows.withColumn("lo", F.min("id").over(block)).withColumn("hi", F.max("id").over(block))
    return rows.filter("lo <> hi").select("key", "id")


def _marked(sets: DataFrame) -> DataFrame:
    """(id, n, k0, k1, ..): size and sketch of each set. An element flips one bit of the sketch."""
    columns = [
        F.expr(f"aggregate(s, 0L, (a, x) -> a ^ if((shiftrightunsigned(x, 6) & {SKETCH_WORDS - 1}) = {w}, shiftleft(1L, cast(x & 63 as int)), 0L))").alias(f"k{w}")
        for w in range(SKETCH_WORDS)
    ]
    return sets.select("id", F.size("s").alias("n"), *columns)


def _close(a: str, b: str, num: int, den: int) -> Column:
    """Whether sizes and sketches leave the threshold open: sets differ in at least as many elements as sketches in bits."""
    col = lambda side, name: F.col(f"{side}{name}")
    bits = sum((F.bit_count(col(a, f"k{w}").bitwiseXOR(col(b, f"k{w}"))) for w in range(SKETCH_WORDS)), F.lit(0))
    sizes = F.least(col(a, "n"), col(b, "n")) * den >= F.greatest(col(a, "n"), col(b, "n")) * num
    return sizes & (bits * (den + num) <= (col(a, "n") + col(b, "n")) * (den - num))


def _named(df: DataFrame, side: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{side}{c}") for c in df.columns])


def _tiles(blocks: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): all pairs within a block that are in different clusters and may be similar.

    A block is cut into parts of about ``TILE`` rows, and each two parts meet in a group of their own, so no
    task has more than two parts of a block. What the sketches rule out never leaves the join.
    """
    parts = blocks.groupBy("key").agg(F.ceil(F.count("*") / TILE).cast("int").alias("parts"))
    rows = staged(attach(blocks, parts, ["key"], "inner").withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")), "tiles")
    x = _named(rows.withColumn("other", F.explode(F.sequence(F.col("own"), F.col("parts") - 1))), "x_")
    y = _named(rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("own")))), "y_")
    place = (F.col("x_key") == F.col("y_key")) & (F.col("x_own") == F.col("y_other")) & (F.col("x_other") == F.col("y_own"))
    once = (F.col("x_own") < F.col("y_own")) | (F.col("x_id") < F.col("y_id"))
    met = x.join(y, place & once & (F.col("x_cluster") != F.col("y_cluster")) & _close("x_", "y_", num, den))
    return met.select(F.least("x_id", "y_id").alias("a"), F.greatest("x_id", "y_id").alias("b")).distinct()


def _ends(pairs: DataFrame) -> DataFrame:
    return _saved(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())


def _linked_members(members: DataFrame, sets_of: Callable[[DataFrame], DataFrame], num: int, den: int) -> DataFrame:
    """(id, cluster) of the ids that have a link. Sets are made for those asked for, and written for open pairs only."""
    sketches = _saved(_sketches(sets_of(_saved(members.select("id").distinct()))))
    blocks, found = members.withColumn("cluster", F.col("id")), None

    def settle(pairs: DataFrame) -> tuple[DataFrame, int]:
        near = _saved(_open(_saved(pairs), sketches, num, den))
        scored = _scored(near, _saved(sets_of(_ends(near))))
        links = _saved(scored.filter(F.col("both") * den >= (F.col("na") + F.col("nb") - F.col("both")) * num).select("a", "b"))
        n = links.count()
        if found is not None and n == 0:
            return found, 0
        known = links if found is None else links.union(found.filter("id <> cluster").select("id", "cluster"))
        return _saved(clusters(known)), n

    def placed(rows: DataFrame) -> DataFrame:
        """Rows of the blocks that hold several clusters of now, and the largest of these."""
        if found is not None:
            rows = rows.drop("cluster").join(found, "id", "left").withColumn("cluster", F.coalesce("cluster", "id"))
        counts = rows.groupBy("key", "cluster").agg(F.count("*").alias("n"))
        largest = counts.groupBy("key").agg(F.max(F.struct("n", "cluster"))["cluster"].alias("largest"), F.count("*").alias("parts"))
        return _saved(attach(rows, largest.filter("parts > 1").drop("parts"), ["key"], "inner"))

    while True:
        blocks = placed(blocks)
        open_ids = blocks.select("id").distinct().count()
        if open_ids == 0 and found is not None:
            return found
        outside = blocks.filter("cluster <> largest").drop("largest")
        pivots = _saved(outside.groupBy("key").agg(F.min_by(F.struct(*[c for c in outside.columns if c != "key"]), "id").alias("p")).select("key", "p.*"))
        met = blocks.join(_named(pivots, "p_"), F.col("key") == F.col("p_key")).filter(F.col("cluster") != F.col("p_cluster"))
        met = met.select(F.least("p_id", "id").alias("a"), F.greatest("p_id", "id").alias("b")).distinct()
        found, joined = settle(met)
        blocks = blocks.drop("largest").join(pivots.select("key", "id"), ["key", "id"], "left_anti")
        if joined < STAR_SHARE * open_ids:
            break
    rest = placed(blocks).drop("largest")
    if rest.isEmpty():
        return found
    marks = _saved(_marked(sets_of(_saved(rest.select("id").distinct()))))
    return settle(_tiles(rest.join(marks, "id"), num, den))[0]


def similar_clusters(df: DataFrame, key: str, text: str, num: int = 80, den: int = 100, n: int = 3) -> DataFrame:
    """(id, cluster, similarita) of the texts linked by a similarity of at least ``num`` / ``den``.

    The cluster is the smallest key that links reach; ``similarita`` is the exact similarity to
    that text, which may be below the threshold where others lie between. Keys are distinct;
    NULL texts are left out. Runs jobs: the sets, and some for each round.
    """
    texts = df.filter(F.col(text).isNotNull())
    rows = _saved(texts.select(F.col(key).alias("id"), F.unhex(fingerprint(text)).alias("f")))
    copies = _saved(rows.groupBy("f").agg(F.min("id").alias("one"), F.count("*").alias("n")))

    def sets_of(ids: DataFrame) -> DataFrame:
        """Sets of the texts with these ids, and of few others; texts are picked where they lie and not sent for a join."""
        some = texts.select(F.col(key).alias("id"), F.col(text).alias("t")).filter(F.col("id").isNotNull())
        return some.filter(perhaps(ids, "id")(F.col("id"))).select("id", F.array_sort(shingles("t", n)).alias("s"))

    # Of equal texts the first only; another that gets through is linked with it once more.
    members = _saved(_shared_blocks(sets_of(copies.select(F.col("one").alias("id"))), num, den))
    found = _linked_members(members, sets_of, num, den)
    led = copies.join(found.withColumnRenamed("id", "one"), "one", "left").filter("n > 1 OR cluster IS NOT NULL")
    led = _saved(led.select("f", "one", F.coalesce("cluster", "one").alias("cluster")))
    pairs = _saved(led.filter("one <> cluster").select(F.col("cluster").alias("a"), F.col("one").alias("b")))
    scores = _scored(pairs, _saved(sets_of(_ends(pairs))))
    scores = scores.select(F.col("b").alias("one"), (F.col("both") / (F.col("na") + F.col("nb") - F.col("both"))).alias("similarita"))
    led = _saved(led.join(scores, "one", "left").select("f", "cluster", F.coalesce("similarita", F.lit(1.0)).alias("similarita")))
    return rows.select("id", "f").join(led, "f").select("id", "cluster", "similarita")


def similar_pairs(df: DataFrame, key: str, text: str, num: int = 80, den: int = 100, n: int = 3) -> DataFrame:
    """(a, b, similarita): every clustered text b with the first text of its cluster."""
    found = similar_clusters(df, key, text, num, den, n).filter("id <> cluster")
    return found.select(F.col("cluster").alias("a"), F.col("id").alias("b"), "similarita")


def _shape(edges: DataFrame) -> tuple[int, bool]:
    """Number of distinct edges, and whether each ``u`` has one ``v`` and no ``v`` is a ``u``."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
    ends = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    deep = (F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))
    n, open_ = ends.agg(F.coalesce(F.sum("up"), F.lit(0)), F.count(F.when(deep, 1))).first()
    return n, open_ == 0


def clusters(pairs: DataFrame, a: str = "a", b: str = "b", rows: int | None = None) -> DataFrame:
    """Connected components as (id, cluster), the cluster being its smallest id.

    Alternates two steps that both only need the smallest neighbour of a node: link larger
    neighbours to it, then link smaller-or-equal ones to it. Stops when every node hangs on a
    root, which is where nothing would change. Each round is cut by a written table; few edges
    are written by few tasks (``rows``: so many of them).
    """
    edges = pairs.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    edges = _saved(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), rows)
    while True:
        count, flat = _shape(edges)
        if flat:
            break
        n = 2 * count
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # u's larger neighbours now hang on u's smallest neighbour.
        large = attach(both, low, ["u"], "inner", n).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        large = _saved(large, n)
        low = staged(large.groupBy("u").agg(F.min("v").alias("m")), "low", n)
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = _saved(small.union(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), n)
    members = edges.select(F.col("u").alias("id"), F.col("v").alias("cluster"))
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("cluster")).distinct()
    return members.union(roots)
