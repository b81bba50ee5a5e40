"""Set-similarity join of word shingles through parity sketches.

A sketch has K blocks of bits; every shingle flips one bit of one block. Two sketches differ in at
most as many bits as their sets differ in elements. A pair at the threshold differs in at most
``d`` elements, so of K > d blocks at least K - d are equal (pigeonhole). K exceeds d by more than the
empty blocks that a set usually has, so one of the equal ones holds elements, and empty
blocks, in which strangers would meet, needn't be sent. K must be the same on both sides, so sets are
sketched per band of sizes: in their own band, and in each lower band that may hold a smaller partner. A block is sent as a 64-bit code of its bits, never as the bits.

What meets in a block is a candidate only, and every candidate is settled, in two ways. First come
rounds of stars: each block whose members are not yet in one component checks one of them against
those of other components, by longer sketches first and, where these leave it open, by exact intersection. That joins n near copies with about n checks.
When a round joins little, what is left (texts that share blocks but are not similar, say) is
compared in full, but by sketches: tasks take tiles of a block and look for pairs of different
components whose sketches differ in no more bits than allowed; only these are intersected. First
each tile sends a forest of such pairs, fewer than it has rows: most are links, and they join near
copies that the stars left apart. The last pass sends every such pair that is open even then, so
that no link is lost where a pair of a forest was none.

Texts with the same set are one node. A set is spread over K blocks, so no block holds more rows
than there are nodes, a small part of all block rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.parity import MAX_FILTER_BITS, Bands, block_keys, mix, perhaps
from ..operators.similarity import clusters
from .common import chunks, discard, field, map_rows, scratch_path, staged, texts_as_bytes

MAX_KNOWN_WORDS = 300_000
MAX_SEEN = 500_000
SKETCH_BITS = 512  # at least
PAIRS_PER_PART = 500
TILE = 1024
STAR_SHARE = 0.1  # rounds of stars go on while they join this share of what is open
_U = np.uint64


class Shingler:
    """Sets of 64-bit hashes of the runs of ``n`` words; a text of fewer words is one run.

    Words end at blanks, tabs and line ends; A-Z counts as lower case.
    """

    def __init__(self, n: int):
        self.n = n
        self.known: dict[bytes, int] = {}

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        return [own for a, b in chunks(texts) for own in self._some(texts[a:b])]

    def _some(self, texts: list[bytes]) -> list[np.ndarray]:
        known, n = self.known, self.n
        if len(known) > MAX_KNOWN_WORDS:
            known.clear()
        words = [t.lower().split() for t in texts]
        flat = [w for own in words for w in own]
        for w in {*flat}.difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.array([known[w] for w in flat], np.uint64)
        runs = self._runs(h, n)
        out, at = [], 0
        for own in words:
            size = len(own)
            some = self._runs(h[at : at + size], size) if 0 < size < n else runs[at : at + max(0, size - n + 1)]
            out.append(np.unique(some))
            at += size
        return out

    @staticmethod
    def _runs(h: np.ndarray, n: int) -> np.ndarray:
        """A hash of each run of n; the words' places count."""
        total = np.full(max(0, len(h) - n + 1), n, np.uint64)
        for k in range(n):
            total = mix(total * _U(0x9E3779B97F4A7C15) + h[k : k + len(total)])
        return total


def node_of(own: np.ndarray) -> int:
    """Number of a set: 64 bits of a hash of its sorted elements."""
    return xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63)


_MEMBER = T.StructType([T.StructField("key", T.LongType()), T.StructField("node", T.LongType())])


def _documents(df: DataFrame, id_col: str, text_col: str, n: int, num: int, den: int) -> DataFrame:
    """(id, node, n_shingles, sketch, keys) of each row, in one pass over the texts.

    The node is NULL without words. ``keys`` has the codes of all blocks; a task gives those, and the
    sketch, of a set it has met before only once.
    """
    schema = T.StructType([field(df, id_col, "id"), *T._parse_datatype_string("node long, n_shingles long, sketch binary, keys array<long>")])

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        shingler, bands, seen = Shingler(n), Bands(num, den), set()
        for batch in batches:
            if len(seen) > MAX_SEEN:
                seen.clear()
            sets = shingler.sets(texts_as_bytes(batch.column(1)))
            nodes, keys, sketches = [node_of(s) if len(s) else None for s in sets], [], []
            for node, own in zip(nodes, sets, strict=True):
                fresh = node is not None and node not in seen
                seen.add(node)
                keys.append(block_keys(own, bands) if fresh else np.zeros(0, np.uint64))
                sketches.append(_sketch(own) if fresh else None)
            ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            flat = np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)
            yield {"id": batch.column(0), "node": nodes, "n_shingles": [len(s) for s in sets], "sketch": sketches, "keys": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))}

    return map_rows(df.select(id_col, text_col), schema, step)


def _shared(rows: DataFrame) -> DataFrame:
    """Distinct rows of keys that have at least two nodes, by one sorted pass."""

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        held: tuple[int, int, bool] | None = None  # last row, and whether one with its key came before
        for batch in batches:
            key, node = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            if held:
                key, node = np.append(held[0], key), np.append(held[1], node)
            if not len(key):
                continue
            fresh = np.append(True, (np.diff(key) != 0) | (np.diff(node) != 0))
            key, node = key[fresh], node[fresh]
            same = np.diff(key) == 0
            before = np.append(bool(held and held[2]), same)
            after = np.append(same, False)
            take = (before | after)[:-1]
            held = (key[-1], node[-1], bool(before[-1]))
            if take.any():
                yield {"key": key[:-1][take], "node": node[:-1][take]}
        if held and held[2]:
            yield {"key": [held[0]], "node": [held[1]]}

    return map_rows(rows.repartition("key").sortWithinPartitions("key", "node"), _MEMBER, step)


def _sketch(own: np.ndarray) -> bytes:
    """Bit sketch of a set for comparison, a bit or two for each element. Half a sketch is the fold of the whole.

    Two unrelated sets of n elements then differ in about half of n bits, far more than similar ones may.
    """
    bits = SKETCH_BITS
    while bits < len(own):
        bits *= 2
    at = ((own >> _U(8)) & _U(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def _perhaps(ids: DataFrame, id_col: str) -> Callable[[Column], Column]:
    return perhaps(ids, id_col, MAX_FILTER_BITS)


class _Tables:
    """Tables of this run, bucketed by node or by block so that joins and groups on these never shuffle them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.names = spark, []
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(self, rows: DataFrame, label: str) -> str:
        self.names.append(f"{label}_{uuid.uuid4().hex}")
        writer = rows.repartition(self.buckets, "node").dropDuplicates(["node"]).write.bucketBy(self.buckets, "node").sortBy("node")
        writer.option("path", scratch_path(self.spark, label)).saveAsTable(self.names[-1])
        return self.names[-1]

    def blocks(self, rows: DataFrame, label: str, lie_by_key: bool = False) -> DataFrame:
        """Rows of blocks, written and read back.

        Rows are not shuffled for it where Spark knows that they lie by key, or is told (``lie_by_key``, of a Python step).
        """
        self.names.append(f"{label}_{uuid.uuid4().hex}")
        rows = rows if lie_by_key else rows.repartition(self.buckets, "key")
        writer = rows.write.bucketBy(self.buckets, "key")
        writer.option("path", scratch_path(self.spark, label)).saveAsTable(self.names[-1])
        return self.spark.table(self.names[-1])

    def drop(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


class _Sets:
    """(node, n, sketch) of the nodes that share a block, and the sets of those that were asked for.

    Sketches settle most pairs, so few sets are ever needed; each is made once, when a pair first needs it.
    """

    def __init__(self, tables: _Tables, df: DataFrame, nodes: DataFrame, id_col: str, text_col: str, n: int):
        self.tables, self.nodes, self.n = tables, nodes, n
        self.texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        self.sketches = [self.tables.write(nodes.select("node", "n", "sketch"), "sketches")]
        self.sets: list[str] = []

    def need(self, wanted: DataFrame, most: int) -> None:
        """Make the sets of nodes, ``most`` at most, that have none yet.

        Only texts that a filter of the wanted ids lets through are joined with them: the join would send all texts.
        """
        spark, n = self.tables.spark, self.n
        fresh = wanted.distinct()
        for name in self.sets:
            fresh = fresh.join(spark.table(name).select("node"), "node", "left_anti")
        rows = staged(self.nodes.select("id", "node").join(fresh, "node", "left_semi").select(F.col("id").alias("__w"), F.col("node").alias("__node")), "wanted", most)
        if rows.isEmpty():
            return

        @F.arrow_udf(T._parse_datatype_string("node long, s array<long>"))
        def describe(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            shingler, seen = Shingler(n), set()
            for text in batches:
                if len(seen) > MAX_SEEN:
                    seen.clear()
                sets = shingler.sets(texts_as_bytes(text))
                nodes = [node_of(s) if len(s) else None for s in sets]
                for i, node in enumerate(nodes):
                    if node in seen:
                        nodes[i], sets[i] = None, sets[i][:0]
                    seen.add(node)
                offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                values = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                yield pa.StructArray.from_arrays([pa.array(nodes, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], ["node", "s"])

        likely = scratch_path(spark, "likely")
        perhaps = _perhaps(rows, "__w")
        self.texts.filter(perhaps(F.col("id"))).write.parquet(likely)
        few = spark.read.schema(self.texts.schema).parquet(likely)
        # Not deterministic to the optimiser, or it would make the filter below a join key and describe all texts for it.
        texts = few.join(rows, F.col("id").eqNullSafe(F.col("__w"))).select("__node", describe.asNondeterministic()("text").alias("d"))
        # Rows that share an id may have other texts; rows that repeat come once.
        self.sets.append(self.tables.write(texts.filter(F.col("__node") == F.col("d.node")).select("d.*"), "sets"))
        discard(spark, likely)

    def join(self, rows: DataFrame, node: str, *columns: str, prefix: str = "") -> DataFrame:
        """Rows with n and sketch, or the set, of the node in a column."""
        names = self.sets if columns == ("s",) else self.sketches
        parts = [rows.join(self.tables.spark.table(name).select(F.col("node").alias(node), *[F.col(c).alias(f"{prefix}{c}") for c in columns]), node) for name in names]
        return reduce(DataFrame.union, parts)


def _met(pairs: DataFrame, sets: _Sets, most: int, *columns: str) -> DataFrame:
    """Pairs (p, z), ``most`` at most, with columns of both: ``p_n`` and ``z_n``, say.

    What a ``p`` with many pairs brings is sent once for every ``PAIRS_PER_PART`` of them.
    """
    parts = staged(pairs.groupBy("p").agg(F.ceil(F.count("*") / PAIRS_PER_PART).cast("int").alias("parts")), "parts", most)
    salted = pairs.join(parts, "p").withColumn("part", F.pmod(F.xxhash64("z"), F.col("parts")).cast("int")).drop("parts")
    of_z = sets.join(salted, "z", *columns, prefix="z_")
    of_p = sets.join(parts, "p", *columns, prefix="p_").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return of_z.join(of_p.drop("parts"), ["p", "part"])


def _open_pairs(pairs: DataFrame, sets: _Sets, most: int, num: int, den: int) -> DataFrame:
    """The pairs, ``most`` at most, whose sketches leave the threshold open: they differ in no more bits than the sets may in elements."""

    @F.arrow_udf("long")
    def differ(p: pa.Array, z: pa.Array) -> pa.Array:
        out = []
        for both in zip(p.to_pylist(), z.to_pylist(), strict=True):
            a, b = _folded(list(both))
            out.append(int(np.bitwise_count(a ^ b).sum()))
        return pa.array(out, pa.int64())

    bits = differ("p_sketch", "z_sketch") * (den + num)
    return _met(pairs, sets, most, "n", "sketch").filter(bits <= (F.col("p_n") + F.col("z_n")).cast("long") * (den - num)).select("p", "z")


def _linked(pairs: DataFrame, sets: _Sets, num: int, den: int, sketched: bool = False) -> DataFrame:
    """The pairs (p, z) whose exact similarity reaches the threshold, written.

    Sketches decide first, unless they have (``sketched``), so that sets are sent for likely links only.
    """
    pairs = staged(pairs, "pairs")
    if not sketched:
        most = pairs.count()
        pairs = staged(_open_pairs(pairs, sets, most, num, den), "open", most)
    most = pairs.count()
    sets.need(pairs.select(F.explode(F.array("p", "z")).alias("node")), 2 * most)
    if not sets.sets:
        return pairs.limit(0)
    both = F.size(F.array_intersect("p_s", "z_s")).cast("long")
    scored = _met(pairs, sets, most, "s").select("p", "z", F.size("p_s").alias("a"), F.size("z_s").alias("b"), both.alias("i"))
    good = scored.filter(F.col("i") * den >= (F.col("a") + F.col("b") - F.col("i")) * num)
    return staged(good.select("p", "z").distinct(), "links", most)


def _folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of 64-bit words, folded to the shortest."""
    least = min(map(len, sketches))
    out = np.zeros((len(sketches), least // 8), np.uint64)
    for i, sketch in enumerate(sketches):
        out[i] = np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint64).reshape(-1, least // 8), axis=0)
    return out


def _forest(close: np.ndarray, differ: np.ndarray, at: int, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Close pairs of the rows from ``at`` on that join labels, the closest for each; updates the labels."""
    p, z = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in range(len(close)):
        near = np.flatnonzero(close[k] & (label != label[at + k]))
        if len(near):
            near = near[np.argsort(differ[k, near], kind="stable")]
            met, first = np.unique(label[near], return_index=True)
            p.append(np.full(len(met), at + k))
            z.append(near[first])
            label[np.isin(label, met)] = label[at + k]
    return np.concatenate(p), np.concatenate(z)


def _close_pairs(blocks: DataFrame, sets: _Sets, num: int, den: int, forest: bool) -> DataFrame:
    """(p, z): pairs of different components within a block whose sketches leave the threshold open.

    Blocks of more than ``TILE`` rows are cut into parts, and each two parts meet in a task. With
    ``forest`` a task keeps only pairs that connect what its tile's pairs connect.
    """
    sizes = sets.tables.blocks(blocks.groupBy("key").agg(F.ceil(F.count("*") / TILE).cast("int").alias("parts")), "tiles")
    rows = sets.join(blocks.join(sizes, "key"), "node", "n", "sketch")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("key", F.least("own", "other").alias("t1"), F.greatest("own", "other").alias("t2"), "node", "component", "n", "sketch")

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        def solve(group: list[dict]) -> Iterator[dict]:
            node, component, n = (np.array([r[c] for r in group], np.int64) for c in ("node", "component", "n"))
            if (component == component[0]).all():
                return
            words, label = _folded([r["sketch"] for r in group]), component.copy()
            for i in range(0, len(group), 128):
                differ = np.zeros((len(words[i : i + 128]), len(words)), np.int64)
                for w in range(words.shape[1]):
                    differ += np.bitwise_count(words[i : i + 128, w, None] ^ words[None, :, w])
                close = differ * (den + num) <= (n[i : i + 128, None] + n) * (den - num)
                if forest:
                    p, z = _forest(close, differ, i, label)
                    p, z = np.minimum(node[p], node[z]), np.maximum(node[p], node[z])
                else:
                    p, z = np.nonzero(close & (component[i : i + 128, None] != component))
                    p, z = node[i + p], node[z]
                yield {"p": p[p < z], "z": z[p < z]}

        group: list[dict] = []
        for batch in batches:
            for r in batch.to_pylist():
                if group and (r["key"], r["t1"], r["t2"]) != (group[0]["key"], group[0]["t1"], group[0]["t2"]):
                    yield from solve(group)
                    group = []
                group.append(r)
        if group:
            yield from solve(group)

    schema = T.StructType([T.StructField("p", T.LongType()), T.StructField("z", T.LongType())])
    return map_rows(rows.repartition("key", "t1", "t2").sortWithinPartitions("key", "t1", "t2"), schema, step).distinct()


def _open_blocks(placed: DataFrame) -> DataFrame:
    """Rows (key, node, component, largest) of the blocks that hold several components, and their largest one."""
    counts = placed.groupBy("key", "component").agg(F.count("*").alias("n"))
    largest = counts.groupBy("key").agg(F.max(F.struct("n", "component"))["component"].alias("largest"), F.count("*").alias("parts"))
    return placed.join(largest.filter("parts > 1").drop("parts"), "key")


def _resolve(members: DataFrame, sets: _Sets, num: int, den: int) -> DataFrame:
    """(node, component) of the nodes that have a link."""
    blocks, component = members.withColumn("component", F.col("node")), None
    while True:
        blocks = sets.tables.blocks(_open_blocks(blocks), "blocks")
        n = blocks.select("node").distinct().count()
        if n == 0 and component is not None:
            return component
        outside = blocks.filter(F.col("component") != F.col("largest"))
        stars = outside.groupBy("key").agg(F.min("node").alias("p"), F.min_by("component", "node").alias("pc"))
        stars = sets.tables.blocks(stars, "stars")
        met = blocks.join(stars, "key").filter(F.col("component") != F.col("pc"))
        links = _linked(met.select(F.least("p", "node").alias("p"), F.greatest("p", "node").alias("z")).distinct(), sets, num, den)
        joined = links.count()
        component = _joined(component, links)
        # By the key alone, by which both lie; a block has one star at most.
        rest = blocks.join(stars.select("key", "p"), "key", "left").filter(F.col("p").isNull() | (F.col("node") != F.col("p")))
        blocks = _placed(rest, component)
        if joined < STAR_SHARE * n:
            break
    for forest in (True, False):
        blocks = sets.tables.blocks(_open_blocks(blocks).drop("largest"), "blocks")
        if blocks.isEmpty():
            break
        links = _linked(_close_pairs(blocks, sets, num, den, forest), sets, num, den, sketched=True)
        component = _joined(component, links)
        blocks = _placed(blocks, component)
    return component


def _placed(blocks: DataFrame, component: DataFrame) -> DataFrame:
    """Rows of blocks with the components of now."""
    rows = blocks.select("key", "node").join(component, "node", "left")
    return rows.select("key", "node", F.coalesce("component", "node").alias("component"))


def _joined(component: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components after more links; those known so far are links to their smallest node."""
    if component is not None and links.isEmpty():
        return component
    edges = links.select(F.col("p").alias("a"), F.col("z").alias("b"))
    if component is not None:
        edges = edges.union(component.filter("node <> component").select("node", "component"))
    most = edges.count()
    found = clusters(edges, rows=most)
    return staged(found.select(F.col("id").alias("node"), F.col("cluster").alias("component")), "components", 2 * most)


def similarity_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Each row's component: id, n_shingles, component_id (the smallest id that links reach).

    Two texts link when ``den`` * intersection >= ``num`` * union of their shingle sets; equal sets
    always do. NULL and empty texts, and those without words, are linked with nothing: their
    component is their own id. NULL ids take part but are never the smallest; a component of NULL
    ids alone has a NULL id. Repeated rows are returned as often as they come. Elements and sets
    are told apart by 64-bit hashes. Runs jobs: one for the sets, one for the blocks, then rounds.
    """
    keyed = scratch_path(df.sparkSession, "keyed")
    described = _documents(df, id_col, text_col, n, num, den)
    described.write.parquet(keyed)
    described = df.sparkSession.read.schema(described.schema).parquet(keyed)
    documents = staged(described.select("id", "node", "n_shingles"), "documents")
    nodes = described.filter(F.col("node").isNotNull()).groupBy("node").agg(F.min("id").alias("id"), F.max("n_shingles").cast("int").alias("n"), F.max("sketch").alias("sketch"))
    nodes = staged(nodes, "nodes")
    tables = _Tables(df.sparkSession)
    try:
        members = tables.blocks(_shared(described.select(F.explode("keys").alias("key"), "node")), "members", lie_by_key=True)
        discard(df.sparkSession, keyed)
        sets = _Sets(tables, df, nodes.join(members.select("node").distinct(), "node", "left_semi"), id_col, text_col, n)
        component = _resolve(members, sets, num, den)
    finally:
        tables.drop()
    known = nodes.join(component, "node", "left").select("node", "id", F.coalesce("component", "node").alias("component"))
    smallest = known.groupBy("component").agg(F.min("id").alias("component_id"))
    ids = staged(known.join(smallest, "component").select("node", "component_id"), "component_ids")
    out = documents.join(ids, "node", "left")
    return out.select("id", "n_shingles", F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


__all__ = ["Bands", "Shingler", "block_keys", "similarity_components"]
