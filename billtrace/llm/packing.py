"""Packing of tokenised documents into sequences by a grouping genetic algorithm.

A document's ids are cut only where it is longer than a sequence. Pieces that fill a sequence are
done; the others are dealt by hash to problems of about ``per_problem`` pieces. A chromosome is a
list of sequences (groups of pieces). Crossover injects well-filled sequences of one parent into
the other, removes the sequences that hold the same pieces, and places what that displaces by best
fit. Each problem evolves on several islands, which are rows of a DataFrame; between epochs the
best chromosome of each island moves to the next one by a join.

What a problem leaves in poorly filled sequences goes on to the next level, together with that of
all other problems, until one problem is left. So the waste doesn't grow with the number of
problems, and no task ever holds more than one problem's pieces.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import field, map_rows, staged
from .tokens import Encoder

CAPACITY = 2048
PER_PROBLEM = 4096
ISLANDS, EPOCHS, GENERATIONS, POPULATION = 2, 3, 8, 4
GOOD_FILL = 0.998  # sequences at least so full stay as they are at a level

Groups = list[list[int]]


def best_fit(groups: Groups, fill: list[int], sizes: list[int], items: Iterable[int], capacity: int) -> None:
    """Place items one by one where the least room remains, in a new group where none has room."""
    room = sorted((capacity - f, g) for g, f in enumerate(fill) if f < capacity)
    for i in items:
        size = sizes[i]
        at = bisect_left(room, (size, -1))
        if at < len(room):
            left, g = room.pop(at)
            groups[g].append(i)
            fill[g] += size
        else:
            left, g = capacity, len(groups)
            groups.append([i])
            fill.append(size)
        if left > size:
            insort(room, (left - size, g))


def _fills(groups: Groups, sizes: list[int]) -> list[int]:
    return [sum([sizes[i] for i in g]) for g in groups]


def worth(groups: Groups, sizes: list[int]) -> tuple[int, int]:
    """Fewer groups are better, then uneven fill: it leaves room that is of use."""
    return -len(groups), sum(f * f for f in _fills(groups, sizes))


def _place(kept: Groups, displaced: list[int], sizes: list[int], capacity: int) -> Groups:
    groups = [list(g) for g in kept]
    best_fit(groups, _fills(groups, sizes), sizes, sorted(displaced, key=lambda i: (-sizes[i], i)), capacity)
    return groups


def crossover(into: Groups, giver: Groups, sizes: list[int], capacity: int, g: random.Random) -> Groups:
    """Inject whole well-filled groups of ``giver``; drop the groups they overlap; best-fit the rest."""
    order = sorted(range(len(giver)), key=_fills(giver, sizes).__getitem__, reverse=True)
    share = g.uniform(0.2, 0.9)
    gift = [giver[k] for k in order[: max(1, len(order) // 2)] if g.random() < share]
    taken = {i for group in gift for i in group}
    kept = [group for group in into if taken.isdisjoint(group)]
    displaced = [i for group in into if not taken.isdisjoint(group) for i in group if i not in taken]
    return _place(gift + kept, displaced, sizes, capacity)


def mutate(groups: Groups, sizes: list[int], capacity: int, g: random.Random) -> Groups:
    """Dissolve the least filled groups and some others, and best-fit their pieces."""
    order = sorted(range(len(groups)), key=_fills(groups, sizes).__getitem__)
    drop = {*order[: max(1, len(groups) // 50)], *g.sample(range(len(groups)), max(1, len(groups) // 50))}
    kept = [group for k, group in enumerate(groups) if k not in drop]
    return _place(kept, [i for k in drop for i in groups[k]], sizes, capacity)


def _start(sizes: list[int], capacity: int, g: random.Random | None) -> Groups:
    """Best-fit decreasing, with the order blurred where ``g`` is given."""
    blur = (lambda i: sizes[i] * g.uniform(0.85, 1.15)) if g else (lambda i: sizes[i])
    groups: Groups = []
    best_fit(groups, [], sizes, sorted(range(len(sizes)), key=lambda i: (-blur(i), i)), capacity)
    return groups


def evolve(sizes: list[int], population: list[Groups], capacity: int, g: random.Random, generations: int = GENERATIONS, size: int = POPULATION) -> list[Groups]:
    """The population after some generations, the best chromosome first."""
    while len(population) < size:
        population.append(_start(sizes, capacity, g if population else None))
    ranked = sorted(((worth(p, sizes), k, p) for k, p in enumerate(population)), reverse=True)
    least, serial = -(-sum(sizes) // capacity), len(ranked)
    for _ in range(generations):
        if -ranked[0][0][0] <= least:
            break
        one, other = g.sample(range(len(ranked)), 2)
        child = crossover(ranked[min(one, other)][2], ranked[max(one, other)][2], sizes, capacity, g)
        if g.random() < 0.5:
            child = mutate(child, sizes, capacity, g)
        serial += 1
        ranked = sorted([*ranked, (worth(child, sizes), serial, child)], reverse=True)[:size]
    return [p for _, _, p in ranked]


def _labels(groups: Groups, n: int) -> list[int]:
    out = [0] * n
    for k, group in enumerate(groups):
        for i in group:
            out[i] = k
    return out


def _groups(labels: list[int]) -> Groups:
    out: Groups = [[] for _ in range(max(labels, default=-1) + 1)]
    for i, k in enumerate(labels):
        out[k].append(i)
    return [g for g in out if g]


def pieces(df: DataFrame, tokenizer_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The pieces of each document: id, piece, start, length, ids_crc32.

    A document's ids end with id 0, so that NULL and empty texts have one id. Those longer than
    ``capacity`` are cut into pieces of that length, of which the first may be shorter.
    """
    named = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    numbers = {"piece": T.IntegerType(), "start": T.LongType(), "length": T.LongType(), "ids_crc32": T.LongType()}
    schema = T.StructType([field(named, "id"), *[T.StructField(n, t) for n, t in numbers.items()]])

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        encoder = Encoder(tokenizer_path, pattern)
        for batch in batches:
            out = {name: [] for name in schema.names}
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.append(encoder.encode(text or ""), np.uint32(0)).astype("<u4")
                edges = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    for name, value in zip(schema.names, (key, k, a, b - a, zlib.crc32(ids[a:b].tobytes())), strict=True):
                        out[name].append(value)
            yield out

    return map_rows(named, schema, step)


_STATE = T.StructType(
    [
        T.StructField("problem", T.LongType()),
        T.StructField("island", T.IntegerType()),
        T.StructField("numbers", T.ArrayType(T.LongType())),
        T.StructField("sizes", T.ArrayType(T.IntegerType())),
        T.StructField("population", T.ArrayType(T.ArrayType(T.IntegerType()))),
    ]
)


def _epoch(state: DataFrame, capacity: int, epoch: int) -> DataFrame:
    """Every island's population after another epoch; a guest from the neighbour joins it first."""

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                g = random.Random(f"{row['problem']}/{row['island']}/{epoch}")
                start = [_groups(p) for p in [*row["population"], *([row["guest"]] if row["guest"] else [])]]
                grown = evolve(row["sizes"], start, capacity, g)
                yield {f.name: [row[f.name]] for f in _STATE} | {"population": [[_labels(p, len(row["sizes"])) for p in grown]]}

    return staged(map_rows(state, _STATE, step), "islands")


def _solve(items: DataFrame, capacity: int, problems: int, islands: int, epochs: int) -> DataFrame:
    """(problem, numbers, sizes, labels): the best chromosome of each problem."""
    dealt = items.withColumn("problem", F.pmod(F.xxhash64("number"), F.lit(problems)))
    # Bounded: a problem gets its share of evenly hashed pieces.
    own = F.array_sort(F.collect_list(F.struct("length", "number")))
    state = dealt.groupBy("problem").agg(own.alias("own")).select("problem", F.explode(F.array(*[F.lit(i) for i in range(islands)])).alias("island"), F.expr("own.number").alias("numbers"), F.expr("own.length").cast("array<int>").alias("sizes"))
    state = state.withColumn("population", F.array().cast("array<array<int>>")).repartition("problem", "island")
    state = _epoch(state.withColumn("guest", F.lit(None).cast("array<int>")), capacity, 0)
    for epoch in range(1, epochs):
        guests = state.select("problem", ((F.col("island") + 1) % islands).cast("int").alias("island"), F.col("population")[0].alias("guest"))
        state = _epoch(state.join(guests, ["problem", "island"], "left"), capacity, epoch)
    used = F.array_max(F.col("population")[0])
    return state.groupBy("problem").agg(F.min_by(F.struct("numbers", "sizes", F.col("population")[0].alias("labels")), F.struct(used, "island")).alias("s")).select("problem", "s.*")


_PLACED = T.StructType([T.StructField("number", T.LongType()), T.StructField("length", T.LongType()), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])


def _placed(solved: DataFrame, capacity: int, level: int, last: bool) -> DataFrame:
    """Places of all pieces; the sequence is NULL for those that go on to the next level."""

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                out = {name: [] for name in _PLACED.names}
                for k, group in enumerate(_groups(row["labels"])):
                    stays = last or sum(row["sizes"][i] for i in group) >= GOOD_FILL * capacity
                    at = 0
                    for i in group:
                        values = (row["numbers"][i], row["sizes"][i], (level << 50) + (row["problem"] << 16) + k if stays else None, at)
                        for name, value in zip(_PLACED.names, values, strict=True):
                            out[name].append(value)
                        at += row["sizes"][i]
                yield out

    return staged(map_rows(solved, _PLACED, step), "placed")


def pack(parts: DataFrame, capacity: int = CAPACITY, per_problem: int = PER_PROBLEM, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """``parts`` (rows with a ``length`` of 1 to ``capacity``) with sequence_id and offset.

    Offsets are gapless from 0 in each sequence. An empty table stays empty. Runs jobs: one for the
    pieces, then for each level one per epoch and one for the places; levels grow with the
    logarithm of the rows.
    """
    if per_problem > 30_000:
        raise ValueError("a problem's sequences are numbered within 16 bits")
    parts = staged(parts.withColumn("number", F.monotonically_increasing_id()), "pieces")
    full = parts.filter(F.col("length") >= capacity).withColumns({"sequence_id": -F.col("number") - 1, "offset": F.lit(0).cast("long")}).drop("number")
    items, level, places = parts.filter(F.col("length") < capacity).select("number", "length"), 1, None
    while True:
        n = items.count()
        problems = max(1, -(-n // per_problem))
        placed = _placed(_solve(items, capacity, problems, islands, epochs), capacity, level, last=problems == 1)
        stay = placed.filter(F.col("sequence_id").isNotNull()).select("number", "sequence_id", "offset")
        places = stay if places is None else places.union(stay)
        if problems == 1:
            break
        items, level = placed.filter(F.col("sequence_id").isNull()).select("number", "length"), level + 1
        if level > 12:  # levels shrink at least by the share of good sequences; then the rest is one problem after the other
            places = places.union(_placed(_solve(items, capacity, max(1, -(-items.count() // per_problem)), islands, epochs), capacity, level, last=True).select("number", "sequence_id", "offset"))
            break
    return full.unionByName(parts.filter(F.col("length") < capacity).join(places, "number").drop("number"))
