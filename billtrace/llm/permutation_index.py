"""Nearest neighbours by inner product through a permutation index.

A vector is represented by the pivots in order of nearness. Index rows lie in blocks of bounded
size; within a block every row is posted in the inverted files of its first pivots. A query looks
into the files of its own first pivots only, ranks what it meets there by footrule distance (the sum
over pivots of how far apart the two orders place them), and the best part of the block is ranked
again by exact inner products. Pivots are a bounded sample of the rows; every row is indexed.

An inner product is no distance, so index vectors get one more component that gives them all the
norm of the longest, and queries a zero there: nearest is then largest product.

Equal vectors are one index row that carries their smallest ids, so no crowd of copies is ever
compared pair by pair, and none pushes another vector out of the ranking.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..operators.joins import attach
from .common import staged
from .vector_codes import same_length

PIVOTS = 128
# A row is posted with its first pivots, a query reads the files of its first pivots.
POSTED, PROBED = 16, 14
# Part of a block that is ranked again by exact products, and the least number of rows.
RERANKED, RERANKED_LEAST = 0.3, 400
BLOCK_ROWS, BLOCK_QUERIES = 16_384, 16_384
LAST = (1 << 63) - 1


def places(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Place of every pivot in each vector's order of nearness; equally near ones by number."""
    order = np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")
    at = np.empty_like(order)
    np.put_along_axis(at, order, np.arange(order.shape[1])[None], 1)
    return at.astype("int16")


def lifted(vectors: np.ndarray, norm: float) -> np.ndarray:
    """Vectors with the component that gives them this norm."""
    rest = np.maximum(norm**2 - np.square(vectors).sum(axis=1), 0)
    return np.column_stack([vectors, np.sqrt(rest)])


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of rows, added up from the first component to the last."""
    out = np.zeros(np.broadcast_shapes(queries.shape[:-1], vectors.shape[:-1]))
    for j in range(vectors.shape[-1]):
        out += queries[..., j] * vectors[..., j]
    return out


class Block:
    """The index of one block: orders of pivots, and for each pivot the rows posted there."""

    def __init__(self, vectors: np.ndarray, pivots: np.ndarray, norm: float):
        self.vectors = vectors
        at = places(lifted(vectors, norm), pivots)
        self.places = np.ascontiguousarray(at.T)
        self.posted = [np.flatnonzero(row < POSTED) for row in self.places]

    def search(self, query: np.ndarray, query_places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows ranked best by footrule distance among those met in the query's files, with their exact products."""
        met = np.zeros(len(self.vectors), bool)
        for p in np.flatnonzero(query_places < PROBED):
            met[self.posted[p]] = True
        rows = np.flatnonzero(met)
        wanted = max(RERANKED_LEAST, int(RERANKED * len(self.vectors)))
        if len(rows) > wanted:
            footrule = np.zeros(len(self.vectors), "int32")
            for at, place in zip(self.places, query_places, strict=True):
                footrule += np.abs(at - place)
            near = footrule[rows]
            rows = rows[near <= np.partition(near, wanted - 1)[wanted - 1]]
        return rows, self.vectors[rows] @ query


def _numbers(column: pa.ChunkedArray, n: int) -> np.ndarray:
    flat = column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).astype("float64").reshape(n, -1)


def _search_block(pivots: np.ndarray, norm: float, k: int, schema: pa.Schema, ties: float = 1e-9):
    def run(table: pa.Table) -> pa.Table:
        is_query = table.column("query_no").is_valid().to_numpy()
        rows, asked = table.filter(pa.array(~is_query)), table.filter(pa.array(is_query))
        found: dict[str, list[np.ndarray]] = {name: [np.empty(0, f.type.to_pandas_dtype())] for name, f in zip(schema.names, schema, strict=True)}
        if rows.num_rows and asked.num_rows:
            block = Block(_numbers(rows.column("v"), rows.num_rows), pivots, norm)
            ids = rows.column("ids").to_pylist()
            queries = _numbers(asked.column("v"), asked.num_rows)
            at = places(np.column_stack([queries, np.zeros(len(queries))]), pivots)
            for number, query, query_places in zip(asked.column("query_no").to_pylist(), queries, at, strict=True):
                near, score = block.search(query, query_places)
                if len(near) > k:
                    least = np.partition(score, len(score) - k)[len(score) - k]
                    near = near[score >= least - ties * max(1.0, abs(least))]
                score = products(query, block.vectors[near])
                names = [ids[i] for i in near]
                score, each = np.repeat(score, [len(x) for x in names]), np.array([i for x in names for i in x], "int64")
                best = np.lexsort((each, -score))[:k]
                found["query_no"].append(np.full(len(best), number))
                found["id"].append(each[best])
                found["score"].append(score[best])
        return pa.table([pa.array(np.concatenate(found[f.name]), f.type) for f in schema], schema=schema)

    return run


def _parts(rows: int, size: int) -> int:
    return max(1, -(-rows // size))


def nearest(df: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", pivots: int = PIVOTS) -> DataFrame:
    """The ``k`` nearest found of each row whose id is divisible by ``every``: query_id, rank, id, score.

    Candidates are all rows but the query's own. Vectors that are NULL, zero or hold a NULL or
    non-finite component take no part, and so do those of another length than most. A row
    without an id is a candidate that ranks behind others of equal score, and no query. Rows that
    repeat an id are rows of their own: each such query is answered, without itself only. An empty
    table or one without queries gives no rows. Ids are integers. Other columns are ignored. Runs jobs:
    lengths, distinct vectors, their counts and norms, pivots.
    """
    spark = df.sparkSession
    kept, size = same_length(df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")), "id", "v")
    kept = kept.filter(F.exists("v", lambda x: x != 0)).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))  # no negative zeros
    asks = F.col("id") % every == 0

    ordered = kept.withColumn("id", F.coalesce("id", F.lit(LAST)))
    first = ordered.withColumn("__n", F.row_number().over(Window.partitionBy("v").orderBy("id"))).filter(F.col("__n") <= k + 1)
    index = staged(first.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")), "vectors")
    # Numbered once and written, so the numbers stay as they are.
    queries = staged(kept.filter(asks).select("v").distinct().withColumn("query_no", F.monotonically_increasing_id()), "queries")

    n, norm = index.agg(F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()
    n_queries = queries.count()
    out = T._parse_datatype_string("query_id long, rank int, id long, score double")
    if not n or not n_queries:
        return spark.createDataFrame([], out)
    drawn = index.select("v", F.xxhash64(F.lit("pivot"), "v").alias("h")).orderBy("h", "v").limit(min(pivots, n)).collect()
    pivot = lifted(np.array([r["v"] for r in drawn], "float64").reshape(len(drawn), size), norm**0.5)

    blocks = _parts(n, BLOCK_ROWS)
    # Enough groups for all cores; a query's result doesn't depend on who shares its group.
    spread = max(1, min(spark.sparkContext.defaultParallelism // blocks, n_queries // 256))
    query_blocks = max(_parts(n_queries, BLOCK_QUERIES), spread)
    numbers = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    met = index.select(F.pmod(F.xxhash64("v"), F.lit(blocks)).cast("int").alias("block"), numbers(query_blocks).alias("query_block"), F.lit(None).cast("long").alias("query_no"), "v", "ids").unionByName(
        queries.select(numbers(blocks).alias("block"), F.pmod(F.xxhash64("query_no"), F.lit(query_blocks)).cast("int").alias("query_block"), "query_no", "v", F.lit(None).cast("array<long>").alias("ids"))
    )
    schema = T._parse_datatype_string("query_no long, id long, score double")
    found = met.groupBy("block", "query_block").applyInArrow(_search_block(pivot, norm**0.5, k + 1, to_arrow_schema(schema)), schema)

    best = Window.partitionBy("query_no").orderBy(F.desc("score"), "id")
    top = found.withColumn("__n", F.row_number().over(best)).filter(F.col("__n") <= k + 1)
    lists = top.groupBy("query_no").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("away"), "id"))).alias("found"))
    answers = queries.join(lists, "query_no").select("v", "found")
    asked = attach(kept.filter(asks), answers, ["v"], "inner")
    own = F.array_position(F.transform("found", lambda f: f["id"]), F.col("id"))  # 0 where the own row is not among them
    others = F.slice(F.filter("found", lambda f, i: i + 1 != own), 1, k)
    ranked = asked.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "f"))
    return ranked.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.nullif("f.id", F.lit(LAST)).alias("id"), (-F.col("f.away")).alias("score"))


__all__ = ["Block", "lifted", "nearest", "places", "products"]
