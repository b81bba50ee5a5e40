"""Shards of near-equal bytes from sampled splitters.

The key of a row is (hash of the text, hash of the id): equal texts lie next to each other, and
everything else is spread evenly. A size-weighted sample of keys gives quantile boundaries for
many fine ranges. Their exact bytes are then counted, and a range with more than twice its share
(a large group of equal texts) is subdivided by the second part of the key. Shards are runs of
these cells, so they differ by little more than a cell.

Texts are read once and never shuffled. The driver sees the sample and the cells only; both
follow from ``ranges``, which grows with the rows so that a cell stays small enough for one task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

UNIT = float(1 << 53)
ROWS_PER_RANGE = 1_000_000
SAMPLES_PER_RANGE = 10


def _unit(*columns: Column) -> Column:
    """Hash of columns as an exact double in [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") / UNIT


def splitters(keys: DataFrame, total: int, ranges: int) -> list[float]:
    """Boundaries between ``ranges`` ranges of ``h``, from a sample in which a byte counts as much as any other."""
    wanted = ranges * SAMPLES_PER_RANGE
    chance = F.col("size") * (wanted / total)
    drawn = keys.filter(_unit(F.lit("sample"), "h", "g", "m") < chance).select("h", F.greatest(chance, F.lit(1.0)).alias("w")).toPandas().sort_values("h")
    if drawn.empty:
        return []
    reach = np.cumsum(drawn["w"].to_numpy())
    cuts = np.searchsorted(reach, reach[-1] * np.arange(1, ranges) / ranges)
    return sorted(set(drawn["h"].to_numpy()[cuts].tolist()) - {0.0})


def _in_cells(keys: DataFrame, cuts: list[float], share: float) -> tuple[DataFrame, pd.DataFrame]:
    """Rows with cell numbers (c0, c1, c2), and the bytes and rows of each cell in key order."""
    spark = keys.sparkSession
    if cuts:
        bucket = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="h", outputCol="b")
        rows = bucket.transform(keys).withColumn("c0", F.col("b").cast("int")).drop("b")
    else:
        rows = keys.withColumn("c0", F.lit(0))
    cells = ["c0"]
    for level, by in ((1, "g"), (2, "m")):
        counted = rows.groupBy(*cells).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).toPandas()
        # One over-full cell of one row can't be divided.
        parts = np.where((counted["bytes"] > 2 * share) & (counted["rows"] > 1), np.ceil(counted["bytes"] / share), 1)
        parts = np.minimum(parts, counted["rows"]).astype("int32")
        table = spark.createDataFrame(counted[cells].assign(parts=parts))
        rows = rows.join(F.broadcast(table), cells).withColumn(f"c{level}", F.floor(F.col(by) * F.col("parts")).cast("int")).drop("parts")
        cells = [*cells, f"c{level}"]
    counted = rows.groupBy(*cells).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).toPandas()
    return rows, counted.sort_values(cells).reset_index(drop=True)


def shard_by_bytes(df: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """Each row's shard: id, size, text_crc32, shard, slot (gapless from 0 within a shard).

    ``size`` is the UTF-8 bytes of the text plus 1; a NULL text counts as empty. Rows that repeat id
    and text may lie in different shards. An empty table gives no rows. Other columns are ignored.
    Runs jobs: the keys, the sample, and three counts of cells.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keys = df.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        _unit(text).alias("h"),
        _unit(F.col(id_col).cast("string")).alias("g"),
        _unit(F.monotonically_increasing_id()).alias("m"),  # written once, so it stays as it is
    )
    keys = staged(keys, "keys")
    total, n = keys.agg(F.sum("size"), F.count("*")).first()
    if not n:
        return keys.select("id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    ranges = ranges or max(shards * 256, n // ROWS_PER_RANGE)
    rows, cells = _in_cells(keys, splitters(keys, total, ranges), total / ranges)
    middle = cells["bytes"].cumsum() - cells["bytes"] / 2
    cells["shard"] = np.minimum(middle * shards // total, shards - 1).astype("int32")
    cells["before"] = cells.groupby("shard")["rows"].cumsum() - cells["rows"]
    places = df.sparkSession.createDataFrame(cells[["c0", "c1", "c2", "shard", "before"]])
    within = Window.partitionBy("c0", "c1", "c2").orderBy("h", "g", "id", "m")
    numbered = rows.withColumn("__n", F.row_number().over(within)).join(F.broadcast(places), ["c0", "c1", "c2"])
    return numbered.select("id", "size", "text_crc32", "shard", (F.col("before") + F.col("__n") - 1).cast("long").alias("slot"))


__all__ = ["shard_by_bytes", "splitters"]
