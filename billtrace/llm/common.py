"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..arrow import map_rows, release_memory
from ..session import scratch_path, staged, tune

# Rows per Arrow batch: with texts of a few kB a batch is a few MB, with the longest ones some 100 MB.
BATCH_ROWS = "1000"


def ready(spark: SparkSession) -> SparkSession:
    """The session with the settings the operators count on."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def texts_as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; NULL counts as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def chunks(texts: list[bytes], size: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Runs (start, end) of texts of at most ``size`` bytes together, or of one longer text; bounds what a step holds at a time."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if i > start and held + len(text) > size:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table that this run wrote and nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def field(df: DataFrame, name: str, as_name: str | None = None) -> T.StructField:
    return T.StructField(as_name or name, df.schema[name].dataType)


def sample_per_class(df: DataFrame, label: str, key: str, per_class: int) -> DataFrame:
    """About ``per_class`` rows of each class (all, where it has fewer), chosen by a hash of the key.

    Classes are counted first; then each row decides for itself, so nothing is shuffled and the
    same rows are chosen every time. The number of classes must be small.
    """
    counts = df.groupBy(label).count().collect()
    unit = F.shiftrightunsigned(F.xxhash64(F.lit("sample"), F.col(key)), 11).cast("double") / float(1 << 53)
    chosen = F.lit(False)
    for value, n in counts:
        chosen = chosen | ((F.col(label) == F.lit(value)) & (unit < per_class / n))
    return df.filter(chosen)


__all__ = ["chunks", "discard", "field", "map_rows", "ready", "release_memory", "sample_per_class", "scratch_path", "staged", "texts_as_bytes"]
