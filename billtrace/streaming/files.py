"""A corpus folder as a stream: every file is parsed once, in bounded batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def stream_new_files(
    spark: SparkSession,
    root: str,
    parser: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    glob: str = "*",
    max_files: int = 500,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Parse the files that the checkpoint has not seen, then stop.

    The checkpoint keeps the list of files, and the sink commits whole batches: after a
    failure the job goes on where it stopped and no file comes out twice. Malformed files
    become rows with ``error``.
    """
    files = (
        spark.readStream.schema(FILE_SCHEMA)
        .format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .load(root)
    )
    return (
        parser(files)
        .writeStream.format(fmt)
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def to_reparse(outputs: DataFrame, sources: DataFrame, key: str, min_bytes: int = 200) -> DataFrame:
    """Source files without an output, or whose output is smaller than ``min_bytes``."""
    whole = outputs.filter(f"length >= {int(min_bytes)}").select(key).distinct()
    return sources.join(whole, key, "left_anti")
