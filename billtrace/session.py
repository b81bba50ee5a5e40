"""Session settings the operators count on, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the next step then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows and bytes of a batch that goes to Python.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "32m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Tasks that list folders for a scan; each takes its share of them. The default makes one for every folder, up to 10,000.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
}

ROWS_PER_TASK = 10_000  # of narrow rows, where their number is known


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime options the operators rely on; cluster sizing stays with the caller."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or one below the warehouse where it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def in_few(df: DataFrame, rows: int) -> DataFrame:
    """A frame of at most ``rows`` rows in as many tasks as these need, one for each core at least.

    A task that writes a file costs the same for ten rows as for thousands. Larger frames stay as they are.
    """
    spark = df.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))
    return df.coalesce(parts) if parts < int(spark.conf.get("spark.sql.shuffle.partitions")) else df


def staged(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    For results that are dear to compute and used more than once. The written table also
    survives the loss of executors. ``rows``: it has no more than so many rows.
    """
    path = scratch_path(df.sparkSession, label)
    if rows is not None:
        df = in_few(df, rows)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that this run wrote and nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
