"""Sinks: files with a fixed column order, and the six typed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TABLES


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    columns: Sequence[str] | None = None,
    mode: str = "overwrite",
) -> None:
    """Write parquet, CSV with header, or line JSON.

    With ``partition_by`` only the partitions present in ``df`` are replaced. Rows are not
    moved to one task per partition value, so a value holding most rows still is written
    by many tasks.
    """
    if columns is not None:
        df = df.select(*columns)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.format(fmt).save(path)


def _create_database(spark: SparkSession, database: str, location: str | None) -> None:
    where = "" if location is None else f" LOCATION '{location}'"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")


def create_tables(spark: SparkSession, database: str, tables=TABLES, location: str | None = None) -> None:
    """The typed tables, where they do not exist yet."""
    _create_database(spark, database, location)
    for name, schema in tables.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet")


def rebuild_tables(
    spark: SparkSession, database: str, frames: dict[str, DataFrame], location: str | None = None
) -> DataFrame:
    """Write every frame as a table from scratch, never appending; returns the rows of each."""
    _create_database(spark, database, location)
    counts = []
    for name, df in frames.items():
        table = f"{database}.{name}"
        df.write.mode("overwrite").format("parquet").saveAsTable(table)
        counts.append(spark.table(table).agg(F.lit(name).alias("tabella"), F.count("*").alias("n")))
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
