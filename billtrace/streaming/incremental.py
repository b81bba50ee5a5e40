"""Loads that leave what is already there alone, and the checks on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.coverage import count_if
from ..operators.picks import first_per_key
from ..operators.shape import missing_partitions, union_all


def insert_absent(existing: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """New rows whose key is absent, one for each key; append these."""
    fresh = new.join(existing.select(*keys), list(keys), "left_anti")
    return first_per_key(fresh, keys, order)


def insert_children(existing: DataFrame, new: DataFrame, parent: str) -> DataFrame:
    """All new rows of the parents that have no rows yet; append these."""
    return new.join(existing.select(parent), parent, "left_anti")


def partitions_to_build(requested: DataFrame, existing: DataFrame, by: Sequence[str], force: bool = False) -> DataFrame:
    """Requested partitions that are missing, or all of them when forced."""
    return requested.select(*by).distinct() if force else missing_partitions(requested, existing, by)


def check_integrity(df: DataFrame, critical: Sequence[str], by: Sequence[str], expected: DataFrame | None = None) -> DataFrame:
    """Groups with NULL in a critical column or a row count other than expected.

    ``expected`` has the group columns and ``n_atteso``.
    """
    nulls = [count_if(F.col(c).isNull()).alias(f"n_null_{c}") for c in critical]
    out = df.groupBy(*by).agg(F.count("*").alias("n"), *nulls)
    broken = F.lit(False)
    for c in critical:
        broken = broken | (F.coalesce(f"n_null_{c}", F.lit(0)) > 0)
    if expected is not None:
        out = out.join(expected.select(*by, "n_atteso"), list(by), "outer")
        out = out.withColumn("n", F.coalesce("n", F.lit(0)))
        broken = broken | ~F.col("n").eqNullSafe(F.col("n_atteso"))
    return out.filter(broken)


def run_metrics(df: DataFrame, by: str, flags: dict[str, Column], requested: DataFrame) -> DataFrame:
    """Rows and flagged rows of each requested partition, ``ok`` or ``empty``."""
    aggs = [count_if(cond).alias(f"n_{name}") for name, cond in flags.items()]
    counted = df.groupBy(by).agg(F.count("*").alias("n"), *aggs)
    out = requested.select(by).distinct().join(counted, by, "left").fillna(0, ["n", *[f"n_{name}" for name in flags]])
    return out.withColumn("status", F.when(F.col("n") > 0, "ok").otherwise("empty"))


def table_counts(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows of each table and rows where its key column is present."""
    rows = [
        df.agg(F.lit(name).alias("tabella"), F.count("*").alias("n"), F.count(col).alias("n_presenti"))
        for name, (df, col) in tables.items()
    ]
    return union_all(*rows)
