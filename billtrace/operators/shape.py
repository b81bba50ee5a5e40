"""Projection, filling, unions and partition replacement."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.uris import is_blank_node
from .joins import attach


def canonical(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Known columns in the given order, unknown ones after them."""
    known = [c for c in order if c in df.columns]
    return df.select(*known, *[c for c in df.columns if c not in order])


def ensure_columns(df: DataFrame, schema: T.StructType, fill: dict[str, object] | None = None) -> DataFrame:
    """Add the columns of ``schema`` that are missing, as typed NULL or as the value in ``fill``."""
    fill = fill or {}
    missing = {
        f.name: F.lit(fill.get(f.name)).cast(f.dataType) for f in schema if f.name not in df.columns
    }
    return df.withColumns(missing) if missing else df


def zero_filled(df: DataFrame, columns: Sequence[str], to: str = "int") -> DataFrame:
    """NULL to 0, cast to a whole number."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast(to) for c in columns})


def with_constants(df: DataFrame, **values: object) -> DataFrame:
    return df.withColumns({k: v if isinstance(v, Column) else F.lit(v) for k, v in values.items()})


def present(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).isNotNull()


def is_flag(c: Column | str, value: str = "1") -> Column:
    """True for the given text only; NULL gives false."""
    return (F.col(c) if isinstance(c, str) else c).eqNullSafe(F.lit(value))


def tolerant_int(c: Column | str) -> Column:
    """Whole number in a text, NULL for ids such as ``105-B``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(c).try_cast("int")


def key_range(df: DataFrame, key: str, after: str, upto: str) -> DataFrame:
    """Rows with ``after < key <= upto``; the scan gets both bounds."""
    return df.filter((F.col(key) > after) & (F.col(key) <= upto))


def without_blank_keys(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull() & ~is_blank_node(key))


def downloadable(df: DataFrame) -> DataFrame:
    """Bills with a text, in their first phase, that started in the Senate."""
    return df.filter(F.col("has_testo_presentato") & F.col("is_prima_fase") & (F.col("ramo_origine") == "S"))


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by name; a column missing on one side becomes NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def tagged_union(frames: dict[str, DataFrame], tag: str) -> DataFrame:
    """Union by name with a literal telling where each row comes from."""
    return union_all(*[df.withColumn(tag, F.lit(label)) for label, df in frames.items()])


def replace_partitions(existing: DataFrame, new: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of ``new``, and those rows of ``existing`` whose partition does not occur in ``new``.

    The partition values are a small lookup, so ``existing`` is not shuffled by its few
    partition values. Runs a job for them.
    """
    touched = new.select(*by).distinct()
    return attach(existing, touched, by, "left_anti").unionByName(new, allowMissingColumns=True)


def only_partitions(df: DataFrame, parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of the given partitions. Runs a job for the partition values."""
    return attach(df, parts.select(*by).distinct(), by, "left_semi")


def missing_partitions(requested: DataFrame, existing: DataFrame, by: Sequence[str]) -> DataFrame:
    """Partitions asked for and not present."""
    have = existing.select(*by).distinct()
    return requested.select(*by).distinct().join(have, list(by), "left_anti")
