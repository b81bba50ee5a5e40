"""One or a few rows, or one value, per key, always under a total order.

Row picks filter ``row_number`` to a constant, which lets Spark cut every key down to the
wanted rows in each map task before the shuffle (``WindowGroupLimit``). Value picks are
plain aggregates with partial aggregation. Either way a key that holds a third of all rows
sends a handful of rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANK = "__rank"


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def _ties(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    return [F.col(f"`{f.name}`") for f in df.schema if f.name not in keys and _orderable(f.dataType)]


def sample_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key; rows equal in ``order`` are settled by all other columns."""
    window = Window.partitionBy(*keys).orderBy(*order, *_ties(df, keys))
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) <= n).drop(_RANK)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order``."""
    return sample_per_group(df, keys, order, 1)


def latest_membership(df: DataFrame, person: str, start: str) -> DataFrame:
    """Membership with the greatest start of each person; a missing start counts as oldest."""
    return first_per_key(df, [person], [F.col(start).desc_nulls_last()])


def first_role_wins(df: DataFrame, keys: Sequence[str], is_first: str) -> DataFrame:
    """Someone listed both as first signer and co-signer of an act stays as first signer."""
    others = [f for f in df.schema if f.name not in (*keys, is_first)]
    if len(others) != 1 or not _orderable(others[0].dataType) or df.schema[is_first].dataType != T.BooleanType():
        return first_per_key(df, keys, [F.col(is_first).desc_nulls_last()])
    # With one more column, plain aggregates do, which need no sort where that column is a number or a date.
    flag, other = F.col(is_first), F.col(f"`{others[0].name}`")
    best = F.max(flag)
    picks = []
    for has in (flag, ~flag, flag.isNull()):
        # Of the rows with this flag: NULL comes first, then the smallest.
        picks.append(F.when(~F.max(has & other.isNull()), F.min(F.when(has, other))))
    value = F.when(best, picks[0]).when(~best, picks[1]).otherwise(picks[2])
    return df.groupBy(*keys).agg(best.alias(is_first), value.alias(others[0].name)).select(*[F.col(f"`{c}`") for c in df.columns])


def current_or_last(df: DataFrame, keys: Sequence[str], end: str, position: str) -> DataFrame:
    """The first entry without an end, else the last one listed."""
    is_open = F.col(end).isNull()
    order = [
        is_open.desc(),
        F.when(is_open, F.col(position)).asc_nulls_last(),
        F.col(position).desc(),
    ]
    return first_per_key(df, keys, order)


def first_values(cols: Sequence[str], order: Sequence[str], where: Column | None = None) -> list[Column]:
    """Aggregates giving, for each column, its first value that is not NULL, among rows meeting ``where``."""
    picks = []
    for c in cols:
        wanted = F.col(c).isNotNull() if where is None else F.col(c).isNotNull() & where
        rank = F.when(wanted, F.struct(*[F.col(o) for o in order], F.col(c).alias("__value")))
        picks.append(F.min_by(F.col(c), rank).alias(c))
    return picks


def first_non_null(df: DataFrame, keys: Sequence[str], cols: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First value that is not NULL, column by column: values may come from different rows."""
    return df.groupBy(*keys).agg(*first_values(cols, order))


def _pick(df: DataFrame, keys: Sequence[str], date: str, cols: Sequence[str], fn) -> DataFrame:
    packed = fn(F.struct(F.col(date), *[F.col(c) for c in cols])).alias("__row")
    rows = df.filter(F.col(date).isNotNull()).groupBy(*keys).agg(packed)
    return rows.select(*keys, f"__row.{date}", *[f"__row.{c}" for c in cols])


def earliest(df: DataFrame, keys: Sequence[str], date: str, cols: Sequence[str]) -> DataFrame:
    """Date and columns of the earliest dated row of each key; equal dates are settled by the columns."""
    return _pick(df, keys, date, cols, F.min)


def latest(df: DataFrame, keys: Sequence[str], date: str, cols: Sequence[str]) -> DataFrame:
    """Date and columns of the latest dated row of each key; equal dates are settled by the columns."""
    return _pick(df, keys, date, cols, F.max)


def unique_history(df: DataFrame, key: str, state: str, date: str) -> DataFrame:
    """Each state of an act once, at its first date, sorted by act and date.

    The sort is a range shuffle over (act, date, state), so the states of one act
    may spread over many tasks.
    """
    once = first_per_key(df, [key, state], [F.col(date).asc_nulls_last()])
    return once.orderBy(key, F.col(date).asc_nulls_last(), state)


def multi_phase(df: DataFrame, bill: str, progress: str) -> DataFrame:
    """All phases of the bills that reach a phase above 1."""
    later = df.filter(F.col(progress) > 1).select(bill)
    return df.join(later, bill, "left_semi")


def first_in_document(df: DataFrame, items: str, flag: str, element: str) -> DataFrame:
    """One row for each array element in document order, the first one flagged."""
    others = [c for c in df.columns if c != items]
    rows = df.select(*others, F.posexplode(items).alias("__pos", element))
    return rows.withColumn(flag, F.col("__pos") == 0).withColumnRenamed("__pos", "posizione")
