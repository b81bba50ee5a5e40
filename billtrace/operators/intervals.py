"""Joins against validity intervals, closed at both ends, where a missing end means still valid.

Both joins work on the distinct (key, date) pairs of the left side and cut the intervals at
month borders, so the equi-join is on (key, month). A key that holds a third of the rows
thus has at most 31 probes in each of its months, and its months go to different tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import NO_GROUP
from ..session import staged
from .joins import attach
from .picks import first_per_key

_MONTH = "__month"


def _month(c: Column) -> Column:
    return F.trunc(c.cast("date"), "month")


def _by_month(ranges: DataFrame, left: DataFrame, at: str, start: str, end: str) -> DataFrame:
    """One row for each month of an interval, within the months the left side has dates in."""
    bounds = left.agg(F.struct(_month(F.min(at)).alias("lo"), _month(F.max(at)).alias("hi"))).scalar()
    lo = F.greatest(_month(F.col(start)), bounds["lo"])
    hi = F.least(F.coalesce(_month(F.col(end)), bounds["hi"]), bounds["hi"])
    months = F.when(lo <= hi, F.sequence(lo, hi, F.expr("interval 1 month")))
    return ranges.filter(F.col(start).isNotNull()).withColumn(_MONTH, F.explode(months))


def _matches(
    left: DataFrame, ranges: DataFrame, key: Sequence[str], at: str, start: str, end: str
) -> DataFrame:
    """Pairs of a distinct (key, date) of the left side and an interval that holds the date."""
    probes = left.select(*key, at).na.drop().distinct().withColumn(_MONTH, _month(F.col(at)))
    cut = _by_month(ranges, left, at, start, end)
    inside = (F.col(start) <= F.col(at)) & (F.col(end).isNull() | (F.col(end) >= F.col(at)))
    return probes.join(cut, [*key, _MONTH]).filter(inside).drop(_MONTH)


def valid_at(
    left: DataFrame, ranges: DataFrame, key: str | Sequence[str], at: str, start: str, end: str
) -> DataFrame:
    """Every left row with every interval of its key that holds its date (inner join)."""
    key = [key] if isinstance(key, str) else list(key)
    return left.join(_matches(left, ranges, key, at, start, end), [*key, at])


def asof_interval(
    left: DataFrame,
    intervals: DataFrame,
    key: str,
    at: str,
    start: str,
    end: str,
    order: Sequence[Column],
    value: str,
    default: str | None = NO_GROUP,
    people: DataFrame | None = None,
) -> DataFrame:
    """Left rows plus ``value`` of the first interval, in ``order``, that holds the date.

    Known keys without a match, or rows without a date, get ``default``; keys that occur
    neither in ``people`` nor in ``intervals`` get NULL. One row comes out for each row
    that goes in. Runs a job for the (key, date) lookup.
    """
    known = intervals.select(key) if people is None else intervals.select(key).union(people.select(key))
    dated = intervals.filter(F.col(key).isNotNull() & F.col(start).isNotNull())
    ranges = first_per_key(dated, [key, start, end], order)
    found = _matches(left, ranges, [key], at, start, end)
    best = first_per_key(found, [key, at], order).select(key, at, value, F.lit(True).alias("__hit"))
    lookup = (
        left.select(key, at)
        .distinct()
        .join(known.distinct(), key, "left_semi")
        .join(best, [key, at], "left")
        .select(
            F.col(key).alias("__key"),
            F.col(at).alias("__at"),
            F.when(F.col("__hit"), F.col(value)).otherwise(F.lit(default)).alias(value),
        )
    )
    same = (F.col(key) == F.col("__key")) & F.col(at).eqNullSafe(F.col("__at"))
    return left.join(staged(lookup, "asof"), same, "left").drop("__key", "__at")


def coalition_side(
    left: DataFrame, majorities: DataFrame, group: str, at: str, side: str = "schieramento"
) -> DataFrame:
    """Majority or opposition of a group on a date.

    ``majorities`` has one row per (group, government) with ``inizio`` and ``fine``. Rows
    without a group or a date get NULL.
    """
    ranges = majorities.select(group, "inizio", "fine").distinct()
    hits = _matches(left, ranges, [group], at, "inizio", "fine")
    in_majority = hits.select(group, at).distinct().withColumn("__in", F.lit(True))
    known = F.col(group).isNotNull() & F.col(at).isNotNull()
    return attach(left, in_majority, [group, at]).select(
        *left.columns,
        F.when(F.col("__in"), "maggioranza").when(known, "opposizione").alias(side),
    )
