"""Dates kept as text, and day differences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .texts import _col


def parse_yyyymmdd(c: Column | str) -> Column:
    """``20130319`` or ``2013-03-19`` to a date, anything else to NULL.

    Only the first eight digits count, as the raw values may carry a time. A value that
    is no calendar date gives NULL instead of a garbled text.
    """
    raw = F.trim(_col(c).cast("string"))
    compact = F.when(F.rlike(raw, F.lit(r"^\d{8}")), F.substring(raw, 1, 8))
    iso = F.when(F.rlike(raw, F.lit(r"^\d{4}-\d{2}-\d{2}")), F.substring(raw, 1, 10))
    return F.coalesce(
        F.try_to_timestamp(compact, F.lit("yyyyMMdd")), F.try_to_timestamp(iso, F.lit("yyyy-MM-dd"))
    ).cast("date")


def days_between(start: Column | str, end: Column | str, as_of: Column | str) -> Column:
    """Days from start to end, never negative; an open end stops at ``as_of``."""
    as_of = F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of
    return F.greatest(F.lit(0), F.datediff(F.coalesce(_col(end), as_of), _col(start)))
