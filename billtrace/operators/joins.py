"""Looking up a table with one row per key from a table whose keys may be very uneven."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..session import staged


def attach(left: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "left", rows: int | None = None) -> DataFrame:
    """Join ``left`` to ``lookup`` (one row per key), however often ``left`` repeats a key.

    The lookup is written to the shared folder first. Spark then knows its true size: below
    ``spark.sql.autoBroadcastJoinThreshold`` it is broadcast and ``left`` is not shuffled at
    all. Above it both sides are plain shuffles, which adaptive execution can split where
    one key holds most rows; it cannot split a side that is aggregated on the key in the
    same stage. Runs a job for the lookup. ``rows``: the lookup has no more than so many rows.
    """
    return left.join(staged(lookup, "lookup", rows), list(on), how)
