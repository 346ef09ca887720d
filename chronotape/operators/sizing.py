"""Broadcast only what has been counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 500_000


def broadcast_if_small(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, *, sized_by: DataFrame | None = None
) -> DataFrame:
    """Hint a broadcast after counting the rows; a larger table is left to a shuffle.

    Meant for reference tables with a few fixed-width columns. The unhinted plan is the exact
    alternative: a sort-merge join whose hot keys adaptive execution splits. ``sized_by`` may be a
    table known to have at least as many rows that is cheaper to count.
    """
    counted = df if sized_by is None else sized_by
    small = counted.count() <= max_rows
    return F.broadcast(df) if small else df
