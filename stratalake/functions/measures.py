"""Aggregate expressions shared by the marts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(x: Column | str, places: int) -> Column:
    """Half-up rounding that snaps to six more places first.

    Sums of doubles depend on the order of addition in their last digits; the snap makes half-way cases
    round the same way whichever order the tasks took.
    """
    return F.round(F.round(x, places + 6), places)


def share(cond: Column, places: int = 4) -> Column:
    """Rounded share of rows for which ``cond`` holds; NULL counts as not held (A-3)."""
    return rounded(F.avg(F.when(cond, 1.0).otherwise(0.0)), places)


def error_rate(status: Column, good: str = "ok") -> Column:
    """Share of rows whose status is known and not good (A-4)."""
    return F.avg(F.when(status != good, 1.0).otherwise(0.0))


def held(cond: Column) -> Column:
    """Number of rows for which ``cond`` holds (A-2)."""
    return F.count_if(cond)


def whole_days(as_of: Column, ts: Column) -> Column:
    """Calendar days from ``ts`` to ``as_of`` (O-12)."""
    return F.datediff(as_of, ts)
