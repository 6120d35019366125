"""Numeric normalisation shared by every reported figure."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_stable(col: Column, places: int = 4) -> Column:
    """HALF_UP rounding that does not depend on the summation order of a distributed sum.

    Doubles are first rounded to 9 places, which absorbs the last-bit differences that
    different partial-aggregation orders produce, then to ``places``.
    """
    return F.round(F.round(col, 9), places)


def to_decimal2(col: Column, precision: int) -> Column:
    """Stored 2-place decimal (HALF_UP) of a double, order-stable as above."""
    return F.round(col, 9).cast(f"decimal({precision},2)")


def percentage(part: Column, whole: Column, places: int = 2) -> Column:
    """P10: ``round(part / whole * 100, places)``, 0.0 when ``whole`` is not positive."""
    return F.when(whole > 0, round_stable(part.cast("double") / whole * 100, places)).otherwise(F.lit(0.0))


def seconds_between(start: Column, end: Column) -> Column:
    """Duration in seconds, NULL when either end is missing."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)
