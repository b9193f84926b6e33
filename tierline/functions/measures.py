"""Report measures as aggregate expressions.

Each measure is a plain aggregate ``Column``, so reports compose them in one
``agg`` and Spark runs them as partial (map-side) plus final aggregation.
Percentages are computed in double, never decimal.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mean(c: str | Column, digits: int | None = 2) -> Column:
    """Mean of the non-null values, rounded half-up; null when none."""
    m = F.avg(_c(c))
    return F.round(m, digits) if digits is not None else m


def rate_pct(predicate: Column, digits: int | None = 2) -> Column:
    """Share of *all* rows where ``predicate`` holds, in percent.

    The denominator is every row (``COUNT(*)``), including rows where the
    predicate is null; a null predicate is not counted.  Null on no rows.
    """
    hits = F.sum(F.when(predicate, F.lit(1)).otherwise(F.lit(0))).cast("double")
    pct = hits * F.lit(100.0) / F.nullif(F.count(F.lit(1)).cast("double"), F.lit(0.0))
    return F.round(pct, digits) if digits is not None else pct


def total(c: str | Column, digits: int | None = 2) -> Column:
    """Sum with null counted as zero, rounded; null on no rows."""
    s = F.sum(F.coalesce(_c(c), F.lit(0.0)))
    return F.round(s, digits) if digits is not None else s


def row_count() -> Column:
    return F.count(F.lit(1))


def delayed(arrival: str | Column = "ARRIVAL_DELAY", threshold: float = 15) -> Column:
    """A flight is delayed when it arrives strictly more than ``threshold`` minutes late."""
    return _c(arrival) > threshold


def cancelled(flag: str | Column = "CANCELLED") -> Column:
    return _c(flag) == 1
