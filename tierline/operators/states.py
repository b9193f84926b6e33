"""Mergeable delay states: what every report is finished from.

A state is a sum or a count, so states of parts add up to the states of the whole.  They come either
from the rows of the fact or from a rollup that already holds them by date, airline and origin; a report
does not see which.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import measures as M

#: Columns of a rollup next to its keys.
STATE_COLUMNS = (
    "ROW_COUNT",
    "LATE_COUNT",
    "CANCELLED_COUNT",
    "ARRIVAL_DELAY_SUM",
    "ARRIVAL_DELAY_COUNT",
    "DEPARTURE_DELAY_SUM",
    "DEPARTURE_DELAY_COUNT",
)


def _from_rows() -> dict[str, Column]:
    return {
        "ROW_COUNT": M.row_count(),
        "LATE_COUNT": F.count_if(M.delayed()),
        "CANCELLED_COUNT": F.count_if(M.cancelled()),
        "ARRIVAL_DELAY_SUM": F.sum("ARRIVAL_DELAY"),
        "ARRIVAL_DELAY_COUNT": F.count("ARRIVAL_DELAY"),
        "DEPARTURE_DELAY_SUM": F.sum("DEPARTURE_DELAY"),
        "DEPARTURE_DELAY_COUNT": F.count("DEPARTURE_DELAY"),
    }


def _merged() -> dict[str, Column]:
    """States of states; a count over nothing is 0, a sum over nothing stays null."""
    return {c: F.sum(c) if c.endswith("_SUM") else F.coalesce(F.sum(c), F.lit(0)) for c in STATE_COLUMNS}


@dataclass(frozen=True)
class States:
    """The rows of a fact, or of a rollup (``merged``)."""

    frame: DataFrame
    merged: bool = False

    def where(self, condition: Column) -> States:
        return replace(self, frame=self.frame.where(condition))

    def by(self, *keys: Column | str, states: tuple[str, ...] = STATE_COLUMNS) -> DataFrame:
        """The wanted states per group, or over everything without keys."""
        found = _merged() if self.merged else _from_rows()
        return self.frame.groupBy(*keys).agg(*[found[c].alias(c) for c in states])


def states_of(source: DataFrame | States) -> States:
    return source if isinstance(source, States) else States(source)


def ratio(num: Column, den: Column) -> Column:
    return num / F.nullif(den, F.lit(0))


def rounded(value: Column, digits: int | None) -> Column:
    return value if digits is None else F.round(value, digits)


def mean_of(measure: str, digits: int | None = 2) -> Column:
    """The mean from a row's sum and count states."""
    return rounded(ratio(F.col(f"{measure}_SUM"), F.col(f"{measure}_COUNT")), digits)


def share_of(hits: str, digits: int | None = 2) -> Column:
    """``hits`` in percent of all rows of a row's states."""
    pct = F.col(hits).cast("double") * F.lit(100.0) / F.nullif(F.col("ROW_COUNT").cast("double"), F.lit(0.0))
    return rounded(pct, digits)
