"""Report filters as typed ``Column`` predicates (P9-P11) and label resolution."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import maybe_broadcast_all


def _date(value: str | dt.date | None) -> dt.date | None:
    if value is None or value == "":
        return None
    if isinstance(value, dt.datetime):  # a timestamp bound compares as its calendar day
        return value.date()
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value))


@dataclass(frozen=True)
class FactFilter:
    """Airline codes, origin codes and an inclusive date range; empty parts are no filter."""

    airlines: Sequence[str] = ()
    airports: Sequence[str] = ()
    date_from: str | dt.date | None = None
    date_to: str | dt.date | None = None
    airline_col: str = "AIRLINE_CODE"
    airport_col: str = "ORIGIN_AIRPORT"
    date_col: str = "FLIGHT_DATE"

    def clauses(self) -> list[Column]:
        out: list[Column] = []
        # An empty IN list would match nothing; the dashboard means "all".
        if self.airlines:
            out.append(F.col(self.airline_col).isin(list(self.airlines)))
        if self.airports:
            out.append(F.col(self.airport_col).isin(list(self.airports)))
        lo, hi = _date(self.date_from), _date(self.date_to)
        if lo is not None:
            out.append(F.col(self.date_col) >= F.lit(lo))
        if hi is not None:
            out.append(F.col(self.date_col) <= F.lit(hi))
        return out

    def to_column(self) -> Column:
        """Conjunction seeded with TRUE; Catalyst folds the seed away."""
        return functools.reduce(lambda a, b: a & b, self.clauses(), F.lit(True))

    def apply(self, df: DataFrame) -> DataFrame:
        return df.filter(self.to_column())


@dataclass(frozen=True)
class Selection:
    """Dimension rows chosen by name, and the fact column that holds their key."""

    dim: DataFrame
    names: Sequence[str]
    fact_key: str
    dim_key: str = "IATA_CODE"
    dim_name: str = "AIRLINE"

    def keys(self) -> DataFrame:
        return self.dim.filter(F.col(self.dim_name).isin(list(self.names))).select(F.col(self.dim_key).alias("_sel_key"))


def _within_ranges(column: Column, keys: DataFrame, ranges: int) -> Column:
    """``column`` lies in one of ``ranges`` stretches that together hold all chosen keys.

    The ends are scalar subqueries, so Spark knows them when the scan starts and pushes them into it.
    With no more keys than ranges every stretch is one key.
    """
    n, ends = F.size("keys"), []
    for i in range(ranges):
        first = F.floor(n * i / ranges)
        for place in (first, F.greatest(first, F.ceil(n * (i + 1) / ranges) - 1)):
            # Spark merges equal subqueries into one struct, and no scan takes a field of a struct as a bound;
            # a coalesce of its own, which moves nothing here, keeps every subquery apart.
            found = keys.coalesce(len(ends) + 1).agg(F.array_sort(F.collect_set("_sel_key")).alias("keys"))
            ends.append(found.select(F.get("keys", place.cast("int"))).scalar())
    return functools.reduce(lambda a, b: a | b, [column.between(lo, hi) for lo, hi in zip(ends[::2], ends[1::2])])


def resolve_selections(fact: DataFrame, *selections: Selection, ranges: int = 0) -> DataFrame:
    """Keep fact rows whose dimension *names* are all selected.

    Every selection is a ``left_semi`` join to the filtered dimension, so names and codes are
    resolved when the query runs and no code travels through the driver.  Selections that are
    counted to be small (in one job for all) are broadcast.  No names means no filter.
    Over a stored fact, ``ranges`` above 0 also filters by that many key ranges known before the scan, so
    that files and row groups are skipped by their statistics; the join decides what stays.
    """
    wanted = [s for s in selections if s.names]
    if not wanted:
        return fact
    for selection, keys in zip(wanted, maybe_broadcast_all(*[s.keys() for s in wanted])):
        if ranges:
            fact = fact.where(_within_ranges(F.col(selection.fact_key), selection.keys(), ranges))
        fact = fact.join(keys, F.col(selection.fact_key) == F.col("_sel_key"), "left_semi")
    return fact


def resolve_codes(
    fact: DataFrame,
    dim: DataFrame,
    names: Sequence[str],
    fact_key: str,
    dim_key: str = "IATA_CODE",
    dim_name: str = "AIRLINE",
) -> DataFrame:
    """One selection by name (P12, J6); see ``resolve_selections``."""
    return resolve_selections(fact, Selection(dim, names, fact_key, dim_key, dim_name))
