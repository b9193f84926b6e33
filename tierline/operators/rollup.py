"""A rollup of the fact by date, airline and origin, and the choice between it and the fact.

The rollup holds sums and counts, so a report over it adds up a small table instead of reading the whole fact,
and rollups of separate parts of the fact merge into the rollup of all of them.  ``choose`` takes the
rollup only where it can answer: the group and the filter must be made of its keys alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from .states import STATE_COLUMNS, States

KEYS = ("FLIGHT_DATE", "AIRLINE_CODE", "ORIGIN_AIRPORT")


def build_rollup(fact: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row of states per group of ``keys``; null keys are groups like any other.

    Partial aggregation keeps a key that holds a third of all rows one row per task.
    """
    return States(fact).by(*keys)


def merge_rollups(first: DataFrame, *others: DataFrame) -> DataFrame:
    """The rollup of everything from the rollups of its parts."""
    keys = [c for c in first.columns if c not in STATE_COLUMNS]
    both = first
    for other in others:
        both = both.unionByName(other)
    return States(both, merged=True).by(*keys)


def _read_columns(frame: DataFrame) -> set[str] | None:
    """Columns that the last step of ``frame`` reads, lower case; ``None`` if its values change from run to run."""
    step = frame._jdf.queryExecution().analyzed()
    if not step.deterministic():
        return None
    read = step.references().toSeq()
    return {read.apply(i).name().lower() for i in range(read.size())}


def covers(fact: DataFrame, rollup: DataFrame, group: Sequence[Column | str] = (), where: Column | None = None) -> bool:
    """Whether ``group`` and ``where``, both over the fact, are made of the rollup's keys alone.

    Spark's own analysis says which columns they read.  A filter that differs from row to row by itself (a
    random number, a file name) holds for no group.
    """
    keys = {c.lower() for c in rollup.columns if c not in STATE_COLUMNS}
    steps = [] if where is None else [fact.where(where)]
    if group:
        steps.append(fact.select(*group))
    found = [_read_columns(s) for s in steps]
    return all(columns is not None and columns <= keys for columns in found)


def choose(
    fact: DataFrame | States, rollup: DataFrame | None, group: Sequence[Column | str] = (), where: Column | None = None
) -> States:
    """The states to answer from, filtered: those of the rollup if it covers the question, else the fact's."""
    source = fact if isinstance(fact, States) else States(fact)
    if rollup is not None and covers(source.frame, rollup, group, where):
        source = States(rollup, merged=True)
    return source if where is None else source.where(where)
