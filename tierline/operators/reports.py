"""Reports over the fact table and the dimensions.

Grouped reports that join a dimension aggregate the fact *first* by its
foreign key (partial + final aggregation, so a hot key is combined map-side),
join the per-key states to the dimension, and finish the measures from the
summed states.  The join then sees one row per key instead of one per flight,
and grouping by a dimension attribute still merges codes that share a name.
Means are finished as sum / count, rates as hits * 100 / rows, both in double.
Every report takes the fact itself or ``States`` of a rollup (``operators.rollup``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import measures as M
from ..schemas import CAUSES
from .joins import maybe_broadcast
from .rollup import choose
from .states import States, mean_of, share_of, states_of

#: States of the reports on arrivals.
ARRIVAL_STATES = ("ROW_COUNT", "LATE_COUNT", "ARRIVAL_DELAY_SUM", "ARRIVAL_DELAY_COUNT")


#: Key ranges that narrow the scan of a stored fact by selected names.
SCAN_RANGES = 2


def _lower(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).alias(c.lower()) for c in cols]


# -- per-group states meet the dimension ---------------------------------------

Source = DataFrame | States


def _join_states(fact: Source, fact_key: str, dim: DataFrame, dim_key: str, attrs: Sequence[str]) -> DataFrame:
    """Per-key delay states inner-joined to the dimension attributes."""
    states = states_of(fact).by(F.col(fact_key).alias("_key"), states=ARRIVAL_STATES)
    dim_side = dim.select(F.col(dim_key).alias("_dkey"), *attrs)
    return states.join(maybe_broadcast(dim_side), F.col("_key") == F.col("_dkey"), "inner")


def _by_attributes(joined: DataFrame, by: Sequence[str]) -> DataFrame:
    """States per dimension attributes: codes that share them merge."""
    return States(joined, merged=True).by(*_lower(by), states=ARRIVAL_STATES)


# -- headline KPIs -----------------------------------------------------------

def kpis(fact: Source, mean_digits: int = 2, rate_digits: int = 2) -> DataFrame:
    """Total, mean delays, delay and cancel rates, on-time rate.

    Both roundings are 2 as the report SQL states; ``rate_digits=1`` reproduces an engine
    that divides in one-decimal fixed point, which touches the rates alone.
    """
    return (
        states_of(fact)
        .by()
        .select(
            F.col("ROW_COUNT").alias("total_flights"),
            mean_of("ARRIVAL_DELAY", mean_digits).alias("avg_arrival_delay"),
            mean_of("DEPARTURE_DELAY", mean_digits).alias("avg_departure_delay"),
            share_of("LATE_COUNT", rate_digits).alias("delay_pct"),
            share_of("CANCELLED_COUNT", rate_digits).alias("cancel_pct"),
        )
        .withColumn("on_time_pct", F.round(F.lit(100.0) - F.col("delay_pct"), rate_digits))
    )


# -- grouped leaderboards ----------------------------------------------------

def leaderboard(
    fact: Source,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    by: Sequence[str],
    count_name: str,
    order: str,
    mean_digits: int = 2,
    rate_digits: int = 2,
) -> DataFrame:
    """Counts, rounded mean arrival delay and delay rate per dimension attribute(s).

    Sorted by ``order`` descending (nulls last), then by the group columns so
    ties are deterministic (A9, A10, O2).
    """
    keys = [c.lower() for c in by]
    out = _by_attributes(_join_states(fact, fact_key, dim, dim_key, by), by).select(
        *keys,
        F.col("ROW_COUNT").alias(count_name),
        mean_of("ARRIVAL_DELAY", mean_digits).alias("avg_arrival_delay"),
        share_of("LATE_COUNT", rate_digits).alias("delay_pct"),
    )
    return out.orderBy(F.desc_nulls_last(order), *[F.asc_nulls_last(k) for k in keys])


def airline_leaderboard(fact: Source, airlines: DataFrame, mean_digits: int = 2, rate_digits: int = 2) -> DataFrame:
    return leaderboard(
        fact, airlines, "AIRLINE_CODE", "IATA_CODE", ["AIRLINE"], "num_flights", "avg_arrival_delay", mean_digits, rate_digits
    )


def airport_leaderboard(fact: Source, airports: DataFrame, mean_digits: int = 2, rate_digits: int = 2) -> DataFrame:
    return leaderboard(
        fact, airports, "ORIGIN_AIRPORT", "IATA_CODE", ["AIRPORT", "CITY", "STATE"], "num_departures", "delay_pct",
        mean_digits, rate_digits,
    )


def top_n(ranked: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` rows of an ordered report (O6, O7); planned as TakeOrdered."""
    return ranked.limit(n)


def airport_label(name: str = "airport", state: str = "state", width: int = 35) -> Column:
    """``first 35 chars of name (state)``; a null state gives a null label."""
    return F.concat(F.substring(F.col(name), 1, width), F.lit(" ("), F.col(state), F.lit(")"))


def top10_airports(fact: Source, airports: DataFrame, n: int = 10, mean_digits: int = 2, rate_digits: int = 2) -> DataFrame:
    return top_n(airport_leaderboard(fact, airports, mean_digits, rate_digits), n).withColumn("label", airport_label())


def worst_group(fact: Source, dim: DataFrame, fact_key: str, dim_key: str, name: str) -> DataFrame:
    """Group with the highest *unrounded* mean arrival delay.

    Ties are broken by name; ``N/A`` when nothing joins.
    """
    states = _by_attributes(_join_states(fact, fact_key, dim, dim_key, [name]), [name])
    per = states.select(name.lower(), mean_of("ARRIVAL_DELAY", None).alias("_mean"))
    best = per.orderBy(F.desc_nulls_last("_mean"), F.asc_nulls_last(name.lower())).limit(1)
    # One row in any case: a global aggregate over the single best group.
    return best.agg(F.coalesce(F.first(name.lower()), F.lit("N/A")).alias(name.lower()))


def worst_airline(fact: Source, airlines: DataFrame) -> DataFrame:
    return worst_group(fact, airlines, "AIRLINE_CODE", "IATA_CODE", "AIRLINE")


def map_points(fact: Source, airports: DataFrame, mean_digits: int = 2, rate_digits: int = 2) -> DataFrame:
    """Per origin airport with its coordinates, unordered.

    Null coordinates are ordinary group values.
    """
    attrs = ["IATA_CODE", "AIRPORT", "CITY", "STATE", "LATITUDE", "LONGITUDE"]
    states = _by_attributes(_join_states(fact, "ORIGIN_AIRPORT", airports, "IATA_CODE", attrs), attrs)
    return states.select(
        *[c.lower() for c in attrs],
        F.col("ROW_COUNT").alias("num_departures"),
        mean_of("ARRIVAL_DELAY", mean_digits).alias("avg_arrival_delay"),
        share_of("LATE_COUNT", rate_digits).alias("delay_pct"),
    )


# -- trends --------------------------------------------------------------------

def trend(fact: Source, flt=None, period: str = "period", departure: bool = True, digits: int = 2) -> DataFrame:
    """Flights and mean delays per calendar month, ordered by month.

    A null date forms its own (last) group unless a date filter removed it.
    """
    states = states_of(fact)
    if flt is not None:
        states = states.where(flt.to_column())
    measures = ["ARRIVAL_DELAY", "DEPARTURE_DELAY"] if departure else ["ARRIVAL_DELAY"]
    wanted = ("ROW_COUNT", *[f"{m}_{k}" for m in measures for k in ("SUM", "COUNT")])
    per = states.by(F.trunc("FLIGHT_DATE", "month").alias(period), states=wanted)
    means = [mean_of(m, digits).alias(f"avg_{m.lower()}") for m in measures]
    return per.select(period, F.col("ROW_COUNT").alias("num_flights"), *means).orderBy(F.asc_nulls_last(period))


# -- causes --------------------------------------------------------------------

def cause_totals(
    raw: DataFrame, causes: Sequence[tuple[str, str]] = CAUSES, shares: bool = False, digits: int = 2
) -> DataFrame:
    """Total minutes per delay cause from one scan (R6, U1, A13; A14 with ``shares``).

    One aggregate sums all causes; the one-row result is unpivoted.  The share
    is each rounded total over the sum of the rounded totals, as the chart
    computes it.
    """
    sums = raw.agg(*[M.total(c, digits).alias(f"_c{i}") for i, (_, c) in enumerate(causes)])
    args = []
    for i, (label, _) in enumerate(causes):
        args += [F.lit(label), F.col(f"_c{i}")]
    grand = None
    for i in range(len(causes)):
        term = F.col(f"_c{i}")
        grand = term if grand is None else grand + term
    long = sums.select(grand.alias("_grand"), F.stack(F.lit(len(causes)), *args).alias("reason", "total_minutes"))
    cols = [F.col("reason"), F.col("total_minutes")]
    if shares:
        share = F.col("total_minutes") * F.lit(100.0) / F.nullif(F.col("_grand"), F.lit(0.0))
        cols.append(F.round(share, digits).alias("share_pct"))
    return long.select(*cols)


# -- small reports -------------------------------------------------------------

def date_bounds(fact: Source, col: str = "FLIGHT_DATE") -> DataFrame:
    """Earliest and latest date in one aggregate."""
    return states_of(fact).frame.agg(F.min(col).alias("min_date"), F.max(col).alias("max_date"))


def dim_list(dim: DataFrame, cols: Sequence[str], order: str) -> DataFrame:
    """Dimension rows sorted by name."""
    keys = [order.lower()] + [c.lower() for c in cols if c.lower() != order.lower()]
    return dim.select(*_lower(cols)).orderBy(*[F.asc_nulls_last(k) for k in keys])


def dim_airlines(airlines: DataFrame) -> DataFrame:
    return dim_list(airlines, ["IATA_CODE", "AIRLINE"], "AIRLINE")


def dim_airports(airports: DataFrame) -> DataFrame:
    return dim_list(airports, ["IATA_CODE", "AIRPORT", "CITY", "STATE"], "AIRPORT")


# -- the dashboard's data, in one place --------------------------------------------

def dashboard(
    fact: DataFrame,
    airlines: DataFrame,
    airports: DataFrame,
    raw: DataFrame,
    airline_names: Sequence[str] = (),
    airport_names: Sequence[str] = (),
    date_from=None,
    date_to=None,
    rollup: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Every dashboard dataset as a lazy DataFrame.

    Selected airline and airport *names* narrow the trend only, through
    ``left_semi`` joins to the filtered dimensions; the date range applies to
    the trend too.  Everything else is unfiltered, as on the dashboard.
    With a ``rollup`` of this fact the nine reports on it read the rollup alone.
    No table data is collected; the size checks of the dimensions run while plans are built.
    """
    from ..functions.filters import FactFilter, Selection, resolve_selections

    by_airline = choose(fact, rollup, ["AIRLINE_CODE"])
    by_airport = choose(fact, rollup, ["ORIGIN_AIRPORT"])
    dates = FactFilter(date_from=date_from, date_to=date_to).to_column()
    chosen = choose(fact, rollup, ["FLIGHT_DATE", "AIRLINE_CODE", "ORIGIN_AIRPORT"], dates)
    rows = resolve_selections(
        chosen.frame,
        Selection(airlines, airline_names, "AIRLINE_CODE", dim_name="AIRLINE"),
        Selection(airports, airport_names, "ORIGIN_AIRPORT", dim_name="AIRPORT"),
        ranges=0 if chosen.merged else SCAN_RANGES,
    )
    board = airline_leaderboard(by_airline, airlines)
    return {
        "airlines": dim_airlines(airlines),
        "airports": dim_airports(airports),
        "date_bounds": date_bounds(choose(fact, rollup, ["FLIGHT_DATE"])),
        "kpis": kpis(choose(fact, rollup)),
        "worst_airline": worst_airline(by_airline, airlines),
        "airline_leaderboard": board,
        "top10_airlines": top_n(board, 10),
        "trend": trend(States(rows, chosen.merged)),
        "delay_causes": cause_totals(raw, shares=True),
        "top10_airports": top10_airports(by_airport, airports),
        "airport_map": map_points(by_airport, airports),
    }
