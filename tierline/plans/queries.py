"""Registered queries: every operator run end to end over the test tables.

Each query takes ``(spark, sf_dir)``, derives the flight-shaped layers from
the given parquet tables (``sources.testview``) and returns a DataFrame; no
query caps its input, and what runs while a plan is built are the one-row size checks
of dimensions.  The layer chain is the same one the
pipeline writes: raw -> clean -> fact.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.filters import FactFilter, Selection, resolve_selections
from ..operators import quality as Q
from ..operators import reports as R
from ..operators import transforms as T
from ..operators.rollup import build_rollup, choose
from ..schemas import FACT_COLUMNS, FLIGHTS
from ..session import ensure_checkpoint_dir
from ..sources import testview as V
from ..sources.csv import CORRUPT, parse_csv
from ..sources.footers import footer_stats
from ..sources.report_functions import create_statement, states_query

# The filter the dashboard applies in the filtered-trend check.
TREND_AIRLINES = ("1", "2", "3")
TREND_AIRPORTS = ("3", "15", "16", "20", "21")
TREND_FROM = "1996-02-10"
TREND_TO = "1999-12-31"
# The same selection expressed by dimension names (label -> code resolution).
TREND_AIRLINE_NAMES = ("Supplier#000000001", "Supplier#000000002", "Supplier#000000003")
TREND_AIRPORT_NAMES = ("NATION_3", "NATION_15", "NATION_16", "NATION_20", "NATION_21")


class Layers:
    """Lazy layer DataFrames of one test directory.

    Each layer's plan is built once per query (the broadcast size checks run
    while building), and reused by every part of the query that reads it.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._memo: dict[str, DataFrame] = {}

    def _get(self, key: str, build: Callable[[], DataFrame]) -> DataFrame:
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    def raw(self) -> DataFrame:
        return self._get("raw", lambda: V.flights_raw(self.spark, self.sf_dir))

    def airlines(self) -> DataFrame:
        return self._get("airlines", lambda: V.airlines(self.spark, self.sf_dir))

    def airports(self) -> DataFrame:
        return self._get("airports", lambda: V.airports(self.spark, self.sf_dir))

    def silver(self) -> DataFrame:
        return self._get("silver", lambda: T.clean(self.raw()))

    def measures(self) -> DataFrame:
        """The fact without the dimension join, for reports that do not read the name."""
        return self._get("measures", lambda: T.fact_measures(self.silver()))

    def gold(self, check_unique: bool = False) -> DataFrame:
        # Reports read the fact as the gold job writes it; the key check
        # itself runs in ``gold_fact`` and in the pipeline.
        return self._get(
            f"gold{check_unique}",
            lambda: T.fact(self.silver(), self.airlines(), check_unique=check_unique),
        )


    def rollup(self) -> DataFrame:
        """The rollup as a written table (in the shared checkpoint folder), as a refresh leaves it."""

        def write() -> DataFrame:
            path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/tierline-rollup/{uuid.uuid4().hex}"
            rollup = build_rollup(self.measures())
            rollup.write.parquet(path)
            return self.spark.read.schema(rollup.schema).parquet(path)

        return self._get("rollup", write)

    def function(self, name: str) -> str:
        """A report's SQL function over views of these layers; returns what to call."""
        views = {"fact": self.measures(), "airlines": self.airlines(), "airports": self.airports(), "raw": self.raw()}
        named = {k: f"tierline_view_{k}" for k in views}
        for k, df in views.items():
            df.createOrReplaceTempView(named[k])
        named["states"] = "tierline_view_states"
        self.spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {named['states']} AS {states_query(named['fact'], rollup=False)}")
        self.spark.sql(create_statement(name, f"tierline_{name}", named, temporary=True))
        return f"tierline_{name}"


def _q(fn: Callable[[Layers], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Layers(spark, sf_dir))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def bronze_flights(L: Layers) -> DataFrame:
    """The raw layer, 31 contract columns."""
    return L.raw()


def compose_date(L: Layers) -> DataFrame:
    """Date parts and the composed date."""
    return T.with_flight_date(L.raw()).select("YEAR", "MONTH", "DAY", "FLIGHT_DATE")


def neutralise_delays(L: Layers) -> DataFrame:
    """P5: delays after cancelled flights are set to 0."""
    return T.neutralise(L.raw()).select("CANCELLED", "DEPARTURE_DELAY", "ARRIVAL_DELAY")


def silver_flights(L: Layers) -> DataFrame:
    """The clean layer, 29 columns."""
    return L.silver()


def gold_fact(L: Layers) -> DataFrame:
    """The fact layer, 9 columns, with the dimension key check."""
    return L.gold(check_unique=True)


def null_profile(L: Layers) -> DataFrame:
    """Null counts of the raw layer."""
    return Q.null_profile(L.raw())


def invalid_dates(L: Layers) -> DataFrame:
    """A3, P7."""
    return L.silver().agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("FLIGHT_DATE").isNull()).alias("invalid_dates"),
    )


def out_of_range(L: Layers) -> DataFrame:
    """A4, P8."""
    return L.silver().agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(Q.out_of_range()).alias("out_of_range"),
    )


def clean_metrics(L: Layers) -> DataFrame:
    """A1, A3, A4 in one pass."""
    return Q.clean_metrics(L.silver())


def unmatched_count(L: Layers) -> DataFrame:
    """J4."""
    return Q.unmatched_count(L.gold())


def unmatched_codes(L: Layers) -> DataFrame:
    """J5, A16."""
    return Q.unmatched_codes(L.silver(), L.airlines())


def kpis(L: Layers) -> DataFrame:
    """R1, A5-A8, P15."""
    return R.kpis(L.measures())


def worst_airline(L: Layers) -> DataFrame:
    """R2, A17, O4, O5."""
    return R.worst_airline(L.measures(), L.airlines())


def airline_leaderboard(L: Layers) -> DataFrame:
    """R3, J2, A9, O2."""
    return R.airline_leaderboard(L.measures(), L.airlines())


def top10_airlines(L: Layers) -> DataFrame:
    """R3, O6."""
    return R.top_n(R.airline_leaderboard(L.measures(), L.airlines()), 10)


def trend_monthly(L: Layers) -> DataFrame:
    """Unfiltered, the null month stays."""
    return R.trend(L.measures(), period="month", departure=False)


def trend_filtered(L: Layers) -> DataFrame:
    """R4, P9-P11."""
    flt = FactFilter(TREND_AIRLINES, TREND_AIRPORTS, TREND_FROM, TREND_TO)
    return R.trend(L.measures(), flt)


def resolve_codes(L: Layers) -> DataFrame:
    """The filtered trend selected by airline and airport *names*."""
    fact = resolve_selections(
        L.measures(),
        Selection(L.airlines(), TREND_AIRLINE_NAMES, "AIRLINE_CODE", dim_name="AIRLINE"),
        Selection(L.airports(), TREND_AIRPORT_NAMES, "ORIGIN_AIRPORT", dim_name="AIRPORT"),
    )
    return R.trend(fact, FactFilter(date_from=TREND_FROM, date_to=TREND_TO))


def delay_causes(L: Layers) -> DataFrame:
    """One scan of the raw layer."""
    return R.cause_totals(L.raw())


def delay_cause_shares(L: Layers) -> DataFrame:
    """R6, A14."""
    return R.cause_totals(L.raw(), shares=True)


def airport_leaderboard(L: Layers) -> DataFrame:
    """R7, J3, A10, O2."""
    return R.airport_leaderboard(L.measures(), L.airports())


def top10_airports(L: Layers) -> DataFrame:
    """R7, O7, P13."""
    return R.top10_airports(L.measures(), L.airports())


def airport_map(L: Layers) -> DataFrame:
    """R8, A11."""
    return R.map_points(L.measures(), L.airports())


def date_bounds(L: Layers) -> DataFrame:
    """R9, A15."""
    return R.date_bounds(L.measures())


def dim_airlines(L: Layers) -> DataFrame:
    """R10, S12, O1."""
    return R.dim_airlines(L.airlines())


def dim_airports(L: Layers) -> DataFrame:
    """R10, S12, O1."""
    return R.dim_airports(L.airports())


def layer_counts(L: Layers) -> DataFrame:
    """The dimension key is unique, so the fact has as many rows without its join."""
    return Q.layer_counts(
        [
            ("bronze_flights", L.raw()),
            ("bronze_airlines", L.airlines()),
            ("bronze_airports", L.airports()),
            ("silver_flights", L.silver()),
            ("gold_fact", L.measures()),
        ]
    )


def fact_preview(L: Layers) -> DataFrame:
    """Five fact rows, the first by all columns so that they are the same in every run."""
    return L.gold().orderBy(*[F.asc_nulls_last(c) for c in FACT_COLUMNS]).limit(5)


def csv_quarantine(L: Layers) -> DataFrame:
    """Every raw row written as CSV, some damaged, parsed under the contract, with its flag.

    Damaged rows have a letter in the numeric TAXI_IN; they keep their other fields.
    """
    raw = L.raw()
    damaged = F.concat(F.lit("x"), F.coalesce(F.col("TAXI_IN").cast("string"), F.lit("")))
    text = raw.withColumn("TAXI_IN", F.when(F.col("FLIGHT_NUMBER").cast("long") % 23 == 0, damaged).otherwise(F.col("TAXI_IN").cast("string")))
    parsed = parse_csv(text.select(F.to_csv(F.struct(*raw.columns)).alias("line")), "line", FLIGHTS)
    return parsed.select(*raw.columns, F.col(CORRUPT).isNotNull().alias("malformed"))


# -- the same reports from a rollup, from SQL and from footers ---------------------

def fact_rollup(L: Layers) -> DataFrame:
    """States of the fact by date, airline and origin."""
    return build_rollup(L.measures())


def rollup_kpis(L: Layers) -> DataFrame:
    """R1 from the written rollup."""
    return R.kpis(choose(L.measures(), L.rollup()))


def rollup_airline_leaderboard(L: Layers) -> DataFrame:
    """R3 from the written rollup."""
    return R.airline_leaderboard(choose(L.measures(), L.rollup(), ["AIRLINE_CODE"]), L.airlines())


def rollup_airport_map(L: Layers) -> DataFrame:
    """R8 from the written rollup."""
    return R.map_points(choose(L.measures(), L.rollup(), ["ORIGIN_AIRPORT"]), L.airports())


def rollup_trend(L: Layers) -> DataFrame:
    """R4 from the written rollup, which covers the whole filter."""
    flt = FactFilter(TREND_AIRLINES, TREND_AIRPORTS, TREND_FROM, TREND_TO).to_column()
    return R.trend(choose(L.measures(), L.rollup(), ["FLIGHT_DATE"], flt))


def _literals(values) -> str:
    return "array(" + ", ".join("'" + v.replace("'", "\\'") + "'" for v in values) + ")"


def sql_trend(L: Layers) -> DataFrame:
    """The trend as a SQL table function, airlines and airports chosen by name."""
    call = L.function("trend")
    return L.spark.sql(
        f"SELECT * FROM {call}(airlines => {_literals(TREND_AIRLINE_NAMES)}, airports => {_literals(TREND_AIRPORT_NAMES)}, "
        f"date_from => DATE'{TREND_FROM}', date_to => DATE'{TREND_TO}')"
    )


def sql_kpis(L: Layers) -> DataFrame:
    """S9, R1."""
    return L.spark.sql(f"SELECT * FROM {L.function('kpis')}()")


def sql_airline_leaderboard(L: Layers) -> DataFrame:
    """S9, R3."""
    return L.spark.sql(f"SELECT * FROM {L.function('airline_leaderboard')}()")


def sql_top_airports(L: Layers) -> DataFrame:
    """The ten worst by their place."""
    return L.spark.sql(f"SELECT * FROM {L.function('top_airports')}(n => 10)")


#: Test tables with the key whose bounds their footers hold.
FOOTER_KEYS = {"lineitem": "l_orderkey", "orders": "o_orderkey", "customer": "c_custkey", "supplier": "s_suppkey"}


def footer_bounds(L: Layers) -> DataFrame:
    """Rows and key bounds of stored tables from their footers alone."""
    parts = [
        footer_stats(L.spark, f"{L.sf_dir.rstrip('/')}/{t}.parquet", [key]).select(
            F.lit(t).alias("table_name"), "row_count", F.col(f"min_{key}").alias("min_key"), F.col(f"max_{key}").alias("max_key")
        )
        for t, key in FOOTER_KEYS.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_ALL = [
    bronze_flights, compose_date, neutralise_delays, silver_flights, gold_fact,
    null_profile, invalid_dates, out_of_range, clean_metrics, unmatched_count,
    unmatched_codes, kpis, worst_airline, airline_leaderboard, top10_airlines,
    trend_monthly, trend_filtered, resolve_codes, delay_causes, delay_cause_shares,
    airport_leaderboard, top10_airports, airport_map, date_bounds, dim_airlines,
    dim_airports, layer_counts, fact_preview, csv_quarantine,
    fact_rollup, rollup_kpis, rollup_airline_leaderboard, rollup_airport_map, rollup_trend,
    sql_trend, sql_kpis, sql_airline_leaderboard, sql_top_airports, footer_bounds,
]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: _q(f) for f in _ALL}
