"""The reports as SQL table functions.

``CREATE FUNCTION ... RETURNS TABLE`` puts every report into the catalog, so that a SQL user asks

    USE gold;
    SELECT * FROM trend(airlines => array('Example Air'), date_from => DATE'2015-03-01')

and needs no Python (Spark calls table functions of the current schema, without a schema name).  The bodies are
plain SQL, expanded by Spark into the calling query: the caller's filters, and values given as arguments,
reach the scans, and states are added up per key before a dimension is joined.

The functions read one view of states, ``report_states``, which stands on the rollup while that is the current
fact's, and else on the fact itself, every row of which is a state of one flight.  So a refresh re-points
one view, and the functions stay as they are.  Rows come unordered, as from a table: the ranked reports
carry their place.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession

from ..operators.rollup import KEYS
from ..operators.states import STATE_COLUMNS
from ..schemas import CAUSES

# How states add up.
_MERGED = {
    "rows": "COALESCE(SUM(f.ROW_COUNT), 0)",
    "late": "COALESCE(SUM(f.LATE_COUNT), 0)",
    "cancelled": "COALESCE(SUM(f.CANCELLED_COUNT), 0)",
    "arrival_sum": "SUM(f.ARRIVAL_DELAY_SUM)",
    "arrival_n": "SUM(f.ARRIVAL_DELAY_COUNT)",
    "departure_sum": "SUM(f.DEPARTURE_DELAY_SUM)",
    "departure_n": "SUM(f.DEPARTURE_DELAY_COUNT)",
}
# The states of one flight, in the same order.
_OF_ONE_FLIGHT = (
    "1L",
    "IF(ARRIVAL_DELAY > 15, 1L, 0L)",
    "IF(CANCELLED = 1, 1L, 0L)",
    "ARRIVAL_DELAY",
    "IF(ARRIVAL_DELAY IS NULL, 0L, 1L)",
    "DEPARTURE_DELAY",
    "IF(DEPARTURE_DELAY IS NULL, 0L, 1L)",
)
#: States by their place in the rollup.
_STATE_COLUMNS = dict(zip(_MERGED, STATE_COLUMNS))

#: The view the functions read.
STATES_VIEW = "report_states"

_AIRPORT = "iata_code STRING, airport STRING, city STRING, state STRING"
_MEAN = "ROUND({m[%s_sum]} / NULLIF({m[%s_n]}, 0), 2)"
_ARRIVAL, _DEPARTURE = _MEAN % ("arrival", "arrival"), _MEAN % ("departure", "departure")
_PCT = "ROUND(CAST({m[%s]} AS DOUBLE) * 100.0D / NULLIF(CAST({m[rows]} AS DOUBLE), 0.0D), 2)"
_LATE, _CANCELLED = _PCT % "late", _PCT % "cancelled"

_BOARD = f"""
SELECT d.AIRLINE AS airline, {{m[rows]}} AS num_flights, {_ARRIVAL} AS avg_arrival_delay, {_LATE} AS delay_pct
FROM {{by_airline}} f JOIN {{airlines}} d ON f.AIRLINE_CODE = d.IATA_CODE
GROUP BY d.AIRLINE"""
_AIRPORT_BOARD = f"""
SELECT d.AIRPORT AS airport, d.CITY AS city, d.STATE AS state, {{m[rows]}} AS num_departures,
  {_ARRIVAL} AS avg_arrival_delay, {_LATE} AS delay_pct
FROM {{by_origin}} f JOIN {{airports}} d ON f.ORIGIN_AIRPORT = d.IATA_CODE
GROUP BY d.AIRPORT, d.CITY, d.STATE"""


@dataclass(frozen=True)
class ReportFunction:
    """Parameters and columns of one function, and its SQL with table and state names to fill in."""

    parameters: str
    columns: str
    body: str


_SELECTION = "airlines ARRAY<STRING> DEFAULT array(), airports ARRAY<STRING> DEFAULT array(), date_from DATE DEFAULT NULL, date_to DATE DEFAULT NULL"
_BOARD_COLUMNS = "airline STRING, num_flights BIGINT, avg_arrival_delay DOUBLE, delay_pct DOUBLE"
_AIRPORT_COLUMNS = "airport STRING, city STRING, state STRING, num_departures BIGINT, avg_arrival_delay DOUBLE, delay_pct DOUBLE"

FUNCTIONS: dict[str, ReportFunction] = {
    "kpis": ReportFunction(
        "",
        "total_flights BIGINT, avg_arrival_delay DOUBLE, avg_departure_delay DOUBLE, delay_pct DOUBLE, cancel_pct DOUBLE, on_time_pct DOUBLE",
        f"""
SELECT {{m[rows]}}, {_ARRIVAL}, {_DEPARTURE}, {_LATE}, {_CANCELLED}, ROUND(100.0D - {_LATE}, 2) FROM {{in_all}} f""",
    ),
    "worst_airline": ReportFunction(
        "",
        "airline STRING",
        """
SELECT COALESCE(MAX_BY(airline, STRUCT(mean IS NOT NULL, mean, -place)), 'N/A') FROM (
  SELECT airline, mean, ROW_NUMBER() OVER (ORDER BY mean DESC NULLS LAST, airline NULLS LAST) AS place FROM (
    SELECT d.AIRLINE AS airline, {m[arrival_sum]} / NULLIF({m[arrival_n]}, 0) AS mean
    FROM {by_airline} f JOIN {airlines} d ON f.AIRLINE_CODE = d.IATA_CODE GROUP BY d.AIRLINE)
) WHERE place = 1""",
    ),
    "airline_leaderboard": ReportFunction("", _BOARD_COLUMNS, _BOARD),
    "top_airlines": ReportFunction(
        "n INT DEFAULT 10",
        f"place INT, {_BOARD_COLUMNS}",
        f"""
SELECT place, airline, num_flights, avg_arrival_delay, delay_pct FROM (
  SELECT ROW_NUMBER() OVER (ORDER BY avg_arrival_delay DESC NULLS LAST, airline NULLS LAST) AS place, * FROM ({_BOARD})
) WHERE place <= n""",
    ),
    "trend": ReportFunction(
        _SELECTION,
        "period DATE, num_flights BIGINT, avg_arrival_delay DOUBLE, avg_departure_delay DOUBLE",
        f"""
SELECT CAST(TRUNC(f.FLIGHT_DATE, 'MONTH') AS DATE), {{m[rows]}}, {_ARRIVAL}, {_DEPARTURE}
FROM {{by_key}} f
LEFT JOIN {{airlines}} a ON f.AIRLINE_CODE = a.IATA_CODE
LEFT JOIN {{airports}} p ON f.ORIGIN_AIRPORT = p.IATA_CODE
WHERE (CARDINALITY(airlines) = 0 OR ARRAY_CONTAINS(airlines, a.AIRLINE))
  AND (CARDINALITY(airports) = 0 OR ARRAY_CONTAINS(airports, p.AIRPORT))
  AND (date_from IS NULL OR f.FLIGHT_DATE >= date_from) AND (date_to IS NULL OR f.FLIGHT_DATE <= date_to)
GROUP BY TRUNC(f.FLIGHT_DATE, 'MONTH')""",
    ),
    "delay_causes": ReportFunction(
        "",
        "reason STRING, total_minutes DOUBLE, share_pct DOUBLE",
        f"""
SELECT reason, total, ROUND(total * 100.0D / NULLIF(whole, 0.0D), 2) FROM (
  SELECT {', '.join(f'c{i}' for i in range(len(CAUSES)))}, {' + '.join(f'c{i}' for i in range(len(CAUSES)))} AS whole FROM (
    SELECT {', '.join(f'ROUND(SUM(COALESCE({c}, 0.0D)), 2) AS c{i}' for i, (_, c) in enumerate(CAUSES))} FROM {{raw}})
) LATERAL VIEW STACK({len(CAUSES)}, {', '.join(f"'{label}', c{i}" for i, (label, _) in enumerate(CAUSES))}) AS reason, total""",
    ),
    "airport_leaderboard": ReportFunction("", _AIRPORT_COLUMNS, _AIRPORT_BOARD),
    "top_airports": ReportFunction(
        "n INT DEFAULT 10",
        f"place INT, {_AIRPORT_COLUMNS}, label STRING",
        f"""
SELECT place, airport, city, state, num_departures, avg_arrival_delay, delay_pct, CONCAT(SUBSTRING(airport, 1, 35), ' (', state, ')') FROM (
  SELECT ROW_NUMBER() OVER (ORDER BY delay_pct DESC NULLS LAST, airport NULLS LAST, city NULLS LAST, state NULLS LAST) AS place, *
  FROM ({_AIRPORT_BOARD})
) WHERE place <= n""",
    ),
    "airport_map": ReportFunction(
        "",
        f"{_AIRPORT}, latitude DOUBLE, longitude DOUBLE, num_departures BIGINT, avg_arrival_delay DOUBLE, delay_pct DOUBLE",
        f"""
SELECT d.IATA_CODE, d.AIRPORT, d.CITY, d.STATE, d.LATITUDE, d.LONGITUDE, {{m[rows]}}, {_ARRIVAL}, {_LATE}
FROM {{by_origin}} f JOIN {{airports}} d ON f.ORIGIN_AIRPORT = d.IATA_CODE
GROUP BY d.IATA_CODE, d.AIRPORT, d.CITY, d.STATE, d.LATITUDE, d.LONGITUDE""",
    ),
    "date_bounds": ReportFunction("", "min_date DATE, max_date DATE", "\nSELECT MIN(f.FLIGHT_DATE), MAX(f.FLIGHT_DATE) FROM {states} f"),
    "airline_list": ReportFunction("", "iata_code STRING, airline STRING", "\nSELECT IATA_CODE, AIRLINE FROM {airlines}"),
    "airport_list": ReportFunction("", _AIRPORT, "\nSELECT IATA_CODE, AIRPORT, CITY, STATE FROM {airports}"),
}


def _grouped(states: str, *keys: str) -> str:
    """A derived table of states by ``keys``: joins then meet one row per key, not one per flight."""
    columns = [f"f.{k}" for k in keys] + [f"{_MERGED[k]} AS {c}" for k, c in _STATE_COLUMNS.items()]
    group = f" GROUP BY {', '.join(f'f.{k}' for k in keys)}" if keys else ""
    return f"(SELECT {', '.join(columns)} FROM {states} f{group})"


def states_query(source: str, rollup: bool) -> str:
    """The states of a rollup, or of every flight of a fact."""
    if rollup:
        return f"SELECT {', '.join((*KEYS, *STATE_COLUMNS))} FROM {source}"
    own = [f"{sql} AS {c}" for sql, c in zip(_OF_ONE_FLIGHT, STATE_COLUMNS)]
    return f"SELECT {', '.join((*KEYS, *own))} FROM {source}"


def create_statement(name: str, as_name: str, tables: Mapping[str, str], temporary: bool) -> str:
    """``CREATE FUNCTION`` of one report over ``tables`` (``states``, ``airlines``, ``airports``, ``raw``)."""
    f, states = FUNCTIONS[name], tables["states"]
    groups = {
        "in_all": _grouped(states),
        "by_airline": _grouped(states, "AIRLINE_CODE"),
        "by_origin": _grouped(states, "ORIGIN_AIRPORT"),
        "by_key": _grouped(states, *KEYS),
    }
    body = f.body.format(m=_MERGED, **groups, **tables).strip()
    kind = "TEMPORARY FUNCTION" if temporary else "FUNCTION"
    return f"CREATE OR REPLACE {kind} {as_name}({f.parameters})\nRETURNS TABLE({f.columns})\nRETURN {body}"


def point_states(spark: SparkSession, rollup: bool, layer: str = "gold") -> None:
    """Let the reports read the rollup, or the fact."""
    table = "rollup_flights_delay" if rollup else "fact_flights_delay"
    spark.sql(f"CREATE OR REPLACE VIEW `{layer}`.{STATES_VIEW} AS {states_query(f'`{layer}`.{table}', rollup)}")


def register_report_functions(spark: SparkSession, rollup: bool, layer: str = "gold") -> list[str]:
    """All reports as functions of the catalog's ``layer``, over the registered tables.

    ``rollup`` says whether the registered rollup is the current fact's.
    """
    point_states(spark, rollup, layer)
    tables = {"states": f"{layer}.{STATES_VIEW}", "airlines": "bronze.airlines", "airports": "bronze.airports", "raw": "bronze.flights"}
    for name in FUNCTIONS:
        spark.sql(create_statement(name, f"`{layer}`.{name}", tables, temporary=False))
    return [f"{layer}.{name}" for name in FUNCTIONS]
