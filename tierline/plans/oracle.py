"""Equivalent SQL for every registered query, as DuckDB runs it.

The tables ``lineitem orders customer supplier nation region`` are views in the
checking engine.  The flight-shaped layers are rebuilt here as CTEs from the
same definitions as ``sources.testview``; every column is cast to the contract
type, and Spark's half-up rounding of doubles is reproduced by rounding a
decimal.
"""

from __future__ import annotations

# Fixed values, written out here so that a mistake in the engine's own constants shows.
_TYPES = {
    "INTEGER": "YEAR MONTH DAY DAY_OF_WEEK DIVERTED CANCELLED",
    "VARCHAR": "AIRLINE FLIGHT_NUMBER TAIL_NUMBER ORIGIN_AIRPORT DESTINATION_AIRPORT SCHEDULED_DEPARTURE DEPARTURE_TIME "
    "WHEELS_OFF WHEELS_ON SCHEDULED_ARRIVAL ARRIVAL_TIME CANCELLATION_REASON",
    "DOUBLE": "DEPARTURE_DELAY TAXI_OUT SCHEDULED_TIME ELAPSED_TIME AIR_TIME DISTANCE TAXI_IN ARRIVAL_DELAY AIR_SYSTEM_DELAY "
    "SECURITY_DELAY AIRLINE_DELAY LATE_AIRCRAFT_DELAY WEATHER_DELAY",
}
_TYPE_OF = {c: t for t, names in _TYPES.items() for c in names.split()}
DATE_PARTS = ("YEAR", "MONTH", "DAY")
FACT_COLUMNS = (
    "FLIGHT_DATE", "AIRLINE_CODE", "AIRLINE_NAME", "FLIGHT_NUMBER", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT",
    "DEPARTURE_DELAY", "ARRIVAL_DELAY", "CANCELLED",
)
CAUSES = (
    ("Airline Delay", "AIRLINE_DELAY"),
    ("Weather Delay", "WEATHER_DELAY"),
    ("NAS Delay", "AIR_SYSTEM_DELAY"),
    ("Late Aircraft Delay", "LATE_AIRCRAFT_DELAY"),
    ("Security Delay", "SECURITY_DELAY"),
)
TREND_AIRLINES = ("1", "2", "3")
TREND_AIRPORTS = ("3", "15", "16", "20", "21")
TREND_FROM = "1996-02-10"
TREND_TO = "1999-12-31"
TREND_AIRLINE_NAMES = ("Supplier#000000001", "Supplier#000000002", "Supplier#000000003")
TREND_AIRPORT_NAMES = ("NATION_3", "NATION_15", "NATION_16", "NATION_20", "NATION_21")


def _r2(x: str) -> str:
    """Spark's ``round(double, 2)`` (half up on the decimal text)."""
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,12)), 2) AS DOUBLE)"


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _clock(k: int) -> str:
    return f"lpad(CAST((h + {k}) % 2400 AS VARCHAR), 4, '0')"


_RAW_EXPR = {
    "YEAR": "year(l_shipdate)",
    "MONTH": "CASE WHEN l_partkey % 89 = 0 THEN 13 ELSE month(l_shipdate) END",
    "DAY": "CASE WHEN l_orderkey % 97 = 0 THEN 31 WHEN l_orderkey % 101 = 0 THEN NULL ELSE day(l_shipdate) END",
    "DAY_OF_WEEK": "l_orderkey % 7 + 1",
    "AIRLINE": "CASE WHEN l_partkey % 53 = 0 THEN 'ZZ' ELSE CAST(l_suppkey AS VARCHAR) END",
    "FLIGHT_NUMBER": "CAST(l_orderkey AS VARCHAR)",
    "TAIL_NUMBER": "CASE WHEN l_partkey % 37 = 0 THEN NULL ELSE 'N' || CAST(l_suppkey AS VARCHAR) END",
    "ORIGIN_AIRPORT": "CAST(s_nationkey AS VARCHAR)",
    "DESTINATION_AIRPORT": "CAST(c_nationkey AS VARCHAR)",
    "SCHEDULED_DEPARTURE": _clock(0),
    "DEPARTURE_TIME": f"CASE WHEN cx THEN NULL ELSE {_clock(10)} END",
    "DEPARTURE_DELAY": "CASE WHEN l_orderkey % 41 = 0 THEN NULL ELSE h % 1100 - 320 END",
    "TAXI_OUT": "ln * 3",
    "WHEELS_OFF": _clock(20),
    "SCHEDULED_TIME": "l_partkey % 300 + 30",
    "ELAPSED_TIME": "l_partkey % 300 + 35",
    "AIR_TIME": "l_partkey % 300 + 20",
    "DISTANCE": "l_partkey % 2500 + 50",
    "WHEELS_ON": _clock(30),
    "TAXI_IN": "ln * 2",
    "SCHEDULED_ARRIVAL": _clock(40),
    "ARRIVAL_TIME": _clock(50),
    "ARRIVAL_DELAY": "CASE WHEN l_orderkey % 43 = 0 THEN NULL ELSE (h * 3) % 1100 - 320 END",
    "DIVERTED": "CASE WHEN l_orderkey % 43 = 0 THEN 1 ELSE 0 END",
    "CANCELLED": "CASE WHEN cx THEN 1 ELSE 0 END",
    "CANCELLATION_REASON": "CASE WHEN cx THEN 'A' END",
    "AIR_SYSTEM_DELAY": "CASE WHEN l_returnflag = 'N' THEN l_orderkey % 60 END",
    "SECURITY_DELAY": "CASE WHEN l_orderkey % 50 = 0 THEN ln END",
    "AIRLINE_DELAY": "CASE WHEN l_linestatus = 'F' THEN l_quantity END",
    "LATE_AIRCRAFT_DELAY": "CASE WHEN l_linestatus = 'O' THEN l_partkey % 90 END",
    "WEATHER_DELAY": "CASE WHEN l_returnflag = 'A' THEN ln END",
}

_RAW_SELECT = ",\n    ".join(
    f'CAST({expr} AS {_TYPE_OF[name]}) AS "{name}"' for name, expr in _RAW_EXPR.items()
)

_DATE_TEXT = (
    "concat_ws('-', CAST(\"YEAR\" AS VARCHAR), lpad(CAST(\"MONTH\" AS VARCHAR), 2, '0'), "
    "lpad(CAST(\"DAY\" AS VARCHAR), 2, '0'))"
)
_FLIGHT_DATE = (
    f"CASE WHEN regexp_full_match({_DATE_TEXT}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
    f"THEN TRY_CAST({_DATE_TEXT} AS DATE) END"
)


def _silver_col(name: str) -> str:
    if name in ("DEPARTURE_DELAY", "ARRIVAL_DELAY"):
        return f'CASE WHEN "CANCELLED" = 1 THEN CAST(0 AS DOUBLE) ELSE "{name}" END AS "{name}"'
    return f'"{name}"'


_SILVER_SELECT = ",\n    ".join(
    [_silver_col(c) for c in _RAW_EXPR if c not in DATE_PARTS]
    + [f'{_FLIGHT_DATE} AS "FLIGHT_DATE"']
)

_GOLD_EXPR = {"AIRLINE_CODE": 's."AIRLINE"', "AIRLINE_NAME": 'a."AIRLINE"'}
_GOLD_SELECT = ",\n    ".join(f'{_GOLD_EXPR.get(c, "s." + chr(34) + c + chr(34))} AS "{c}"' for c in FACT_COLUMNS)

LAYERS = f"""
li AS (
  SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS ln, l_quantity,
         l_returnflag, l_linestatus, l_shipdate,
         l_partkey * 37 + CAST(l_linenumber AS BIGINT) * 13 + l_orderkey * 7 AS h,
         (l_returnflag = 'R' AND l_linenumber = 1) AS cx
  FROM lineitem
),
joined AS (
  SELECT li.*, s.s_nationkey, c.c_nationkey
  FROM li
  JOIN orders o ON li.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON li.l_suppkey = s.s_suppkey
),
raw_flights AS (
  SELECT
    {_RAW_SELECT}
  FROM joined
),
airlines AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS "IATA_CODE", CAST(s_name AS VARCHAR) AS "AIRLINE" FROM supplier
),
airports AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS "IATA_CODE", CAST(n_name AS VARCHAR) AS "AIRPORT",
         CAST(r_name AS VARCHAR) AS "CITY", CAST(n_regionkey AS VARCHAR) AS "STATE",
         'X' AS "COUNTRY",
         CAST(CASE WHEN n_nationkey % 8 = 0 THEN NULL ELSE n_nationkey * 2 - 25 END AS DOUBLE) AS "LATITUDE",
         CAST(CASE WHEN n_nationkey % 8 = 0 THEN NULL ELSE n_nationkey * 5 - 60 END AS DOUBLE) AS "LONGITUDE"
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
silver AS (
  SELECT
    {_SILVER_SELECT}
  FROM raw_flights
),
gold AS (
  SELECT
    {_GOLD_SELECT}
  FROM silver s LEFT JOIN airlines a ON s."AIRLINE" = a."IATA_CODE"
)
"""


def _with(body: str) -> str:
    return f"WITH {LAYERS.strip()}\n{body.strip()}\n"


_RATE = "SUM(CASE WHEN {p} THEN 1 ELSE 0 END) * 100.0 / NULLIF(COUNT(*), 0)"
_DELAY_PCT = _r2(_RATE.format(p="f.ARRIVAL_DELAY > 15"))
_AVG_ARR = _r2("AVG(f.ARRIVAL_DELAY)")


def _leaderboard(dim: str, key: str, by: list[str], count_name: str, order: str) -> str:
    cols = ", ".join(f'd."{c}" AS {c.lower()}' for c in by)
    grp = ", ".join(f'd."{c}"' for c in by)
    ties = ", ".join(f"{c.lower()} ASC NULLS LAST" for c in by)
    return f"""
SELECT {cols},
       COUNT(*) AS {count_name},
       {_AVG_ARR} AS avg_arrival_delay,
       {_DELAY_PCT} AS delay_pct
FROM gold f JOIN {dim} d ON f."{key}" = d."IATA_CODE"
GROUP BY {grp}
ORDER BY {order} DESC NULLS LAST, {ties}
"""


_AIRLINE_BOARD = _leaderboard("airlines", "AIRLINE_CODE", ["AIRLINE"], "num_flights", "avg_arrival_delay")
_AIRPORT_BOARD = _leaderboard("airports", "ORIGIN_AIRPORT", ["AIRPORT", "CITY", "STATE"], "num_departures", "delay_pct")


def _trend(where: str, period: str = "period", departure: bool = True) -> str:
    dep = f",\n       {_r2('AVG(DEPARTURE_DELAY)')} AS avg_departure_delay" if departure else ""
    return f"""
SELECT CAST(date_trunc('month', FLIGHT_DATE) AS DATE) AS {period},
       COUNT(*) AS num_flights,
       {_r2('AVG(ARRIVAL_DELAY)')} AS avg_arrival_delay{dep}
FROM gold f
WHERE {where}
GROUP BY 1
ORDER BY 1 NULLS LAST
"""


_DATE_RANGE = f"FLIGHT_DATE >= DATE '{TREND_FROM}' AND FLIGHT_DATE <= DATE '{TREND_TO}'"


def _causes(shares: bool) -> str:
    totals = [(label, _r2(f'SUM(COALESCE("{c}", 0))')) for label, c in CAUSES]
    branches = "\n  UNION ALL\n  ".join(
        f"SELECT {i} AS pos, '{label}' AS reason, {expr} AS total_minutes FROM raw_flights"
        for i, (label, expr) in enumerate(totals)
    )
    share = (
        f",\n       {_r2('total_minutes * 100.0 / NULLIF(SUM(total_minutes) OVER (), 0)')} AS share_pct"
        if shares
        else ""
    )
    return f"""
, causes AS (
  {branches}
)
SELECT reason, total_minutes{share}
FROM causes
ORDER BY pos
"""


def _null_profile() -> str:
    branches = "\n  UNION ALL\n  ".join(
        f"SELECT '{name}' AS column_name, CAST(COUNT(*) - COUNT(\"{name}\") AS BIGINT) AS null_count, "
        f"COUNT(*) AS n FROM raw_flights"
        for name in _RAW_EXPR
    )
    return f"""
, counts AS (
  {branches}
)
SELECT column_name, null_count, {_r2('null_count * 100.0 / n')} AS null_pct
FROM counts WHERE null_count > 0
ORDER BY column_name
"""


_OUT_OF_RANGE = (
    '("DEPARTURE_DELAY" IS NOT NULL AND ("DEPARTURE_DELAY" < -300 OR "DEPARTURE_DELAY" > 720)) OR '
    '("ARRIVAL_DELAY" IS NOT NULL AND ("ARRIVAL_DELAY" < -300 OR "ARRIVAL_DELAY" > 720))'
)


def _count_if(p: str) -> str:
    return f"CAST(SUM(CASE WHEN {p} THEN 1 ELSE 0 END) AS BIGINT)"


_SQL = {
    "bronze_flights": "SELECT * FROM raw_flights",
    "compose_date": 'SELECT "YEAR", "MONTH", "DAY", ' + _FLIGHT_DATE + ' AS "FLIGHT_DATE" FROM raw_flights',
    "neutralise_delays": 'SELECT "CANCELLED", '
    + 'CASE WHEN "CANCELLED" = 1 THEN CAST(0 AS DOUBLE) ELSE "DEPARTURE_DELAY" END AS "DEPARTURE_DELAY", '
    + 'CASE WHEN "CANCELLED" = 1 THEN CAST(0 AS DOUBLE) ELSE "ARRIVAL_DELAY" END AS "ARRIVAL_DELAY" FROM raw_flights',
    "silver_flights": "SELECT * FROM silver",
    "gold_fact": "SELECT * FROM gold",
    "fact_preview": "SELECT * FROM gold ORDER BY " + ", ".join(f'"{c}" ASC NULLS LAST' for c in FACT_COLUMNS) + " LIMIT 5",
    "csv_quarantine": "SELECT * REPLACE (CASE WHEN CAST(FLIGHT_NUMBER AS BIGINT) % 23 = 0 THEN NULL ELSE TAXI_IN END AS TAXI_IN), "
    "CAST(FLIGHT_NUMBER AS BIGINT) % 23 = 0 AS malformed FROM raw_flights",
    "invalid_dates": f'SELECT COUNT(*) AS total_rows, {_count_if("FLIGHT_DATE IS NULL")} AS invalid_dates FROM silver',
    "out_of_range": f"SELECT COUNT(*) AS total_rows, {_count_if(_OUT_OF_RANGE)} AS out_of_range FROM silver",
    "clean_metrics": f"SELECT COUNT(*) AS total_rows, {_count_if('FLIGHT_DATE IS NULL')} AS invalid_dates, "
    f"{_count_if(_OUT_OF_RANGE)} AS out_of_range FROM silver",
    "unmatched_count": f'SELECT {_count_if("AIRLINE_NAME IS NULL")} AS unmatched_rows, COUNT(*) AS total_rows FROM gold',
    "unmatched_codes": 'SELECT DISTINCT s."AIRLINE" AS airline_code FROM silver s '
    'WHERE NOT EXISTS (SELECT 1 FROM airlines a WHERE a."IATA_CODE" = s."AIRLINE")',
    "kpis": f"""
SELECT COUNT(*) AS total_flights,
       {_r2('AVG(ARRIVAL_DELAY)')} AS avg_arrival_delay,
       {_r2('AVG(DEPARTURE_DELAY)')} AS avg_departure_delay,
       {_r2(_RATE.format(p='ARRIVAL_DELAY > 15'))} AS delay_pct,
       {_r2(_RATE.format(p='CANCELLED = 1'))} AS cancel_pct,
       {_r2('100.0 - ' + _r2(_RATE.format(p='ARRIVAL_DELAY > 15')))} AS on_time_pct
FROM gold
""",
    "worst_airline": """
SELECT a."AIRLINE" AS airline
FROM gold f JOIN airlines a ON f.AIRLINE_CODE = a."IATA_CODE"
GROUP BY a."AIRLINE"
ORDER BY AVG(f.ARRIVAL_DELAY) DESC NULLS LAST, a."AIRLINE" ASC NULLS LAST
LIMIT 1
""",
    "airline_leaderboard": _AIRLINE_BOARD,
    "top10_airlines": _AIRLINE_BOARD + "LIMIT 10",
    "trend_monthly": _trend("TRUE", period="month", departure=False),
    "trend_filtered": _trend(
        f"AIRLINE_CODE IN ({_list(TREND_AIRLINES)}) AND ORIGIN_AIRPORT IN ({_list(TREND_AIRPORTS)}) AND {_DATE_RANGE}"
    ),
    "resolve_codes": _trend(
        f'AIRLINE_CODE IN (SELECT "IATA_CODE" FROM airlines WHERE "AIRLINE" IN ({_list(TREND_AIRLINE_NAMES)})) '
        f'AND ORIGIN_AIRPORT IN (SELECT "IATA_CODE" FROM airports WHERE "AIRPORT" IN ({_list(TREND_AIRPORT_NAMES)})) '
        f"AND {_DATE_RANGE}"
    ),
    "airport_leaderboard": _AIRPORT_BOARD,
    "top10_airports": f"""
SELECT *, concat(substr(airport, 1, 35), ' (', state, ')') AS label
FROM ({_AIRPORT_BOARD} LIMIT 10) t
""",
    "airport_map": f"""
SELECT d."IATA_CODE" AS iata_code, d."AIRPORT" AS airport, d."CITY" AS city, d."STATE" AS state,
       d."LATITUDE" AS latitude, d."LONGITUDE" AS longitude,
       COUNT(*) AS num_departures,
       {_AVG_ARR} AS avg_arrival_delay,
       {_DELAY_PCT} AS delay_pct
FROM gold f JOIN airports d ON f.ORIGIN_AIRPORT = d."IATA_CODE"
GROUP BY 1, 2, 3, 4, 5, 6
""",
    "date_bounds": "SELECT MIN(FLIGHT_DATE) AS min_date, MAX(FLIGHT_DATE) AS max_date FROM gold",
    "dim_airlines": 'SELECT "IATA_CODE" AS iata_code, "AIRLINE" AS airline FROM airlines '
    "ORDER BY airline NULLS LAST, iata_code NULLS LAST",
    "dim_airports": 'SELECT "IATA_CODE" AS iata_code, "AIRPORT" AS airport, "CITY" AS city, "STATE" AS state '
    "FROM airports ORDER BY airport NULLS LAST, iata_code, city, state",
    "layer_counts": """
SELECT 'bronze_flights' AS layer, COUNT(*) AS row_count FROM raw_flights
UNION ALL SELECT 'bronze_airlines', COUNT(*) FROM airlines
UNION ALL SELECT 'bronze_airports', COUNT(*) FROM airports
UNION ALL SELECT 'silver_flights', COUNT(*) FROM silver
UNION ALL SELECT 'gold_fact', COUNT(*) FROM gold
""",
}


_SQL["fact_rollup"] = f"""
SELECT FLIGHT_DATE, AIRLINE_CODE, ORIGIN_AIRPORT, COUNT(*) AS "ROW_COUNT",
       {_count_if("ARRIVAL_DELAY > 15")} AS "LATE_COUNT", {_count_if("CANCELLED = 1")} AS "CANCELLED_COUNT",
       SUM(ARRIVAL_DELAY) AS "ARRIVAL_DELAY_SUM", COUNT(ARRIVAL_DELAY) AS "ARRIVAL_DELAY_COUNT",
       SUM(DEPARTURE_DELAY) AS "DEPARTURE_DELAY_SUM", COUNT(DEPARTURE_DELAY) AS "DEPARTURE_DELAY_COUNT"
FROM gold GROUP BY 1, 2, 3
"""
# The same reports by other ways: from a rollup, as SQL functions.
_SAME = {
    "rollup_kpis": "kpis",
    "rollup_airline_leaderboard": "airline_leaderboard",
    "rollup_airport_map": "airport_map",
    "rollup_trend": "trend_filtered",
    "sql_trend": "resolve_codes",
    "sql_kpis": "kpis",
    "sql_airline_leaderboard": "airline_leaderboard",
}
_SQL |= {new: _SQL[old] for new, old in _SAME.items()}
_SQL["sql_top_airports"] = f"""
SELECT * FROM (
  SELECT CAST(row_number() OVER (ORDER BY delay_pct DESC NULLS LAST, airport NULLS LAST, city NULLS LAST, state NULLS LAST) AS INTEGER) AS place,
         *, concat(substr(airport, 1, 35), ' (', state, ')') AS label
  FROM ({_AIRPORT_BOARD}) t
) ranked WHERE place <= 10
"""
_FOOTERS = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, MIN({key}) AS min_key, MAX({key}) AS max_key FROM {t}"
    for t, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey"), ("customer", "c_custkey"), ("supplier", "s_suppkey"))
)


def _build() -> dict[str, str]:
    out = {k: _with(v) for k, v in _SQL.items()}
    out["footer_bounds"] = _FOOTERS
    out["delay_causes"] = f"WITH {LAYERS.strip()}{_causes(False)}"
    out["delay_cause_shares"] = f"WITH {LAYERS.strip()}{_causes(True)}"
    out["null_profile"] = f"WITH {LAYERS.strip()}{_null_profile()}"
    return out


ORACLE_SQL: dict[str, str] = _build()
