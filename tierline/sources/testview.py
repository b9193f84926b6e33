"""Flight-shaped tables derived from the TPC-H-like test tables.

The reference's flight file is not shipped, so every operator is exercised on a
view that Spark derives from ``lineitem``, ``orders``, ``supplier`` and
``customer`` (raw flights), ``supplier`` (airlines) and ``nation`` + ``region``
(airports).  The work grows with the test tables: one row of flights per
lineitem row.

Plan shape: ``orders`` is narrowed to the two keys needed and joined to
``customer``; ``lineitem`` joins that on the order key, then ``supplier``.  So
the largest table is shuffled at most once, by order key, and the order side
(not lineitem) carries the customer attribute.  Customer and supplier are
broadcast only behind a bounded row count (``operators.joins``); beyond it,
and for the lineitem-orders join, Spark shuffles and adaptive execution
re-plans from measured sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import join_dimension, maybe_broadcast_all
from ..schemas import AIRLINES_SCHEMA, AIRPORTS_SCHEMA, FLIGHTS_SCHEMA


# Types of the test-table columns the view reads.  Declaring them
# skips footer-based schema inference (a job per read) and reads only these
# columns.
READ_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in READ_SCHEMAS:
        reader = reader.schema(READ_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text(c: Column) -> Column:
    return c.cast("string")


def _dbl(c: Column) -> Column:
    return c.cast("double")


def _clock(k: int) -> str:
    return f"lpad(CAST((h + {k}) % 2400 AS STRING), 4, '0')"


# The flight columns of the test view (FIXTURES section D) as
# Spark SQL over the joined test rows.  ``h`` and ``cx`` are computed once
# per row in a first projection:
#   h  = l_partkey*37 + l_linenumber*13 + l_orderkey*7
#   cx = (l_returnflag = 'R' AND l_linenumber = 1)     -- a cancelled flight
# Every value is cast to the contract type afterwards.  Expression text goes
# to the JVM in one call (much cheaper to build than 31 Column trees).
FLIGHT_SQL = {
    "YEAR": "year(l_shipdate)",
    "MONTH": "CASE WHEN l_partkey % 89 = 0 THEN 13 ELSE month(l_shipdate) END",
    "DAY": "CASE WHEN l_orderkey % 97 = 0 THEN 31 WHEN l_orderkey % 101 = 0 THEN NULL "
    "ELSE dayofmonth(l_shipdate) END",
    "DAY_OF_WEEK": "l_orderkey % 7 + 1",
    "AIRLINE": "CASE WHEN l_partkey % 53 = 0 THEN 'ZZ' ELSE CAST(l_suppkey AS STRING) END",
    "FLIGHT_NUMBER": "CAST(l_orderkey AS STRING)",
    "TAIL_NUMBER": "CASE WHEN l_partkey % 37 = 0 THEN NULL ELSE concat('N', CAST(l_suppkey AS STRING)) END",
    "ORIGIN_AIRPORT": "CAST(s_nationkey AS STRING)",
    "DESTINATION_AIRPORT": "CAST(c_nationkey AS STRING)",
    "SCHEDULED_DEPARTURE": _clock(0),
    "DEPARTURE_TIME": f"CASE WHEN cx THEN NULL ELSE {_clock(10)} END",
    "DEPARTURE_DELAY": "CASE WHEN l_orderkey % 41 = 0 THEN NULL ELSE h % 1100 - 320 END",
    "TAXI_OUT": "l_linenumber * 3",
    "WHEELS_OFF": _clock(20),
    "SCHEDULED_TIME": "l_partkey % 300 + 30",
    "ELAPSED_TIME": "l_partkey % 300 + 35",
    "AIR_TIME": "l_partkey % 300 + 20",
    "DISTANCE": "l_partkey % 2500 + 50",
    "WHEELS_ON": _clock(30),
    "TAXI_IN": "l_linenumber * 2",
    "SCHEDULED_ARRIVAL": _clock(40),
    "ARRIVAL_TIME": _clock(50),
    "ARRIVAL_DELAY": "CASE WHEN l_orderkey % 43 = 0 THEN NULL ELSE (h * 3) % 1100 - 320 END",
    "DIVERTED": "CASE WHEN l_orderkey % 43 = 0 THEN 1 ELSE 0 END",
    "CANCELLED": "CASE WHEN cx THEN 1 ELSE 0 END",
    "CANCELLATION_REASON": "CASE WHEN cx THEN 'A' END",
    "AIR_SYSTEM_DELAY": "CASE WHEN l_returnflag = 'N' THEN l_orderkey % 60 END",
    "SECURITY_DELAY": "CASE WHEN l_orderkey % 50 = 0 THEN l_linenumber END",
    "AIRLINE_DELAY": "CASE WHEN l_linestatus = 'F' THEN l_quantity END",
    "LATE_AIRCRAFT_DELAY": "CASE WHEN l_linestatus = 'O' THEN l_partkey % 90 END",
    "WEATHER_DELAY": "CASE WHEN l_returnflag = 'A' THEN l_linenumber END",
}

ROW_HELPERS = (
    "l_partkey * 37 + CAST(l_linenumber AS BIGINT) * 13 + l_orderkey * 7 AS h",
    "(l_returnflag = 'R' AND l_linenumber = 1) AS cx",
)


def _typed(cols: dict[str, Column], schema) -> list[Column]:
    return [cols[f.name].cast(f.dataType).alias(f.name) for f in schema.fields]


def _typed_sql(exprs: dict[str, str], schema) -> list[str]:
    return [f"CAST({exprs[f.name]} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields]


def flights_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw flights: one row per lineitem row, the 31 contract columns."""
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey"
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"
    )
    customer, supplier = maybe_broadcast_all(customer, supplier)
    order_nation = orders.join(customer, "o_custkey").select(
        F.col("o_orderkey").alias("l_orderkey"), "c_nationkey"
    )
    # Both sides grow with the data: a shuffle join.  Adaptive execution turns
    # it into a broadcast when the measured order side is small, and splits a
    # skewed order key otherwise.
    rows = lineitem.join(order_nation, "l_orderkey")
    rows = rows.join(supplier, "l_suppkey")
    return rows.selectExpr("*", *ROW_HELPERS).selectExpr(*_typed_sql(FLIGHT_SQL, FLIGHTS_SCHEMA))


def airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = {"IATA_CODE": _text(F.col("s_suppkey")), "AIRLINE": F.col("s_name")}
    return table(spark, sf_dir, "supplier").select(*_typed(cols, AIRLINES_SCHEMA))


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), "r_name"
    )
    nk = F.col("n_nationkey")
    no_coords = nk % 8 == 0
    cols = {
        "IATA_CODE": _text(nk),
        "AIRPORT": F.col("n_name"),
        "CITY": F.col("r_name"),
        "STATE": _text(F.col("n_regionkey")),
        "COUNTRY": F.lit("X"),
        "LATITUDE": F.when(~no_coords, _dbl(nk * 2 - 25)),
        "LONGITUDE": F.when(~no_coords, _dbl(nk * 5 - 60)),
    }
    return join_dimension(nation, region, "n_regionkey").select(*_typed(cols, AIRPORTS_SCHEMA))
