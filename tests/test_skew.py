"""A key holding a third of all rows: results stay whole and exact on every join/aggregate path."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tierline.operators import quality as Q
from tierline.operators import reports as R
from tierline.operators import transforms as T
from tierline.operators.joins import MAX_ROWS_CONF

N = 3000


@pytest.fixture()
def skewed(spark):
    # row i: code "HOT" for a third of the rows, else one of 50 codes; a few unknown codes
    base = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT"))
        .when(F.col("id") % 97 == 0, F.lit("ZZ"))
        .otherwise((F.col("id") % 50).cast("string")).alias("AIRLINE"),
        F.lit(dt.date(2015, 1, 1)).alias("FLIGHT_DATE"),
        F.col("id").cast("string").alias("FLIGHT_NUMBER"),
        F.lit("X1").alias("ORIGIN_AIRPORT"),
        F.lit("X2").alias("DESTINATION_AIRPORT"),
        (F.col("id") % 40).cast("double").alias("DEPARTURE_DELAY"),
        (F.col("id") % 30).cast("double").alias("ARRIVAL_DELAY"),
        F.lit(0).alias("CANCELLED"),
    )
    dim = spark.range(50).select(F.col("id").cast("string").alias("IATA_CODE"),
                                 F.concat(F.lit("Air "), (F.col("id") % 7).cast("string")).alias("AIRLINE"))
    dim = dim.unionByName(spark.createDataFrame([("HOT", "Air Hot")], "IATA_CODE string, AIRLINE string"))
    return base, dim


def _expected(rows, names):
    out = {}
    for code, arr in rows:
        name = names.get(code)
        if name is None:
            continue
        n, s, late = out.get(name, (0, 0.0, 0))
        out[name] = (n + 1, s + arr, late + (arr > 15))
    return {k: (n, round(s / n, 2), round(late * 100.0 / n, 2)) for k, (n, s, late) in out.items()}


@pytest.mark.parametrize("broadcast", [True, False])
def test_hot_key_results_are_whole(spark, skewed, broadcast):
    clean, dim = skewed
    conf = {MAX_ROWS_CONF: "1000000" if broadcast else "0",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        fact = T.fact(clean, dim)
        assert fact.count() == N
        un = Q.unmatched_count(fact).first()
        assert un.unmatched_rows == len([i for i in range(N) if i % 3 != 0 and i % 97 == 0])
        got = {r.airline: (r.num_flights, r.avg_arrival_delay, r.delay_pct)
               for r in R.airline_leaderboard(fact, dim).collect()}
        rows = [(("HOT" if i % 3 == 0 else "ZZ" if i % 97 == 0 else str(i % 50)), float(i % 30)) for i in range(N)]
        names = {r.IATA_CODE: r.AIRLINE for r in dim.collect()}
        assert got == _expected(rows, names)
        assert got["Air Hot"][0] == N // 3
        codes = {r.airline_code for r in Q.unmatched_codes(clean, dim).collect()}
        assert codes == {"ZZ"}
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_hot_key_is_combined_map_side(spark, skewed):
    clean, dim = skewed
    plan = R.airline_leaderboard(T.fact(clean, dim), dim)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan or "partial_count" in plan


def test_boards_past_the_broadcast_bound_join_no_fact_rows(spark):
    """The fact side of a board is aggregated before any join, so no join meets the hot code's rows."""
    from tierline.plans.queries import QUERIES

    from .conftest import SF001

    spark.conf.set(MAX_ROWS_CONF, "0")
    try:
        for key in ("airline_leaderboard", "top10_airlines", "worst_airline", "kpis"):
            plan = QUERIES[key](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
            assert "LeftOuter" not in plan and "AIRLINE_NAME" not in plan, key
    finally:
        spark.conf.unset(MAX_ROWS_CONF)
