"""Column functions on the edge rows of FIXTURES section C."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from tierline.functions import measures as M
from tierline.functions.dates import compose_date
from tierline.operators import quality as Q
from tierline.operators import transforms as T

YMD = StructType([StructField(n, IntegerType()) for n in ("YEAR", "MONTH", "DAY")])


def test_compose_date_edges(spark):
    rows = [
        ((2015, 1, 5), dt.date(2015, 1, 5)),
        ((2015, 13, 5), None),
        ((2015, 2, 30), None),
        ((2015, 1, 0), None),
        ((15, 1, 1), None),
        ((2015, 123, 1), dt.date(2015, 12, 1)),  # lpad truncates to two characters
        ((None, 1, 5), None),
        ((2015, None, 5), None),
        ((2015, 1, None), None),
        ((12015, 1, 1), None),
    ]
    df = spark.createDataFrame([r for r, _ in rows], YMD)
    got = [r[0] for r in df.select(compose_date("YEAR", "MONTH", "DAY")).collect()]
    assert got == [e for _, e in rows]


def test_compose_date_equals_pattern_parse_brute_force(spark):
    import itertools

    from tierline.functions.dates import compose_date_by_pattern

    ys = [0, 1, 15, 999, 1000, 1582, 1900, 2000, 2015, 2016, 9999, 10000, 12015, None]
    ms = [-12, -1, 0, 1, 2, 9, 10, 11, 12, 13, 20, 99, 100, 110, 123, 999, 1000, None]
    ds = [-5, -1, 0, 1, 9, 10, 28, 29, 30, 31, 32, 99, 100, 290, 310, None]
    df = spark.createDataFrame(list(itertools.product(ys, ms, ds)), YMD)
    out = df.select(compose_date("YEAR", "MONTH", "DAY").alias("f"), compose_date_by_pattern("YEAR", "MONTH", "DAY").alias("s"))
    assert out.filter(~F.col("f").eqNullSafe(F.col("s"))).count() == 0
    assert out.filter(F.col("s").isNotNull()).count() > 500


def test_compose_date_ignores_parser_policy(spark):
    df = spark.createDataFrame([(15, 1, 5), (999, 1, 5), (12015, 1, 5), (-2015, 1, 5), (2015, 1, 5)], YMD)
    for policy in ("EXCEPTION", "LEGACY", "CORRECTED"):
        spark.conf.set("spark.sql.legacy.timeParserPolicy", policy)
        try:
            got = [r[0] for r in df.select(compose_date("YEAR", "MONTH", "DAY")).collect()]
        finally:
            spark.conf.unset("spark.sql.legacy.timeParserPolicy")
        assert got == [None, None, None, None, dt.date(2015, 1, 5)], policy


def test_compose_date_strict_rejects_truncation(spark):
    df = spark.createDataFrame([(2015, 123, 1), (2015, 1, 5)], YMD)
    got = [r[0] for r in df.select(compose_date("YEAR", "MONTH", "DAY", strict=True)).collect()]
    assert got == [None, dt.date(2015, 1, 5)]


def test_neutralise_edges(spark):
    schema = StructType([StructField("CANCELLED", IntegerType()), StructField("D", DoubleType())])
    df = spark.createDataFrame([(1, 10.0), (1, None), (0, None), (None, 3.0)], schema)
    out = T.neutralise(df, ["D"])
    assert out.columns == ["CANCELLED", "D"]
    assert out.schema["D"].dataType == DoubleType()
    assert [r.D for r in out.collect()] == [0.0, 0.0, None, 3.0]


def test_out_of_range_bounds_inclusive(spark):
    schema = StructType([StructField("DEPARTURE_DELAY", DoubleType()), StructField("ARRIVAL_DELAY", DoubleType())])
    rows = [(-300.0, 0.0), (-301.0, 0.0), (720.0, 0.0), (721.0, 0.0), (None, None), (0.0, 800.0), (-400.0, 900.0)]
    df = spark.createDataFrame(rows, schema)
    flags = [r[0] for r in df.select(Q.out_of_range()).collect()]
    assert flags == [False, True, False, True, False, True, True]
    # one row with both delays out counts once
    assert df.filter(Q.out_of_range()).count() == 4


def test_rate_counts_all_rows_and_skips_null_predicates(spark):
    schema = StructType([StructField("ARRIVAL_DELAY", DoubleType())])
    df = spark.createDataFrame([(16.0,), (15.0,), (None,), (100.0,)], schema)
    row = df.agg(M.rate_pct(M.delayed()).alias("r"), M.mean("ARRIVAL_DELAY").alias("m")).first()
    assert row.r == 50.0  # 2 of 4 rows, the null row is in the denominator
    assert row.m == round((16 + 15 + 100) / 3, 2)


def test_measures_on_empty_input(spark):
    schema = StructType([StructField("ARRIVAL_DELAY", DoubleType()), StructField("CANCELLED", IntegerType())])
    df = spark.createDataFrame([], schema)
    row = df.agg(M.row_count().alias("n"), M.mean("ARRIVAL_DELAY").alias("m"),
                 M.rate_pct(M.delayed()).alias("r"), M.total("ARRIVAL_DELAY").alias("t")).first()
    assert (row.n, row.m, row.r, row.t) == (0, None, None, None)


def test_round_is_half_up(spark):
    df = spark.range(1).select(F.lit(1.005).alias("x"), F.lit(0.285).alias("y"))
    r = df.select(F.round("x", 2), F.round("y", 2)).first()
    assert tuple(r) == (1.01, 0.29)
