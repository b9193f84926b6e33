"""Enrichment, filters, reports and quality operators on hand-made edge rows."""

import datetime as dt

import pytest

from tierline.functions.filters import FactFilter, resolve_codes
from tierline.operators import quality as Q
from tierline.operators import reports as R
from tierline.operators import transforms as T
from tierline.operators.joins import fits_broadcast, join_dimension

FACT_DDL = ("FLIGHT_DATE date, AIRLINE_CODE string, AIRLINE_NAME string, FLIGHT_NUMBER string, "
            "ORIGIN_AIRPORT string, DESTINATION_AIRPORT string, DEPARTURE_DELAY double, "
            "ARRIVAL_DELAY double, CANCELLED int")
D1, D2 = dt.date(2015, 1, 5), dt.date(2015, 2, 7)


def _fact(spark, rows):
    return spark.createDataFrame(rows, FACT_DDL)


@pytest.fixture()
def airlines(spark):
    return spark.createDataFrame([("AA", "Air A"), ("BB", "Air B"), ("CC", "Air A")], "IATA_CODE string, AIRLINE string")


@pytest.fixture()
def airports(spark):
    return spark.createDataFrame(
        [("X1", "A very long airport name that goes past thirty five chars", "C1", "S1", "US", 1.0, 2.0),
         ("X2", "Short", "C2", None, "US", None, None)],
        "IATA_CODE string, AIRPORT string, CITY string, STATE string, COUNTRY string, LATITUDE double, LONGITUDE double",
    )


def _clean(spark, codes):
    return spark.createDataFrame([(c, i) for i, c in enumerate(codes)], "AIRLINE string, ID int")


def test_enrich_keeps_unmatched_and_null_codes(spark, airlines):
    out = T.enrich(_clean(spark, ["AA", "ZZ", None]), airlines).orderBy("ID").collect()
    assert [(r.AIRLINE_CODE, r.AIRLINE_NAME) for r in out] == [("AA", "Air A"), ("ZZ", None), (None, None)]


def test_enrich_duplicate_key_raises_or_fans_out(spark):
    dup = spark.createDataFrame([("AA", "x"), ("AA", "y"), ("BB", "z")], "IATA_CODE string, AIRLINE string")
    clean = _clean(spark, ["AA", "BB", "ZZ"])
    with pytest.raises(ValueError, match="not unique"):
        T.enrich(clean, dup)
    assert T.enrich(clean, dup, check_unique=False).count() == 4


def test_unmatched_count_and_codes(spark, airlines):
    clean = _clean(spark, ["AA", "ZZ", None, "ZZ", "BB"])
    fact = T.enrich(clean, airlines)
    row = Q.unmatched_count(fact).first()
    assert (row.unmatched_rows, row.total_rows) == (3, 5)
    codes = {r.airline_code for r in Q.unmatched_codes(clean, airlines).collect()}
    assert codes == {"ZZ", None}
    plan = Q.unmatched_codes(clean, airlines)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan


def test_filter_empty_lists_mean_all_and_dates_drop_null(spark):
    f = _fact(spark, [(D1, "AA", None, "1", "X1", "X2", 1.0, 1.0, 0),
                      (None, "BB", None, "2", "X2", "X1", 2.0, 2.0, 0)])
    assert FactFilter().apply(f).count() == 2
    assert FactFilter(airlines=["AA"]).apply(f).count() == 1
    assert FactFilter(date_from="2015-01-01").apply(f).count() == 1
    assert FactFilter(date_to=dt.date(2015, 1, 5)).apply(f).count() == 1
    assert FactFilter(date_to=dt.datetime(2015, 1, 5, 23, 0)).apply(f).count() == 1
    assert FactFilter(date_from="2015-01-06").apply(f).count() == 0


def test_resolve_codes_by_name(spark, airlines):
    f = _fact(spark, [(D1, c, None, "1", "X1", "X2", 1.0, 1.0, 0) for c in ["AA", "BB", "CC", "ZZ", None]])
    out = resolve_codes(f, airlines, ["Air A"], "AIRLINE_CODE")
    assert sorted(r.AIRLINE_CODE for r in out.collect()) == ["AA", "CC"]
    assert "LeftSemi" in out._jdf.queryExecution().executedPlan().toString()
    assert resolve_codes(f, airlines, [], "AIRLINE_CODE").count() == 5
    assert resolve_codes(f, airlines, ["Nobody"], "AIRLINE_CODE").count() == 0


def test_leaderboard_merges_codes_sharing_a_name(spark, airlines):
    f = _fact(spark, [
        (D1, "AA", None, "1", "X1", "X2", 0.0, 10.0, 0),
        (D1, "CC", None, "2", "X1", "X2", 0.0, 30.0, 0),
        (D1, "BB", None, "3", "X2", "X1", 0.0, 5.0, 0),
        (D1, "ZZ", None, "4", "X2", "X1", 0.0, 99.0, 0),
        (D1, "BB", None, "5", "X2", "X1", 0.0, None, 1),
    ])
    rows = [tuple(r) for r in R.airline_leaderboard(f, airlines).collect()]
    assert rows == [("Air A", 2, 20.0, 50.0), ("Air B", 2, 5.0, 0.0)]
    assert [r.airline for r in R.worst_airline(f, airlines).collect()] == ["Air A"]


def test_worst_group_on_empty_is_not_available(spark, airlines):
    assert [r.airline for r in R.worst_airline(_fact(spark, []), airlines).collect()] == ["N/A"]


def test_kpis(spark):
    f = _fact(spark, [(D1, "AA", None, "1", "X1", "X2", 5.0, 20.0, 0),
                      (D2, "AA", None, "2", "X1", "X2", 0.0, 0.0, 1),
                      (D2, "AA", None, "3", "X1", "X2", None, None, 0)])
    r = R.kpis(f).first()
    assert (r.total_flights, r.avg_arrival_delay, r.avg_departure_delay) == (3, 10.0, 2.5)
    assert (r.delay_pct, r.cancel_pct, r.on_time_pct) == (33.33, 33.33, 66.67)


def test_kpis_on_empty(spark):
    r = R.kpis(_fact(spark, [])).first()
    assert (r.total_flights, r.avg_arrival_delay, r.delay_pct, r.cancel_pct) == (0, None, None, None)


def test_trend_keeps_null_month_last(spark):
    f = _fact(spark, [(D1, "AA", None, "1", "X1", "X2", 1.0, 2.0, 0),
                      (None, "AA", None, "2", "X1", "X2", 3.0, 4.0, 0),
                      (D2, "AA", None, "3", "X1", "X2", 5.0, 6.0, 0)])
    got = [tuple(r) for r in R.trend(f).collect()]
    assert got == [(dt.date(2015, 1, 1), 1, 2.0, 1.0), (dt.date(2015, 2, 1), 1, 6.0, 5.0), (None, 1, 4.0, 3.0)]


def test_airport_label_and_map_points(spark, airports):
    f = _fact(spark, [(D1, "AA", None, "1", "X1", "X2", 1.0, 20.0, 0),
                      (D1, "AA", None, "2", "X2", "X1", 1.0, 2.0, 0)])
    top = {r.airport: r.label for r in R.top10_airports(f, airports).collect()}
    assert top["A very long airport name that goes past thirty five chars"] == "A very long airport name that goes  (S1)"
    assert top["Short"] is None  # a null state gives a null label
    pts = {r.iata_code: (r.latitude, r.num_departures) for r in R.map_points(f, airports).collect()}
    assert pts == {"X1": (1.0, 1), "X2": (None, 1)}


def test_cause_totals_and_shares(spark):
    raw = spark.createDataFrame(
        [(1.0, None, 2.0, 3.0, 4.0), (None, None, 2.0, 1.0, 4.0)],
        "AIRLINE_DELAY double, WEATHER_DELAY double, AIR_SYSTEM_DELAY double, LATE_AIRCRAFT_DELAY double, SECURITY_DELAY double",
    )
    got = {r.reason: (r.total_minutes, r.share_pct) for r in R.cause_totals(raw, shares=True).collect()}
    assert got == {"Airline Delay": (1.0, 5.88), "Weather Delay": (0.0, 0.0), "NAS Delay": (4.0, 23.53),
                   "Late Aircraft Delay": (4.0, 23.53), "Security Delay": (8.0, 47.06)}


def test_null_profile_omits_clean_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, None, "y")], "a int, b string, c string")
    got = [tuple(r) for r in Q.null_profile(df).collect()]
    assert got == [("a", 1, 50.0), ("b", 2, 100.0)]


def test_schema_drift(spark):
    assert Q.schema_drift(["A", "B", "X"], ["A", "B", "C"]) == {"missing": ["C"], "extra": ["X"]}
    from tierline.schemas import FLIGHTS
    df = spark.createDataFrame([(1,)], "YEAR int")
    with pytest.raises(Q.SchemaDriftError):
        Q.check_drift(df, FLIGHTS, warn=lambda s: None)


def test_layer_counts_and_preview(spark):
    a, b = spark.range(3), spark.range(5)
    assert {(r.layer, r.row_count) for r in Q.layer_counts([("a", a), ("b", b)]).collect()} == {("a", 3), ("b", 5)}
    assert Q.preview(b, 2).count() == 2


def test_broadcast_only_within_checked_bound(spark):
    small, big = spark.range(10), spark.range(100)
    assert fits_broadcast(small, 10) and not fits_broadcast(big, 10)
    saved = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan_small = join_dimension(big, small, "id", max_rows=10)._jdf.queryExecution().executedPlan().toString()
        plan_big = join_dimension(small, big, "id", max_rows=10)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert "BroadcastHashJoin" in plan_small
    assert "BroadcastHashJoin" not in plan_big and "SortMergeJoin" in plan_big


def test_one_decimal_rates(spark):
    f = _fact(spark, [(D1, "AA", None, str(i), "X1", "X2", 0.0, 20.0 if i < 2 else 0.0, 0) for i in range(3)])
    r = R.kpis(f, rate_digits=1).first()
    assert (r.delay_pct, r.on_time_pct, r.avg_arrival_delay) == (66.7, 33.3, 13.33)
    assert R.kpis(f, mean_digits=1).first().avg_arrival_delay == 13.3
    assert R.kpis(f).first().delay_pct == 66.67


def test_size_checks_are_fresh_and_no_funnel(spark, tmp_path):
    from tierline.operators import joins as J

    a = str(tmp_path / "a")
    spark.range(10).write.parquet(a)
    assert J.fits_broadcast(spark.read.parquet(a), 50) is True
    spark.range(1000).write.mode("overwrite").parquet(a)  # the same path with other content
    assert J.fits_broadcast(spark.read.parquet(a), 50) is False
    plan = J.dimension_size(spark.read.parquet(a))._jdf.queryExecution().executedPlan().toString()
    assert "Limit" not in plan and "partial_count" in plan
    wide = spark.range(20).selectExpr("id", "repeat('x', 100000) as v")
    spark.conf.set(J.MAX_BYTES_CONF, "1000000")
    try:
        assert J.fits_broadcast(wide, 50) is False  # few rows, many bytes
    finally:
        spark.conf.unset(J.MAX_BYTES_CONF)


def test_worst_group_of_nothing_is_not_available(spark, airlines):
    none = _fact(spark, [(D1, "ZZ", None, "1", "X1", "X2", 1.0, 1.0, 0)])
    assert [r.airline for r in R.worst_airline(none, airlines).collect()] == ["N/A"]


def test_empty_edges(spark):
    df = spark.range(3)
    assert Q.null_profile(df, []).count() == 0
    with pytest.raises(ValueError):
        Q.layer_counts([])
