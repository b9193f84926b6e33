"""Physical plan shape of the registered queries."""

import pytest

from tierline.functions.filters import FactFilter
from tierline.operators import reports as R
from tierline.plans import queries as QS
from tierline.plans.oracle import ORACLE_SQL
from tierline.plans.queries import QUERIES

from .conftest import SF001


def _plan(df) -> str:
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString()


def _final_plan(df) -> str:
    df.collect()
    return _plan(df)


@pytest.fixture(scope="module")
def q():
    return QUERIES


def test_cause_report_scans_lineitem_once(spark, q):
    plan = _plan(q["delay_causes"](spark, SF001))
    assert plan.count("lineitem.parquet") == 1


def test_unmatched_codes_is_an_anti_join(spark, q):
    assert "LeftAnti" in _plan(q["unmatched_codes"](spark, SF001))


def test_gold_fact_broadcasts_the_checked_dimension(spark, q):
    assert "BroadcastHashJoin" in _final_plan(q["gold_fact"](spark, SF001))


def test_no_python_udf_anywhere(spark, q):
    for name, fn in q.items():
        plan = _plan(fn(spark, SF001))
        for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
            assert node not in plan, (name, node)


def test_leaderboard_aggregates_before_joining_the_dimension(spark, q):
    plan = _plan(q["airline_leaderboard"](spark, SF001))
    # partial + final aggregation by code below the dimension join, then by name
    assert plan.count("HashAggregate") >= 4


def test_scans_are_pruned(spark, q):
    plan = _plan(q["delay_causes"](spark, SF001))
    line = [l for l in plan.splitlines() if "lineitem.parquet" in l][0]
    assert "l_extendedprice" not in line and "l_shipdate" not in line


def test_filters_reach_the_scan(spark, q, tmp_path):
    path = str(tmp_path / "fact")
    QS.Layers(spark, SF001).measures().write.parquet(path)
    flt = FactFilter(QS.TREND_AIRLINES, QS.TREND_AIRPORTS, QS.TREND_FROM, QS.TREND_TO)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = _plan(R.trend(spark.read.parquet(path), flt))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = [l for l in plan.splitlines() if "PushedFilters" in l][0]
    for part in ("In(AIRLINE_CODE, [1,2,3])", "In(ORIGIN_AIRPORT, [", f"GreaterThanOrEqual(FLIGHT_DATE,{QS.TREND_FROM})", f"LessThanOrEqual(FLIGHT_DATE,{QS.TREND_TO})"):
        assert part in pushed, part
    assert "ReadSchema: struct<FLIGHT_DATE:date,AIRLINE_CODE:string,ORIGIN_AIRPORT:string,DEPARTURE_DELAY:double,ARRIVAL_DELAY:double>" in plan


LIMITED = {"top10_airlines", "top10_airports", "worst_airline", "fact_preview", "sql_top_airports"}  # the limit is the feature


def test_only_top_k_queries_cap_rows(spark, q):
    """No registered query caps, samples or filters its input to stay cheap; only top-k reports limit."""
    for name, fn in q.items():
        plan = _plan(fn(spark, SF001))
        capped = any(node in plan for node in ("GlobalLimit", "CollectLimit", "TakeOrderedAndProject", "Sample"))
        assert capped == (name in LIMITED), name
    for name, sql in ORACLE_SQL.items():
        assert ("LIMIT" in sql.upper() or "place <= 10" in sql) == (name in LIMITED), name


def test_every_query_reads_the_given_tables(spark, q):
    """Each registered query scans the test tables (no made-up or fixed input)."""
    tables = ("lineitem", "orders", "customer", "supplier", "nation", "region")
    for name, fn in q.items():
        plan = _plan(fn(spark, SF001))
        assert "LocalTableScan" not in plan and "LocalRelation" not in plan, name
        # reports from the rollup read the table that Spark has just derived from the given ones
        written = name.startswith("rollup_") and "/tierline-rollup/" in plan
        assert written or any(f"{SF001}/{t}.parquet" in plan for t in tables), name


def test_rollup_reports_read_no_flights(spark, q):
    for name in ("rollup_kpis", "rollup_airline_leaderboard", "rollup_airport_map", "rollup_trend"):
        assert "lineitem" not in _plan(q[name](spark, SF001)), name


def test_footer_query_reads_no_column(spark, q):
    plan = _plan(q["footer_bounds"](spark, SF001))
    assert plan.count("PushedAggregation: [COUNT(*), MIN(") == 4


def test_layer_counts_computes_the_flights_once(spark, q):
    """All three flight layers have the same rows: their scans and joins are one exchange, reused."""
    plan = _final_plan(q["layer_counts"](spark, SF001)).split("== Initial Plan ==")[0]
    assert plan.count("LocalTableScan") == 0 and plan.count("lineitem.parquet") == 1
