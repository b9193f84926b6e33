"""Every registered query against its SQL oracle in DuckDB (row count, columns, values)."""

import datetime as dt
import os

import duckdb
import pytest

import __spark_entry__ as E
from tierline.plans.oracle import ORACLE_SQL
from tierline.plans.queries import QUERIES

from .conftest import SF001

TABLES = ["region", "nation", "customer", "supplier", "orders", "lineitem"]


def _norm(v):
    if isinstance(v, float):
        return repr(v)  # exact: the oracle reproduces Spark's rounding bit for bit
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF001, t + '.parquet')}')")
    return c


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES) <= set(E.queries())
    assert set(ORACLE_SQL) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF001)
    got = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLE_SQL[key])
    want = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, got) == _rows(rel.columns, want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["airline", "num_flights", "avg_arrival_delay", "delay_pct"]
    assert df.count() > 0


JOIN_HEAVY = ["gold_fact", "airline_leaderboard", "airport_map", "unmatched_codes", "resolve_codes",
              "worst_airline", "top10_airports", "layer_counts"]


@pytest.mark.parametrize("key", JOIN_HEAVY)
def test_results_do_not_depend_on_join_strategy(spark, con, key):
    """Shuffle joins everywhere (no broadcast, no adaptive re-planning): same rows as the oracle."""
    conf = {"tierline.broadcast.maxRows": "0", "spark.sql.adaptive.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    saved = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = QUERIES[key](spark, SF001)
        got = [tuple(r) for r in df.collect()]
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    # The ten codes of this table hold a tenth of the rows each: a dimension beyond the bound has the
    # rows of such codes broadcast, and the rest shuffled.
    assert ("BroadcastHashJoin" in plan) == (key == "gold_fact") == ("ShuffledHashJoin" in plan)
    rel = con.sql(ORACLE_SQL[key])
    assert _rows(df.columns, got) == _rows(rel.columns, rel.fetchall())
