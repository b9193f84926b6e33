"""The whole chain from CSV files, twice, against the registered queries."""

import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tierline.plans import pipeline as P
from tierline.schemas import CONTRACTS
from tierline.sources import testview as V

from .conftest import SF001


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    work = tmp_path_factory.mktemp("lake")
    src = {}
    for name, df in [("flights", V.flights_raw(spark, SF001)), ("airlines", V.airlines(spark, SF001)),
                     ("airports", V.airports(spark, SF001))]:
        p = str(work / "csv" / name)
        df.write.option("header", "true").csv(p)
        src[name] = p
    base = f"file:{work}/lake"
    first = P.run_all(spark, base, src, log=lambda s: None)
    second = P.run_all(spark, base, src, log=lambda s: None, keep_versions=1)
    return base, first, second


def _counts(r):
    return ([(b["dataset"], b["rows_written"]) for b in r["bronze"]], r["silver"]["rows"], r["gold"]["rows"])


def test_run_all_is_repeatable(lake):
    _, first, second = lake
    assert _counts(first) == _counts(second)
    assert first["silver"]["location"] != second["silver"]["location"]
    # retention removed the first run's versions; a quarantine is part of its raw version
    gone = [first[k]["location"] for k in ("silver", "gold", "rollup")] + [first["gold"]["unmatched_codes_location"]]
    assert sorted(second["vacuum"]) == sorted(gone + [b["location"] for b in first["bronze"]])


def test_stage_metrics_match_fixture(lake):
    _, first, _ = lake
    flights = [b for b in first["bronze"] if b["dataset"] == "flights"][0]
    assert flights["rows_read"] == 6000 and flights["malformed"] == 0
    nulls = {n["column_name"]: n["null_count"] for n in flights["nulls"]}
    assert nulls["DAY"] == 49 and nulls["TAIL_NUMBER"] == 182 and nulls["DEPARTURE_DELAY"] == 131
    assert first["silver"]["invalid_dates"] == 157 and first["silver"]["out_of_range"] == 653
    assert first["gold"]["unmatched"] == 125 and first["gold"]["unmatched_codes"] == 1
    assert first["gold"]["unmatched_codes_location"]


def test_registered_tables_equal_the_derived_layers(spark, lake):
    q = E.queries()
    for table, key in [("bronze.flights", "bronze_flights"), ("silver.flights", "silver_flights"),
                       ("gold.fact_flights_delay", "gold_fact")]:
        written = spark.table(table)
        derived = q[key](spark, SF001)
        assert written.columns == derived.columns
        assert written.exceptAll(derived).count() == 0 and derived.exceptAll(written).count() == 0


def test_reports_over_the_written_fact(spark, lake):
    from tierline.operators import reports as R

    fact = spark.table("gold.fact_flights_delay")
    k = R.kpis(fact).first()
    assert (k.total_flights, k.avg_arrival_delay, k.delay_pct) == (6000, 216.51, 64.62)
    assert R.worst_airline(fact, spark.table("bronze.airlines")).first()[0] == "Supplier#000000009"


def test_ingest_refuses_nulls_in_not_null_columns(spark, tmp_path):
    p = tmp_path / "airlines.csv"
    p.write_text("IATA_CODE,AIRLINE\nAA,Air A\n,Nameless\n")
    with pytest.raises(P.ContractViolation):
        P.ingest(spark, f"file:{tmp_path}/lake", "airlines", str(p), log=lambda s: None)


def test_malformed_flight_rows_go_to_quarantine(spark, tmp_path):
    p = tmp_path / "airlines.csv"
    p.write_text("IATA_CODE,AIRLINE\nAA,Air A\nBB,Air B,EXTRA\n")
    r = P.ingest(spark, f"file:{tmp_path}/lake", "airlines", str(p), log=lambda s: None)
    assert r["malformed"] == 1 and r["rows_written"] == 2
    assert spark.table("bronze._quarantine_airlines").count() == 1


def test_malformed_rows_split_in_one_write(spark, tmp_path):
    p = tmp_path / "airports.csv"
    p.write_text(
        "IATA_CODE,AIRPORT,CITY,STATE,COUNTRY,LATITUDE,LONGITUDE\n"
        "A1,One,C,S,US,1.0,2.0\nA2,Two,C,S,US,north,2.0\nA3,Three\nA4,Four,C,S,US,,\n"
    )
    r = P.ingest(spark, f"file:{tmp_path}/lake", "airports", str(p), log=lambda s: None)
    assert (r["rows_read"], r["malformed"], r["rows_written"]) == (4, 2, 4)
    q = sorted(x["_corrupt_record"] for x in spark.table("bronze._quarantine_airports").collect())
    assert q == ["A2,Two,C,S,US,north,2.0", "A3,Three"]
    r2 = P.ingest(spark, f"file:{tmp_path}/lake2", "airports", str(p), keep_malformed=False, log=lambda s: None)
    assert r2["rows_written"] == 2
    assert spark.table("bronze.airports").count() == 2 and spark.table("bronze._quarantine_airports").count() == 2
    assert spark.table("bronze.airports").columns == CONTRACTS["airports"].names
    # a fresh registration from storage finds the quarantine too
    spark.sql("DROP TABLE bronze.airports")
    from tierline.sources.catalog import register_layers

    spark.sql("DROP TABLE bronze._quarantine_airports")
    got = {r["table"]: r["status"] for r in register_layers(spark, f"file:{tmp_path}/lake")}
    assert got["bronze._quarantine_airports"] == got["bronze.airports"] == "registered"
    assert spark.table("bronze._quarantine_airports").count() == 2 and spark.table("bronze.airports").count() == 4


def test_not_null_violation_publishes_nothing(spark, tmp_path):
    base = f"file:{tmp_path}/lake"
    good = tmp_path / "good.csv"
    good.write_text("IATA_CODE,AIRLINE\nAA,Air A\n")
    P.ingest(spark, base, "airlines", str(good), log=lambda s: None)
    before = spark.table("bronze.airlines").collect()
    bad = tmp_path / "bad.csv"
    bad.write_text("IATA_CODE,AIRLINE\nBB,\n")
    with pytest.raises(P.ContractViolation):
        P.ingest(spark, base, "airlines", str(bad), log=lambda s: None)
    assert spark.table("bronze.airlines").collect() == before


def test_stages_as_separate_processes(spark, tmp_path):
    """Each stage in its own process: hand-over through storage, schema enforced across sessions."""
    import subprocess
    import sys

    from .conftest import ROOT

    src = {}
    for name, df in [("airlines", V.airlines(spark, SF001)), ("airports", V.airports(spark, SF001)),
                     ("flights", V.flights_raw(spark, SF001))]:
        p = str(tmp_path / "csv" / name)
        df.write.option("header", "true").csv(p)
        src[name] = p
    base = f"file:{tmp_path}/lake"
    env_args = ["--base", base]

    def run(*args):
        return subprocess.run([sys.executable, "-m", "tierline", *args, *env_args], cwd=ROOT,
                              capture_output=True, text=True, timeout=300)

    r = run("raw", *[f"--source={k}={v}" for k, v in src.items()])
    assert r.returncode == 0, r.stderr[-2000:]
    # the whole chain in one process, with retention: earlier versions are removed
    r = run("all", *[f"--source={k}={v}" for k, v in src.items()], "--keep-versions", "1")
    assert r.returncode == 0, r.stderr[-2000:]
    summary = json.loads(r.stdout.strip().splitlines()[-1])
    assert summary["gold"]["rows"] == 6000 and len(summary["vacuum"]) == 3  # the first raw versions
    for stage in ("clean", "fact"):
        r = run(stage)
        assert r.returncode == 0, r.stderr[-2000:]
    r = run("register")  # an in-memory catalog would keep nothing
    assert r.returncode != 0 and "in-memory catalog ends with this process" in r.stderr
    from tierline.sources.layers import current_version

    fact = spark.read.parquet(current_version(spark, base, "gold", "fact_flights_delay"))
    assert fact.count() == 6000
    # a drifted raw file is refused by a fresh process too
    bad = tmp_path / "csv" / "airlines_v2.csv"
    bad.write_text("IATA_CODE,AIRLINE,EXTRA\nAA,Air A,x\n")
    r = subprocess.run([sys.executable, "-c", (
        "import sys; from tierline.session import build_session; from tierline.sources.layers import write_layer;"
        f"s = build_session('t', base_uri='{base}');"
        "df = s.createDataFrame([('AA', 'Air A', 'x')], 'IATA_CODE string, AIRLINE string, EXTRA string');"
        f"write_layer(df, '{base}', 'bronze', 'airlines')")], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert r.returncode != 0 and "SchemaMismatchError" in r.stderr


def test_sql_over_registered_tables(spark, lake):
    """SQL text with bound values over the registered layers agrees with the report operators."""
    from tierline.functions.filters import FactFilter
    from tierline.operators import reports as R
    from tierline.sources.catalog import query, register_layers

    base, _, _ = lake
    register_layers(spark, base)  # other tests point the session catalog elsewhere
    sql = """
        SELECT a.airline AS airline,
               COUNT(*) AS num_flights,
               ROUND(AVG(f.arrival_delay), 2) AS avg_arrival_delay,
               ROUND(CAST(COUNT_IF(f.arrival_delay > 15) AS DOUBLE) * 100 / COUNT(*), 2) AS delay_pct
        FROM gold.fact_flights_delay f
        JOIN bronze.airlines a ON f.airline_code = a.iata_code
        WHERE f.flight_date >= :since
        GROUP BY a.airline
    """
    got = {tuple(r) for r in query(spark, sql, {"since": "1997-01-01"}).collect()}
    fact = FactFilter(date_from="1997-01-01").apply(spark.table("gold.fact_flights_delay"))
    want = {tuple(r) for r in R.airline_leaderboard(fact, spark.table("bronze.airlines")).collect()}
    assert got == want and len(got) > 0


def test_layer_row_counts_over_registered_tables(spark, lake):
    from tierline.sources.catalog import layer_row_counts, register_layers

    base, _, _ = lake
    register_layers(spark, base)
    got = {r.layer: r.row_count for r in layer_row_counts(spark).collect()}
    assert got == {"bronze_airlines": 10, "bronze_airports": 25, "bronze_flights": 6000,
                   "silver_flights": 6000, "gold_fact_flights_delay": 6000}


def test_extra_raw_column_flows_through_and_needs_overwrite_schema(spark, tmp_path):
    """U3 + S6: an extra raw column warns and flows into the clean layer; the changed shape is refused
    by schema enforcement unless overwrite_schema is set, and the fact projection drops it."""
    from tierline.sources.layers import SchemaMismatchError, write_layer

    base = f"file:{tmp_path}/lake"
    raw = V.flights_raw(spark, SF001)
    write_layer(raw, base, "bronze", "flights")
    write_layer(V.airlines(spark, SF001), base, "bronze", "airlines")
    P.run_silver(spark, base, log=lambda s: None)
    write_layer(raw.withColumn("EXTRA", F.lit("x")), base, "bronze", "flights", overwrite_schema=True)
    warnings = []
    with pytest.raises(SchemaMismatchError):
        P.run_silver(spark, base, log=warnings.append)
    assert any("EXTRA" in w for w in warnings)
    P.run_silver(spark, base, log=lambda s: None, overwrite_schema=True)
    assert spark.table("silver.flights").columns[-2:] == ["EXTRA", "FLIGHT_DATE"]  # date appended last
    P.run_gold(spark, base, log=lambda s: None)
    assert "EXTRA" not in spark.table("gold.fact_flights_delay").columns


def test_dashboard_datasets_over_registered_tables(spark, lake):
    from tierline.operators import reports as R
    from tierline.sources.catalog import register_layers

    base, _, _ = lake
    register_layers(spark, base)
    t = spark.table
    d = R.dashboard(t("gold.fact_flights_delay"), t("bronze.airlines"), t("bronze.airports"), t("bronze.flights"),
                    airline_names=["Supplier#000000001", "Supplier#000000002", "Supplier#000000003"],
                    airport_names=["NATION_3", "NATION_15", "NATION_16", "NATION_20", "NATION_21"],
                    date_from="1996-02-10", date_to="1999-12-31")
    assert d["kpis"].first().total_flights == 6000
    assert d["worst_airline"].first()[0] == "Supplier#000000009"
    assert d["trend"].count() == 47           # the filtered trend of FIXTURES D
    assert d["top10_airlines"].count() == 10 and d["delay_causes"].count() == 5
    assert d["airports"].count() == 25 and d["airport_map"].count() == 10  # only origins with departures


RETRY_SCRIPT = r"""
import sys
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F, types as T
from tierline.sources.layers import write_layer

spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.sparkContext.setLogLevel("OFF")

@F.udf(T.LongType())
def flaky(x):  # test-only fault injection: every task's first attempt dies
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    return x

base = sys.argv[1]
df = spark.range(0, 1000, 1, 4).select(flaky("id").alias("id"))
m = write_layer(df, base, "t_retry", "tab", metrics=[F.sum("id").alias("total")])
t = spark.table("t_retry.tab")
print("RESULT", m["rows"], m["total"], t.count(), t.agg(F.sum("id")).first()[0])
"""


def test_layer_write_survives_task_retries(tmp_path):
    """Every task fails once and is retried: the written rows and observed metrics stay exact."""
    import subprocess
    import sys

    from .conftest import ROOT

    r = subprocess.run([sys.executable, "-c", RETRY_SCRIPT, f"file:{tmp_path}/lake"], cwd=ROOT,
                       capture_output=True, text=True, timeout=300)
    line = [l for l in r.stdout.splitlines() if l.startswith("RESULT")]
    assert line, r.stderr[-3000:]
    assert line[0].split()[1:] == ["1000", "499500", "1000", "499500"]


def test_fact_filters_push_to_the_scan_and_files_are_date_ordered(spark, lake):
    import glob

    import pyarrow.parquet as pq

    from tierline.functions.filters import FactFilter
    from tierline.operators import reports as R
    from tierline.sources.catalog import register_layers

    base, _, second = lake
    register_layers(spark, base)
    flt = FactFilter(airlines=["1", "2"], date_from="1996-02-10", date_to="1999-12-31")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # print scan metadata whole
    try:
        plan = R.trend(spark.table("gold.fact_flights_delay"), flt)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = [l for l in plan.splitlines() if "PushedFilters" in l][0]
    assert "GreaterThanOrEqual(FLIGHT_DATE" in pushed and "LessThanOrEqual(FLIGHT_DATE" in pushed
    assert "In(AIRLINE_CODE" in pushed
    # rows are sorted by date inside every written file (narrow row-group statistics)
    files = glob.glob(second["gold"]["location"].replace("file:", "") + "/*.parquet")
    assert files
    for f in files:
        dates = [d for d in pq.read_table(f, columns=["FLIGHT_DATE"]).column(0).to_pylist() if d is not None]
        assert dates == sorted(dates)


def test_stage_writes_do_not_sample(spark, lake, tmp_path):
    """Ingest and clean are narrow; the fact's own write deals its rows out by one exchange that needs no sampling."""
    from tierline.operators import transforms as T
    from tierline.schemas import FLIGHTS
    from tierline.sources import csv as C
    from tierline.sources.catalog import register_layers

    base, _, _ = lake
    register_layers(spark, base)
    csv_dir = str(tmp_path / "flights")
    V.flights_raw(spark, SF001).limit(100).write.option("header", "true").csv(csv_dir)
    stages = {
        "ingest": C.read_csv(spark, csv_dir, FLIGHTS),
        "clean": T.clean(spark.table("bronze.flights")),
        "enrich": P.fact_rows(spark, base, 8),  # what run_gold writes
    }
    for name, df in stages.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        for shuffle in ("Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
                        "Exchange RoundRobinPartitioning"):
            assert shuffle not in plan, (name, shuffle)
        assert plan.count("Exchange shufflepartitionid") == (name == "enrich"), name
    assert "BroadcastHashJoin" in stages["enrich"]._jdf.queryExecution().executedPlan().toString()


def test_layer_shapes_match_the_declared_contracts(spark, lake):
    """Clean layer: 29 columns in contract order with FLIGHT_DATE last; fact: the 9 projected columns."""
    from tierline.schemas import FACT_COLUMNS, FLIGHTS_SCHEMA, SILVER_FLIGHTS_SCHEMA
    from tierline.sources.catalog import register_layers

    def shape(schema):
        return [(f.name, f.dataType.simpleString()) for f in schema.fields]

    base, _, _ = lake
    register_layers(spark, base)
    assert shape(spark.table("bronze.flights").schema) == shape(FLIGHTS_SCHEMA)
    assert shape(spark.table("silver.flights").schema) == shape(SILVER_FLIGHTS_SCHEMA)
    assert len(SILVER_FLIGHTS_SCHEMA.fields) == 29
    assert shape(E.queries()["silver_flights"](spark, SF001).schema) == shape(SILVER_FLIGHTS_SCHEMA)
    assert spark.table("gold.fact_flights_delay").columns == list(FACT_COLUMNS)


def test_a_clean_ingest_empties_the_quarantine(spark, tmp_path):
    p, base = tmp_path / "airlines.csv", f"file:{tmp_path}/it's a lake"
    p.write_text("IATA_CODE,AIRLINE\nAA,Air A\nBB,Air B,EXTRA\n")
    P.ingest(spark, base, "airlines", str(p), log=lambda s: None)
    assert spark.table("bronze._quarantine_airlines").count() == 1
    p.write_text("IATA_CODE,AIRLINE\nAA,Air A\n")
    r = P.ingest(spark, base, "airlines", str(p), log=lambda s: None)
    assert r["malformed"] == 0 and spark.table("bronze._quarantine_airlines").count() == 0


def test_a_version_counts_only_after_validation(spark, tmp_path):
    from tierline.sources.layers import current_version, write_layer

    base = f"file:{tmp_path}/lake"
    old = write_layer(spark.range(3), base, "t_commit", "tab")["location"]
    seen = []

    def doomed(_):
        seen.append(current_version(spark, base, "t_commit", "tab"))
        raise ValueError("not valid")

    with pytest.raises(ValueError, match="not valid"):
        write_layer(spark.range(9), base, "t_commit", "tab", validate=doomed)

    def crash(_):
        raise KeyboardInterrupt  # the process ends without any clean-up

    with pytest.raises(KeyboardInterrupt):
        write_layer(spark.range(9), base, "t_commit", "tab", validate=crash)
    assert seen == [old] and current_version(spark, base, "t_commit", "tab") == old


def test_every_unmatched_code_is_reported_and_the_fact_prunes_by_date(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    from tierline.schemas import SILVER_FLIGHTS_SCHEMA
    from tierline.sources.layers import write_layer

    base = f"file:{tmp_path}/lake"
    rows = spark.range(6000).selectExpr(
        *[
            {
                "AIRLINE": "if(id % 10 = 0, concat('Q', id % 300), 'AA') as AIRLINE",
                "FLIGHT_DATE": "date_add(date'2015-01-01', cast(id % 365 as int)) as FLIGHT_DATE",
                "FLIGHT_NUMBER": "cast(id as string) as FLIGHT_NUMBER",
            }.get(f.name, f"cast(null as {f.dataType.simpleString()}) as {f.name}")
            for f in SILVER_FLIGHTS_SCHEMA.fields
        ]
    )
    write_layer(rows, base, "silver", "flights", overwrite_schema=True)
    write_layer(spark.createDataFrame([("AA", "Air A")], "IATA_CODE string, AIRLINE string"), base, "bronze", "airlines", overwrite_schema=True)
    m = P.run_gold(spark, base, log=lambda s: None, overwrite_schema=True, files=8)
    codes = spark.read.parquet(m["unmatched_codes_location"]).collect()
    assert len(codes) == m["unmatched_codes"] == 30 and sum(r["rows"] for r in codes) == m["unmatched"] == 600
    met = 0
    files = glob.glob(m["location"].replace("file:", "") + "/*.parquet")
    for f in files:
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index("FLIGHT_DATE")
        stats = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
        met += any(str(s.min) <= "2015-06-30" and str(s.max) >= "2015-06-01" for s in stats if s)
    assert len(files) >= 6 and met <= 2  # one month meets the statistics of one or two files
