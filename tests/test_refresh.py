"""The refresh in depth: one scan a stage, files that prune, records, resuming, the rollup and the footers."""

import glob
import json
import os
import subprocess
import sys
import textwrap

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tierline.functions.filters import FactFilter
from tierline.operators import layout as G
from tierline.operators import reports as R
from tierline.operators.rollup import build_rollup, choose, covers, merge_rollups
from tierline.plans import pipeline as P
from tierline.plans import queries as QS
from tierline.sources import footers, fs
from tierline.sources import testview as V
from tierline.sources.catalog import current_rollup, register_layers
from tierline.sources.layers import current_version, layer_location, read_record, version_name, versions, write_layer
from tierline.sources.report_functions import FUNCTIONS, register_report_functions

from .conftest import ROOT, SF001

QUIET = {"log": lambda s: None}


def _csvs(spark, folder):
    src = {}
    for name, df in [("flights", V.flights_raw(spark, SF001)), ("airlines", V.airlines(spark, SF001)), ("airports", V.airports(spark, SF001))]:
        src[name] = f"{folder}/csv/{name}"
        df.write.option("header", "true").csv(src[name])
    return src


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    work = tmp_path_factory.mktemp("refresh")
    src = _csvs(spark, work)
    base = f"file:{work}/lake"
    P.run_all(spark, base, src, **QUIET)
    return base, src


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- rollup ---------------------------------------------------------------------

def test_nine_reports_read_the_rollup_alone(spark, lake):
    base, _ = lake
    register_layers(spark, base)
    fact, airlines, airports, raw = (spark.table(t) for t in ("gold.fact_flights_delay", "bronze.airlines", "bronze.airports", "bronze.flights"))
    rollup = current_rollup(spark, base, max_share=1.0)
    args = dict(airline_names=QS.TREND_AIRLINE_NAMES, airport_names=QS.TREND_AIRPORT_NAMES, date_from=QS.TREND_FROM, date_to=QS.TREND_TO)
    plain, fast = (R.dashboard(fact, airlines, airports, raw, rollup=r, **args) for r in (None, rollup))
    on_fact = [k for k in plain if k not in ("airlines", "airports", "delay_causes")]
    assert len(on_fact) == 8  # with the top ten of airlines and airports, the nine reports of the dashboard
    for k in on_fact:
        assert "fact_flights_delay" in _plan(plain[k]), k
        assert "fact_flights_delay" not in _plan(fast[k]) and "rollup_flights_delay" in _plan(fast[k]), k
        assert sorted(map(str, plain[k].collect())) == sorted(map(str, fast[k].collect())), k
        assert plain[k].schema == fast[k].schema, k


def test_uncovered_questions_fall_back_to_the_fact(spark, lake):
    base, _ = lake
    register_layers(spark, base)
    fact, rollup = spark.table("gold.fact_flights_delay"), current_rollup(spark, base, max_share=1.0)
    covered = FactFilter(["1"], ["3"], "1996-01-01").to_column()
    uncovered = [F.col("CANCELLED") == 1, F.col("DESTINATION_AIRPORT") == "3", F.rand() < 0.5, F.expr("FLIGHT_NUMBER = '1' or FLIGHT_DATE is null")]
    assert covers(fact, rollup, ["airline_code", F.trunc("FLIGHT_DATE", "month")], covered) and covers(fact, rollup)
    assert not covers(fact, rollup, ["FLIGHT_NUMBER"]) and not any(covers(fact, rollup, where=w) for w in uncovered)
    for where in uncovered[:2] + uncovered[3:]:
        got = R.kpis(choose(fact, rollup, where=where))
        assert "fact_flights_delay" in _plan(got)
        assert got.collect() == R.kpis(fact.where(where)).collect()


def test_rollups_of_parts_merge_to_the_rollup_of_all(spark, lake):
    fact = V.flights_raw(spark, SF001).select(
        F.make_date(F.lit(1996), "MONTH", F.lit(1)).alias("FLIGHT_DATE"), F.col("AIRLINE").alias("AIRLINE_CODE"),
        F.when(F.col("ORIGIN_AIRPORT") != "3", F.col("ORIGIN_AIRPORT")).alias("ORIGIN_AIRPORT"), "FLIGHT_NUMBER", "CANCELLED", "ARRIVAL_DELAY", "DEPARTURE_DELAY",
    ).where("MONTH <= 12")
    odd = F.col("FLIGHT_NUMBER").cast("int") % 3
    whole = build_rollup(fact)
    parts = [build_rollup(fact.where(odd == i)) for i in range(3)]
    assert sorted(map(str, merge_rollups(*parts).collect())) == sorted(map(str, whole.collect()))
    assert whole.where("ORIGIN_AIRPORT is null").count() > 0
    empty = choose(fact, build_rollup(fact.limit(0)))
    assert R.kpis(empty).collect() == R.kpis(fact.limit(0)).collect()


def test_a_rollup_of_another_fact_is_not_handed_out(spark, lake, tmp_path):
    base, src = lake
    register_layers(spark, base)
    assert current_rollup(spark, base, max_share=1.0) is not None
    assert current_rollup(spark, base, max_share=0.01) is None  # not worth it here: hardly smaller than the fact
    P.run_gold(spark, base, **QUIET)
    assert current_rollup(spark, base, max_share=1.0) is None
    P.run_rollup(spark, base, **QUIET)
    assert current_rollup(spark, base, max_share=1.0) is not None


# -- SQL functions ------------------------------------------------------------------

def test_reports_are_functions_of_the_catalog(spark, lake, monkeypatch):
    base, _ = lake
    register_layers(spark, base)
    airlines, airports = spark.table("bronze.airlines"), spark.table("bronze.airports")
    want = R.dashboard(spark.table("gold.fact_flights_delay"), airlines, airports, spark.table("bronze.flights"))
    spark.sql("USE gold")
    for rollup in (False, True):
        assert register_report_functions(spark, rollup) == [f"gold.{n}" for n in FUNCTIONS]
        source = "rollup_flights_delay" if rollup else "fact_flights_delay"
        for name, report in [("kpis", "kpis"), ("worst_airline", "worst_airline"), ("airline_leaderboard", "airline_leaderboard"), ("trend", "trend"),
                             ("airport_map", "airport_map"), ("date_bounds", "date_bounds"), ("delay_causes", "delay_causes"), ("airline_list", "airlines")]:
            got = spark.sql(f"SELECT * FROM {name}()")
            assert sorted(map(str, got.collect())) == sorted(map(str, want[report].collect())), name
            assert name in ("delay_causes", "airline_list") or source in _plan(got)
        top = spark.sql("SELECT * FROM top_airports(n => 3) ORDER BY place")
        assert [tuple(r)[1:] for r in top.collect()] == [tuple(r) for r in want["top10_airports"].limit(3).collect()]
        assert spark.sql("SELECT count(*) FROM top_airlines()").first()[0] == 10
        some = spark.sql("SELECT sum(num_flights) FROM trend(airlines => array('Supplier#000000003'), date_to => DATE'1996-12-31')").first()[0]
        fact = spark.table("gold.fact_flights_delay")
        assert some == fact.where("AIRLINE_CODE = '3' and FLIGHT_DATE <= date'1996-12-31'").count()
        assert spark.sql("SELECT * FROM trend(airports => array('nowhere'))").count() == 0
    # a new fact re-points the view at once, its rollup does so again where it is small enough
    P.run_gold(spark, base, **QUIET)
    assert "fact_flights_delay" in _plan(spark.sql("SELECT * FROM kpis()"))
    monkeypatch.setattr(P, "current_rollup", lambda s, b: current_rollup(s, b, max_share=1.0))
    P.run_rollup(spark, base, **QUIET)
    assert "rollup_flights_delay" in _plan(spark.sql("SELECT * FROM kpis()"))
    spark.sql("USE default")


def test_arguments_reach_the_scan(spark, lake):
    base, _ = lake
    register_layers(spark, base)
    register_report_functions(spark, rollup=False)
    spark.sql("USE gold")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = _plan(spark.sql("SELECT * FROM trend(date_from => DATE'1996-02-10')"))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
        spark.sql("USE default")
    assert "GreaterThanOrEqual(FLIGHT_DATE,1996-02-10)" in plan


# -- layout -----------------------------------------------------------------------

N_ROWS = 40_000


def _flights(spark, hot=False):
    """Clean rows of 50 airlines, 80 airports and 365 days; with ``hot`` a third has one date, airline and origin."""
    from tierline.schemas import SILVER_FLIGHTS_SCHEMA

    mixed = lambda seed, n: F.pmod(F.xxhash64(F.col("id"), F.lit(seed)), F.lit(n))
    is_hot = F.lit(hot) & (F.col("id") % 3 == 0)
    values = {
        "FLIGHT_DATE": F.when(is_hot, F.lit("2015-07-01").cast("date")).otherwise(F.date_add(F.lit("2015-01-01").cast("date"), mixed(1, 365).cast("int"))),
        "AIRLINE": F.when(is_hot, F.lit("A7")).otherwise(F.concat(F.lit("A"), mixed(2, 50).cast("string"))),
        "ORIGIN_AIRPORT": F.when(is_hot, F.lit("P9")).otherwise(F.concat(F.lit("P"), mixed(3, 80).cast("string"))),
        "FLIGHT_NUMBER": F.col("id").cast("string"),
    }
    return spark.range(N_ROWS).select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in SILVER_FLIGHTS_SCHEMA.fields])


def _files(location):
    out = []
    for f in glob.glob(location.replace("file:", "") + "/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        names = meta.schema.names
        bounds = {}
        for c in ("FLIGHT_DATE", "AIRLINE_CODE", "ORIGIN_AIRPORT"):
            stats = [meta.row_group(i).column(names.index(c)).statistics for i in range(meta.num_row_groups)]
            bounds[c] = (min(str(s.min) for s in stats), max(str(s.max) for s in stats))
        out.append((meta.num_rows, bounds))
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_files_prune_by_every_dimension_and_hold_equal_shares(spark, tmp_path, hot):
    base = f"file:{tmp_path}/lake"
    write_layer(_flights(spark, hot), base, "silver", "flights", overwrite_schema=True)
    dim = spark.createDataFrame([(f"A{i}", f"Air {i}") for i in range(50)], "IATA_CODE string, AIRLINE string")
    write_layer(dim, base, "bronze", "airlines", overwrite_schema=True)
    m = P.run_gold(spark, base, overwrite_schema=True, files=64, **QUIET)
    files = _files(m["location"])
    assert sum(n for n, _ in files) == m["rows"] == N_ROWS and len(files) <= 64
    assert max(n for n, _ in files) <= 3 * N_ROWS / 64
    opened = lambda c, v: sum(n for n, b in files if b[c][0] <= v <= b[c][1]) / N_ROWS
    if not hot:
        for c, values in (("FLIGHT_DATE", ["2015-03-03", "2015-10-20"]), ("AIRLINE_CODE", ["A13", "A44"]), ("ORIGIN_AIRPORT", ["P20", "P71"])):
            assert all(opened(c, v) <= 0.5 for v in values), c
            assert sum(opened(c, v) for v in values) / 2 <= 0.4, c
    else:
        assert opened("FLIGHT_DATE", "2015-01-20") <= 0.5


def test_observed_and_counted_layouts_agree(spark, lake, monkeypatch):
    base, _ = lake
    register_layers(spark, base)
    assert f"{G.PREFIX}cells" not in read_record(spark, layer_location(spark, base, "silver", "flights"))["metrics"]  # one file's rows
    assert "shufflepartitionid" not in _plan(P.fact_rows(spark, base))
    monkeypatch.setattr(P, "FACT_FILE_ROWS", 1000)
    P.run_silver(spark, base, **QUIET)
    assert "shufflepartitionid" in _plan(P.fact_rows(spark, base))
    record = read_record(spark, layer_location(spark, base, "silver", "flights"))
    assert record["metrics"][f"{G.PREFIX}cells"] and record["options"]["cuts"]
    fact = spark.table("gold.fact_flights_delay")
    seen, rows = P.fact_layout(spark, base, fact)
    columns = {n: F.col(n) for n in P.FACT_DIMENSIONS}
    cells = seen.curve.with_cell(fact, columns, "c").groupBy("c").count().collect()
    assert rows == 6000 and all(0 <= r["c"] < seen.curve.cells for r in cells)
    # the observed quantiles are those of the cells, up to their accuracy
    flat = sorted(r["c"] for r in cells for _ in range(r["count"]))
    for i, q in enumerate(seen.cell_quantiles, 1):
        lo, hi = (flat[max(0, min(5999, int((i / G.CELL_QUANTILES + d) * 6000)))] for d in (-0.12, 0.12))  # of some 375 rows looked at
        assert lo <= q <= hi


def test_numbers_sort_like_their_values(spark):
    values = ["", "A", "A1", "AA", "B", "a", "ab", "abcdef", "Z", "é", "漢字", None]
    got = spark.createDataFrame([(v,) for v in values], "v string").select("v", G.number_of(F.col("v"), "text").alias("n")).collect()
    known = sorted((r["v"].encode(), r["n"]) for r in got if r["v"] is not None)
    assert [n for _, n in known] == sorted(n for _, n in known) and {r["n"] for r in got if r["v"] is None} == {None}


def test_spans_cover_all_files_in_curve_order():
    curve = G.Curve((("a", "date", ()),) * 3)
    layout = G.Layout(curve, tuple(sorted([5] * 200 + list(range(0, 4096, 14)))))
    for files in (1, 7, 64, 300):
        spans = layout.spans(files)
        assert all(0 <= a <= b < files for a, b in spans)
        assert all(x[0] <= y[0] and x[1] <= y[1] for x, y in zip(spans, spans[1:]))
        assert {k for a, b in spans for k in range(a, b + 1)} == set(range(files))
        assert spans[5][1] - spans[5][0] + 1 >= int(files * 200 / 493) - 1


# -- one scan a stage ------------------------------------------------------------------

SCRIPT = """
    import json, sys
    from tierline.plans import pipeline as P
    from tierline.session import build_session
    base, log = sys.argv[1], sys.argv[2]
    spark = build_session("scans", base_uri=base, master="local[2]", conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log,
        "spark.eventLog.compress": "false", "spark.sql.shuffle.partitions": "4"})
    quiet = lambda s: None
    P.FACT_FILE_ROWS = 1000  # so that the fact is dealt out
    P.run_bronze(spark, base, json.loads(sys.argv[3]), log=quiet, parallel=False)
    P.run_silver(spark, base, log=quiet)
    P.run_gold(spark, base, log=quiet, preview_rows=0)
    spark.stop()
"""


def test_every_stage_scans_its_input_once(spark, lake, tmp_path):
    """Rows that Spark's event log says were read, from a process of its own."""
    _, src = lake
    bad = tmp_path / "airlines.csv"
    rows = V.airlines(spark, SF001).collect()
    bad.write_text("IATA_CODE,AIRLINE\n" + "".join(f"{r[0]},{r[1]}\n" for r in rows) + "Q1,Air Q,EXTRA\n")
    os.mkdir(tmp_path / "log")
    args = [f"file:{tmp_path}/lake", f"file:{tmp_path}/log", json.dumps({**src, "airlines": str(bad)})]
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(SCRIPT), *args], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    names, read = {}, {}

    def walk(node):
        for m in node.get("metrics", []):
            if m["name"] == "number of output rows" and node["nodeName"].startswith("Scan"):
                names[m["accumulatorId"]] = (node["nodeName"].split()[1], node["metadata"].get("Location", ""))
        for child in node.get("children", []):
            walk(child)

    logs = [f for f in glob.glob(f"{tmp_path}/log/**", recursive=True) if os.path.isfile(f)]
    events = [json.loads(line) for f in logs for line in open(f) if line.startswith("{")]
    for e in events:
        if "sparkPlanInfo" in e:
            walk(e["sparkPlanInfo"])
    for e in events:
        if e["Event"] == "SparkListenerStageCompleted":
            for a in e["Stage Info"]["Accumulables"]:
                if a["ID"] in names:
                    read[names[a["ID"]]] = read.get(names[a["ID"]], 0) + int(a["Value"])
    by = lambda kind, part: sum(n for (k, at), n in read.items() if k == kind and part in at)
    assert by("csv", "flights") == 6000 and by("csv", "airlines.csv") == 11 and by("csv", "airports") == 25
    assert by("parquet", "bronze/flights") == 6000 and by("parquet", "silver/flights") == 6000


def test_a_source_may_go_right_after_its_scan(spark, tmp_path, monkeypatch):
    p, base = tmp_path / "airlines.csv", f"file:{tmp_path}/lake"
    p.write_text("IATA_CODE,AIRLINE\nAA,Air A\nBB,Air B,EXTRA\n")
    real = P.write_split

    def then_gone(df, *args, validate=None, **kw):
        def check(metrics):
            p.write_text("something else\n")  # the source changes before anything is published
            return validate(metrics)

        return real(df, *args, validate=check, **kw)

    monkeypatch.setattr(P, "write_split", then_gone)
    r = P.ingest(spark, base, "airlines", str(p), **QUIET)
    assert (r["rows_read"], r["malformed"], r["rows_written"]) == (2, 1, 2)
    assert [x["_corrupt_record"] for x in spark.table("bronze._quarantine_airlines").collect()] == ["BB,Air B,EXTRA"]
    assert {x["IATA_CODE"] for x in spark.table("bronze.airlines").collect()} == {"AA", "BB"}


# -- records and resuming -----------------------------------------------------------------

def _versions(spark, base):
    tables = [("bronze", "airlines"), ("bronze", "airports"), ("bronze", "flights"), ("silver", "flights"), ("gold", "fact_flights_delay"), ("gold", "rollup_flights_delay")]
    return {t: version_name(current_version(spark, base, *t) or "none") for t in tables}


def test_a_failed_chain_goes_on_at_the_failed_stage(spark, lake, tmp_path, monkeypatch):
    _, src = lake
    base = f"file:{tmp_path}/lake"
    real = P.fact_rows

    def fails(*a, **k):
        raise RuntimeError("gold is down")

    monkeypatch.setattr(P, "fact_rows", fails)
    with pytest.raises(RuntimeError):
        P.run_all(spark, base, src, resume=True, **QUIET)
    before = _versions(spark, base)
    assert before["silver", "flights"] != "none" and before["gold", "fact_flights_delay"] == "none"
    monkeypatch.setattr(P, "fact_rows", real)
    out = P.run_all(spark, base, src, resume=True, **QUIET)
    after = _versions(spark, base)
    changed = {t for t in after if after[t] != before[t]}
    assert changed == {("gold", "fact_flights_delay"), ("gold", "rollup_flights_delay")}
    assert out["silver"]["skipped"] and out["silver"]["rows"] == out["gold"]["rows"] == 6000
    # nothing changed: nothing runs
    again = P.run_all(spark, base, src, resume=True, **QUIET)
    assert _versions(spark, base) == after and again["gold"]["skipped"] and again["rollup"]["skipped"]
    # a changed dimension runs what reads it, and all below
    changed_src = {**src, "airlines": str(tmp_path / "airlines.csv")}
    V.airlines(spark, SF001).limit(9).toPandas().to_csv(changed_src["airlines"], index=False)
    out = P.run_all(spark, base, changed_src, resume=True, **QUIET)
    last = _versions(spark, base)
    assert {t for t in last if last[t] != after[t]} == {("bronze", "airlines"), ("gold", "fact_flights_delay"), ("gold", "rollup_flights_delay")}
    # other options, other version
    P.run_silver(spark, base, strict_dates=True, resume=True, **QUIET)
    assert _versions(spark, base)["silver", "flights"] != last["silver", "flights"]


def test_every_version_has_its_record(spark, lake):
    base, _ = lake
    register_layers(spark, base)
    fact = layer_location(spark, base, "gold", "fact_flights_delay")
    record = read_record(spark, fact)
    assert record["metrics"]["rows"] == 6000 and set(record["inputs"]) == {"silver.flights", "bronze.airlines"}
    assert record["inputs"]["silver.flights"] in [version_name(v) for v in versions(spark, base, "silver", "flights")]
    assert read_record(spark, f"{base}/nowhere") == {} and fs.read_text(spark, f"{base}/nothing") is None


# -- footers --------------------------------------------------------------------------

def test_footers_answer_counts_and_bounds(spark, lake):
    base, _ = lake
    register_layers(spark, base)
    at = layer_location(spark, base, "gold", "fact_flights_delay")
    pushed = footers.footer_stats(spark, at, ["FLIGHT_DATE"])
    plan = pushed._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(FLIGHT_DATE), MAX(FLIGHT_DATE)]" in plan
    assert "ReadSchema: struct<count(*):bigint,min(FLIGHT_DATE):date,max(FLIGHT_DATE):date>" in plan
    fact = spark.table("gold.fact_flights_delay")
    want = R.date_bounds(fact).first()
    assert pushed.first().asDict() == {"row_count": 6000, "min_FLIGHT_DATE": want[0], "max_FLIGHT_DATE": want[1]}
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session is as it was


def test_footers_without_statistics_are_scanned(spark, tmp_path):
    df = spark.range(100).select(F.date_add(F.lit("2015-01-01").cast("date"), F.col("id").cast("int")).alias("d"), F.col("id").cast("string").alias("s"))
    for name, on in (("with", "true"), ("without", "false")):
        df.repartition(3).write.option("parquet.column.statistics.enabled", on).parquet(f"{tmp_path}/{name}")
        got = footers.file_stats(spark, f"file:{tmp_path}/{name}", ["d", "s"])
        assert got == {**footers.file_stats(spark, f"file:{tmp_path}/{name}", ["d"]), "min_s": "0", "max_s": "99"}
        assert got["row_count"] == 100 and str(got["min_d"]) == "2015-01-01"
    df.limit(0).write.parquet(f"{tmp_path}/empty")
    assert footers.file_stats(spark, f"file:{tmp_path}/empty", ["d"]) == {"row_count": 0, "min_d": None, "max_d": None}
