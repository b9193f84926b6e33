"""Skew beyond the broadcast bound, ranges that reach the scan, and tables that change their shape."""

import glob
import json
import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierline.functions.filters import Selection, resolve_selections
from tierline.operators import transforms as T
from tierline.operators.joins import hot_keys, join_skewed
from tierline.operators.quality import typed_drift
from tierline.sources import layers as L
from tierline.sources.catalog import stored_stats

from .conftest import ROOT

N = 30_000


@pytest.fixture()
def skewed(spark):
    """A third of the rows has one code, some have none, the others one of 5,000; the dimension lacks some."""
    code = F.when(F.col("id") % 3 == 0, F.lit("HOT")).when(F.col("id") % 31 == 0, None).otherwise(F.pmod(F.xxhash64("id"), F.lit(5000)).cast("string"))
    rows = spark.range(0, N, 1, 8).select("id", code.alias("AIRLINE"))
    dim = spark.range(4000).select(F.col("id").cast("string").alias("IATA_CODE"), F.concat(F.lit("Air "), "id").alias("AIRLINE"))
    return rows, dim.unionByName(spark.createDataFrame([("HOT", "Air Hot")], "IATA_CODE string, AIRLINE string"))


@pytest.fixture()
def plain_session(spark):
    """A session without adaptive execution."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def _tasks(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect())


def test_no_task_holds_the_hot_code(plain_session, skewed):
    rows, dim = skewed
    flights = rows.withColumnRenamed("AIRLINE", "code")
    small = dim.select(F.col("IATA_CODE").alias("k"), F.col("AIRLINE").alias("name"))
    usual = _tasks(flights.join(small.hint("shuffle_hash"), F.col("code") == F.col("k"), "left"))
    assert usual[-1] > 2 * usual[len(usual) // 2]  # what the plain shuffle join does
    assert hot_keys(flights, "code") == ["HOT", None]
    joined = join_skewed(flights, small, "code", "k")
    tasks = _tasks(joined)
    assert sum(tasks) == N and tasks[-1] <= 2 * tasks[len(tasks) // 2]
    want = flights.join(F.broadcast(small), F.col("code") == F.col("k"), "left")
    assert joined.exceptAll(want).count() == 0 and want.exceptAll(joined).count() == 0
    inner = join_skewed(flights, small, "code", "k", how="inner")
    assert inner.count() == want.where("k is not null").count()
    with pytest.raises(ValueError):
        join_skewed(flights, small, "code", "k", how="full")


def test_enrich_beyond_the_bound_equals_the_broadcast(plain_session, skewed):
    rows, dim = skewed
    usual, split = T.enrich(rows, dim), T.enrich(rows, dim, max_broadcast_rows=0)
    assert split.columns == usual.columns
    assert split.exceptAll(usual).count() == 0 and usual.exceptAll(split).count() == 0
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and "BroadcastHashJoin" in plan and "ShuffledHashJoin" in plan


def test_few_rows_and_no_hot_key(spark, skewed):
    _, dim = skewed
    small = dim.select(F.col("IATA_CODE").alias("k"), F.col("AIRLINE").alias("name"))
    none = spark.createDataFrame([], "code string")
    assert hot_keys(none, "code") == [] and join_skewed(none, small, "code", "k").count() == 0
    even = spark.range(4000).select(F.col("id").cast("string").alias("code"))
    joined = join_skewed(even, small, "code", "k")
    assert hot_keys(even, "code") == [] and joined.where("name is not null").count() == 4000
    assert joined._jdf.queryExecution().executedPlan().toString().count("HashJoin") == 1  # rows are read once
    nulls = spark.range(50).select(F.lit(None).cast("string").alias("code"))
    assert hot_keys(nulls, "code") == [None] and join_skewed(nulls, small, "code", "k").count() == 50
    assert join_skewed(nulls, small, "code", "k", how="inner").count() == 0


# -- ranges -----------------------------------------------------------------------

@pytest.mark.parametrize("names", [["n7"], ["n1", "n2", "n3", "n90"], [f"n{i}" for i in range(0, 100, 9)], ["nobody"], []])
def test_ranges_change_no_result(spark, names):
    fact = spark.range(5000).select(F.pmod(F.xxhash64("id"), F.lit(120)).cast("string").alias("code"), "id")
    dim = spark.range(100).select(F.col("id").cast("string").alias("IATA_CODE"), F.concat(F.lit("n"), F.col("id") % 95).alias("AIRLINE"))
    pick = Selection(dim, names, "code")
    want = sorted(r["id"] for r in resolve_selections(fact, pick).collect())
    assert all(sorted(r["id"] for r in resolve_selections(fact, pick, ranges=n).collect()) == want for n in (1, 3))


SCRIPT = """
    import sys
    from pyspark.sql import functions as F
    from tierline.functions.filters import Selection, resolve_selections
    from tierline.session import build_session
    log, data = sys.argv[1:]
    spark = build_session("ranges", master="local[2]", conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log, "spark.eventLog.compress": "false"})
    rows = spark.range(64000).select(F.lpad((F.col("id") / 1000).cast("int").cast("string"), 2, "0").alias("code"), "id")
    rows.repartitionByRange(16, "code").sortWithinPartitions("code").write.parquet(data)
    dim = spark.range(64).select(F.lpad(F.col("id").cast("string"), 2, "0").alias("IATA_CODE"), F.concat(F.lit("n"), "id").alias("AIRLINE"))
    for ranges in (0, 2):
        spark.sparkContext.setJobDescription(f"ranges {ranges}")
        print(resolve_selections(spark.read.parquet(data), Selection(dim, ["n3", "n60"], "code"), ranges=ranges).count())
    spark.stop()
"""


def test_ranges_skip_row_groups(tmp_path):
    os.mkdir(tmp_path / "log")
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(SCRIPT), f"file:{tmp_path}/log", f"file:{tmp_path}/data"],
                          cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert done.stdout.split() == ["2000", "2000"]
    scans, read, what = set(), [], {}
    logs = [f for f in glob.glob(f"{tmp_path}/log/**", recursive=True) if os.path.isfile(f)]
    events = [json.loads(line) for f in logs for line in open(f) if line.startswith("{")]

    def walk(node, execution):
        if node["nodeName"].startswith("Scan parquet"):
            ids = [m["accumulatorId"] for m in node["metrics"] if m["name"] == "number of output rows"]
            scans.update((i, execution) for i in ids)
        for child in node.get("children", []):
            walk(child, execution)

    for e in events:
        if "sparkPlanInfo" in e:
            walk(e["sparkPlanInfo"], e["executionId"])
    of = dict(scans)
    for e in events:
        if e["Event"] == "SparkListenerStageCompleted":
            for a in e["Stage Info"]["Accumulables"]:
                if a["ID"] in of:
                    what[of[a["ID"]]] = what.get(of[a["ID"]], 0) + int(a["Value"])
    read = [n for _, n in sorted(what.items())]
    assert read[0] == 64_000 and read[1] <= 64_000 / 4, read


# -- shapes -----------------------------------------------------------------------

def _schema(text):
    return StructType.fromDDL(text)


def test_old_and_new_versions_read_together(spark, tmp_path):
    base = f"file:{tmp_path}/lake"
    one = spark.createDataFrame([(1, 1.5, "a"), (2, None, "b")], "k int, x float, s string")
    two = spark.createDataFrame([(2**40, 2.25, "c", 7)], "k bigint, x double, s string, extra int")
    L.write_layer(one, base, "t_evolve", "tab")
    with pytest.raises(L.SchemaMismatchError, match="schema differs"):
        L.write_layer(two, base, "t_evolve", "tab")  # only on demand
    L.write_layer(two, base, "t_evolve", "tab", evolve=True)
    assert [f.dataType.simpleString() for f in spark.table("t_evolve.tab").schema] == ["bigint", "double", "string", "int"]
    # a narrower batch is widened on the way in, and its columns may come in another order
    L.write_layer(spark.createDataFrame([("d", 3, 4, 1)], "S string, k smallint, x int, extra int"), base, "t_evolve", "tab", evolve=True)
    assert [tuple(r) for r in spark.table("t_evolve.tab").collect()] == [(3, 4.0, "d", 1)]
    got = L.read_versions(spark, base, "t_evolve", "tab")
    rows = sorted(tuple(r)[:4] for r in got.collect())
    assert rows == [(1, 1.5, "a", None), (2, None, "b", None), (3, 4.0, "d", 1), (2**40, 2.25, "c", 7)]
    assert got.select("_version").distinct().count() == 3 and got.schema["k"].dataType.simpleString() == "bigint"
    for bad in ("k string, x double, s string, extra int", "k bigint, x double, s string", "k decimal(30,2), x double, s string, extra int"):
        with pytest.raises(L.SchemaMismatchError):
            L.write_layer(spark.createDataFrame([], bad), base, "t_evolve", "tab", evolve=True)
    assert len(L.versions(spark, base, "t_evolve", "tab")) == 3


@pytest.mark.parametrize("a, b, want", [
    ("int", "bigint", "bigint"), ("smallint", "double", "double"), ("float", "double", "double"), ("date", "timestamp_ntz", "timestamp_ntz"),
    ("decimal(5,2)", "decimal(9,3)", "decimal(9,3)"), ("decimal(9,2)", "decimal(8,3)", None), ("bigint", "double", None), ("int", "float", None),
    ("string", "int", None), ("int", "int", "int"), ("array<int>", "array<bigint>", None),
])
def test_wider_types(a, b, want):
    for x, y in ((a, b), (b, a)):
        if want is None:
            with pytest.raises(L.SchemaMismatchError):
                L.merged_schema(_schema(f"c {x}"), _schema(f"C {y}"))
        else:
            assert L.merged_schema(_schema(f"c {x} not null"), _schema(f"C {y}")) == _schema(f"c {want}")


def test_typed_drift():
    got = typed_drift(_schema("a bigint, b string, c int, e int"), _schema("a int, b string, c string, d int"))
    assert got == {"missing": ["d"], "extra": ["e"], "wider": ["a: int -> bigint"], "changed": ["c: string -> int"]}


def test_stored_stats_of_split_versions(spark, tmp_path):
    rows = spark.createDataFrame([(1, None), (2, "bad"), (5, None)], "k int, why string")
    for keep, want in ((True, {"row_count": 3, "min_k": 1, "max_k": 5}), (False, {"row_count": 2, "min_k": 1, "max_k": 5})):
        base, layer = f"file:{tmp_path}/lake{keep}", f"t_stats_{keep}".lower()
        L.write_split(rows, base, layer, "tab", "rest", "why", keep=keep)
        assert stored_stats(spark, base, layer, "tab", ("k",)) == want
        assert [tuple(r) for r in spark.table(f"{layer}.rest").collect()] == [(2, "bad")]
    with pytest.raises(FileNotFoundError):
        stored_stats(spark, f"file:{tmp_path}/none", "t_none", "tab")
