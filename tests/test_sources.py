"""CSV contract reads, quarantine split, versioned layer writes and the catalog."""

import os

import pytest
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from tierline.schemas import Contract
from tierline.sources import csv as C
from tierline.sources import layers as L
from tierline.sources.catalog import catalog_tables, query, register_layers

SMALL = Contract(
    "small",
    StructType([StructField("Y", IntegerType()), StructField("M", IntegerType()),
                StructField("A", StringType()), StructField("D", DoubleType())]),
)


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)
    return path


MALFORMED = "Y,M,A,D\n2015,1,AA,5.5\n2015,x,AA,1\n2015,2\n2015,3,AA,2,EXTRA\n2015,4,,\n\n"


def test_malformed_rows_are_flagged_and_split(spark, workdir):
    p = _write(f"{workdir}/in/small.csv", MALFORMED)
    staged, metrics = C.stage_csv(spark, p, SMALL)
    assert metrics["rows"] == 5 and metrics["malformed"] == 3
    assert metrics["null:M"] == 1 and metrics["null:A"] == 2 and metrics["null:D"] == 2
    keep, bad = C.split_corrupt(staged, keep=True)
    assert keep.columns == ["Y", "M", "A", "D"]
    assert keep.count() == 5
    assert sorted(r[C.CORRUPT] for r in bad.collect()) == ["2015,2", "2015,3,AA,2,EXTRA", "2015,x,AA,1"]
    drop, _ = C.split_corrupt(staged, keep=False)
    assert sorted(r.M for r in drop.collect()) == [1, 4]


def test_staging_lives_under_the_checkpoint_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert C.staging_uri(spark, "x").startswith(root.rstrip("/") + "/tierline-staging/")


def test_header_must_match_contract(spark, workdir):
    p = _write(f"{workdir}/in/swapped.csv", "M,Y,A,D\n1,2015,AA,5.5\n")
    with pytest.raises(Exception, match="header|CSV"):
        C.read_csv(spark, p, SMALL).collect()


def test_write_layer_versions_and_enforces_schema(spark, workdir):
    base = f"file:{workdir}/lake"
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    m1 = L.write_layer(df, base, "t_layer", "tab")
    assert m1["rows"] == 2
    m2 = L.write_layer(df.filter("k = 1"), base, "t_layer", "tab")
    assert m2["location"] != m1["location"]
    assert spark.table("t_layer.tab").count() == 1
    # schema change refused unless asked for
    other = spark.createDataFrame([(1, 2.0)], "k int, v double")
    with pytest.raises(L.SchemaMismatchError):
        L.write_layer(other, base, "t_layer", "tab")
    assert spark.table("t_layer.tab").count() == 1
    L.write_layer(other, base, "t_layer", "tab", overwrite_schema=True)
    assert spark.table("t_layer.tab").schema["v"].dataType == DoubleType()


def test_refresh_can_read_its_own_table(spark, workdir):
    base = f"file:{workdir}/lake"
    L.write_layer(spark.createDataFrame([(1,), (2,)], "k int"), base, "t_self", "tab")
    cur = spark.table("t_self.tab")
    L.write_layer(cur.selectExpr("k * 10 AS k"), base, "t_self", "tab")
    assert sorted(r.k for r in spark.table("t_self.tab").collect()) == [10, 20]


def test_current_version_and_read_layer_from_storage(spark, workdir):
    base = f"file:{workdir}/lake"
    L.write_layer(spark.createDataFrame([(1,)], "k int"), base, "t_store", "tab")
    L.write_layer(spark.createDataFrame([(5,), (6,)], "k int"), base, "t_store", "tab")
    loc = L.current_version(spark, base, "t_store", "tab")
    assert loc == spark.sql("DESCRIBE TABLE EXTENDED t_store.tab").filter("col_name = 'Location'").first()[1]
    assert len(L.old_versions(spark, base, "t_store", "tab", keep=1)) == 1
    assert L.old_versions(spark, base, "t_store", "tab", keep=2) == []


def test_register_layers_is_idempotent(spark, workdir):
    base = f"file:{workdir}/lake"
    L.write_layer(spark.createDataFrame([("AA", "Air A")], "IATA_CODE string, AIRLINE string"), base, "bronze", "airlines")
    first = register_layers(spark, base)
    second = register_layers(spark, base)
    assert [r["status"] for r in first] == [r["status"] for r in second]
    assert {"table": "silver.flights", "status": "missing"} in second
    names = {(r.namespace, r.tableName) for r in catalog_tables(spark).collect()}
    assert ("bronze", "airlines") in names
    got = query(spark, "SELECT airline FROM bronze.airlines WHERE iata_code = :c", {"c": "AA"}).collect()
    assert [r.airline for r in got] == ["Air A"]


def test_cluster_conf_scales_partitions():
    from tierline.session import cluster_conf

    big = cluster_conf(100 << 40, total_cores=8000)  # 100 TB
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    small = cluster_conf(1 << 20, total_cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"


def test_vacuum_keeps_newest_committed_versions(spark, workdir):
    base = f"file:{workdir}/lake"
    for i in range(4):
        L.write_layer(spark.createDataFrame([(i,)], "k int"), base, "t_vac", "tab")
    current = L.current_version(spark, base, "t_vac", "tab")
    # an in-flight (uncommitted) newer folder must survive
    import os
    inflight = f"{workdir}/lake/t_vac/tab/v999999999999999-inflight"
    os.makedirs(inflight)
    deleted = L.vacuum_layer(spark, base, "t_vac", "tab", keep=2)
    assert len(deleted) == 2 and current not in deleted
    left = [n for n in os.listdir(f"{workdir}/lake/t_vac/tab") if n.startswith("v")]
    assert len(left) == 3 and "v999999999999999-inflight" in left
    assert [r.k for r in spark.table("t_vac.tab").collect()] == [3]
    with pytest.raises(ValueError):
        L.old_versions(spark, base, "t_vac", "tab", keep=0)


def test_partitioned_layer_prunes_and_reregisters(spark, workdir):
    base = f"file:{workdir}/lake"
    df = spark.createDataFrame([(1, 2015, "a"), (2, 2016, "b"), (3, 2016, "c")], "k int, y int, v string")
    L.write_layer(df, base, "t_part", "tab", partition_by=["y"])
    t = spark.table("t_part.tab")
    assert t.columns == ["k", "v", "y"] and t.count() == 3
    plan = t.filter("y = 2016")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(y" in plan and "y=2016" in plan
    # same data shape again: accepted although partition columns moved last
    L.write_layer(df.filter("y = 2016"), base, "t_part", "tab", partition_by=["y"])
    assert spark.table("t_part.tab").count() == 2
    # a fresh registration from storage finds the partitions
    spark.sql("DROP TABLE t_part.tab")
    from tierline.sources.layers import register_table

    register_table(spark, "t_part", "tab", L.current_version(spark, base, "t_part", "tab"), partitioned=True)
    assert spark.table("t_part.tab").count() == 2


def test_reregistration_follows_a_changed_stored_schema(spark, workdir):
    from tierline.sources.catalog import register_layers

    a, b = f"file:{workdir}/lake_a", f"file:{workdir}/lake_b"
    L.write_layer(spark.createDataFrame([("AA", "Air A", "x")], "IATA_CODE string, AIRLINE string, EXTRA string"),
                  a, "bronze", "airlines", overwrite_schema=True)
    L.write_layer(spark.createDataFrame([("BB", "Air B")], "IATA_CODE string, AIRLINE string"),
                  b, "bronze", "airlines", overwrite_schema=True)
    register_layers(spark, a)
    assert spark.table("bronze.airlines").columns == ["IATA_CODE", "AIRLINE", "EXTRA"]
    register_layers(spark, b)
    assert spark.table("bronze.airlines").columns == ["IATA_CODE", "AIRLINE"]
    assert [r.AIRLINE for r in spark.table("bronze.airlines").collect()] == ["Air B"]
