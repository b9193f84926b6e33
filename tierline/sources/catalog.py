"""Catalog registration of the layers and SQL over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import durable_catalog
from .footers import file_stats
from .fs import list_dirs
from .layers import current_version, ensure_layer, layer_location, read_layer, read_record, read_version, register_version, schema_diff, version_name, version_tables

# Layer namespaces and the tables each holds.
LAYER_TABLES = (
    ("bronze", "airlines"),
    ("bronze", "airports"),
    ("bronze", "flights"),
    ("silver", "flights"),
    ("gold", "fact_flights_delay"),
)
FACT = LAYER_TABLES[-1]
#: States of the fact by date, airline and origin.
ROLLUP_TABLE = "rollup_flights_delay"


def register_layers(spark: SparkSession, base: str, fmt: str = "parquet") -> list[dict]:
    """Create the layer schemas and register each table (and any quarantine) at its newest committed version.

    Idempotent: a table already registered is re-pointed (or left) and counts
    as success.  Tables with no committed version are reported, not created.  ``durable``
    says whether the registration outlives this process (it does not in Spark's
    in-memory catalog).
    """
    out = []
    durable = durable_catalog(spark)
    for layer in sorted({layer for layer, _ in LAYER_TABLES}):
        ensure_layer(spark, base, layer)
    root = base.rstrip("/")
    quarantines = [("bronze", n) for n in list_dirs(spark, f"{root}/bronze") if n.startswith("_quarantine_")]
    quarantines += [("gold", n) for n in list_dirs(spark, f"{root}/gold") if n.startswith("_unmatched_") or n == ROLLUP_TABLE]
    for layer, table in quarantines + list(LAYER_TABLES):
        loc = current_version(spark, base, layer, table)
        if loc is None:
            out.append({"table": f"{layer}.{table}", "status": "missing"})
            continue
        # Hive-style partition folders (col=value) mark a partitioned version.
        partitioned = any("=" in name for name in list_dirs(spark, loc))
        # Re-pointing keeps the catalog's column list, so a stored version of
        # another shape is registered afresh.
        stale = spark.catalog.tableExists(f"{layer}.{table}") and bool(
            schema_diff(spark.table(f"{layer}.{table}").schema, read_version(spark, loc, fmt, table).schema)
        )
        for name in register_version(spark, layer, table, loc, fmt, replace=stale, partitioned=partitioned and "tables" not in read_record(spark, loc).get("options", {})):
            out.append({"table": f"{layer}.{name}", "status": "registered", "location": loc, "durable": durable})
    return out


def current_rollup(spark: SparkSession, base: str, max_share: float = 0.5) -> DataFrame | None:
    """The rollup of the current fact, if there is one and it is worth reading.

    A rollup of an older fact is never handed out, nor one with more than ``max_share`` of the fact's rows.
    """
    fact, at = layer_location(spark, base, *FACT), layer_location(spark, base, "gold", ROLLUP_TABLE)
    if fact is None or at is None:
        return None
    record = read_record(spark, at)
    rows, of = record.get("metrics", {}).get("rows"), record.get("options", {}).get("fact_rows")
    if record.get("inputs", {}).get(".".join(FACT)) != version_name(fact):
        return None
    if rows is not None and of is not None and rows > max_share * of:
        return None
    return read_layer(spark, "gold", ROLLUP_TABLE, base)


def catalog_tables(spark: SparkSession) -> DataFrame:
    """Registered layer tables as a DataFrame (namespace, table)."""
    frames = [spark.sql(f"SHOW TABLES IN `{layer}`") for layer in sorted({l for l, _ in LAYER_TABLES})
              if spark.catalog.databaseExists(layer)]
    if not frames:
        return spark.createDataFrame([], "namespace string, tableName string")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.select("namespace", "tableName")


def layer_row_counts(spark: SparkSession) -> DataFrame:
    """Row counts of the registered layer tables side by side.

    Labels are ``<layer>_<table>`` (``gold_fact_flights_delay`` ...).  Each
    count reads only parquet row-group metadata.
    """
    from ..operators.quality import layer_counts

    present = [(f"{l}_{t}", spark.table(f"{l}.{t}")) for l, t in LAYER_TABLES if spark.catalog.tableExists(f"{l}.{t}")]
    if not present:
        raise ValueError("no layer table is registered")
    return layer_counts(present)


def stored_stats(spark: SparkSession, base: str, layer: str, table: str, bounds: tuple[str, ...] = ()) -> dict:
    """Rows, and least and greatest values of ``bounds``, of the current version, from its footers."""
    at = layer_location(spark, base, layer, table)
    if at is None:
        raise FileNotFoundError(f"no committed version of {layer}.{table} under {base}")
    place, schema = version_tables(spark, table, at).get(table, (at, None))
    return file_stats(spark, place, bounds, schema)


def query(spark: SparkSession, sql: str, args: dict | None = None) -> DataFrame:
    """SQL text over the registered tables; values are bound, never spliced."""
    return spark.sql(sql, args=args) if args else spark.sql(sql)
