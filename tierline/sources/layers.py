"""Layer tables: versioned full-refresh writes registered in the Spark catalog.

A refresh never overwrites files in place.  Each write goes to a new version
folder ``<base>/<layer>/<table>/v<epoch-ms>``; only when the write job has
committed is the catalog table pointed at it.  Readers therefore see the old
version or the new one, never a half-written mix; a failed or retried job
leaves the current table untouched; and a job may read the very table it
replaces.  Before writing, the new schema is compared with the registered one
(names and types; nullability ignored) and a mismatch fails unless
``overwrite_schema`` is set.

Metrics (row count and any extra aggregate columns) are observed during the
write itself, so a layer costs one pass over its input.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, StructField, StructType

from . import fs

#: Hadoop setting that lets a write job leave its own marker.
NO_MARKER = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
VERSION_PREFIX = "v"
#: What a version was made of; readers of the table skip names that begin with an underscore.
RECORD = "_record.json"
#: Reader option under which a location's folders are no partitions.
ALL_FOLDERS = "recursiveFileLookup"
#: Folder column of a version that is dealt by validity.
VALID = "is_valid"


class SchemaMismatchError(ValueError):
    pass


def table_name(layer: str, table: str) -> str:
    return f"`{layer}`.`{table}`"


def layer_uri(base: str, layer: str, table: str | None = None) -> str:
    out = f"{base.rstrip('/')}/{layer}"
    return f"{out}/{table}" if table else out


def _shape(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name.lower(), f.dataType.simpleString()) for f in schema.fields]


def schema_diff(old: StructType, new: StructType) -> list[str]:
    """Human-readable differences in column names/types/order (nullability ignored)."""
    a, b = _shape(old), _shape(new)
    if a == b:
        return []
    out = []
    da, db = dict(a), dict(b)
    for n, t in b:
        if n not in da:
            out.append(f"new column {n} {t}")
        elif da[n] != t:
            out.append(f"column {n}: {da[n]} -> {t}")
    out += [f"dropped column {n}" for n, _ in a if n not in db]
    if not out:
        out.append("column order changed")
    return out


#: Types whose every value the later types of the same line hold exactly.
WIDER = (
    ("tinyint", "smallint", "int", "bigint"),
    ("tinyint", "smallint", "int", "double"),
    ("tinyint", "smallint", "float", "double"),
    ("date", "timestamp_ntz"),
)


def _wider(a: DataType, b: DataType) -> DataType | None:
    """The one of two types that holds all values of both, if there is one."""
    if a == b:
        return a
    if isinstance(a, DecimalType) and isinstance(b, DecimalType):
        for x, y in ((a, b), (b, a)):
            if x.scale >= y.scale and x.precision - x.scale >= y.precision - y.scale:
                return x
        return None
    names = a.simpleString(), b.simpleString()
    for line in WIDER:
        if names[0] in line and names[1] in line:
            return a if line.index(names[0]) > line.index(names[1]) else b
    return None


def merged_schema(old: StructType, new: StructType) -> StructType:
    """One schema that reads both: columns of ``old`` in their order, then the added ones, each of the wider type.

    Names match without regard to case and all columns are nullable.  Types with no common one are refused.
    """
    later = {f.name.lower(): f for f in new.fields}
    out = []
    for f in old.fields:
        g = later.pop(f.name.lower(), f)
        kind = _wider(f.dataType, g.dataType)
        if kind is None:
            raise SchemaMismatchError(f"column {f.name}: {f.dataType.simpleString()} and {g.dataType.simpleString()} have no common type")
        out.append(StructField(f.name, kind, True))
    return StructType(out + [StructField(f.name, f.dataType, True) for f in later.values()])


def evolved(old: StructType, new: StructType) -> StructType:
    """The schema of a table that takes ``new`` after ``old``: columns may be added and types widened.

    A dropped column is refused.  A column that comes narrower than the table's is widened on the way in, so no
    version ever narrows the table.
    """
    missing = [f.name for f in old.fields if f.name.lower() not in {g.name.lower() for g in new.fields}]
    if missing:
        raise SchemaMismatchError(f"dropped columns {missing}")
    return merged_schema(old, new)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with exactly these columns and types; what it lacks is null."""
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[(F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def _quoted(uri: str) -> str:
    """A URI inside a SQL string literal."""
    return uri.replace("\\", "\\\\").replace("'", "\\'")


def ensure_layer(spark: SparkSession, base: str, layer: str) -> None:
    """``CREATE SCHEMA IF NOT EXISTS`` with the layer's location."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{layer}` LOCATION '{_quoted(layer_uri(base, layer))}'")


def _new_version(base: str, layer: str, table: str) -> str:
    stamp = f"{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:6]}"
    return f"{layer_uri(base, layer, table)}/{VERSION_PREFIX}{stamp}"


def current_version(spark: SparkSession, base: str, layer: str, table: str) -> str | None:
    """Newest committed version folder of a table (one with a ``_SUCCESS`` marker)."""
    root = layer_uri(base, layer, table)
    for name in reversed(fs.list_dirs(spark, root)):
        if name.startswith(VERSION_PREFIX) and fs.exists(spark, f"{root}/{name}/_SUCCESS"):
            return f"{root}/{name}"
    return None


def version_name(location: str) -> str:
    """The version folder's own name; two spellings of one URI share it."""
    return next((p for p in reversed(location.rstrip("/").split("/")) if p.startswith(VERSION_PREFIX) and "-" in p), location)


def _reads_all_folders(spark: SparkSession, layer: str, table: str) -> bool:
    if not spark.catalog.tableExists(f"{layer}.{table}"):
        return False
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table_name(layer, table)}").filter("col_name = 'Storage Properties'").collect()
    return bool(rows) and ALL_FOLDERS in rows[0]["data_type"]


def read_record(spark: SparkSession, location: str) -> dict:
    """The version record below ``location``: rows, observed metrics, inputs and options ({} without one)."""
    text = fs.read_text(spark, f"{location.rstrip('/')}/{RECORD}")
    return json.loads(text) if text else {}


def register_table(
    spark: SparkSession,
    layer: str,
    table: str,
    location: str,
    fmt: str = "parquet",
    replace: bool = False,
    partitioned: bool = False,
    schema: StructType | None = None,
) -> None:
    """Create the external table, or point an existing one at ``location``.

    With a ``schema`` the table has these columns alone and reads the files of all folders below the
    location, whatever those folders are called.

    Registering an already registered table is a success.  A partitioned
    table keeps one catalog entry per partition, each with its own folder, so
    it is recreated at the new location and its partitions are recovered from
    storage (the catalog switch is then not atomic: readers may briefly see
    no table).
    """
    name = table_name(layer, table)
    # A table of another kind (its own columns, or all folders) cannot be re-pointed.
    replace = replace or (schema is not None) != _reads_all_folders(spark, layer, table)
    if replace or (partitioned and spark.catalog.tableExists(f"{layer}.{table}")):
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: the data stays
    if spark.catalog.tableExists(f"{layer}.{table}"):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{_quoted(location)}'")
        spark.sql(f"REFRESH TABLE {name}")
    elif schema is not None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt} OPTIONS ({ALL_FOLDERS} 'true') LOCATION '{_quoted(location)}'")
    else:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{_quoted(location)}'")
        if partitioned:
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def table_schema(spark: SparkSession, base: str, layer: str, table: str, fmt: str = "parquet") -> StructType | None:
    """Columns of the registered table, else (a fresh session) of the newest version."""
    if spark.catalog.tableExists(f"{layer}.{table}"):
        return spark.table(f"{layer}.{table}").schema
    loc = current_version(spark, base, layer, table)
    return read_version(spark, loc, fmt).schema if loc else None


def check_shape(spark: SparkSession, base: str, layer: str, table: str, incoming: StructType, fmt: str = "parquet") -> None:
    """Refuse columns that differ from the registered table's, else (a fresh session) the newest version's."""
    qualified, previous = f"{layer}.{table}", table_schema(spark, base, layer, table, fmt)
    diff = schema_diff(previous, incoming) if previous is not None else []
    if diff:
        raise SchemaMismatchError(
            f"{qualified}: schema differs from the registered table ({'; '.join(diff)}); "
            "pass overwrite_schema=True to replace it"
        )


def commit_version(
    spark: SparkSession, target: str, metrics: Mapping, inputs: Mapping[str, str] | None = None, options: Mapping | None = None
) -> None:
    """Write the record of a finished version, then its marker."""
    record = {"metrics": dict(metrics), "inputs": dict(inputs or {}), "options": dict(options or {})}
    fs.write_text(spark, f"{target}/{RECORD}", json.dumps(record, default=str, sort_keys=True))
    fs.touch(spark, f"{target}/_SUCCESS")


def write_layer(
    df: DataFrame,
    base: str,
    layer: str,
    table: str,
    fmt: str = "parquet",
    overwrite_schema: bool = False,
    evolve: bool = False,
    partition_by: Sequence[str] | None = None,
    metrics: Sequence[Column] = (),
    helpers: Sequence[str] = (),
    validate: Callable[[dict], None] | None = None,
    cluster_by: Sequence[str] | None = None,
    inputs: Mapping[str, str] | None = None,
    options: Mapping | None = None,
) -> dict:
    """Full refresh of ``layer.table`` (S5, S6); returns the observed metrics.

    ``rows`` is always observed; ``metrics`` adds named aggregate columns.  Columns named in ``helpers`` are there
    for the metrics alone and are not written.
    ``validate`` sees the metrics after the data is written and before the version is
    marked as committed (``_SUCCESS``) and the catalog is switched.  If it raises, or the
    process ends there, the version stays uncommitted and no reader picks it.
    ``evolve`` accepts a schema that differs by added columns and wider types, and refuses any other change.
    ``cluster_by`` sorts rows *within* each write task (no shuffle).
    ``inputs`` (what the version is made of) and ``options`` go into its record next to the metrics,
    before the marker, so a committed version always has its record.
    """
    spark = df.sparkSession
    ensure_layer(spark, base, layer)
    exists = spark.catalog.tableExists(f"{layer}.{table}")
    if evolve and not overwrite_schema:
        if helpers:
            raise ValueError("a table that evolves takes no helper columns")
        previous = table_schema(spark, base, layer, table, fmt)
        if previous is not None and schema_diff(previous, df.schema):
            df = conform(df, evolved(previous, df.schema))
            overwrite_schema = bool(schema_diff(previous, df.schema))  # it differs by safe changes alone
    if not overwrite_schema:
        incoming = StructType([f for f in df.schema.fields if f.name not in helpers])
        if partition_by:  # partition columns are stored (and read back) last
            rest = [f for f in incoming.fields if f.name not in partition_by]
            incoming = StructType(rest + [incoming[c] for c in partition_by])
        check_shape(spark, base, layer, table, incoming, fmt)
    target = _new_version(base, layer, table)
    obs = Observation(f"write-{layer}-{table}-{uuid.uuid4().hex[:8]}")
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"), *metrics).drop(*helpers)
    if cluster_by:
        out = out.sortWithinPartitions(*cluster_by)
    # The job itself leaves no marker: a version counts only once it is validated.
    writer = out.write.format(fmt).mode("errorifexists").option(NO_MARKER, "false")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(target)
    result = dict(obs.get)
    if validate is not None:
        try:
            validate(result)
        except Exception:
            fs.delete(spark, target)
            raise
    commit_version(spark, target, result, inputs, options)
    register_table(spark, layer, table, target, fmt, replace=exists and overwrite_schema,
                   partitioned=bool(partition_by))
    result["location"] = target
    return result


def write_split(
    df: DataFrame,
    base: str,
    layer: str,
    table: str,
    rest_table: str,
    flag: str,
    keep: bool = True,
    metrics: Sequence[Column] = (),
    validate: Callable[[dict], None] | None = None,
    inputs: Mapping[str, str] | None = None,
    options: Mapping | None = None,
) -> dict:
    """One write of ``df`` as one version that two tables read.

    Rows whose ``flag`` column is null are valid.  ``layer.table`` holds all columns but the flag, of all rows (``keep``)
    or of the valid ones; ``layer.rest_table`` holds all columns of the others.  The rows are dealt into two
    folders of the version, so the input is computed once, and both tables appear with its one marker.
    """
    spark = df.sparkSession
    ensure_layer(spark, base, layer)
    schema = StructType([f for f in df.schema.fields if f.name != flag])
    check_shape(spark, base, layer, table, schema)
    target = _new_version(base, layer, table)
    obs = Observation(f"write-{layer}-{table}-{uuid.uuid4().hex[:8]}")
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"), *metrics).withColumn(VALID, F.col(flag).isNull())
    out.write.mode("errorifexists").option(NO_MARKER, "false").partitionBy(VALID).parquet(target)
    result = dict(obs.get)
    if validate is not None:
        try:
            validate(result)
        except Exception:
            fs.delete(spark, target)
            raise
    for folder in ("true", "false"):  # a side without rows is an empty folder
        fs.make_dir(spark, f"{target}/{VALID}={folder}")
    tables = {table: {"folder": "" if keep else f"{VALID}=true", "schema": schema.json()}}
    tables[rest_table] = {"folder": f"{VALID}=false", "schema": df.schema.json()}
    commit_version(spark, target, result, inputs, {**(options or {}), "tables": tables})
    register_version(spark, layer, table, target)
    return {**result, "location": target, "rest": f"{target}/{VALID}=false"}


def version_tables(spark: SparkSession, table: str, location: str) -> dict[str, tuple[str, StructType | None]]:
    """Table -> (folder, columns) of everything a version holds; mostly the table itself and no columns."""
    named = read_record(spark, location).get("options", {}).get("tables")
    if not named:
        return {table: (location, None)}
    place = lambda folder: f"{location}/{folder}" if folder else location
    return {t: (place(x["folder"]), StructType.fromJson(json.loads(x["schema"]))) for t, x in named.items()}


def register_version(spark: SparkSession, layer: str, table: str, location: str, fmt: str = "parquet", replace: bool = False, partitioned: bool = False) -> list[str]:
    """Register every table of a version; returns their names."""
    found = version_tables(spark, table, location)
    for name, (place, schema) in found.items():
        register_table(spark, layer, name, place, fmt, replace=replace, partitioned=partitioned, schema=schema)
    return list(found)


def read_version(spark: SparkSession, location: str, fmt: str = "parquet", table: str | None = None) -> DataFrame:
    """A stored version as its table reads it."""
    name = table or location.rstrip("/").split("/")[-2]
    place, schema = version_tables(spark, name, location).get(name, (location, None))
    if schema is None:
        return spark.read.format(fmt).load(place)
    return spark.read.schema(schema).option(ALL_FOLDERS, "true").format(fmt).load(place)


def versions(spark: SparkSession, base: str, layer: str, table: str) -> list[str]:
    """All committed versions, oldest first."""
    root = layer_uri(base, layer, table)
    names = [n for n in fs.list_dirs(spark, root) if n.startswith(VERSION_PREFIX)]
    return [f"{root}/{n}" for n in names if fs.exists(spark, f"{root}/{n}/_SUCCESS")]


def read_versions(spark: SparkSession, base: str, layer: str, table: str, locations: Sequence[str] | None = None) -> DataFrame:
    """Several versions (all committed ones by default) as one schema, with the version's name in ``_version``.

    Versions of different shapes read together: the scan itself widens their types, columns that a version lacks
    are null.
    """
    found = list(locations) if locations is not None else versions(spark, base, layer, table)
    if not found:
        raise FileNotFoundError(f"no committed version of {layer}.{table} under {base}")
    parts = {at: version_tables(spark, table, at).get(table, (at, None)) for at in found}
    schemas = [own if own is not None else spark.read.parquet(place).schema for place, own in parts.values()]
    merged = schemas[0]
    for schema in schemas[1:]:
        merged = merged_schema(merged, schema)
    out = None
    for at, (place, _) in parts.items():
        rows = spark.read.schema(merged).option(ALL_FOLDERS, "true").parquet(place).withColumn("_version", F.lit(version_name(at)))
        out = rows if out is None else out.unionByName(rows)
    return out


def read_layer(spark: SparkSession, layer: str, table: str, base: str | None = None, fmt: str = "parquet") -> DataFrame:
    """The current version of a layer table: from the catalog, else from storage."""
    if spark.catalog.tableExists(f"{layer}.{table}"):
        return spark.table(f"{layer}.{table}")
    if base is None:
        raise ValueError(f"{layer}.{table} is not registered and no base URI was given")
    loc = current_version(spark, base, layer, table)
    if loc is None:
        raise FileNotFoundError(f"no committed version of {layer}.{table} under {base}")
    return read_version(spark, loc, fmt)


def layer_location(spark: SparkSession, base: str, layer: str, table: str) -> str | None:
    """The version a reader of the table gets: the registered one, else the newest committed."""
    at = registered_location(spark, layer, table)
    if at is None:
        return current_version(spark, base, layer, table)
    name = version_name(at)
    return at[: at.index(name) + len(name)]


def registered_location(spark: SparkSession, layer: str, table: str) -> str | None:
    """Location the catalog table points at, if it is registered."""
    if not spark.catalog.tableExists(f"{layer}.{table}"):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table_name(layer, table)}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def old_versions(spark: SparkSession, base: str, layer: str, table: str, keep: int = 2) -> list[str]:
    """Version folders that retention may delete, keeping the newest ``keep`` committed ones.

    Only folders older than the ``keep``-th newest committed version qualify,
    so the current version and any newer in-flight write are never listed, and
    neither is the folder the catalog points at.  Older uncommitted folders
    (failed writes) do qualify.
    """
    if keep < 1:
        raise ValueError("keep must be at least 1")
    root = layer_uri(base, layer, table)
    names = [n for n in fs.list_dirs(spark, root) if n.startswith(VERSION_PREFIX)]
    committed = [n for n in names if fs.exists(spark, f"{root}/{n}/_SUCCESS")]
    if len(committed) <= keep:
        return []
    cutoff = committed[-keep]
    pinned = registered_location(spark, layer, table)
    out = []
    for n in names:
        uri = f"{root}/{n}"
        if n < cutoff and (pinned is None or n != version_name(pinned)):
            out.append(uri)
    return out


def vacuum_layer(spark: SparkSession, base: str, layer: str, table: str, keep: int = 2) -> list[str]:
    """Delete version folders beyond the retention of ``keep`` committed versions.

    A daily full refresh otherwise keeps every past copy.  Keeping two leaves
    the previous version for a rollback (``register_table`` at its location).
    """
    doomed = old_versions(spark, base, layer, table, keep)
    for uri in doomed:
        fs.delete(spark, uri)
    return doomed
