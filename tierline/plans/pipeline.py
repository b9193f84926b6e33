"""The layered batch pipeline: CSV -> raw -> clean -> fact -> catalog.

Each stage reads its input once.  Its checks ride on that pass as observed
metrics instead of extra count jobs:

* raw: one full-width parse of each CSV writes the layer and its quarantine, as two folders
  of one version, and observes rows, malformed rows and every column's null count;
* clean: rows, invalid dates and out-of-range rows are observed on the write;
* fact: rows and unmatched rows are observed on the write; all unmatched codes
  with their row counts go to ``gold._unmatched_airline_codes`` on every run, from
  two columns of the written fact (no second join);
* rollup: states of the written fact by date, airline and origin, for the reports.

The raw and the clean write also observe the quantiles by which the fact write deals its rows
out to files (``operators.layout``), so that it needs no sampling pass.

Layers are the only hand-over between stages, so any stage can run alone,
and every stage raises on error (the source ingest printed and went on).  Every version records
the versions it was made of, so a chain that failed can go on at the failed stage (``resume``).
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import compose_date
from ..operators import layout as G
from ..operators import quality as Q
from ..operators import transforms as T
from ..operators.rollup import build_rollup
from ..schemas import CONTRACTS, DATE_PARTS, FLIGHTS, Contract
from ..sources import csv as C
from ..sources import fs
from ..session import durable_catalog
from ..sources.catalog import FACT, LAYER_TABLES, ROLLUP_TABLE, current_rollup, register_layers
from ..sources.layers import (
    current_version,
    ensure_layer,
    layer_location,
    read_layer,
    read_record,
    register_version,
    vacuum_layer,
    version_name,
    write_layer,
    write_split,
)
from ..sources.report_functions import point_states, register_report_functions

Log = Callable[[str], None]


#: Every airline code without a dimension row, with its number of fact rows.
UNMATCHED_TABLE = "_unmatched_airline_codes"
#: Dimensions of the fact's files, in the order of the curve, and what sorts rows inside a file.
FACT_DIMENSIONS = {"FLIGHT_DATE": "date", "AIRLINE_CODE": "text", "ORIGIN_AIRPORT": "text"}
#: Columns whose hash spreads rows of one cell; raw, clean and fact rows have them all.
SPREAD = ("FLIGHT_NUMBER", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "DEPARTURE_DELAY", "ARRIVAL_DELAY")
#: Rows of a fact file; a fact beyond that is dealt out, and to no fewer files than there are cores.
FACT_FILE_ROWS = 4_000_000


class ContractViolation(ValueError):
    pass


def null_report(metrics: Mapping, contract: Contract) -> list[dict]:
    """Null profile from observed counts: columns with nulls, sorted by name."""
    rows = metrics["rows"]
    out = []
    for c in sorted(contract.names):
        n = metrics.get(f"null:{c}", 0)
        if n:
            out.append({"column_name": c, "null_count": n, "null_pct": round(n * 100.0 / rows, 2) if rows else None})
    return out


def source_state(spark: SparkSession, path: str) -> str:
    """A digest of the source's files: names, sizes and modification times."""
    return hashlib.sha256(json.dumps(fs.list_files(spark, path)).encode()).hexdigest()


def _layout_columns(df: DataFrame) -> dict[str, tuple]:
    """The fact's dimensions as the raw flights hold them."""
    columns = {"FLIGHT_DATE": compose_date(*DATE_PARTS), "AIRLINE_CODE": F.col("AIRLINE"), "ORIGIN_AIRPORT": F.col("ORIGIN_AIRPORT")}
    return {name: (columns[name], kind) for name, kind in FACT_DIMENSIONS.items()}


def ingest(
    spark: SparkSession,
    base: str,
    name: str,
    path: str,
    contract: Contract | None = None,
    keep_malformed: bool = True,
    log: Log = print,
    inputs: Mapping[str, str] | None = None,
) -> dict:
    """One CSV into ``bronze.<name>`` and its malformed rows into ``bronze._quarantine_<name>``.

    One pass parses the file at full width and writes all rows, dealt by validity into two folders of one
    version, while observing rows, malformed rows and every column's null count.  The contract's
    not-null rule is checked from those counts before the version is committed; then both tables
    appear together.  The source is read once, so it may change or go at any time after.
    """
    contract = contract or CONTRACTS[name]
    source = C.read_csv(spark, path, contract)

    def before_publish(metrics: Mapping) -> None:
        # A not-null violation leaves both tables as they were.
        broken = [c for c in contract.not_null if metrics.get(f"null:{c}", 0)]
        if broken:
            raise ContractViolation(f"{name}: nulls in columns declared not null: {broken}")

    observed = [m for m in C.ingest_metrics(source, contract.names)][1:]  # the write counts its rows itself
    if contract.name == FLIGHTS.name:
        observed += G.quantiles(_layout_columns(source), SPREAD)
    metrics = write_split(
        source, base, "bronze", name, f"_quarantine_{name}", C.CORRUPT, keep=keep_malformed,
        metrics=observed, validate=before_publish, inputs=inputs, options={"keep_malformed": keep_malformed},
    )
    report = {"dataset": name, "rows_read": metrics["rows"], "malformed": metrics["malformed"],
              "nulls": null_report(metrics, contract),
              "rows_written": metrics["rows"] - (0 if keep_malformed else metrics["malformed"]),
              "location": metrics["location"], "quarantine": metrics["rest"]}
    log(f"{name}: {metrics['rows']:,} rows read, {metrics['malformed']:,} malformed")
    for item in report["nulls"]:
        log(f"  - {item['column_name']}: {item['null_count']:,} / {metrics['rows']:,} ({item['null_pct']:.2f}%)")
    if not report["nulls"]:
        log("  no null values")
    return report


def unchanged(
    spark: SparkSession, base: str, layer: str, table: str, inputs: Mapping[str, str], options: Mapping | None = None
) -> str | None:
    """The newest committed version if it was made of exactly these inputs and options, registered again if need be."""
    at = current_version(spark, base, layer, table)
    if at is None:
        return None
    record = read_record(spark, at)
    same = record.get("inputs") == dict(inputs) and all(record.get("options", {}).get(k) == v for k, v in (options or {}).items())
    if not same:
        return None
    if layer_location(spark, base, layer, table) != at or not spark.catalog.tableExists(f"{layer}.{table}"):
        ensure_layer(spark, base, layer)
        register_version(spark, layer, table, at)
    return at


def _made_of(spark: SparkSession, base: str, *tables: tuple[str, str]) -> dict[str, str]:
    """``layer.table`` -> name of the version a reader gets now."""
    found = {f"{layer}.{table}": layer_location(spark, base, layer, table) for layer, table in tables}
    return {k: version_name(v) for k, v in found.items() if v}


def run_bronze(
    spark: SparkSession,
    base: str,
    sources: Mapping[str, str],
    keep_malformed: bool = True,
    log: Log = print,
    parallel: bool = True,
    resume: bool = False,
) -> list[dict]:
    """L1: every source CSV (name -> path) to its raw table.

    The datasets are independent, so their jobs run concurrently (Spark
    schedules jobs from several threads side by side): the small dimension
    loads overlap the large fact load instead of queueing behind it.  Reports
    come back in the order airlines, airports, flights, then any others; the
    first failure is raised.  With ``resume`` a source whose files are those of the newest version is
    not read again.
    """
    order = [n for n in ("airlines", "airports", "flights") if n in sources] + [
        n for n in sources if n not in ("airlines", "airports", "flights")
    ]
    ensure_layer(spark, base, "bronze")

    def one(name: str) -> dict:
        inputs = {"source": source_state(spark, sources[name]), "contract": CONTRACTS[name].schema.json()}
        if resume:
            kept = unchanged(spark, base, "bronze", name, inputs, {"keep_malformed": keep_malformed})
            if kept:
                log(f"{name}: unchanged since {version_name(kept)}")
                return {"dataset": name, "skipped": True, "location": kept}
        return ingest(spark, base, name, sources[name], keep_malformed=keep_malformed, log=log, inputs=inputs)

    if not parallel or len(order) < 2:
        return [one(n) for n in order]
    with ThreadPoolExecutor(max_workers=len(order)) as pool:
        futures = [pool.submit(one, n) for n in order]
        return [f.result() for f in futures]


def silver_metrics() -> list:
    return [
        F.count_if(F.col("FLIGHT_DATE").isNull()).alias("invalid_dates"),
        F.count_if(Q.out_of_range()).alias("out_of_range"),
    ]


def _curve(spark: SparkSession, base: str, layer: str, table: str) -> tuple[G.Curve | None, dict]:
    """The curve observed with the version a reader gets, and that version's metrics."""
    at = layer_location(spark, base, layer, table)
    metrics = read_record(spark, at).get("metrics", {}) if at else {}
    return G.Curve.of(metrics, FACT_DIMENSIONS), metrics


def run_silver(
    spark: SparkSession, base: str, strict_dates: bool = False, log: Log = print, overwrite_schema: bool = False, resume: bool = False
) -> dict:
    """L2: raw flights -> clean flights, with drift check and observed quality counts.

    Missing contract columns raise; extra ones are reported and flow through,
    so the new clean table differs from the registered one and its write
    fails unless ``overwrite_schema`` accepts the new shape.
    The write also observes how the rows lie on the fact's curve.
    """
    inputs, options = _made_of(spark, base, ("bronze", "flights")), {"strict_dates": strict_dates}
    if resume and (kept := unchanged(spark, base, "silver", "flights", inputs, options)):
        log(f"silver: unchanged since {version_name(kept)}")
        return {**read_record(spark, kept)["metrics"], "location": kept, "skipped": True}
    raw = Q.check_drift(read_layer(spark, "bronze", "flights", base), FLIGHTS, warn=log)
    clean = T.clean(raw, strict_dates=strict_dates)
    curve, seen = _curve(spark, base, "bronze", "flights")
    metrics, helpers = silver_metrics(), []
    if curve and seen["rows"] > FACT_FILE_ROWS:  # a fact of one file has no files to skip
        columns = {"FLIGHT_DATE": F.col("FLIGHT_DATE"), "AIRLINE_CODE": F.col("AIRLINE"), "ORIGIN_AIRPORT": F.col("ORIGIN_AIRPORT")}
        clean, cells = curve.observed_cells(clean, columns, SPREAD, "_cell")
        metrics, helpers = [*metrics, cells], ["_cell"]
        options["cuts"] = {k: v for k, v in seen.items() if k.startswith(G.PREFIX)}
    m = write_layer(clean, base, "silver", "flights", metrics=metrics, helpers=helpers, overwrite_schema=overwrite_schema, inputs=inputs, options=options)
    log(f"silver: {m['rows']:,} rows, invalid FLIGHT_DATE {m['invalid_dates']:,}")
    if m["out_of_range"]:
        log(f"[WARN] rows with delay outside the accepted range: {m['out_of_range']:,}")
    return m


def fact_layout(spark: SparkSession, base: str, fact: DataFrame) -> tuple[G.Layout, int]:
    """(layout of the fact's files, rows) as observed with the clean version; counted where it was not."""
    at = layer_location(spark, base, "silver", "flights")
    record = read_record(spark, at) if at else {}
    metrics, cuts = record.get("metrics", {}), record.get("options", {}).get("cuts", {})
    curve, cells = G.Curve.of(cuts, FACT_DIMENSIONS), metrics.get(f"{G.PREFIX}cells")
    if curve and cells is not None:
        return G.Layout(curve, tuple(cells)), metrics["rows"]
    # A clean layer that another tool wrote: two passes over the three columns, with no join.
    columns = {name: F.col(name) for name in FACT_DIMENSIONS}
    dims = fact.select(*columns, *[c for c in SPREAD if c not in columns])
    wanted = G.quantiles({name: (F.col(name), kind) for name, kind in FACT_DIMENSIONS.items()}, SPREAD)
    counted = dims.agg(F.count(F.lit(1)).alias("rows"), *wanted).first().asDict()
    curve = G.Curve.of(counted, FACT_DIMENSIONS)
    celled, wanted = curve.observed_cells(dims, columns, SPREAD, "_cell")
    cells = celled.agg(wanted).first()[0]
    return G.Layout(curve, tuple(cells or ())), counted["rows"]


def fact_files(spark: SparkSession, rows: int) -> int:
    cores = spark.sparkContext.defaultParallelism
    return max(cores, -(-rows // FACT_FILE_ROWS))


def fact_rows(spark: SparkSession, base: str, files: int | None = None) -> DataFrame:
    """The fact as it is written: the dimension joined and the rows dealt out to files along the curve.

    A fact known to have no more rows than one file is written where its rows lie.
    """
    flights = read_layer(spark, "silver", "flights", base)
    fact = T.fact(flights, read_layer(spark, "bronze", "airlines", base), check_unique=True)
    at = layer_location(spark, base, "silver", "flights")
    known = read_record(spark, at).get("metrics", {}).get("rows") if at else None
    if files is None and known is not None and known <= FACT_FILE_ROWS:
        return fact
    layout, rows = fact_layout(spark, base, T.fact_measures(flights))
    columns = {name: F.col(name) for name in FACT_DIMENSIONS}
    return G.deal(fact, layout, columns, files or fact_files(spark, rows), SPREAD)


def run_gold(
    spark: SparkSession,
    base: str,
    log: Log = print,
    log_codes: int = 20,
    preview_rows: int = 5,
    overwrite_schema: bool = False,
    files: int | None = None,
    resume: bool = False,
) -> dict:
    """L3: clean flights + airlines -> fact table, with the FK integrity report.

    The fact is dealt out along a curve through date, airline and origin (``operators.layout``), by cut points
    that earlier writes observed: scan and join run once, and filters on any of the three open only the files
    whose statistics meet them.  ``files`` sets their number, and deals out small facts too.  Every unmatched code is written to
    ``gold._unmatched_airline_codes``; ``log_codes`` bounds the log line alone.

    The preview (P14) reads a few rows of the version just written, not the
    job's input again.
    """
    inputs = _made_of(spark, base, ("silver", "flights"), ("bronze", "airlines"))
    if resume and (kept := unchanged(spark, base, *FACT, inputs)):
        codes = unchanged(spark, base, "gold", UNMATCHED_TABLE, {".".join(FACT): version_name(kept)})
        if codes:
            log(f"gold: unchanged since {version_name(kept)}")
            return {**read_record(spark, kept)["metrics"], "location": kept, "unmatched_codes_location": codes, "skipped": True}
    m = write_layer(
        fact_rows(spark, base, files), base, *FACT,
        metrics=[F.count_if(F.col("AIRLINE_NAME").isNull()).alias("unmatched")],
        cluster_by=list(FACT_DIMENSIONS),
        overwrite_schema=overwrite_schema,
        inputs=inputs,
    )
    point_states(spark, rollup=False)  # until the rollup of this fact is written
    log(f"gold: {m['rows']:,} rows")
    # Names are contract not-null, so a null name marks an unmatched row.
    written = spark.read.parquet(m["location"])
    codes = (
        written.filter(F.col("AIRLINE_NAME").isNull())
        .groupBy(F.col("AIRLINE_CODE").alias("airline_code"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    u = write_layer(codes, base, "gold", UNMATCHED_TABLE, inputs={".".join(FACT): version_name(m["location"])})
    m["unmatched_codes"], m["unmatched_codes_location"] = u["rows"], u["location"]
    if m["unmatched"]:
        some = spark.read.parquet(u["location"]).orderBy(F.desc("rows"), "airline_code").limit(log_codes).collect()
        log(f"[WARN] flights with unmatched airline codes: {m['unmatched']:,} rows, {u['rows']:,} codes, "
            f"most rows: {[r['airline_code'] for r in some]} (all in gold.{UNMATCHED_TABLE})")
    if preview_rows:
        m["preview"] = [r.asDict() for r in Q.preview(spark.table("gold.fact_flights_delay"), preview_rows).collect()]
        for row in m["preview"]:
            log(f"  {row}")
    return m


def run_rollup(spark: SparkSession, base: str, log: Log = print, resume: bool = False) -> dict:
    """The states of the current fact by date, airline and origin, into ``gold.rollup_flights_delay``.

    The version records the fact it was made of; ``sources.catalog.current_rollup`` hands it out only
    while that fact is the current one.
    """
    at = layer_location(spark, base, *FACT)
    if at is None:
        raise FileNotFoundError(f"no committed version of {'.'.join(FACT)} under {base}")
    inputs = {".".join(FACT): version_name(at)}
    if resume and (kept := unchanged(spark, base, "gold", ROLLUP_TABLE, inputs)):
        log(f"rollup: unchanged since {version_name(kept)}")
        return {**read_record(spark, kept)["metrics"], "location": kept, "skipped": True}
    fact_count = read_record(spark, at).get("metrics", {}).get("rows")
    m = write_layer(
        build_rollup(read_layer(spark, *FACT, base)), base, "gold", ROLLUP_TABLE,
        cluster_by=["FLIGHT_DATE"], inputs=inputs, options={"fact_rows": fact_count},
    )
    log(f"rollup: {m['rows']:,} rows")
    point_states(spark, rollup=current_rollup(spark, base) is not None)
    return m


def register(spark: SparkSession, base: str) -> list[dict]:
    """L4: the layer tables, and the reports as SQL functions once all tables they read are there."""
    out = register_layers(spark, base)
    if all(spark.catalog.tableExists(f"{layer}.{table}") for layer, table in LAYER_TABLES):
        names = register_report_functions(spark, rollup=current_rollup(spark, base) is not None)
        out += [{"function": name, "status": "registered", "durable": durable_catalog(spark)} for name in names]
    return out


def vacuum_layers(spark: SparkSession, base: str, keep: int, names: Sequence[str] = ()) -> list[str]:
    """Retention over every layer table (and quarantine folders that earlier releases kept for ``names``)."""
    tables = list(LAYER_TABLES) + [("gold", UNMATCHED_TABLE), ("gold", ROLLUP_TABLE)]
    tables += [("bronze", f"_quarantine_{n}") for n in names]
    deleted: list[str] = []
    for layer, table in tables:
        deleted += vacuum_layer(spark, base, layer, table, keep)
    return deleted


def run_all(
    spark: SparkSession,
    base: str,
    sources: Mapping[str, str],
    keep_malformed: bool = True,
    log: Log = print,
    keep_versions: int | None = None,
    overwrite_schema: bool = False,
    resume: bool = False,
) -> dict:
    """The whole chain in order; each stage raises on error.

    With ``resume`` a stage is skipped while its newest version was made of what it would read now: after a
    failure the chain goes on at the failed stage, and a changed source runs all stages below it.
    ``keep_versions`` (off by default) deletes layer versions beyond the
    newest ``keep_versions`` committed ones once the chain has succeeded.
    """
    out = {
        "bronze": run_bronze(spark, base, sources, keep_malformed, log, resume=resume),
        "silver": run_silver(spark, base, log=log, overwrite_schema=overwrite_schema, resume=resume),
        "gold": run_gold(spark, base, log=log, overwrite_schema=overwrite_schema, resume=resume),
        "rollup": run_rollup(spark, base, log=log, resume=resume),
        "register": register(spark, base),
    }
    if keep_versions is not None:
        out["vacuum"] = vacuum_layers(spark, base, keep_versions, list(sources))
    return out
