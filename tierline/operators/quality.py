"""Data-quality reports as DataFrames, each one pass over its input."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import DELAY_COLUMNS, DELAY_MAX, DELAY_MIN, Contract
from .joins import maybe_broadcast


def _stack(pairs: Sequence[tuple[str, Column]], key: str, value: str) -> Column:
    """``stack`` expression turning a one-row set of columns into rows."""
    args = []
    for label, c in pairs:
        args += [F.lit(label), c]
    return F.stack(F.lit(len(pairs)), *args).alias(key, value)


def null_profile(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Per column null count and share of rows.

    One aggregate computes every count in a single scan; the one-row result is
    unpivoted, columns without nulls are dropped and rows sorted by name.
    """
    cols = list(columns) if columns is not None else df.columns
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, null_count bigint, null_pct double")
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)],
    )
    long = counts.select(
        "_rows", _stack([(c, F.col(f"_n{i}")) for i, c in enumerate(cols)], "column_name", "null_count")
    )
    return (
        long.filter(F.col("null_count") > 0)
        .select(
            "column_name",
            "null_count",
            F.round(F.col("null_count") * F.lit(100.0) / F.col("_rows"), 2).alias("null_pct"),
        )
        .orderBy("column_name")
    )


def schema_drift(actual: Iterable[str], expected: Iterable[str]) -> dict[str, list[str]]:
    """Column-name set difference both ways (U3); metadata only, no job.

    Types are not compared, as in the source job.
    """
    a, e = set(actual), set(expected)
    return {"missing": sorted(e - a), "extra": sorted(a - e)}


def typed_drift(actual: StructType, expected: StructType) -> dict[str, list[str]]:
    """Drift in names and types: ``missing``, ``extra``, ``wider`` (safe to read as the wider type) and ``changed``."""
    from ..sources.layers import SchemaMismatchError, merged_schema

    out = {**schema_drift([f.name for f in actual.fields], [f.name for f in expected.fields]), "wider": [], "changed": []}
    kinds = {f.name: f for f in expected.fields}
    for f in actual.fields:
        want = kinds.get(f.name)
        if want is None or want.dataType == f.dataType:
            continue
        change = f"{f.name}: {want.dataType.simpleString()} -> {f.dataType.simpleString()}"
        try:
            wide = merged_schema(StructType([want]), StructType([f])).fields[0].dataType == f.dataType
        except SchemaMismatchError:
            wide = False
        out["wider" if wide else "changed"].append(change)
    return out


class SchemaDriftError(ValueError):
    pass


def check_drift(df: DataFrame, contract: Contract, warn=print) -> DataFrame:
    """Raise on missing contract columns, warn on extra ones (they flow through)."""
    drift = schema_drift(df.columns, contract.names)
    if drift["extra"]:
        warn(f"[WARN] {contract.name}: unexpected columns {drift['extra']}")
    if drift["missing"]:
        raise SchemaDriftError(f"{contract.name}: missing columns {drift['missing']}")
    return df


def out_of_range(cols: Iterable[str] = DELAY_COLUMNS, lo: float = DELAY_MIN, hi: float = DELAY_MAX) -> Column:
    """True when any non-null column lies outside [lo, hi] (P8); null is in range."""
    preds = [F.col(c).isNotNull() & ~F.col(c).between(lo, hi) for c in cols]
    out = preds[0]
    for p in preds[1:]:
        out = out | p
    return out


def clean_metrics(clean_df: DataFrame, date_col: str = "FLIGHT_DATE") -> DataFrame:
    """Rows, invalid dates and out-of-range rows of the clean layer in one pass (A3, A4)."""
    return clean_df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(date_col).isNull()).alias("invalid_dates"),
        F.count_if(out_of_range()).alias("out_of_range"),
    )


def unmatched_count(fact_df: DataFrame, name_col: str = "AIRLINE_NAME") -> DataFrame:
    """Fact rows without a dimension match (J4): a null name after the left join."""
    return fact_df.agg(
        F.count_if(F.col(name_col).isNull()).alias("unmatched_rows"),
        F.count(F.lit(1)).alias("total_rows"),
    )


def unmatched_codes(
    flights: DataFrame, dim: DataFrame, code: str = "AIRLINE", dim_code: str = "IATA_CODE"
) -> DataFrame:
    """Distinct fact codes with no dimension row (J5, A16); a null code is listed.

    The codes are aggregated first (partial aggregation, so a hot code costs
    nothing extra) and only one row per code meets the dimension in a
    ``left_anti`` join.  The join condition also names the per-code row count
    (always at least 1), which keeps the optimizer from moving the anti join
    below the aggregation, where it would meet every fact row and, with a
    dimension too big to broadcast, shuffle the whole fact.
    """
    codes = flights.groupBy(F.col(code).alias("airline_code")).agg(F.count(F.lit(1)).alias("_rows"))
    keys = dim.select(F.col(dim_code).alias("_k"))
    cond = (F.col("airline_code") == F.col("_k")) & (F.col("_rows") > 0)
    return codes.join(maybe_broadcast(keys), cond, "left_anti").select("airline_code")


def layer_counts(layers: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Row counts of several tables side by side."""
    if not layers:
        raise ValueError("layer_counts needs at least one (name, DataFrame) pair")
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("layer"), "row_count") for name, df in layers]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First rows, unordered."""
    return df.limit(n)
