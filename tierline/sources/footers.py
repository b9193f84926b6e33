"""Row counts and bounds of stored versions from Parquet footers alone.

Spark's second Parquet reader answers count, min and max from row-group statistics when asked to; it is
switched on in a session of its own, which shares the context and changes nothing for others.  Statistics can
be absent (or unusable, as for text); then the columns are scanned, with the same result.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_FOOTER_CONF = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def _frame(spark: SparkSession, paths: Sequence[str], schema: StructType | None) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", "true")
    return (reader.schema(schema) if schema is not None else reader).parquet(*paths)


def _stats(df: DataFrame, bounds: Sequence[str]) -> DataFrame:
    ends = [f(c).alias(f"{n}_{c}") for c in bounds for n, f in (("min", F.min), ("max", F.max))]
    return df.agg(F.count(F.lit(1)).alias("row_count"), *ends)


def footer_stats(spark: SparkSession, paths: str | Sequence[str], bounds: Sequence[str] = (), schema: StructType | None = None) -> DataFrame:
    """One row ``(row_count, min_<c>, max_<c>, ...)``, planned as a pushed aggregation; running it fails
    where a footer lacks the statistics.  Without any file to read Spark's pushed count is null."""
    session = spark.newSession()
    for key, value in _FOOTER_CONF.items():
        session.conf.set(key, value)
    return _stats(_frame(session, [paths] if isinstance(paths, str) else list(paths), schema), bounds)


def file_stats(spark: SparkSession, paths: str | Sequence[str], bounds: Sequence[str] = (), schema: StructType | None = None) -> dict:
    """The same row as a dict, from footers where they hold it, else from a scan of the bound columns."""
    try:
        row = footer_stats(spark, paths, bounds, schema).first()
    except (PySparkException, Py4JJavaError):  # a footer without statistics; what else is wrong fails the scan as well
        row = _stats(_frame(spark, [paths] if isinstance(paths, str) else list(paths), schema), bounds).first()
    return {**row.asDict(), "row_count": row["row_count"] or 0}
