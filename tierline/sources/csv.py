"""Header CSV sources under a declared contract.

The reader never infers types: the contract's ``StructType`` is applied, a
header that does not match the contract's names fails the read
(``enforceSchema=false``; CSV binds columns by position otherwise), and in
PERMISSIVE mode a malformed line keeps its parsed fields with the bad ones null
and carries its text in a corrupt-record column.

The corrupt-record flag is only reliable on a full-width read: column pruning
drops it, and a query that reads the flag alone is refused.  A layer write
reads every column, so the flag is exact there and ingest needs one pass
(``layer_rows`` + ``ingest_metrics``); the quarantine re-reads the file at
full width only when malformed rows were seen (``quarantine_rows``).  For
sources that may change between two reads, ``stage_csv`` parses once into a
staged parquet copy under the session's checkpoint folder and ``split_corrupt``
splits from there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import Contract
from ..session import ensure_checkpoint_dir

CORRUPT = "_corrupt_record"


def read_csv(
    spark: SparkSession,
    path: str,
    contract: Contract,
    corrupt_col: str | None = CORRUPT,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Lazy PERMISSIVE read of header CSV file(s) with the contract schema."""
    schema = contract.schema
    if corrupt_col:
        schema = StructType(list(schema.fields) + [StructField(corrupt_col, StringType(), True)])
    reader = spark.read.option("header", "true").option("enforceSchema", "false").schema(schema)
    for k, v in {**parse_options(corrupt_col), **(options or {})}.items():
        reader = reader.option(k, v)
    return reader.csv(path)


def parse_options(corrupt_col: str | None = CORRUPT) -> dict[str, str]:
    """How a line is parsed, from files and from columns alike."""
    return {"mode": "PERMISSIVE", **({"columnNameOfCorruptRecord": corrupt_col} if corrupt_col else {})}


def parse_csv(lines: DataFrame, column: str, contract: Contract, corrupt_col: str = CORRUPT) -> DataFrame:
    """Lines of text in a column, parsed as ``read_csv`` parses lines of files."""
    schema = StructType(list(contract.schema.fields) + [StructField(corrupt_col, StringType(), True)])
    return lines.select(F.from_csv(F.col(column), schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), parse_options(corrupt_col)).alias("_row")).select("_row.*")


def staging_uri(spark: SparkSession, name: str) -> str:
    """A fresh folder for one staged copy, under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tierline-staging/{name}-{uuid.uuid4().hex[:12]}"


def ingest_metrics(df: DataFrame, columns: list[str], corrupt_col: str = CORRUPT) -> list:
    """Row count, per-column null counts and malformed count, as aggregate columns."""
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(corrupt_col).isNotNull()).alias("malformed"),
        *[F.count_if(F.col(c).isNull()).alias(f"null:{c}") for c in columns],
    ]


def stage_csv(
    spark: SparkSession,
    path: str,
    contract: Contract,
    name: str | None = None,
    options: dict[str, str] | None = None,
) -> tuple[DataFrame, dict]:
    """Parse the CSV once at full width into a staged parquet copy.

    Returns the staged DataFrame (contract columns plus the corrupt-record
    column) and the metrics observed during that single pass: ``rows``,
    ``malformed`` and ``null:<column>`` for every contract column, plus
    ``staging``, the folder to delete once the copy has been used.
    """
    df = read_csv(spark, path, contract, CORRUPT, options)
    obs = Observation(f"stage-{contract.name}-{uuid.uuid4().hex[:8]}")
    target = staging_uri(spark, name or contract.name)
    df.observe(obs, *ingest_metrics(df, contract.names)).write.mode("errorifexists").parquet(target)
    metrics = dict(obs.get)
    metrics["staging"] = target
    return spark.read.parquet(target), metrics


def layer_rows(df: DataFrame, keep: bool = True, corrupt_col: str = CORRUPT) -> DataFrame:
    """Contract columns of a full-width read; malformed rows removed unless ``keep``."""
    out = df if keep else df.filter(F.col(corrupt_col).isNull())
    return out.drop(corrupt_col)


def quarantine_rows(df: DataFrame, corrupt_col: str = CORRUPT) -> DataFrame:
    """Malformed rows of a full-width read: every parsed field plus the line text."""
    return df.filter(F.col(corrupt_col).isNotNull())


def split_corrupt(staged: DataFrame, keep: bool = True, corrupt_col: str = CORRUPT) -> tuple[DataFrame, DataFrame]:
    """(rows for the layer, quarantined rows) from a staged full-width parse.

    With ``keep`` malformed rows stay in the layer with their bad fields null,
    as the source job does, *and* are copied to quarantine; without it they
    are removed from the layer.
    """
    return layer_rows(staged, keep, corrupt_col), quarantine_rows(staged, corrupt_col)
