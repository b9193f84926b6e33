"""The training-data pipeline: toxicity, near-duplicates, benchmark decontamination, PII, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept.  All but the
last return the columns of ``docs``; the last returns the packed pieces.  Null texts are empty, null
ids and repeated rows pass like others, empty tables stay empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm import decontaminate, packing, pii, simhash, toxicity
from tierline.llm.common import documents, materialize, row_key, small_side
from tierline.llm.queries import vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose (id, text) is not among ``keys``."""
    gone = small_side(materialize(keys.select(F.col("key").alias("__key")).distinct(), "gone"))
    keyed = docs.withColumn("__key", row_key(F.col("doc_id"), F.col("text")))
    return keyed.join(gone, "__key", "left_anti").select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    scored = toxicity.toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _without(docs, scored.where("predicted = 1"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of near-duplicates the document with the smallest id stays.

    A class of null ids only keeps the row with the smallest key, and so do rows that share the
    smallest id.  Rows repeated as a whole stay once.
    """
    found = materialize(simhash.near_duplicates(docs, shingle=3, max_bits=2), "classes")
    name = F.when(F.col("component_id").isNull(), F.concat(F.lit("f"), "fingerprint")).otherwise(F.col("component_id").cast("string"))
    heads = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy(name.alias("class")).agg(F.min("key").alias("key"))
    kept = _without(docs, found.join(heads.select("key"), "key", "left_anti"))
    again = materialize(found.groupBy("key").count().where("count > 1").select(F.col("key").alias("__key")), "repeated")
    again = small_side(again)
    keyed = kept.withColumn("__key", row_key(F.col("doc_id"), F.col("text")))
    once = keyed.join(again, "__key", "left_anti")
    return once.unionByName(keyed.join(again, "__key", "left_semi").dropDuplicates(["__key"])).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    found = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(docs, found.where("contaminated"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and disclosing terms are replaced in the text; ``n_chars`` follows the text."""
    clean = pii.redact(docs)
    if "n_chars" in clean.columns:
        clean = clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of 2048."""
    return packing.pack(docs, vocabulary(), size=2048)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", redact_pii),
    ("packing", pack),
]

#: Votes, classes and packing are not SQL.  Tests compare near-duplicates and decontamination with brute-force
#: versions; toxicity and redaction as stages, and the whole run, are only checked for empty tables and row counts.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
