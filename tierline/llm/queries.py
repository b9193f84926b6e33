"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, codebooks, decontaminate, html_extract, langid, licenses, packing, phrase_dedup, pii, quality_rules, sharding, simhash, toxicity
from .common import documents
from .html_labels import LABELLED
from .oracle import ORACLE_SQL as ORACLE_SQL

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.pack(documents(spark, sf_dir), vocabulary(), size=2048)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents from the nearest labelled ones."""
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")).drop("key")


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents; a document lies in the folder of its source and language."""
    path = F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return licenses.scan(documents(spark, sf_dir).withColumn("path", path), count_outside=True)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and the cascade's verdict on all documents."""
    return quality_rules.quality(documents(spark, sf_dir))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows inside all documents."""
    found = decontaminate.contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.drop("hits", "key")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards through virtual slots."""
    return sharding.shard(documents(spark, sf_dir), shards=16)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return html_extract.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"), LABELLED)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and disclosing terms in all documents."""
    return pii.report(documents(spark, sf_dir))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents by 64-bit fingerprints."""
    return simhash.near_duplicates(documents(spark, sf_dir), shingle=3, max_bits=2).drop("key")


def op10_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without passages of 50 words that a smaller doc_id has."""
    return phrase_dedup.dedup(documents(spark, sf_dir), window=50)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all embeddings."""
    return codebooks.codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from those not held out."""
    return langid.language_id(documents(spark, sf_dir))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers over all documents, aligned by bytes."""
    import public_tokenizers

    a, b = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align.alignment(documents(spark, sf_dir), a, b).drop("key")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_packing,
        op2_toxicity,
        op3_licenses,
        op4_quality_rules,
        op5_decontamination,
        op6_sharding,
        op7_html_extraction,
        op8_pii,
        op9_simhash,
        op10_phrase_dedup,
        op11_vector_codes,
        op12_language_id,
        op13_token_alignment,
    )
}
