"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Rows up to which a counted table may be broadcast.
BROADCAST_ROWS = 200_000


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder of the session."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tierline-llm/{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends, losses only reread files."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a materialized table for broadcast if its counted rows stay under the bound.

    Beyond the bound the table is returned as it is, and the join shuffles.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def row_key(doc_id: Column, text: Column) -> Column:
    """One non-null key per distinct (id, text); repeated rows share it."""
    return F.concat_ws(":", doc_id.cast("string"), F.hex(F.xxhash64(text)))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def chunks(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Arrow batches in slices, so that few texts at a time are Python objects."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


class Recent(dict):
    """A memory of ``make(key)`` for at least the last ``keep`` keys and at most twice as many."""

    def __init__(self, keep: int):
        super().__init__()
        self.keep, self.old = keep, {}

    def make(self, key):
        raise KeyError(key)

    def __missing__(self, key):
        value = self.old.pop(key, None)
        if value is None:
            value = self.make(key)
        if len(self) >= self.keep:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value
