"""Sharding through fixed virtual slots (law ``bytes``).

Records are hashed into a fixed number of virtual slots, and only the bytes of every slot, a table of
that fixed size, decide where slots go.  The slot-to-shard map is a small versioned table: the
first version deals slots out by size, later ones edit it and move as few slots as needed.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, new_folder

SLOTS = 8192


def virtual_slot(doc_id: Column, text: Column, slots: int = SLOTS) -> Column:
    """Slot of a record by its id; records without an id go by their text."""
    return F.pmod(F.when(doc_id.isNull(), F.xxhash64(text)).otherwise(F.xxhash64(doc_id)), F.lit(slots)).cast("int")


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """``(doc_id, size, text_crc32, virtual_slot)`` of every row; null counts as an empty text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        virtual_slot(F.col(id_col), text, slots).alias("virtual_slot"),
    )


def slot_bytes(rows: DataFrame) -> dict[int, int]:
    """Bytes of every slot in use; at most as many entries as there are slots."""
    return {r[0]: r[1] for r in rows.groupBy("virtual_slot").agg(F.sum("size")).collect()}


def deal(sizes: dict[int, int], shards: int, slots: int = SLOTS) -> dict[int, int]:
    """Slot -> shard: largest slot first, always to the lightest shard."""
    heap = [(0, 0, s) for s in range(shards)]
    out = {}
    for slot in sorted(range(slots), key=lambda s: (-sizes.get(s, 0), s)):
        load, n, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (load + sizes.get(slot, 0), n + 1, shard))
    return out


def rebalance(old: dict[int, int], sizes: dict[int, int], shards: int) -> dict[int, int]:
    """Edit a map for new sizes or more shards: move slots only from above the mean to below it.

    With one more shard, slots move only into that one as long as the others stay above the mean.
    """
    out = dict(old)
    load = {s: 0 for s in range(shards)}
    for slot, shard in out.items():
        load[shard] += sizes.get(slot, 0)
    mean = sum(load.values()) / shards
    for slot in sorted(out, key=lambda s: (-sizes.get(s, 0), s)):
        size, here = sizes.get(slot, 0), out[slot]
        there = min(load, key=lambda s: (load[s], s))
        if size and load[here] - size >= mean > 0 and load[there] + size <= mean:
            out[slot], load[here], load[there] = there, load[here] - size, load[there] + size
    # Slots that still fit nowhere below the mean go if they narrow the gap.
    for slot in sorted(out, key=lambda s: (-sizes.get(s, 0), s)):
        size, here = sizes.get(slot, 0), out[slot]
        there = min(load, key=lambda s: (load[s], s))
        if size and load[here] > mean and load[there] + size < load[here]:
            out[slot], load[here], load[there] = there, load[here] - size, load[there] + size
    return out


def save_map(spark: SparkSession, path: str, version: int, placed: dict[int, int]) -> None:
    """Add a version of the map; a version is written once and never changed."""
    rows = spark.createDataFrame(sorted(placed.items()), "virtual_slot int, shard int")
    rows.coalesce(1).write.mode("error").parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{path}/version={version}").select("virtual_slot", "shard")


def assign(rows: DataFrame, placed: DataFrame) -> DataFrame:
    """Adds ``shard`` and ``slot``, the row's place in its shard, gapless from 0.

    A shard's rows are numbered inside each virtual slot, after the rows of its earlier slots, so
    no task holds a whole shard.  The map has one row per virtual slot, hence the broadcast.
    """
    tie = ["doc_id", "size", "text_crc32"]
    counts = rows.groupBy("virtual_slot").agg(F.count("*").alias("n")).join(F.broadcast(placed), "virtual_slot")
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("virtual_slot", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("virtual_slot").orderBy(*tie))
    return rows.withColumn("inside", inside).join(F.broadcast(base), "virtual_slot").withColumn("slot", F.col("base") + F.col("inside") - 1)


def shard(docs: DataFrame, shards: int = 16, slots: int = SLOTS, map_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot)``, one row per input row.

    The map is stored as version 1 below ``map_path`` (by default a new shared folder).  Null texts are
    empty, null ids are dealt by their text, repeated rows share a virtual slot but each has its own
    place.  An empty table gives no rows; further columns are ignored.
    """
    spark = docs.sparkSession
    rows = materialize(sized(docs, id_col, text_col, slots), "sized")
    path = map_path or new_folder(spark, "slot-map")
    save_map(spark, path, 1, deal(slot_bytes(rows), shards, slots))
    out = assign(rows, load_map(spark, path, 1))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot"
    )
