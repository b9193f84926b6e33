"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first()
    return tuple(row)


def _round(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    # Large star: every larger neighbour of u moves to the smallest of u's neighbourhood.
    large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    # Small star: u and its smaller neighbours move to the smallest of them.
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(u, v)`` edges between long ids -> ``(u, root)`` for every id but the roots.

    The root is the smallest id of the component.  Ends and their order do not matter, self loops
    and repeated edges are allowed, no edges give no rows.  Every round is written to the shared
    folder; the number of rounds grows with the logarithm of the longest chain.
    """
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = materialize(e, "edges")
    last = _state(e)
    while last[0]:
        e = materialize(_round(e), "edges")
        now = _state(e)
        if now == last:
            break
        last = now
    return e.select("u", F.col("v").alias("root"))
