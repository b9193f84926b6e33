"""Dimension joins with a checked broadcast.

A dimension is broadcast only after an aggregate proves it small, in rows and in bytes.
Each task of that aggregate sends one row, so the check is no funnel whatever the size, and it reads
the *dimension* alone, never the fact.  Nothing is remembered between checks: a file replaced
in place is counted again.  Beyond the bounds the join is left to Spark as a shuffle join, where
adaptive execution can still switch to a broadcast from measured sizes and split skewed
key partitions.

The bounds (500,000 rows, conf ``tierline.broadcast.maxRows``; 64 MB of values, conf
``tierline.broadcast.maxBytes``) apply to the projected dimension, which carries only the key and the
attributes the join needs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

#: Conf keys overriding the broadcast bounds.
MAX_ROWS_CONF = "tierline.broadcast.maxRows"
MAX_BYTES_CONF = "tierline.broadcast.maxBytes"
DEFAULT_MAX_ROWS = 500_000
DEFAULT_MAX_BYTES = 64 << 20


def broadcast_bound(df: DataFrame) -> int:
    value = df.sparkSession.conf.get(MAX_ROWS_CONF, None)
    return int(value) if value else DEFAULT_MAX_ROWS


def byte_bound(df: DataFrame) -> int:
    value = df.sparkSession.conf.get(MAX_BYTES_CONF, None)
    return int(value) if value else DEFAULT_MAX_BYTES


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values written as text, plus 16 per column."""
    size = F.lit(16 * len(df.columns)).cast("long")
    for c in df.columns:
        size = size + F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0))
    return size


def dimension_size(dim: DataFrame) -> DataFrame:
    """One row with the dimension's rows and bytes."""
    return dim.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes(dim)), F.lit(0)).alias("bytes"))


def fits_broadcast(dim: DataFrame, max_rows: int | None = None) -> bool:
    """True when ``dim`` is counted to stay within both bounds."""
    bound = broadcast_bound(dim) if max_rows is None else max_rows
    size = dimension_size(dim).first()
    return size["rows"] <= bound and size["bytes"] <= byte_bound(dim)


def maybe_broadcast_all(*dims: DataFrame) -> list[DataFrame]:
    """``maybe_broadcast`` of several dimensions whose sizes are counted in one job."""
    sizes = [dimension_size(d).select(F.lit(i).alias("dim"), "rows", "bytes") for i, d in enumerate(dims)]
    both = sizes[0]
    for s in sizes[1:]:
        both = both.unionAll(s)
    counted = {r["dim"]: r for r in both.collect()}  # one row per dimension
    fits = [counted[i]["rows"] <= broadcast_bound(d) and counted[i]["bytes"] <= byte_bound(d) for i, d in enumerate(dims)]
    return [F.broadcast(d) if ok else d for d, ok in zip(dims, fits)]


def maybe_broadcast(dim: DataFrame, max_rows: int | None = None) -> DataFrame:
    return F.broadcast(dim) if fits_broadcast(dim, max_rows) else dim


def join_dimension(
    fact: DataFrame,
    dim: DataFrame,
    on: Column | str | list[str],
    how: str = "inner",
    max_rows: int | None = None,
) -> DataFrame:
    """``fact`` joined to a dimension, broadcasting it only when it is proven small."""
    return fact.join(maybe_broadcast(dim, max_rows), on, how)


def profile_dimension(dim: DataFrame, key: list[str] | tuple[str, ...]) -> tuple[int, int, int]:
    """(rows, keys that repeat, bytes) of a dimension in one aggregate job.

    Serves both checks a dimension join needs: the key must be unique (else
    the join fans out) and the row count bounds the broadcast.  Partial
    aggregation by key keeps a repeated hot key cheap.
    """
    per_key = dim.groupBy(*key).agg(F.count(F.lit(1)).alias("_copies"), F.sum(row_bytes(dim)).alias("_bytes"))
    row = per_key.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"),
        F.count_if(F.col("_copies") > 1).alias("repeated"),
        F.coalesce(F.sum("_bytes"), F.lit(0)).alias("bytes"),
    ).first()
    return int(row["rows"]), int(row["repeated"]), int(row["bytes"])


#: A key with more than this share of all rows is hot; so there are fewer than 200 hot keys.
HOT_SHARE = 0.005


def hot_keys(rows: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Values of ``key`` (null among them) that hold more than ``share`` of all rows, from the aggregated counts of the key alone."""
    seen = Observation(f"keys-{uuid.uuid4().hex[:8]}")
    per = rows.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    per = per.observe(seen, F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
    top = per.orderBy(F.desc("n")).limit(int(1 / share)).collect()
    return [r["key"] for r in top if r["n"] > share * seen.get["rows"]]


def join_skewed(rows: DataFrame, dim: DataFrame, key: str, dim_key: str, how: str = "left", share: float = HOT_SHARE) -> DataFrame:
    """``rows`` joined to a dimension that is too big to broadcast, with no task that a hot key fills.

    The dimension's key must be unique, so the rows of the hot keys (fewer than ``1 / share``) are a broadcast of
    proven size: hot rows, and rows without a key, meet them where they lie.  The others are shuffled, and
    no key among them holds more than ``share``.  This needs nothing of the session's settings.  The counts
    read the key column; rows are read in both branches, or once where no key is hot.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"join_skewed joins left or inner, not {how!r}")
    hot = hot_keys(rows, key, share)
    on = F.col(key) == F.col(dim_key)
    # A hint, so that no estimate turns the big dimension into a broadcast.
    if not hot:
        return rows.join(dim.hint("shuffle_hash"), on, how)
    known = [k for k in hot if k is not None]
    of_hot = lambda c: F.coalesce(F.col(c).isin(known), F.lit(False)) if known else F.lit(False)
    here = F.col(key).isNull() | of_hot(key)
    few, rest = dim.where(of_hot(dim_key)), dim.where(~of_hot(dim_key)).hint("shuffle_hash")
    return rows.where(here).join(F.broadcast(few), on, how).unionByName(rows.where(~here).join(rest, on, how))
