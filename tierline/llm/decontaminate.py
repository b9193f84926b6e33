"""Benchmark decontamination by a prefix-filtered set join (DataFrame functions only).

A benchmark item becomes windows of ``window`` words (a shorter item is one window), and a window
is the set of its shingles.  A document contains a window if it holds all the window's words in
a row, so every shingle of the window is a necessary one and the shortest sufficient prefix under
any order is the first shingle.  The steps:

1. Find all positions of documents that start a benchmark shingle, and count every shingle.
2. Order each window's shingles by rarity.  A window with a shingle that no document holds is out.
3. Join the prefix, the rarest shingle, to the positions.  The shingle's place in the window fixes
   where the window would start (positional bound); it must fit in the document (length bound).
4. Verify the words of every candidate against the document's words.

Nothing depends on the number of items: windows are joined, and broadcast only below a counted bound.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, row_key, small_side

#: Everything but digits, a-z and non-ASCII characters separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; null has none."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))
    return F.array_remove(F.split(F.coalesce(low, F.lit("")), SEPARATORS), "")


def _shingles(hashes: str, width: int) -> Column:
    """Hashes of all runs of ``width`` words, in order, from the array of word hashes."""
    at = lambda i, k: F.get(F.col(hashes), i + k)
    runs = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(hashes) - width, F.lit(0))),
        lambda i: F.xxhash64(*[at(i, F.lit(k)) for k in range(width)], F.lit(width)),
    )
    return F.when(F.size(hashes) >= width, runs)


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int, shingle: int) -> DataFrame:
    """``(item_id, win, n, width)``: the windows of every item as word arrays."""
    w = items.select(F.col(id_col).cast("string").alias("item_id"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    w = w.withColumn("n", F.least(F.size("w"), F.lit(window)))
    wins = F.transform(F.sequence(F.lit(1), F.size("w") - F.col("n") + 1), lambda i: F.slice("w", i, F.col("n")))
    return w.select("item_id", "n", F.explode(wins).alias("win")).withColumn("width", F.least("n", F.lit(shingle))).distinct()


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    shingle: int = 5,
) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, hits, key)``, one row per input row.

    ``n_hit`` counts the document's words inside any window, ``hits`` holds ``(start, n)`` of every
    occurrence in words.  A null or empty document or item has no words and matches nothing; items
    are told apart by the string of their id, and null ids count for none.  Repeated rows get equal
    results; an empty table of documents gives no rows, an empty benchmark leaves all rows clean.
    Texts may be of any length; further columns are ignored.
    """
    wins = item_windows(items, item_id, item_text, window, shingle)
    of_items = materialize(wins.select("item_id", F.array_join("win", " ").alias("wid"), "win", "n", "width"), "item-windows")
    windows = materialize(of_items.select("wid", "win", "n", "width").distinct(), "windows")
    widths = sorted(r[0] for r in windows.select("width").distinct().collect())  # 1 to ``shingle`` at most

    hashed = windows.withColumn("h", F.transform("win", lambda x: F.xxhash64(x)))
    per_window = None
    for k in widths:
        part = hashed.where(F.col("width") == k).select("wid", "n", F.lit(k).alias("width"), F.posexplode(_shingles("h", k)).alias("off", "sh"))
        per_window = part if per_window is None else per_window.unionByName(part)
    keyed = docs.select(row_key(F.col(id_col), F.col(text_col)).alias("key"), F.col(id_col).alias("doc_id"), words(F.col(text_col)).alias("w"))
    if per_window is None:
        judged = keyed.select("key", "doc_id", F.size("w").alias("n_words"), F.array().cast("array<struct<start:int,n:int,wid:string>>").alias("hits"))
    else:
        per_window = materialize(per_window, "window-shingles")
        wanted = small_side(materialize(per_window.select("sh").distinct(), "shingles"))
        found = None
        hashes = keyed.select("key", F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
        for k in widths:
            part = hashes.select("key", F.size("h").alias("n_words"), F.posexplode(_shingles("h", k)).alias("pos", "sh")).join(wanted, "sh")
            found = part if found is None else found.unionByName(part)
        found = materialize(found, "positions")
        rarity = found.groupBy("sh").agg(F.count("*").alias("freq"))
        ordered = per_window.join(rarity, "sh", "left").groupBy("wid", "n", "width")
        prefix = ordered.agg(F.min(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "sh", "off")).alias("p"))
        prefix = prefix.where("p.freq > 0").select("wid", "n", "p.sh", "p.off")
        start = F.col("pos") - F.col("off")
        near = found.join(prefix, "sh").where((start >= 0) & (start + F.col("n") <= F.col("n_words")))
        near = near.select("key", start.alias("start"), "n", "wid").distinct()
        near = near.groupBy("key").agg(F.collect_list(F.struct("start", "n", "wid")).alias("near"))
        near = small_side(materialize(near, "candidates"), 20_000)
        same = lambda c: F.array_join(F.slice("w", c["start"] + 1, c["n"]), " ") == c["wid"]
        judged = keyed.join(near, "key", "left").select(
            "key", "doc_id", F.size("w").alias("n_words"), F.array_sort(F.filter(F.coalesce("near", F.array()), same)).alias("hits")
        )
    judged = materialize(judged, "judged")
    pairs = judged.where(F.size("hits") > 0).select("key", F.explode(F.array_distinct(F.col("hits.wid"))).alias("wid")).distinct()
    named = pairs.join(of_items.where("item_id is not null").select("wid", "item_id"), "wid").groupBy("key")
    named = named.agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    # Starts come in order, so every window adds what lies beyond the furthest end so far.
    covered = F.aggregate(
        "hits",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, h: F.struct(
            (a["n"] + F.greatest(F.lit(0), h["start"] + h["n"] - F.greatest(h["start"], a["end"]))).alias("n"),
            F.greatest(a["end"], h["start"] + h["n"]).alias("end"),
        ),
        lambda a: a["n"].cast("long"),
    )
    out = judged.join(named, "key", "left").withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    return out.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        covered.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
        F.transform("hits", lambda h: F.struct(h["start"].alias("start"), h["n"].alias("n"))).alias("hits"),
        "key",
    )
