"""Substring dedup with repeated-phrase automata.

Every window of ``window`` words that also starts in a document with a smaller id is removed:

1. Equal texts meet by their digest.  Only the one with the smallest id goes on; the others repeat
   it whole.
2. Every window names an anchor, the least hash among its runs of ``run`` words, so equal windows name
   equal anchors.  Anchors found in two texts or more mark the passages that may recur; about one
   word in twenty is one, which keeps this step small.
3. The words around recurring anchors are cut out as segments.  Equal segments meet by digest, and
   again only the smallest id's goes on.
4. Anchors are dealt out in shards.  A shard confirms the windows that recur among its segments, compiles
   them into Aho-Corasick automata over word ids and streams the segments through them, which
   locates every occurrence exactly.  The windows of an anchor with more than ``max_segments``
   different segments are dealt out one by one instead, by their digest.
5. Documents with located windows drop the covered words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, materialize, row_key

BASE = 0x9E3779B97F4A7C15
LAST = 2**63 - 1
EMPTY = hashlib.sha256(b"").hexdigest()
#: Words of patterns in one automaton.
NODES = 1_000_000


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def run_hashes(words: list[bytes], run: int) -> np.ndarray:
    """A 64-bit hash of every run of ``run`` words."""
    h = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    n = len(h)
    if n < run:
        return np.zeros(0, np.uint64)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * _powers(n, BASE))))
    out = (total[run:] - total[:-run]) * _powers(n, pow(BASE, -1, 1 << 64))[: n - run + 1]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def anchors(words: list[bytes], window: int, run: int) -> np.ndarray:
    """The anchor of every window: the least hash among its runs."""
    h = run_hashes(words, run)
    span, have = window - run + 1, 1
    while have < span:  # minima over 2, 4, 8, ... runs, then the exact span
        step = min(have, span - have)
        h = np.minimum(h[:-step], h[step:])
        have += step
    return h


def digest(joined: bytes) -> bytes:
    return xxhash.xxh3_128_digest(joined)


def profiles(docs: DataFrame, window: int, run: int) -> DataFrame:
    """``(key, doc_id, sig, n_words, whole, anchors)`` of every row, one pass."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            sig, n, whole, found = [], [], [], []
            for text in b.column(2).to_pylist():
                words = (text or b"").split()
                joined = b" ".join(words)
                sig.append(digest(joined))
                n.append(len(words))
                whole.append(hashlib.sha256(joined).hexdigest())
                a = np.unique(anchors(words, window, run)) if len(words) >= window else np.zeros(0, np.uint64)
                found.append(a.view(np.int64))
            cols = [pa.array(sig, pa.binary()), pa.array(n, pa.int64()), pa.array(whole), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols], ["key", "doc_id", "sig", "n_words", "whole", "anchors"])

    return docs.mapInArrow(work, "key string, doc_id long, sig binary, n_words long, whole string, anchors array<long>")


def _segments(window: int, run: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "seg", "key", "doc_id", "start", "n", "words"]
        for b in chunks(batches):
            rows = []
            for key, doc, text, wanted in zip(*(c.to_pylist() for c in b.columns)):
                words = text.split()
                a = anchors(words, window, run).view(np.int64)
                cut = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1], [True])))
                on = np.isin(a[cut[:-1]], np.array(wanted, np.int64))
                for i, j in zip(cut[:-1][on].tolist(), cut[1:][on].tolist()):
                    part = b" ".join(words[i : j + window - 1])
                    rows.append((int(a[i]), digest(part), key, doc, i, j - i + window - 1, part))
                    if len(rows) >= 20_000:
                        yield _batch(rows, names)
                        rows = []
            yield _batch(rows, names)

    return work


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.binary(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 7, kinds)], names)


def locate(segments: list[tuple[int, int, list[bytes]]], window: int) -> Iterator[tuple[int, int]]:
    """``(segment, start)`` of windows that also stand in a segment with a smaller id.

    segments: anchor, id, words.  Only segments of one anchor can share a window.
    """
    seen: dict[tuple[int, int], tuple[int, int]] = {}  # (anchor, hash) -> first (segment, start)
    again: dict[tuple[int, int], tuple[int, int]] = {}
    for s, (anchor, _, words) in enumerate(segments):
        for at, h in enumerate(run_hashes(words, window).tolist()):
            first = seen.setdefault((anchor, h), (s, at))
            if first[0] != s:
                again[anchor, h] = first
    ids: dict[bytes, int] = {}
    coded = [[ids.setdefault(w, len(ids)) for w in words] for _, _, words in segments]
    patterns = list(again.values())
    for cut in range(0, len(patterns), max(1, NODES // window)):
        shard = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        part = patterns[cut : cut + max(1, NODES // window)]
        for i, (s, at) in enumerate(part):
            shard.add_word(tuple(coded[s][at : at + window]), i)
        shard.make_automaton()
        owner = np.full(len(part), LAST)
        found = [(i, s, end - window + 1) for s in range(len(segments)) for end, i in shard.iter(tuple(coded[s]))]
        for i, s, _ in found:
            owner[i] = min(owner[i], segments[s][1])
        for i, s, at in found:
            if owner[i] < segments[s][1]:
                yield s, at


def _shards(window: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out():
            rows = [(held[s][2], held[s][3] + at, window) for s, at in locate([(a, doc, w) for a, doc, _, _, w in held], window)]
            cols = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 3, (pa.string(), pa.int64(), pa.int64()))]
            return pa.RecordBatch.from_arrays(cols, ["key", "start", "n"])

        for b in batches:
            for a, doc, key, start, words in zip(*(c.to_pylist() for c in b.columns)):
                if size > NODES and held[-1][0] != a:  # a shard ends between two anchors
                    yield out()
                    held, size = [], 0
                held.append((a, doc, key, start, words.split()))
                size += len(held[-1][4])
        yield out()

    return work


def _single_windows(window: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, doc, key, start, joined in zip(*(c.to_pylist() for c in b.columns)):
                words = joined.split()
                n = len(words) - window + 1
                sig = pa.array([digest(b" ".join(words[i : i + window])) for i in range(n)], pa.binary())
                cols = [sig, pa.array([doc] * n, pa.int64()), pa.array([key] * n), pa.array(range(start, start + n), pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, ["sig", "doc_id", "key", "start"])

    return work


def repeated_spans(texts: DataFrame, prof: DataFrame, window: int, run: int, max_segments: int) -> DataFrame:
    """``(key, start, n)``: words of first texts that recur from smaller ids; spans may overlap."""
    first = prof.where(F.col("n_words") >= window).groupBy("sig").agg(F.min(F.struct("doc_id", "key")).alias("f"), F.first("anchors").alias("anchors"))
    first = materialize(first.select("f.key", "f.doc_id", "anchors"), "first-texts")
    exploded = first.select("key", F.explode("anchors").alias("a"))
    common = exploded.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a")
    wanted = exploded.join(common, "a").groupBy("key").agg(F.collect_list("a").alias("wanted"))
    wanted = materialize(wanted.join(first.select("key", "doc_id"), "key"), "wanted")
    # Repeated rows share a key and give the same segments, hence the distinct.
    rows = texts.drop("doc_id").join(wanted, "key").select("key", "doc_id", "text", "wanted")
    segs = rows.mapInArrow(_segments(window, run), "a long, seg binary, key string, doc_id long, start long, n long, words binary")
    segs = materialize(segs, "segments")

    least = segs.groupBy("a", "seg").agg(F.min("doc_id").alias("least"))
    kinds = materialize(least, "segment-kinds")
    dense = kinds.groupBy("a").agg(F.count("*").alias("kinds")).where("kinds > 1")
    whole = segs.select("a", "seg", "key", "doc_id", "start", "n").join(kinds, ["a", "seg"]).where("doc_id > least").select("key", "start", "n")
    owners = kinds.join(dense, "a").withColumnRenamed("least", "doc_id")
    owned = materialize(segs.join(owners, ["a", "seg", "doc_id"]).select("a", "doc_id", "key", "start", "words", "kinds").distinct(), "owned")
    few = owned.where(F.col("kinds") <= max_segments).drop("kinds").repartition("a").sortWithinPartitions("a")
    spans = whole.unionByName(few.mapInArrow(_shards(window), "key string, start long, n long"))
    many = owned.where(F.col("kinds") > max_segments).drop("kinds").mapInArrow(_single_windows(window), "sig binary, doc_id long, key string, start long")
    low = many.groupBy("sig").agg(F.min("doc_id").alias("least"))
    spans = spans.unionByName(many.join(low, "sig").where("doc_id > least").select("key", "start", F.lit(window).cast("long").alias("n")))
    return spans


def _cut(words: list[bytes], starts: list[int], sizes: list[int]) -> list[bytes]:
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, np.array(starts), 1)
    np.add.at(edge, np.array(starts) + np.array(sizes), -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(edge)[:-1] == 0).tolist()]


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, run: int = 8, max_segments: int = 20_000) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)``, one row per input row.

    Words are runs without ASCII white space.  Null and empty texts have none and lose none.  Equal ids
    are not smaller than each other, so repeated rows of one id keep their words; a null id counts as
    larger than all others.  Texts may be of any length.  An empty table gives no rows; further
    columns are ignored.
    """
    if not 0 < run <= window:
        raise ValueError("a run must fit in a window")
    texts = docs.select(
        row_key(F.col(id_col), F.col(text_col)).alias("key"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc_id"),
        F.col(text_col).cast("binary").alias("text"),
    )
    prof = materialize(profiles(texts, window, run), "profiles")
    narrow = prof.select("key", "doc_id", "sig", "n_words", "whole")
    least = narrow.where(F.col("n_words") >= window).groupBy("sig").agg(F.min("doc_id").alias("least"))
    narrow = narrow.join(least, "sig", "left").withColumn("copy", F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)))
    spans = repeated_spans(texts, prof, window, run, max_segments)
    spans = spans.groupBy("key").agg(F.collect_set(F.struct("start", "n")).alias("spans"))
    spans = materialize(spans, "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            rows = []
            for key, text, found in zip(*(c.to_pylist() for c in b.columns)):
                words = text.split()
                kept = _cut(words, [x["start"] for x in found], [x["n"] for x in found])
                rows.append((key, len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            cols = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 3, (pa.string(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays(cols, ["key", "n_removed", "kept_sha256"])

    changed = texts.drop("doc_id").join(spans, "key").select("key", "text", "spans").mapInArrow(cut, "key string, n_removed long, kept_sha256 string")
    changed = materialize(changed.dropDuplicates(["key"]), "changed")
    out = narrow.join(changed, "key", "left")
    return out.select(
        F.when(F.col("doc_id") < LAST, F.col("doc_id")).alias("doc_id"),
        "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("copy"), F.lit(EMPTY)).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"),
    )
