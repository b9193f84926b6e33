"""SimHash near-duplicates through a Gray-order hierarchical index.

Every text becomes a 64-bit fingerprint.  Distinct fingerprints within ``max_bits`` differing bits
are linked, and documents of one connected component form a class.

The index has upper nodes that Spark deals out and lower nodes inside a task:

* Upper nodes: the 64 bits are four blocks of 16.  Two fingerprints that differ in at most two
  bits agree on at least two blocks, so they meet under one of the six masks that keep two blocks.
  A node is a mask and the bits shared under it.  A node of more than ``max_node`` fingerprints is
  factored again: the 32 free bits are four blocks of 8, and two of them are kept.  Such a node
  has 16 free bits left, so it never holds more than 65,536 fingerprints.
* Lower nodes: a node's fingerprints are sorted by Gray rank, so neighbours share long patterns.
  Sixteen children form a parent, which keeps the bits on which they all agree.  A search goes
  down from the top, adds the differences on the bits each node newly fixes, and drops the
  whole group once they exceed the limit.

Only spanning links leave a node, never all pairs of a group of copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, materialize, row_key
from .components import components

FAN = 16
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """SimHash of the A-Z-lowered words of a UTF-8 text; no words give zero."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 32768):
        h = np.array([digest(joined[a:b], 42) for a, b in zip(starts[at : at + 32768], stops[at : at + 32768])], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(doc_id, key, fp)`` with the fingerprint's 64 bits as a signed long, one row per input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            fps = [fingerprint(t, shingle) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.array(fps, np.uint64).view(np.int64))], ["doc_id", "key", "fp"])

    key = row_key(F.col(id_col), F.col(text_col)).alias("key")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), key, F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, key string, fp long")


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Place of each fingerprint in Gray-code order."""
    r = fp.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


class GrayIndex:
    """Nodes over Gray-sorted fingerprints; level 0 holds the fingerprints themselves."""

    def __init__(self, fps: np.ndarray):
        self.levels = [(fps, np.full(len(fps), ALL))]
        while len(self.levels[-1][0]) > FAN:
            pattern, mask = self.levels[-1]
            cut = np.arange(0, len(pattern), FAN)
            low, high = np.bitwise_and.reduceat(pattern, cut), np.bitwise_or.reduceat(pattern, cut)
            mask = np.bitwise_and.reduceat(mask, cut) & ~(low ^ high)
            self.levels.append((low & mask, mask))

    def search(self, queries: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions (query, fingerprint) within ``most`` differing bits."""
        top = len(self.levels) - 1
        pattern, mask = self.levels[top]
        q = np.repeat(np.arange(len(queries)), len(pattern))
        node = np.tile(np.arange(len(pattern)), len(queries))
        diff = np.bitwise_count((queries[q] ^ pattern[node]) & mask[node]).astype(np.int64)
        for level in range(top - 1, -1, -1):
            on = diff <= most
            q, node, diff = q[on], node[on], diff[on]
            above = self.levels[level + 1][1]
            pattern, mask = self.levels[level]
            child = (node[:, None] * FAN + np.arange(FAN)).ravel()
            q, diff, parent = np.repeat(q, FAN), np.repeat(diff, FAN), np.repeat(node, FAN)
            real = child < len(pattern)
            q, diff, parent, node = q[real], diff[real], parent[real], child[real]
            diff = diff + np.bitwise_count((queries[q] ^ pattern[node]) & mask[node] & ~above[parent])
        on = diff <= most
        return q[on], node[on]


def _spanning(fps: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (id, smallest id of its class) inside one node."""
    order = np.argsort(gray_rank(fps), kind="stable")
    fps, ids = fps[order], ids[order]
    index, label = GrayIndex(fps), np.arange(len(fps))
    for at in range(0, len(fps), 2048):
        i, j = index.search(fps[at : at + 2048], most)
        i = i + at
        while True:
            low = np.minimum(label[i], label[j])
            if (low == label[i]).all() and (low == label[j]).all():
                break
            for end in (i, j):
                np.minimum.at(label, label[end], low)
                np.minimum.at(label, end, low)
            while (label[label] != label).any():
                label = label[label]
    # Classes found so far may still meet through labels of earlier chunks.
    while (label[label] != label).any():
        label = label[label]
    least = np.full(len(fps), np.iinfo(np.int64).max)
    np.minimum.at(least, label, ids)
    root = least[label]
    return ids[ids != root], root[ids != root]


def _node_links(most: int):
    def links(m: np.ndarray, key: np.ndarray, fp: np.ndarray, v: np.ndarray):
        new = np.flatnonzero(np.concatenate(([True], (m[1:] != m[:-1]) | (key[1:] != key[:-1]))))
        sizes = np.diff(np.concatenate((new, [len(m)])))
        size = np.repeat(sizes, sizes)
        for lag in range(1, FAN):  # nodes that fit one leaf: compare inside the leaf
            a = np.flatnonzero((size[:-lag] <= FAN) & (m[lag:] == m[:-lag]) & (key[lag:] == key[:-lag]))
            a = a[np.bitwise_count(fp[a] ^ fp[a + lag]) <= most]
            if len(a):
                yield v[a], v[a + lag]
        for at, n in zip(new[sizes > FAN], sizes[sizes > FAN]):
            yield _spanning(fp[at : at + n], v[at : at + n], most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def out(parts):
            cols = [np.concatenate(x) for x in zip(*parts)]
            for u, w in links(cols[0], cols[1], cols[2].view(np.uint64), cols[3]):
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(w)], ["u", "v"])

        for b in batches:
            if not b.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            # The last node of a batch may go on in the next one.
            last = len(cols[0]) - 1
            inside = (cols[0] == cols[0][last]) & (cols[1] == cols[1][last])
            first = int(np.argmax(inside))
            if first or (held and (held[-1][0][-1] != cols[0][0] or held[-1][1][-1] != cols[1][0])):
                yield from out([*held, [c[:first] for c in cols]])
                held = []
            held.append([c[first:] for c in cols])
        if held:
            yield from out(held)

    return run


def _masks(blocks: list[int]) -> list[int]:
    return [a | b for a, b in combinations(blocks, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _under(rows: DataFrame, masks: list[int]) -> DataFrame:
    nodes = F.array(*[F.struct(F.lit(_signed(m)).alias("m"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for m in masks])
    return rows.select("fp", "v", F.explode(nodes).alias("n")).select("n.m", "n.key", "fp", "v")


def links(fps: DataFrame, max_bits: int = 2, max_node: int = 4096) -> DataFrame:
    """Spanning links ``(u, v)`` of distinct fingerprints ``(fp, v)`` within ``max_bits`` (at most 2) bits."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the four-block masks are exact up to two differing bits")
    upper = _masks([0xFFFF << 16 * i for i in range(4)])
    first = _under(fps, upper)
    sizes = first.groupBy("m", "key").agg(F.count("*").alias("n")).where("n > 1")
    first = first.join(sizes, ["m", "key"])
    small, large = first.where(F.col("n") <= max_node).drop("n"), first.where(F.col("n") > max_node)
    parts = [small]
    for mask in upper:  # factor a large node again by its free bits
        free = [i for i in range(4) if not mask >> 16 * i & 1]
        blocks = [0xFF << 16 * i + 8 * j for i in free for j in range(2)]
        parts.append(_under(large.where(F.col("m") == _signed(mask)).select("fp", "v"), [mask | x for x in _masks(blocks)]))
    nodes = parts[0]
    for p in parts[1:]:
        nodes = nodes.unionByName(p)
    nodes = nodes.repartition("m", "key").sortWithinPartitions("m", "key")
    return nodes.mapInArrow(_node_links(max_bits), "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2, max_node: int = 4096) -> DataFrame:
    """``(doc_id, fingerprint, component_id, key)``, one row per input row.

    Words are runs without ASCII white space of the whole text, A-Z lower-cased; shingles of
    ``shingle`` words with repeats (a shorter text is one shingle).  A null or empty text has
    fingerprint zero, which links like any other.  ``component_id`` is the smallest id reachable.  A
    row of null id takes the class of its fingerprint; a fingerprint that only null ids hold is no
    vertex, and its class is null.  Repeated rows share their class, and one id on rows of several
    texts joins their classes.  An empty table gives no rows; further columns are ignored.
    """
    prints = materialize(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    fps = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "distinct")
    vertex = fps.where("doc_id is not null").select("fp", F.col("doc_id").alias("v"))
    roots = components(links(vertex, max_bits, max_node))
    known = fps.join(roots, fps.doc_id == roots.u, "left").select("fp", F.coalesce("root", "doc_id").alias("component_id"))
    return prints.join(known, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "key"
    )
