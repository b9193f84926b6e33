"""Vector code compression: product codes by Lloyd's rounds over partition-local cover trees.

1. Vectors become integers and are cut into equal parts.  Every task builds, for runs of at most ``CHUNK``
   vectors and for every part, a cover tree: a node holds a centre, the radius of its points around it and a
   stretch of the run, reordered so that every subtree is one stretch.  The trees are written once.
2. A round walks all trees of a run from the root.  A node whose nearest entry is nearer than any other by more than
   twice its radius goes to that entry whole (triangle inequality), and cumulative sums over the stretches
   give its sum; only ambiguous nodes descend, and leaves compare their points exactly.
3. Every task adds up its trees, so a round shuffles one number per entry component and task.
   All arithmetic that decides is done in integers; roots of distances only rule entries out, with a margin.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, new_folder

#: Vectors of one tree and points of one leaf.
CHUNK = 4096
LEAF = 24
#: Runs of one file: a reader holds a file's rows at once.
RUNS_PER_FILE = 16
#: Label sums that are broadcast: keys of at most 65 characters.
BROADCAST_LABELS = 200_000

#: A node: first point and end of its stretch, place of its centre, first child, children.
NODE = np.dtype([("lo", "<i4"), ("hi", "<i4"), ("centre", "<i4"), ("child", "<i4"), ("children", "<i4"), ("radius", "<f8")])


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All places of the stretches [lo, hi), one after the other."""
    n = hi - lo
    if not n.sum():
        return np.zeros(0, np.int64)
    return np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())


def _squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all points to all entries."""
    out = np.empty((len(points), len(entries)), np.int64)
    for j, e in enumerate(entries):
        d = points - e
        out[:, j] = np.einsum("ij,ij->i", d, d)
    return out


@dataclass
class CoverTree:
    """Points in tree order and the nodes over them; ``order`` gives each point's place in the run."""

    points: np.ndarray
    order: np.ndarray
    nodes: np.ndarray

    @classmethod
    def build(cls, run: np.ndarray) -> CoverTree:
        """Children of a node are centred on its points, further than half its scale from each other, and hold the points within that half."""
        order = np.arange(len(run))
        reach = np.sqrt(_squares(run, run[:1])[:, 0])
        rows = [[0, len(run), 0, 0, 0, float(reach.max())]]  # centres as places in the run, for now
        at = 0
        while at < len(rows):
            lo, hi, centre, _, _, radius = rows[at]
            if hi - lo > LEAF and radius > 0:
                rest, put, first = order[lo:hi].copy(), lo, len(rows)
                while len(rest):
                    reach = np.sqrt(_squares(run[rest], run[centre : centre + 1])[:, 0])
                    near = reach <= radius / 2
                    members = rest[near]
                    order[put : put + len(members)] = members
                    rows.append([put, put + len(members), centre, 0, 0, float(reach[near].max())])
                    put, rest = put + len(members), rest[~near]
                    if len(rest):
                        centre = int(rest[0])
                rows[at][3:5] = first, len(rows) - first
            at += 1
        nodes = np.array([tuple(r) for r in rows], NODE)
        place = np.empty(len(run), np.int64)
        place[order] = np.arange(len(run))
        nodes["centre"] = place[nodes["centre"]]
        return cls(run[order], order, nodes)

    def assign(self, entries: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
        """Stretches that go to an entry whole, as (lo, hi, entry) arrays, and the other points with their entries."""
        same = (entries[:, None] == entries[None]).all(2)
        first = same.argmax(1) == np.arange(len(entries))  # entries equal to an earlier one win nothing
        own = np.flatnonzero(first)
        whole, points, nearest = [], [], []
        front = np.zeros(1, np.int64)
        while len(front):
            node = self.nodes[front]
            square = _squares(self.points[node["centre"]], entries[own])
            best = square.argmin(1)
            d = np.sqrt(square)
            d1 = d[np.arange(len(d)), best]
            d[np.arange(len(d)), best] = np.inf
            d2 = d.min(1)
            sure = (node["radius"] == 0) | (d2 - d1 > 2 * node["radius"] + 1e-9 * (d1 + node["radius"]) + 1e-6)
            whole.append((node["lo"][sure], node["hi"][sure], own[best[sure]]))
            node = node[~sure]
            leaf = node["children"] == 0
            here = _ranges(node["lo"][leaf].astype(np.int64), node["hi"][leaf].astype(np.int64))
            points.append(here)
            nearest.append(own[_squares(self.points[here], entries[own]).argmin(1)] if len(here) else here)
            inner = node[~leaf]
            front = _ranges(inner["child"].astype(np.int64), (inner["child"] + inner["children"]).astype(np.int64))
        return whole, np.concatenate(points), np.concatenate(nearest)

    def totals(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(points, sums of points) of every entry."""
        whole, points, nearest = self.assign(entries)
        before = np.concatenate([np.zeros((1, self.points.shape[1]), np.int64), np.cumsum(self.points, 0)])
        count, total = np.zeros(len(entries), np.int64), np.zeros(entries.shape, np.int64)
        for lo, hi, entry in whole:
            np.add.at(count, entry, (hi - lo).astype(np.int64))
            np.add.at(total, entry, before[hi] - before[lo])
        np.add.at(count, nearest, 1)
        np.add.at(total, nearest, self.points[points])
        return count, total

    def labels(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of every vector of the run, in the run's order."""
        whole, points, nearest = self.assign(entries)
        entry = np.empty(len(self.points), np.int64)
        for lo, hi, e in whole:
            entry[_ranges(lo.astype(np.int64), hi.astype(np.int64))] = np.repeat(e, hi - lo)
        entry[points] = nearest
        d = self.points - entries[entry]
        out, error = np.empty_like(entry), np.empty_like(entry)
        out[self.order], error[self.order] = entry, np.einsum("ij,ij->i", d, d)
        return out, error


# -- the trees as a table --------------------------------------------------------

_RUNS = (
    "dim int, n int, vec_ids array<long>, labels array<string>, points binary, orders array<binary>, nodes array<binary>, "
    "smallest array<struct<vec_id:long,vector:array<long>>>"
)


def _label_key(label: Column) -> Column:
    """One non-null key of bounded length per label."""
    text = label.cast("string")
    return F.coalesce(F.concat(F.lit("="), F.when(F.char_length(text) > 64, F.sha2(text, 256)).otherwise(text)), F.lit(""))


def runs(vectors: DataFrame, parts: int, scale: int, entries: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """Cover trees of all vectors that hold finite components alone, one row per run of equally long ones, written."""
    vec = F.col(vector_col).cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    length = F.size(vec)
    rows = vectors.where(F.col(vector_col).isNotNull()).where(finite & (length > 0) & (length % parts == 0))
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), _label_key(F.col(label_col)).alias("label"), vec.alias("vec"))

    def make(ids: list, labels: list, run: np.ndarray) -> list:
        if 4 * int(np.abs(run).max()) ** 2 * run.shape[1] >= 2**62:
            raise OverflowError("vector components are too large for squared distances of 64 bits")
        trees = [CoverTree.build(p) for p in np.split(run, parts, 1)]
        small = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, run[i].tolist()))[:entries]
        first = [{"vec_id": ids[i], "vector": run[i].tolist()} for i in small]
        return [run.shape[1], len(ids), ids, labels, run.tobytes(), [t.order.astype("<i4").tobytes() for t in trees], [t.nodes.tobytes() for t in trees], first]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_runs: dict[int, list] = {}

        def batch(rows: list[list]) -> pa.RecordBatch:
            first = pa.list_(pa.struct([("vec_id", pa.int64()), ("vector", pa.list_(pa.int64()))]))
            types = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.binary()), first]
            names = [c.split()[0] for c in _RUNS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for b in batches:
            lists = b.column(2)
            dims = np.diff(lists.offsets.to_numpy())
            values = np.floor(lists.flatten().to_numpy() * scale)
            if len(values) and np.abs(values).max() >= 2.0**31:
                raise OverflowError("vector components are too large for squared distances of 64 bits")
            values, ends = values.astype(np.int64), np.cumsum(dims)
            ids, labels = b.column(0).to_pylist(), b.column(1).to_pylist()
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                run = values[_ranges(ends[at] - dim, ends[at])].reshape(-1, dim)
                held = open_runs.setdefault(dim, [[], [], np.zeros((0, dim), np.int64)])
                held[0] += [ids[i] for i in at]
                held[1] += [labels[i] for i in at]
                held[2] = np.concatenate([held[2], run])
                while len(held[0]) >= CHUNK:
                    yield batch([make(held[0][:CHUNK], held[1][:CHUNK], held[2][:CHUNK])])
                    held[:] = held[0][CHUNK:], held[1][CHUNK:], held[2][CHUNK:]
        for held in open_runs.values():
            if held[0]:
                yield batch([make(*held)])

    spark = vectors.sparkSession
    path = new_folder(spark, "cover-trees")
    rows.mapInArrow(build, _RUNS).write.option("compression", "zstd").option("maxRecordsPerFile", RUNS_PER_FILE).parquet(path)
    return spark.read.schema(_RUNS).parquet(path)


def _trees(batch: pa.RecordBatch, parts: int) -> Iterator[tuple[int, list[CoverTree]]]:
    """(row, trees of the parts) of every run."""
    for i in range(batch.num_rows):
        dim, n = batch.column("dim")[i].as_py(), batch.column("n")[i].as_py()
        run = np.frombuffer(batch.column("points")[i].as_buffer(), "<i8").reshape(n, dim)
        trees = []
        for part, order, nodes in zip(np.split(run, parts, 1), batch.column("orders")[i], batch.column("nodes")[i]):
            order = np.frombuffer(order.as_buffer(), "<i4").astype(np.int64)
            trees.append(CoverTree(part[order], order, np.frombuffer(nodes.as_buffer(), NODE)))
        yield i, trees


def round_totals(trees: DataFrame, books: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(points, sums) of every entry of every part, over all runs."""
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(np.zeros(len(b), np.int64), np.zeros(b.shape, np.int64)) for b in books]
        for batch in batches:
            for _, own in _trees(batch, parts):
                for (count, total), tree, book in zip(found, own, books):
                    n, s = tree.totals(book)
                    count += n
                    total += s
        rows = [(p, e, c - 1, x) for p, (n, s) in enumerate(found) for e in np.flatnonzero(n).tolist() for c, x in enumerate([int(n[e]), *s[e].tolist()])]
        types = [pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        cols = zip(*rows) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["part", "entry", "place", "x"])

    rows = trees.select("dim", "n", "points", "orders", "nodes").mapInArrow(run, "part int, entry int, place int, x long")
    out = [(np.zeros(len(b), np.int64), np.zeros(b.shape, np.int64)) for b in books]
    for r in rows.groupBy("part", "entry", "place").agg(F.sum("x").alias("x")).collect():  # one row per entry component
        count, total = out[r["part"]]
        if r["place"] < 0:
            count[r["entry"]] = r["x"]
        else:
            total[r["entry"], r["place"]] = r["x"]
    return out


def train(trees: DataFrame, books: list[np.ndarray], rounds: int) -> list[np.ndarray]:
    """Codebooks after ``rounds`` of assignment and floor(sum / count); unused entries stay."""
    for _ in range(rounds):
        found = round_totals(trees, books)
        books = [np.where(n[:, None] > 0, s // np.maximum(n, 1)[:, None], b) for (n, s), b in zip(found, books)]
    return books


def encode(trees: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``(vec_id, label, code, error)`` of every vector of the runs."""
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, own in _trees(batch, parts):
                got = [tree.labels(book) for tree, book in zip(own, books)]
                codes = np.stack([e for e, _ in got], 1)
                codes = [bytes(r).hex() for r in codes.astype(np.uint8)]
                error = np.sum([d for _, d in got], 0)
                cols = [batch.column("vec_ids")[i].values, batch.column("labels")[i].values, pa.array(codes), pa.array(error, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, ["vec_id", "label", "code", "error"])

    return trees.select("dim", "n", "vec_ids", "labels", "points", "orders", "nodes").mapInArrow(run, "vec_id long, label string, code string, error long")


def with_label_error(coded: DataFrame, max_labels: int = BROADCAST_LABELS) -> DataFrame:
    """Adds ``label_error``, the error summed over equal labels.

    Up to ``max_labels`` sums are broadcast.  Beyond that only the sums of labels that hold over a thousandth of
    all rows are (fewer than a thousand, whatever the table), and the others are joined by a shuffle.
    """
    sums = materialize(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("rows")), "label-errors")
    size = sums.agg(F.count("*").alias("labels"), F.sum("rows").alias("rows")).first()
    if size["labels"] <= max_labels:
        return coded.join(F.broadcast(sums.drop("rows")), "label")
    hot = F.col("rows") * 1000 > size["rows"]
    hot_sums = F.broadcast(sums.where(hot).drop("rows"))
    many = coded.join(hot_sums, "label")
    few = coded.join(hot_sums.select("label"), "label", "left_anti").join(sums.where(~hot).drop("rows"), "label")
    return many.unionByName(few)


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, list[np.ndarray]]:
    """``(vec_id, label, code, error)`` of every kept vector, and the codebooks of the parts.

    Null vectors and vectors with null or non-finite components go.  So do empty vectors, those whose length the
    parts don't divide, and those of another length than most (the longer one of two equally frequent
    lengths): no codebook fits them.  A null id sorts last, equal ids sort by their vectors; repeated rows count
    as often as they stand there.  With fewer vectors than entries the codebooks are that
    much smaller; an empty table gives no rows and empty codebooks.  Components beyond what squared
    distances of 64 bits hold (about 20,000 for 64 components) raise ``OverflowError``.
    """
    trees = runs(vectors, parts, scale, entries, id_col, vector_col, label_col)
    lengths = trees.groupBy("dim").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()
    if not lengths:
        return encode(trees, [np.zeros((0, 0), np.int64)] * parts), [np.zeros((0, 0), np.int64)] * parts
    trees = trees.where(F.col("dim") == lengths[0]["dim"])
    small = trees.select(F.inline("smallest")).orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).collect()
    start = np.array([r["vector"] for r in small], np.int64)
    books = train(trees, np.split(start, parts, 1), rounds)
    return encode(trees, books), books


def codes(vectors: DataFrame, **columns: str) -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)`` of every kept vector; null labels are one label.

    Rows are kept as ``compress`` says; further columns are ignored.
    """
    coded, books = compress(vectors, **columns)
    out = with_label_error(materialize(coded, "codes"))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
