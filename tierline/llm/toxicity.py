"""Toxicity votes of the nearest labelled examples.

1. Features of a text are its words and their first and last letters, so that
   inflected and compounded terms count together.  A bounded sample of labelled rows picks the
   features that go with either label (chi-square).
2. One pass over all documents gives their sparse vectors, and the corpus counts give the idf.
3. The examples are held in an inverted index: postings by feature, cut into blocks of examples, with
   the largest weight of every feature in every block.  A query visits blocks in the order of
   their upper bound and stops when no block can beat the k-th best, so the search is exact.
4. Neighbours vote with a weight that falls with their distance.  The examples' own votes, each left
   out of its search, calibrate votes to probabilities by isotonic regression.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Recent, chunks, materialize, row_key

WORD = re.compile(r"[^\W\d_]+")
BLOCK = 64


@dataclass(frozen=True)
class Params:
    """Bounds of the fit and of the search."""

    max_examples: int = 4000  # labelled rows of each label
    max_features: int = 2048
    min_chi2: float = 40.0  # far beyond chance for millions of candidate features
    min_lift: float = 4.0
    k: int = 15
    rows_per_task: int = 50_000  # searches of one task; vectors are too small to be dealt out by bytes


def term_features(word: str) -> list[str]:
    out = ["w" + word]
    if len(word) > 4:
        out += ["a" + word[:4], "z" + word[-4:]]
        if len(word) > 6:
            out += ["a" + word[:6], "z" + word[-6:]]
    return out


def is_training(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


def _examples(docs: DataFrame, labels: DataFrame, p: Params) -> DataFrame:
    """A bounded sample of the labelled training rows, the same in every run."""
    known = labels.where("toxic in (0, 1) and doc_id is not null").where(is_training(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    side = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(p.max_examples) for y in (0, 1)]
    return docs.join(F.broadcast(side[0].unionByName(side[1])), "doc_id")


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in chunks(batches, 50):
        for label, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            words = WORD.findall((text or "").lower())
            # With the words around its first place: copies of one text repeat them.
            first = {f: i for i in range(len(words) - 1, -1, -1) for f in term_features(words[i])}
            if first:
                around = [xxhash.xxh64_intdigest(" ".join(words[max(0, i - 2) : i + 3])) >> 1 for i in first.values()]
                cols = [pa.array(np.full(len(first), label, np.int32)), pa.array(list(first)), pa.array(around, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, ["toxic", "term", "around"])


def choose_features(examples: DataFrame, p: Params) -> list[str]:
    """Features that go with a label, strongest first.

    A feature counts once for the same words around it, so that copies of one text don't add up.
    """
    n = {r["toxic"]: r["n"] for r in examples.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return []
    terms = examples.select("doc_id", "toxic", "text").mapInArrow(_terms, "toxic int, term string, around long")
    got = terms.distinct().groupBy("term").agg(F.sum("toxic").cast("double").alias("a"), F.sum(1 - F.col("toxic")).cast("double").alias("b"))
    a, b, c, d = F.col("a"), F.col("b"), n1 - F.col("a"), n0 - F.col("b")
    chi2 = (n1 + n0) * (a * d - b * c) ** 2 / (float(n1) * n0 * F.greatest((a + b) * (c + d), F.lit(1.0)))
    ratio = ((a + 0.5) / (n1 + 1)) / ((b + 0.5) / (n0 + 1))
    got = got.withColumn("chi2", chi2).where((F.col("chi2") >= p.min_chi2) & (F.greatest(ratio, 1 / ratio) >= p.min_lift))
    return [r["term"] for r in got.orderBy(F.desc("chi2"), "term").limit(p.max_features).collect()]


class Vectorizer(Recent):
    """Sparse counts over the chosen features; remembers what a word contributes."""

    def __init__(self, features: list[str], keep: int = 100_000):
        super().__init__(keep)
        self.place = {f: i for i, f in enumerate(features)}

    def make(self, word: str) -> tuple[int, ...]:
        return tuple(self.place[f] for f in term_features(word) if f in self.place)

    def __call__(self, text: str | None) -> dict[int, int]:
        out: dict[int, int] = {}
        for word in WORD.findall((text or "").lower()):
            for i in self[word]:
                out[i] = out.get(i, 0) + 1
        return out


def vectors(docs: DataFrame, features: list[str]) -> DataFrame:
    """``(doc_id, key, terms, counts)`` of every row, one pass over the whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vec = Vectorizer(features)
        for b in chunks(batches):
            got = [sorted(vec(t).items()) for t in b.column(2).to_pylist()]
            terms = pa.array([[i for i, _ in g] for g in got], pa.list_(pa.int32()))
            counts = pa.array([[n for _, n in g] for g in got], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), terms, counts], ["doc_id", "key", "terms", "counts"])

    rows = docs.select(F.col("doc_id").cast("long"), row_key(F.col("doc_id"), F.col("text")).alias("key"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, key string, terms array<int>, counts array<int>")


def unit(terms: list[int], counts: list[int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    t = np.asarray(terms, np.int64)
    w = (1 + np.log(np.asarray(counts, float))) * idf[t]
    norm = np.sqrt((w * w).sum())
    return t, w / norm if norm else w


class BlockMaxIndex:
    """Exact top-k cosine over unit vectors of the examples."""

    def __init__(self, ids: list[int], vecs: list[tuple[np.ndarray, np.ndarray]], n_features: int):
        order = sorted(range(len(ids)), key=lambda i: (vecs[i][0][np.argsort(-vecs[i][1], kind="stable")].tolist(), ids[i]))
        self.ids = np.array([ids[i] for i in order], np.int64)
        self.place = {i: at for at, i in enumerate(order)}
        n_blocks = -(-len(ids) // BLOCK)
        post: dict[int, list] = {}
        for at, i in enumerate(order):
            for t, w in zip(*vecs[i]):
                post.setdefault(int(t), []).append((at, w))
        self.top = np.zeros((n_features, n_blocks))
        self.post, self.cut = {}, {}
        for t, rows in post.items():
            at = np.array([r[0] for r in rows], np.int64)
            w = np.array([r[1] for r in rows])
            np.maximum.at(self.top[t], at // BLOCK, w)
            self.post[t], self.cut[t] = (at, w), np.searchsorted(at, np.arange(n_blocks + 1) * BLOCK)

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> list[tuple[int, float]]:
        """The k best (place, cosine) above zero; ties go to the smaller id.  ``without``: a place left out."""
        bound = weights @ self.top[terms]
        best: list[tuple[float, int, int]] = []
        for block in np.argsort(-bound, kind="stable"):
            if bound[block] <= 0 or (len(best) == k and bound[block] < -best[-1][0] - 1e-9):
                break
            score = np.zeros(BLOCK)
            for t, q in zip(terms.tolist(), weights.tolist()):
                if t in self.post:
                    a, b = self.cut[t][block], self.cut[t][block + 1]
                    if b > a:
                        at, w = self.post[t]
                        score[at[a:b] - block * BLOCK] += q * w[a:b]
            on = np.flatnonzero(score > 0)
            here = [(-round(float(score[i]), 9), int(self.ids[block * BLOCK + i]), int(block * BLOCK + i)) for i in on if block * BLOCK + i != without]
            best = sorted(best + here)[:k]
        return [(place, -s) for s, _, place in best]


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising step function of x by pooling adjacent violators: (knots, values)."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for xi, yi, wi in zip(x[order], y[order], w[order]):
        if pools and pools[-1][3] == xi:
            p = pools[-1]
            p[0], p[1] = p[0] + yi * wi, p[1] + wi
        else:
            pools.append([yi * wi, wi, xi, xi])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            s, n, _, high = pools.pop()
            pools[-1][0], pools[-1][1], pools[-1][3] = pools[-1][0] + s, pools[-1][1] + n, high
    knots = np.array([v for p in pools for v in (p[2], p[3])])
    return knots, np.array([p[0] / p[1] for p in pools for _ in (0, 1)])


class Voter:
    """Index, votes and calibration over the examples; bounded by the parameters alone."""

    def __init__(self, rows: list[tuple[int, int, list[int], list[int]]], share: dict[int, float], idf: np.ndarray, p: Params):
        """rows: id, label, terms, counts.  share: labelled rows that one example of each label stands for."""
        self.idf, self.k = idf, p.k
        with_terms = sorted(r for r in rows if r[2])
        vecs = [unit(r[2], r[3], idf) for r in with_terms]
        self.index = BlockMaxIndex([r[0] for r in with_terms], vecs, len(idf)) if with_terms else None
        weight = lambda y: share.get(y, 1.0)
        total = sum(weight(r[1]) for r in rows)
        prior = sum(weight(1) for r in rows if r[1]) / total if total else 0.0
        bare = [r[1] for r in rows if not r[2]]
        # Texts without any feature are alike: their nearest examples are those without any, too.
        seen = sum(map(weight, bare))
        self.bare = (sum(weight(1) for y in bare if y) + prior) / (seen + 1)
        self.prior, self.knots, self.values = prior, None, None
        if self.index:
            n = len(with_terms)
            self.y, self.w = np.zeros(n, np.int64), np.ones(n)
            for i, r in enumerate(with_terms):
                at = self.index.place[i]
                self.y[at], self.w[at] = r[1], weight(r[1])
            votes = np.array([self._vote(self.index.search(*vecs[i], p.k, self.index.place[i])) for i in range(n)])
            at = np.array([self.index.place[i] for i in range(n)])
            self.knots, self.values = isotonic(votes, self.y[at].astype(float), self.w[at])

    def _vote(self, near: list[tuple[int, float]]) -> float:
        if not near:
            return self.prior
        at = np.array([i for i, _ in near])
        w = self.w[at] * np.array([s for _, s in near]) ** 2
        # Far neighbours weigh little, so the vote stays near the prior.
        return float(((w * self.y[at]).sum() + self.prior / 4) / (w.sum() + 1 / 4))

    def score(self, terms: list[int], counts: list[int]) -> tuple[float, list[tuple[int, float]]]:
        """Calibrated score and the evidence (example id, cosine)."""
        if not self.index or not len(terms):
            return self.bare, []
        near = self.index.search(*unit(terms, counts, self.idf), self.k)
        if not near:
            return self.prior, []
        vote = self._vote(near)
        # A little of the vote itself keeps the order inside a calibrated step.
        s = 0.98 * float(np.interp(vote, self.knots, self.values)) + 0.02 * vote
        return min(1.0, max(0.0, s)), [(int(self.index.ids[i]), s) for i, s in near]


def toxicity(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    """``(doc_id, held_out, score, predicted, neighbours, similarities, key)``, one row per input row.

    A score depends on the text alone.  A null or empty text has no features and gets the share of
    label 1 among labelled texts without features.  Without labelled rows of both labels every
    score is that share.  Ties between examples go to the smaller id.  Repeated rows get equal scores;
    a null id is not held out.  An empty table gives no rows; further columns are ignored.
    """
    docs, labels = docs.select("doc_id", "text"), labels.select("doc_id", "toxic")
    spark = docs.sparkSession
    examples = materialize(_examples(docs, labels, params), "examples")
    features = choose_features(examples, params)
    vecs = materialize(vectors(docs, features), "vectors")
    n_docs = vecs.count()
    df = {r["t"]: r["n"] for r in vecs.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("n")).collect()}
    idf = np.array([np.log((1 + n_docs) / (1 + df.get(i, 0))) + 0.05 for i in range(len(features))])
    known = vectors(examples, features).join(examples.select("doc_id", "toxic").distinct(), "doc_id").dropDuplicates(["doc_id"])
    rows = [(r["doc_id"], r["toxic"], list(r["terms"]), list(r["counts"])) for r in known.collect()]
    of_label = labels.where("toxic in (0, 1) and doc_id is not null").where(is_training(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    every = {r["toxic"]: r["n"] for r in of_label.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = {y: every.get(y, 0) / max(1, sum(r[1] == y for r in rows)) for y in (0, 1)}
    voter = spark.sparkContext.broadcast(Voter(rows, share, idf, params))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = voter.value
        for b in chunks(batches):
            got = [v.score(t, c) for t, c in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            cols = [
                b.column(0),
                b.column(1),
                pa.array([g[0] for g in got], pa.float64()),
                pa.array([[i for i, _ in g[1]] for g in got], pa.list_(pa.int64())),
                pa.array([[s for _, s in g[1]] for g in got], pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "key", "score", "neighbours", "similarities"])

    tasks = max(spark.sparkContext.defaultParallelism, -(-n_docs // params.rows_per_task))
    out = vecs.repartition(tasks).mapInArrow(run, "doc_id long, key string, score double, neighbours array<long>, similarities array<double>")
    held = F.coalesce(~is_training(F.col("doc_id")), F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "neighbours", "similarities", "key")
