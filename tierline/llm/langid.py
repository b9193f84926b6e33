"""Language identification: multinomial naive Bayes over hashed character n-grams.

1. Texts are lower-cased code point by code point; stretches of what is neither letter nor mark become one space.
   All n-grams of 1 to ``orders`` code points, from the space before the first word to the space after the
   last, are hashed into ``2 ** bits`` buckets.
2. Counts of every language are added up per task and then by Spark; the matrix of log-probabilities,
   languages times buckets, is broadcast.
3. Scoring is a sparse-dense product in numpy per batch: every n-gram of a text picks its bucket's
   log-probabilities, summed over the text.

The texts go through windows of bounded length, so a text of any length is scored whole.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks

UNDETERMINED = "und"
SPACE = 32
#: Places of one hashing window.
WINDOW = 1 << 18
_PRIME = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Params:
    """Size of the model and of the sample it is fitted on."""

    orders: int = 4
    bits: int = 16
    smoothing: float = 0.5
    #: Training rows of each language are thinned by their id's hash to about this many.
    rows_per_language: int = 20_000
    #: More languages than this are refused: the matrix has a row for each.
    max_languages: int = 500


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


# -- n-grams -----------------------------------------------------------------

@cache
def _classes() -> tuple[np.ndarray, np.ndarray]:
    """(folded code point or a space, whether it is a letter) of every code point."""
    fold = np.full(sys.maxunicode + 1, SPACE, np.uint32)
    letter = np.zeros(sys.maxunicode + 1, bool)
    for cp in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(cp))[0]
        if kind in "LM":
            low = chr(cp).lower()
            fold[cp] = ord(low) if len(low) == 1 else cp
            letter[cp] = kind == "L"
    return fold, letter


@dataclass
class Folded:
    """Texts in one array of code points, single spaces between words: text i is [start[i], end[i]), spaces at both ends."""

    codes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    has_letter: np.ndarray


def fold(texts: list[str | None]) -> Folded:
    table, letter = _classes()
    raw = [(t or "") + " " for t in texts]
    points = np.frombuffer("".join([" ", *raw]).encode("utf-32-le", "surrogatepass"), "<u4")
    codes, is_letter = table[points], letter[points]
    word = codes != SPACE
    keep = word.copy()
    keep[1:] |= word[:-1]  # the space after a word
    keep[0] = True
    ends = np.cumsum([1, *map(len, raw)])
    kept = np.concatenate([[0], np.cumsum(keep)])
    letters = np.concatenate([[0], np.cumsum(is_letter)])
    # The space before a text is the one after the text before it.
    start, end = kept[ends[:-1]] - 1, kept[ends[1:]]
    return Folded(codes[keep], start, end, letters[ends[1:]] > letters[ends[:-1]])


def windows(folded: Folded, p: Params) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(texts, from, to, buckets): the n-grams of ``texts[i]`` in this window are ``buckets[from[i]:to[i]]``."""
    codes, n_texts = folded.codes.astype(np.uint64), np.arange(len(folded.start))
    for at in range(0, len(codes), WINDOW):
        to = min(at + WINDOW, len(codes))
        here = codes[at : to + p.orders - 1]
        value = np.zeros(len(here), np.uint64)
        for order in range(1, p.orders + 1):
            value = value[: len(here) - order + 1] * _PRIME + here[order - 1 :] + np.uint64(order)
            # n-grams that begin in the window and end inside their text
            lo = np.clip(folded.start, at, to)
            hi = np.clip(folded.end - order + 1, at, min(to, at + len(value)))
            on = hi > lo
            if on.any():
                mixed = (value ^ (value >> np.uint64(29))) * _PRIME
                yield n_texts[on], lo[on] - at, hi[on] - at, (mixed >> np.uint64(64 - p.bits)).astype(np.int64)


# -- the model -----------------------------------------------------------------

@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray  # log
    weights: np.ndarray  # log, languages x buckets
    params: Params

    def scores(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, posterior) of every text; ties go to the language that sorts first."""
        if not self.languages:
            return [(UNDETERMINED, 0.0)] * len(texts)
        folded = fold(texts)
        total = np.tile(self.prior, (len(texts), 1))
        for text, lo, hi, bucket in windows(folded, self.params):
            cuts = np.stack([lo, hi], 1).ravel()
            for k, w in enumerate(self.weights):
                picked = np.append(w[bucket], 0.0)
                total[text, k] += np.add.reduceat(picked, cuts)[::2]
        best = total.argmax(1)
        share = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
        return [(self.languages[b], float(s)) if ok else (UNDETERMINED, 0.0) for b, s, ok in zip(best, share, folded.has_letter)]


def count_grams(rows: DataFrame, languages: list[str], p: Params) -> np.ndarray:
    """Languages x buckets: n-grams of all ``(language index, text)`` rows, added up per task first."""
    size = 1 << p.bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in chunks(batches, 200):
            of = b.column(0).to_numpy()
            for text, lo, hi, bucket in windows(fold(b.column(1).to_pylist()), p):
                for lang in np.unique(of[text]).tolist():
                    own = of[text] == lang
                    picked = np.concatenate([bucket[x:y] for x, y in zip(lo[own], hi[own])])
                    total.setdefault(lang, np.zeros(size, np.int64))
                    total[lang] += np.bincount(picked, minlength=size)
        for lang, n in total.items():
            at = np.flatnonzero(n)
            cols = [pa.array(np.full(len(at), lang, np.int32)), pa.array(at.astype(np.int32)), pa.array(n[at])]
            yield pa.RecordBatch.from_arrays(cols, ["lang", "bucket", "n"])

    # At most one row per language and bucket, whatever the corpus.
    got = rows.mapInArrow(run, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((len(languages), size))
    out[got["lang"].to_numpy(), got["bucket"].to_numpy()] = got["n"].to_numpy()
    return out


def fit(docs: DataFrame, p: Params = Params()) -> Model:
    """A model of the training rows: those with a language whose crc32(doc_id as text) mod 5 is not 0.

    Rows are thinned per language by the hash of their id, so that repeated rows stay or go together; priors come
    from all training rows.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
    counts = known.groupBy(F.col("lang").cast("string").alias("lang")).agg(F.count("*").alias("n")).orderBy("lang").limit(p.max_languages + 1).collect()
    if len(counts) > p.max_languages:
        raise ValueError(f"more than {p.max_languages} languages; raise Params.max_languages if they are meant")
    languages, n = [r["lang"] for r in counts], np.array([r["n"] for r in counts], float)
    if not languages:
        return Model([], np.zeros(0), np.zeros((0, 1 << p.bits)), p)
    steps = 1 << 20
    at_most = [min(steps, max(1, round(steps * p.rows_per_language / x))) for x in n]
    names = docs.sparkSession.createDataFrame([(i, y, m) for i, (y, m) in enumerate(zip(languages, at_most))], "index int, name string, at_most int")
    rows = known.select("doc_id", F.col("lang").cast("string").alias("name"), "text").join(F.broadcast(names), "name")
    rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(steps)) < F.col("at_most"))
    grams = count_grams(rows.select("index", "text"), languages, p)
    weights = np.log((grams + p.smoothing) / (grams.sum(1, keepdims=True) + p.smoothing * grams.shape[1]))
    return Model(languages, np.log(n / n.sum()), weights, p)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``, one row per input row, from the texts alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, 200):
            got = shared.value.scores(b.column(2).to_pylist())
            cols = [b.column(0), b.column(1), pa.array([y for y, _ in got], pa.string()), pa.array([s for _, s in got], pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), is_held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def language_id(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``, one row per input row; ``score`` is the posterior of ``lang_pred``.

    Texts that are null or hold no letter are ``und`` with score 0, and so is every text when no row can be learned
    from.  Ties go to the language that sorts first.  Rows without an id are neither learned from nor held
    out; repeated rows get equal results (scores up to the rounding of their sums).  Texts of any length are scored whole.  An empty table gives
    no rows; further columns are ignored.
    """
    docs = docs.select("doc_id", "text", "lang")
    return predict(docs, fit(docs, params))
