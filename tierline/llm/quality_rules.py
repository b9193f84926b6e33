"""Quality rules as a short-circuit cascade.

Base statistics are computed for every document.  The rules beside them run in a cascade: on a
bounded sample, each rule's time and share of rejected documents are measured, the rules are ordered by
rejections per second, and a document stops at the first rule that rejects it.  The order changes
the work, never the verdict: a document is kept if no rule rejects it.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks

SYMBOLS = re.compile(r"[#*$%&|<>]")
LETTER = re.compile(r"[^\W\d_]")


class Text:
    """A document with what the rules share."""

    def __init__(self, text: str | None):
        self.text = text or ""
        raw = self.text.encode("utf-8", "surrogatepass")
        self.words = raw.split()
        self.raw = raw

    def word_chars(self) -> int:
        # Every byte but UTF-8 continuation bytes starts a code point.
        joined = np.frombuffer(b"".join(self.words), np.uint8)
        return int((joined & 0xC0 != 0x80).sum())

    def symbols(self) -> int:
        return len(SYMBOLS.findall(self.text))

    def duplicate_lines(self) -> int:
        lines = [x for x in self.raw.split(b"\n") if x.split(None, 1)]
        return len(lines) - len(set(lines))

    def repeated_words(self) -> int:
        """Words inside five-word windows that occur at least twice."""
        w, window = self.words, 5
        n = len(w) - window + 1
        if n < 2:
            return 0
        known: dict[bytes, int] = {}
        ids = np.fromiter((known.setdefault(x, len(known)) for x in w), np.int64, len(w))
        if len(known) == len(w):
            return 0
        # Exact names of windows: pairs of names become names, five words in three steps.
        name = ids
        for step in (1, 2):
            pair = name[: len(name) - step] * (int(name.max()) + 1) + name[step:]
            name = np.unique(pair, return_inverse=True)[1]
        name = name[:n] * (int(ids.max()) + 1) + ids[window - 1 :]
        _, at, count = np.unique(name, return_inverse=True, return_counts=True)
        twice = np.flatnonzero(count[at] > 1)
        edge = np.zeros(len(w) + 1, np.int64)
        np.add.at(edge, twice, 1)
        np.add.at(edge, twice + window, -1)
        return int((np.cumsum(edge)[:-1] > 0).sum())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]


def _symbol_share(t: Text) -> bool:
    return 10 * t.symbols() > 3 * len(t.words)


def _word_length(t: Text) -> bool:
    n, chars = len(t.words), t.word_chars()
    return chars < 2 * n or chars > 25 * n


def _duplicate_lines(t: Text) -> bool:
    lines = [x for x in t.raw.split(b"\n") if x.split(None, 1)]
    return 2 * (len(lines) - len(set(lines))) > len(lines)


def _wordless(t: Text) -> bool:
    return 10 * sum(1 for w in t.text.split() if LETTER.search(w)) < 6 * len(t.words)


def _shouting(t: Text) -> bool:
    letters = sum(map(str.isalpha, t.text))
    return 2 * sum(map(str.isupper, t.text)) > letters > 0


def _few_kinds(t: Text) -> bool:
    return len(t.words) >= 50 and 20 * len(set(t.words)) < len(t.words)


RULES = (
    Rule("symbols", _symbol_share),
    Rule("word_length", _word_length),
    Rule("duplicate_lines", _duplicate_lines),
    Rule("wordless", _wordless),
    Rule("shouting", _shouting),
    Rule("few_kinds", _few_kinds),
)


def profile(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000, text_col: str = "text") -> list[dict]:
    """Seconds and rejected share of every rule, measured on about ``sample_rows`` rows over all partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            texts = [Text(t) for t in b.column(0).to_pylist()]
            for r in rules:
                began = time.perf_counter()
                hits = sum(map(r.rejects, texts))
                cols = [pa.array([r.name]), pa.array([time.perf_counter() - began]), pa.array([hits], pa.int64()), pa.array([len(texts)], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, ["rule", "seconds", "rejected", "rows"])

    total = docs.count()
    sample = docs.select(F.col(text_col).cast("string")).sample(min(1.0, sample_rows / max(1, total)), seed=1)
    got = sample.mapInArrow(run, "rule string, seconds double, rejected long, rows long").groupBy("rule")
    got = got.agg(F.sum("seconds").alias("s"), F.sum("rejected").alias("r"), F.sum("rows").alias("n")).collect()
    return [{"rule": x["rule"], "seconds": x["s"] / max(1, x["n"]), "rejects": x["r"] / max(1, x["n"])} for x in got]


def ordered(rules: tuple[Rule, ...], measured: list[dict]) -> tuple[Rule, ...]:
    """Most rejections per second first; unmeasured rules keep their order at the end."""
    gain = {m["rule"]: m["rejects"] / max(m["seconds"], 1e-9) for m in measured}
    return tuple(sorted(rules, key=lambda r: -gain.get(r.name, -1.0)))


def quality(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 2000, evidence: bool = False
) -> DataFrame:
    """Base statistics and the cascade's verdict, one row per input row.

    ``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)``, with
    ``evidence`` also ``rejected_by``, the rule at which the cascade stopped (which one of
    several depends on the measured order).  Null and empty texts have no words and fail the base.
    Repeated rows get equal results, an empty table gives no rows, further columns are ignored.
    """
    cascade = ordered(rules, profile(docs, rules, sample_rows, text_col))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            rows = []
            for text in b.column(1).to_pylist():
                t = Text(text)
                n, repeat = len(t.words), t.repeated_words()
                failed = n < 10 or 100 * repeat > 20 * n
                by = "base" if failed else next((r.name for r in cascade if r.rejects(t)), None)
                rows.append((n, t.word_chars(), t.symbols(), t.duplicate_lines(), repeat, failed, by is None, by))
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.string()]
            cols = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 8, kinds)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kinds = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, rejected_by string"
    out = rows.mapInArrow(run, kinds)
    return out if evidence else out.drop("rejected_by")
