"""Shortest-pack-first packing over the length histogram.

Documents become token pieces of at most ``size`` ids.  Only the histogram of piece lengths, at most
``size`` counts, reaches the driver.  There, lengths are placed longest first, always into the packs
that are filled least; packs with the same content are one pattern with a count.  The
patterns say for every length which ranks go to which sequence and offset, and every piece
finds its place by its rank among the pieces of its length.
"""

from __future__ import annotations

import heapq
import os
import re
import sys
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Recent, chunks, materialize

END_ID = 1
#: The pre-tokens of the vocabulary's own definition.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
ODD = ("\x1c", "\x1d", "\x1e", "\x1f", "<|")


def _younger() -> re.Pattern[str]:
    """Code points that Unicode 3.2 does not assign, and all from U+10000 on.

    The tokenizer, ``regex`` and Python each follow a later version of their own, so they may differ on
    what is a letter, a number or a lower case there; up to 3.2 all agree, which a test goes through.
    One range past U+FFFF keeps the search at one table look-up a character.
    """
    ranges = [[0x10000, sys.maxunicode]]
    for c in range(0x10000):
        if unicodedata.ucd_3_2_0.category(chr(c)) == "Cn":
            if ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges) + "]")


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


YOUNGER = _younger()


def byte_letters() -> dict[int, str]:
    """Byte-level BPE's letters: printable Latin-1 bytes stand for themselves, others follow 255."""
    out, extra = {}, 256
    for b in range(256):
        plain = 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255
        out[b] = chr(b) if plain else chr(extra)
        extra += not plain
    return out


class WordIds(Recent):
    """Lower-cased white-space word -> its ids as little-endian bytes.

    White space always ends a pre-token, so ids of words one by one are the ids of the text.
    """

    def __init__(self, path: str, keep: int = 150_000):
        from tokenizers import Tokenizer

        super().__init__(keep)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.table = str.maketrans({chr(k): v for k, v in byte_letters().items()})

    def make(self, word: str) -> bytes:
        if word.isalpha():
            return self._encode(word)
        if word[-1] in ".,;:!?" and word[:-1].isalpha():
            return self[word[:-1]] + self[word[-1]]
        parts = PRE_TOKEN.findall(word)
        return self._encode(word) if parts == [word] else b"".join([self[p] for p in parts])

    def _encode(self, piece: str) -> bytes:
        tokens = self.model.tokenize(piece.encode().decode("latin-1").translate(self.table))
        return array("I", [t.id for t in tokens]).tobytes()

    def text(self, text: str | None) -> bytes:
        text = text or ""
        if not _latin(text) and YOUNGER.search(text):  # Latin-1 is old as a whole
            return self._whole(text)
        low = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        # Separators that only Python takes for white space, special tokens, and lower case that would
        # be composed again are left to the tokenizer as a whole.
        if any(c in text for c in ODD) or not unicodedata.is_normalized("NFC", low):
            return self._whole(text)
        return b"".join([self[w] for w in low.split()])

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


_LOADED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One per process: a reused worker keeps what it has learned."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


def pieces(docs: DataFrame, vocabulary: str, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens)``: every document's ids, cut at ``size``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(vocabulary)
        end = np.array([END_ID], "<u4").tobytes()
        for b in chunks(batches):
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = words.text(text) + end
                n = len(ids) // 4
                for at in range(0, n, size):
                    part = ids[4 * at : 4 * (at + size)]
                    rows.append((doc, at, len(part) // 4, zlib.crc32(part), n))
            cols = [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 5)]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def pack_histogram(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns ``(lengths, packs)`` that hold every length exactly as often as counted."""
    full: list[tuple[tuple[int, ...], int]] = []
    heap: list[tuple[int, int, tuple[int, ...], int]] = []  # (-free, order, lengths, packs)
    order = 0

    def put(free: int, lengths: tuple[int, ...], packs: int, least: int) -> None:
        nonlocal order
        if packs:
            if free < least:
                full.append((lengths, packs))
            else:
                order += 1
                heapq.heappush(heap, (-free, order, lengths, packs))

    least = min(counts, default=1)
    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            if heap and -heap[0][0] >= length:
                free, _, lengths, packs = heapq.heappop(heap)
                take = min(packs, n)
                put(-free, lengths, packs - take, least)
                put(-free - length, (*lengths, length), take, least)
                n -= take
            else:
                each = size // length
                packs, rest = divmod(n, each)
                put(size - each * length, (length,) * each, packs, least)
                put(size - rest * length, (length,) * rest, int(rest > 0), least)
                n = 0
    return full + [(lengths, packs) for _, _, lengths, packs in heap]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """length -> rows (first rank, first sequence, offset), by first rank."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for lengths, packs in patterns:
        offset = 0
        for length in lengths:
            out.setdefault(length, []).append((used.get(length, 0), sequence, offset))
            used[length] = used.get(length, 0) + packs
            offset += length
        sequence += packs
    return {k: np.array(v, np.int64) for k, v in out.items()}


def ranked(parts: DataFrame, rows: int, per_bucket: int = 100_000) -> DataFrame:
    """Adds ``rank``, the place of a row among all of its length, without one task per length."""
    buckets = max(64, -(-rows // per_bucket))
    tie = ["doc_id", "start", "doc_tokens", "ids_crc32"]
    dealt = parts.withColumn("bucket", F.pmod(F.xxhash64(*tie), F.lit(buckets)).cast("int"))
    sizes = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy(*tie))
    return dealt.withColumn("inside", inside).join(base, ["length", "bucket"]).withColumn("rank", F.col("base") + F.col("inside") - 1)


def pack(docs: DataFrame, vocabulary: str, size: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``, one row per piece.

    A null or empty text is its end id alone.  Long texts are cut at every ``size`` ids.  Repeated rows
    are packed as often as they occur; a null id is packed like any other.  An empty table gives no
    rows; further columns are ignored.  What the driver holds depends on ``size`` alone.
    """
    parts = materialize(pieces(docs, vocabulary, size, id_col, text_col), "pieces")
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = parts.sparkSession.sparkContext.broadcast(slots(pack_histogram(counts, size)))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column(2).to_numpy(), b.column(5).to_numpy()
            place = np.zeros((b.num_rows, 2), np.int64)
            for n in np.unique(length):
                on, rows = length == n, table.value[int(n)]
                slot = rows[np.searchsorted(rows[:, 0], rank[on], side="right") - 1]
                place[on] = np.stack((slot[:, 1] + rank[on] - slot[:, 0], slot[:, 2]), axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(place[:, 0].copy()), pa.array(place[:, 1].copy())], [*columns, "sequence_id", "offset"])

    rows = ranked(parts, sum(counts.values())).select(*columns, "rank")
    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in [*columns, "sequence_id", "offset"]))
