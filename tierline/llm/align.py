"""Alignment of two tokenizers' tokens over the same texts.

1. Both tokenizers encode every text; the bytes of their tokens give byte ranges.
2. ``pandas.merge_asof`` finds for every token start the covering token of the other side, per batch and
   keyed by document: positions are counted on through the batch, so every document has
   positions of its own.  Both directions together give all overlapping token pairs.
3. Overlapping tokens that end at the same byte close a group and are a link.
4. Links are counted over the whole corpus by slots.  Of two tokens that end together the shorter one's bytes
   are the end of the longer one's, so the vocabularies alone bound the possible pairs (about
   830,000 slots for two vocabularies of 50,000 and 32,000), whatever the corpus holds.  The counts are
   therefore small enough to be broadcast.

Tokens never cross from a non-space to a space (checked on the vocabularies; otherwise texts are encoded
whole), so what a stretch between such places becomes is remembered, and long texts
are aligned in blocks that end at such places.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, materialize, row_key
from .packing import byte_letters

#: Characters of one block; a block ends between two stretches.
BLOCK_CHARS = 500_000
#: Longer stretches are not remembered.
LONG = 60
#: The pre-token pattern that the byte-level definition names without spelling it out.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# -- the two tokenizers ------------------------------------------------------

class ByteSide:
    """The byte-level tokenizer: its tokens' bytes, and ids of stretches of text."""

    def __init__(self, path: str):
        import tiktoken

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        back = {letter: byte for byte, letter in byte_letters().items()}
        raw = lambda entry: bytes(back[c] for c in entry) if all(c in back for c in entry) else entry.encode()
        size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        self.tokens: list[bytes] = [b""] * size
        for t in spec["added_tokens"]:
            self.tokens[t["id"]] = t["content"].encode()
        for entry, i in vocab.items():
            if entry not in {t["content"] for t in spec["added_tokens"]}:
                self.tokens[i] = raw(entry)
        made = [vocab[x + y] for x, y in merges]
        pre = spec["pre_tokenizer"] or {}
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not spec["normalizer"]
        # Merges in the order of their ids are ranks, and the rank form of the same definition is faster.
        if plain and made == sorted(set(made)):
            ranks = {raw(e): i for e, i in vocab.items() if len(e) == 1} | {raw(x + y): i for (x, y), i in zip(merges, made)}
            self.encode = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            from tokenizers import Tokenizer

            whole = Tokenizer.from_file(path)
            whole.encode_special_tokens = True
            self.encode = lambda text: whole.encode(text, add_special_tokens=False).ids
        self.splits = plain


class PieceSide:
    """The piece tokenizer, which puts a space before every text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        is_byte = [self.model.is_byte(i) for i in range(len(pieces))]
        self.tokens = [bytes([int(p[3:5], 16)]) if b else p.replace("▁", " ").encode() for p, b in zip(pieces, is_byte)]
        own = [p for p, b in zip(pieces, is_byte) if not b]
        self.space = self.model.piece_to_id("▁")
        probe = "a  é ﬁ b "
        kept = b"".join(self.tokens[i] for i in self.model.encode(probe)) == (" " + probe).encode()
        self.splits = kept and self.tokens[self.space] == b" " and not any(re.search("[^▁]▁", p) for p in own)
        self.splits_lines = self.splits and not any("\n" in p for p in own)

    def encode(self, stretches: list[str]) -> list[list[int]]:
        """Ids of stretches; the space the model puts first is a stretch's own or is taken off."""
        own = [s[0] == " " for s in stretches]
        got = self.model.encode([s[1:] if o else s for s, o in zip(stretches, own)], num_threads=1)
        return [[self.space] if s == " " else ids if o else ids[1:] for s, ids, o in zip(stretches, got, own)]


#: What a stretch becomes: ids of both sides as little-endian 32 bits, its bytes, and whether both sides reproduce it.
Stretch = tuple[bytes, bytes, int, bool]


class Stretches:
    """Remembers what up to ``keep`` stretches of text become on both sides, and what one batch adds."""

    def __init__(self, a_path: str, b_path: str, keep: int = 250_000):
        self.keep, self.known = keep, {}
        self.a, self.b = ByteSide(a_path), PieceSide(b_path)
        self.slots = PairSlots(self.a.tokens, self.b.tokens)
        if self.a.splits and self.b.splits:
            # A new stretch begins where one of these white spaces follows anything else.
            begin = " \n" if self.b.splits_lines else " "
            self.pattern = re.compile(rf"\s*\S+(?:[^\S{begin}]\s*\S*)*|\s+")
        else:
            self.pattern = None

    def encode(self, stretches: list[str]) -> list[Stretch]:
        tokens_a, tokens_b, out = self.a.tokens, self.b.tokens, []
        for s, b in zip(stretches, self.b.encode(stretches)):
            a, raw = self.a.encode(s), s.encode()
            exact = b"".join([tokens_a[i] for i in a]) == raw == b"".join([tokens_b[i] for i in b])
            out.append((array("i", a).tobytes(), array("i", b).tobytes(), len(raw), exact))
        return out

    def texts(self, texts: list[str | None]) -> list[list[Stretch]]:
        """The stretches of space + text of every text; none for texts that have no tokens."""
        if len(self.known) > self.keep:
            self.known.clear()
        known, find = self.known, self.pattern.findall if self.pattern else lambda text: [text]
        split = [find(" " + t) if t else [] for t in texts]
        fresh = list({p for parts in split for p in parts if p not in known})
        short, long = [p for p in fresh if len(p) <= LONG], [p for p in fresh if len(p) > LONG]
        known.update(zip(short, self.encode(short)))
        once = dict(zip(long, self.encode(long)))
        out = [[known[p] if p in known else once[p] for p in parts] for parts in split]
        return [parts if all([s[3] for s in parts]) else [] for parts in out]


_LOADED: dict[tuple[str, str], Stretches] = {}


def stretches(a_path: str, b_path: str) -> Stretches:
    """One per process: a reused worker keeps what it has learned."""
    if (a_path, b_path) not in _LOADED:
        _LOADED[a_path, b_path] = Stretches(a_path, b_path)
    return _LOADED[a_path, b_path]


# -- pairs that can end together -----------------------------------------------

class PairSlots:
    """A number for every pair of tokens that can end at the same byte.

    The shorter token's bytes are the end of the longer one's, so the longer token and the other's length
    name the pair (with the place among tokens of the same bytes, where there are such).
    """

    def __init__(self, a: list[bytes], b: list[bytes]):
        self.len_a, self.len_b = (np.array([len(t) for t in side], np.int64) for side in (a, b))
        self.place_a, self.same_a = self._places(a)
        self.place_b, self.same_b = self._places(b)
        self.from_a = np.concatenate([[0], np.cumsum(self.len_a * self.same_b)])
        self.from_b = self.from_a[-1] + np.concatenate([[0], np.cumsum(self.len_b * self.same_a)])
        self.size = int(self.from_b[-1])

    @staticmethod
    def _places(tokens: list[bytes]) -> tuple[np.ndarray, int]:
        seen: Counter[bytes] = Counter()
        out = np.zeros(len(tokens), np.int64)
        for i, t in enumerate(tokens):
            out[i], seen[t] = seen[t], seen[t] + 1
        return out, max(seen.values(), default=1)

    def b_of_slots(self, tokens_a: list[bytes], tokens_b: list[bytes]) -> np.ndarray:
        """The B token of every slot (0 for slots that no pair has)."""
        out = np.zeros(self.size, np.int64)
        by_bytes: dict[bytes, list[int]] = {}
        for i, t in enumerate(tokens_b):
            by_bytes.setdefault(t, []).append(i)
        for i, t in enumerate(tokens_a):
            for n in range(1, len(t) + 1):
                for place, j in enumerate(by_bytes.get(t[-n:], ())):
                    out[self.from_a[i] + (n - 1) * self.same_b + place] = j
        out[self.from_a[-1] :] = np.repeat(np.arange(len(tokens_b)), self.len_b * self.same_a)
        return out

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        la, lb = self.len_a[a], self.len_b[b]
        long_a = self.from_a[a] + (lb - 1) * self.same_b + self.place_b[b]
        long_b = self.from_b[b] + (la - 1) * self.same_a + self.place_a[a]
        return np.where(lb <= la, long_a, long_b).astype(np.int32)


# -- the alignment of a batch --------------------------------------------------

@dataclass
class Aligned:
    """Tokens of one batch in order; ``doc_*`` name the row, ``start``/``end`` are positions through the batch."""

    a: pd.DataFrame  # id, doc, start, end, group
    b: pd.DataFrame
    overlaps: pd.DataFrame  # a, b (places in the two frames), linked


def align_tokens(a_ids: np.ndarray, b_ids: np.ndarray, a_doc: np.ndarray, b_doc: np.ndarray, slots: PairSlots) -> Aligned:
    """Overlaps, links and groups of tokens that cover the same bytes on both sides."""
    sides = []
    for ids, doc, length in ((a_ids, a_doc, slots.len_a), (b_ids, b_doc, slots.len_b)):
        end = np.cumsum(length[ids])
        sides.append(pd.DataFrame({"id": ids, "doc": doc, "start": end - length[ids], "end": end}))
    a, b = sides
    starts_a = pd.DataFrame({"start": a["start"], "a": np.arange(len(a))})
    starts_b = pd.DataFrame({"start": b["start"], "b": np.arange(len(b))})
    under_a = pd.merge_asof(starts_a, starts_b, on="start")  # the B token that covers each A start
    under_b = pd.merge_asof(starts_b, starts_a, on="start")
    # Tokens that start together meet in both directions and count once.
    twice = a["start"].to_numpy()[under_b["a"].to_numpy()] == b["start"].to_numpy()
    pa_, pb_ = (np.concatenate([under_a[c].to_numpy(), under_b[c].to_numpy()[~twice]]) for c in ("a", "b"))
    linked = a["end"].to_numpy()[pa_] == b["end"].to_numpy()[pb_]
    for side, places in ((a, pa_), (b, pb_)):
        closes = np.zeros(len(side), bool)
        closes[places[linked]] = True
        side["closes"] = closes
        side["group"] = np.cumsum(closes) - closes
    return Aligned(a, b, pd.DataFrame({"a": pa_, "b": pb_, "linked": linked}))


class GroupText:
    """``a1,a2|b1;a3|b2,b3`` of all groups, one piece of fixed width per token."""

    def __init__(self, n_a: int, n_b: int):
        width = len(str(max(n_a, n_b))) + 1
        table = lambda n, tail: np.array([f"{i}{tail}".encode() for i in range(n)], f"S{width}")
        self.a, self.b = {c: table(n_a, c) for c in ",|"}, {c: table(n_b, c) for c in ",;"}
        self.width = width

    def pieces(self, got: Aligned) -> tuple[np.ndarray, np.ndarray]:
        """All pieces in order, and the row of every piece."""
        n = int(got.a["group"].iloc[-1]) + 1
        group_a, group_b = got.a["group"].to_numpy(), got.b["group"].to_numpy()
        of_a, of_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
        at_a = np.arange(len(group_a)) + (np.cumsum(of_b) - of_b)[group_a]
        at_b = np.arange(len(group_b)) + np.cumsum(of_a)[group_b]
        out = np.empty(len(at_a) + len(at_b), f"S{self.width}")
        row = np.empty(len(out), np.int64)
        for side, at, tables, tail in ((got.a, at_a, self.a, "|"), (got.b, at_b, self.b, ";")):
            ids, closes = side["id"].to_numpy(), side["closes"].to_numpy()
            out[at] = np.where(closes, tables[tail][ids], tables[","][ids])
            row[at] = side["doc"].to_numpy()
        return out, row


@dataclass
class Row:
    """What has been aligned of one document so far."""

    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    tail: bytes = b""

    def __post_init__(self):
        self.sha, self.links = hashlib.sha256(), []

    def add_groups(self, text: bytes) -> None:
        # The last group's end mark is held back until another group follows.
        self.sha.update(self.tail + text[:-1])
        self.tail = text[-1:]


def blocks(rows: list[list[Stretch]]) -> Iterator[list[tuple[int, list[Stretch]]]]:
    """Stretches of rows in blocks of bounded length; a long row goes through several blocks."""
    block, size = [], 0
    for doc, parts in enumerate(rows):
        at = 0
        while at < len(parts):
            to = at
            while to < len(parts) and size < BLOCK_CHARS:
                size += parts[to][2]
                to += 1
            block.append((doc, parts[at:to]))
            at = to
            if size >= BLOCK_CHARS:
                yield block
                block, size = [], 0
    if block:
        yield block


def align_block(block: list[tuple[int, list[Stretch]]], slots: PairSlots) -> Aligned:
    sides = []
    for field in (0, 1):
        raw = [b"".join([s[field] for s in parts]) for _, parts in block]
        doc = np.repeat([d for d, _ in block], [len(r) // 4 for r in raw])
        sides += [np.frombuffer(b"".join(raw), "<i4").astype(np.int64), doc]
    return align_tokens(sides[0], sides[2], sides[1], sides[3], slots)


_SCHEMA = "doc_id long, key string, n_a long, n_b long, n_groups long, n_links long, links binary, groups_sha256 string"


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(F.col(id_col), text).alias("key"), text.alias("text"))


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, key, n_a, n_b, n_groups, n_links, links, groups_sha256)``; ``links`` holds slots, 32 bits each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = stretches(a_path, b_path)
        slots, text = memory.slots, GroupText(len(memory.a.tokens), len(memory.b.tokens))
        for batch in chunks(batches, 200):
            rows = [Row() for _ in range(batch.num_rows)]
            for block in blocks(memory.texts(batch.column(2).to_pylist())):
                got = align_block(block, slots)
                pieces, of = text.pieces(got)
                link = got.overlaps[got.overlaps["linked"]].sort_values("a")
                a, b = link["a"].to_numpy(), link["b"].to_numpy()
                slot = slots.of(got.a["id"].to_numpy()[a], got.b["id"].to_numpy()[b]).astype("<i4")
                doc_a, doc_b, doc_l = got.a["doc"].to_numpy(), got.b["doc"].to_numpy(), got.a["doc"].to_numpy()[a]
                for doc, _ in block:
                    cut = [slice(*np.searchsorted(d, [doc, doc + 1])) for d in (doc_a, doc_b, doc_l, of)]
                    row = rows[doc]
                    row.n_a += cut[0].stop - cut[0].start
                    row.n_b += cut[1].stop - cut[1].start
                    row.n_groups += cut[2].stop - cut[2].start
                    row.links.append(slot[cut[2]].tobytes())
                    row.add_groups(pieces[cut[3]].tobytes().replace(b"\0", b""))
            links = [b"".join(r.links) for r in rows]
            cols = [batch.column(0), batch.column(1)]
            cols += [pa.array([getattr(r, c) for r in rows], pa.int64()) for c in ("n_a", "n_b", "n_groups")]
            cols += [pa.array([len(x) // 4 for x in links], pa.int64()), pa.array(links, pa.binary())]
            cols.append(pa.array([r.sha.hexdigest() if r.n_a else "" for r in rows]))
            yield pa.RecordBatch.from_arrays(cols, [f.split()[0] for f in _SCHEMA.split(", ")])

    return _keyed(docs, id_col, text_col).mapInArrow(run, _SCHEMA)


def tokens(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The alignment itself, one row per input row: ids, byte ends and groups of both sides' tokens, and the overlaps.

    ``(doc_id, key, a_ids, a_ends, a_groups, b_ids, b_ends, b_groups, overlaps)``; ends count from the space
    before the text, groups from 0, ``overlaps`` are pairs of 0-based token places.  Texts without tokens have
    empty arrays.
    """
    schema = "doc_id long, key string, " + ", ".join(f"{s}_{c} array<int>" for s in "ab" for c in ("ids", "ends", "groups"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = stretches(a_path, b_path)
        for batch in chunks(batches, 50):
            out: list[list[list]] = [[] for _ in range(7)]
            for parts in memory.texts(batch.column(2).to_pylist()):
                got = align_block([(0, parts)], memory.slots) if parts else None
                for at, (side, col) in enumerate((s, c) for s in "ab" for c in ("id", "end", "group")):
                    out[at].append(getattr(got, side)[col].tolist() if got else [])
                pairs = got.overlaps.sort_values(["a", "b"])[["a", "b"]].to_numpy().tolist() if got else []
                out[6].append([{"a": x, "b": y} for x, y in pairs])
            pair = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
            cols = [batch.column(0), batch.column(1), *(pa.array(o, pa.list_(pa.int32())) for o in out[:6]), pa.array(out[6], pair)]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "key", *(f"{s}_{c}" for s in "ab" for c in ("ids", "ends", "groups")), "overlaps"])

    return _keyed(docs, id_col, text_col).mapInArrow(run, schema + ", overlaps array<struct<a:int,b:int>>")


def pair_counts(found: DataFrame, a_path: str, b_path: str) -> tuple[np.ndarray, np.ndarray]:
    """(count of every slot, whether it is the highest of its B token), over all rows of ``found``."""
    memory = stretches(a_path, b_path)
    slots, size, n_b = memory.slots, memory.slots.size, len(memory.b.tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in chunks(batches, 2000):
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i4"), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["slot", "n"])

    got = found.select("links").mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    count = np.zeros(size, np.int64)
    count[got["slot"].to_numpy()] = got["n"].to_numpy()
    b_of = slots.b_of_slots(memory.a.tokens, memory.b.tokens)
    best = np.zeros(n_b, np.int64)
    np.maximum.at(best, b_of, count)
    return count, (count > 0) & (count == best[b_of])


def alignment(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, key)``, one row per input row.

    ``n_best`` and ``count_sum`` use link counts over all rows: repeated rows count as often as they stand there,
    and all pairs that tie for a B token's highest count are best.  Texts that are null, empty or not
    reproduced by both tokenizers have no tokens: zeros and ''.  Null ids pass.  Texts of any length are
    aligned whole, in blocks.  An empty table gives no rows; further columns are ignored.
    """
    spark = docs.sparkSession
    found = materialize(aligned(docs, a_path, b_path, id_col, text_col), "aligned")
    counts = spark.sparkContext.broadcast(pair_counts(found, a_path, b_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, best = counts.value
        for batch in chunks(batches, 2000):
            links = [np.frombuffer(x, "<i4") for x in batch.column("links").to_pylist()]
            n_best = pa.array([int(best[x].sum()) for x in links], pa.int64())
            total = pa.array([int(count[x].sum()) for x in links], pa.int64())
            cols = [batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
            cols += [n_best, total, batch.column("groups_sha256"), batch.column("key")]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "key"])

    return found.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, key string")
