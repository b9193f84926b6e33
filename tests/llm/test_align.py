"""Token alignment against a plain version: whole texts, byte ranges compared one by one."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tierline.llm import align

TEXTS = [
    "The quick brown fox.\nIt jumps  over\tthe lazy dog.\n\n  Indented line \n",
    "", None, " ", "\n", "x", "  two spaces", "tail   ",
    "▁ low line", "a▁b", "<s>plain</s> <|endoftext|> <0x41>", "It's we'll 'tis 12345 3.14",
    "Ünïcödé straße naïve é ﬁ ｆｕｌｌ \U0001f600\U0001f468‍\U0001f469", "日本語のテキスト 漢字", "नमस्ते दुनिया", "Привет, мир",
    "if (x) {\r\n  return;\r\n}\r\n", "a\x0bb\x0cc\x1cd\x85e\xa0f g　h \r i", "nul\x00in", "word " * 3000, "y" * 5000,
]


@pytest.fixture(scope="module")
def paths():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def whole(paths):
    """Text -> (A ids, B ids, A bytes, B bytes) from the tokenizers themselves."""
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    a = Tokenizer.from_file(paths[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=paths[1])
    letters = {}
    for byte in range(256):  # the decoder's own table, read through single letters
        letters.setdefault(a.id_to_token(a.encode(bytes([byte]).decode("latin-1"), add_special_tokens=False).ids[-1])[-1], None)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [x for x in range(256) if x not in printable]
    back = {chr(x): x for x in printable} | {chr(256 + i): x for i, x in enumerate(others)}
    assert set(letters) <= set(back) and isinstance(a.decoder, decoders.ByteLevel)

    def b_bytes(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def run(text):
        ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text, num_threads=1)
        return ia, ib, [bytes(back[c] for c in a.id_to_token(i)) for i in ia], [b_bytes(i) for i in ib]

    return run


def plain(rows, whole):
    """doc -> the contract's columns, by loops."""
    per, count = [], Counter()
    for doc, text in rows:
        ia, ib, ba, bb = whole(text) if text else ([], [], [], [])
        target = (" " + text).encode() if text else b""
        if not text or b"".join(ba) != target or b"".join(bb) != target:
            per.append((doc, [], [], [], ""))
            continue
        ea, eb = np.cumsum([len(x) for x in ba]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
        at = dict(zip(eb, ib))
        links = [(i, at[x]) for i, x in zip(ia, ea) if x in at]
        groups, pa, pb = [], 0, 0
        for hi in sorted(set(ea) & set(eb)):
            na, nb = ea.index(hi, pa) + 1, eb.index(hi, pb) + 1
            groups.append(",".join(map(str, ia[pa:na])) + "|" + ",".join(map(str, ib[pb:nb])))
            pa, pb = na, nb
        count.update(links)
        per.append((doc, ia, ib, links, ";".join(groups)))
    best = {}
    for (_, j), n in count.items():
        best[j] = max(best.get(j, 0), n)
    out = []
    for doc, ia, ib, links, text in per:
        digest = hashlib.sha256(text.encode()).hexdigest() if ia else ""
        n_groups = text.count(";") + 1 if ia else 0
        out.append((doc, len(ia), len(ib), n_groups, len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links), digest))
    return Counter(out)


COLS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def found(df):
    return Counter(tuple(r) for r in df.select(*COLS).collect())


def test_contract(spark, docs, no_docs, rows, paths, whole):
    assert found(align.alignment(docs, *paths)) == plain([r[:2] for r in rows], whole)
    assert align.alignment(no_docs, *paths).count() == 0


def test_hard_texts_repeats_and_null_ids(spark, paths, whole):
    data = [(i, t) for i, t in enumerate(TEXTS)] + [(1000, TEXTS[0]), (0, TEXTS[0]), (None, "no id"), (None, None)]
    got = found(align.alignment(spark.createDataFrame(data, "doc_id long, text string").repartition(3), *paths))
    want = plain(data, whole)
    assert got == want
    by_doc = {r[0]: r for r in want}
    assert by_doc[8][1:] == by_doc[9][1:] == (0, 0, 0, 0, 0, 0, "")  # the tokenizers don't reproduce U+2581
    assert by_doc[19][1] > 3000 and by_doc[20][1] > 0


def test_blocks_of_a_long_text_join_to_the_whole(spark, paths, whole, monkeypatch):
    rng = random.Random(4)
    data = [(i, " ".join(rng.choice(TEXTS[0].split()) + rng.choice(["", ",", "\n", "ß"]) for _ in range(n))) for i, n in enumerate((3, 700, 1, 90))]
    memory = align.Stretches(*paths)
    monkeypatch.setattr(align, "BLOCK_CHARS", 64)
    cut = list(align.blocks(memory.texts([t for _, t in data])))
    assert len(cut) > 20 and max(sum(s[2] for _, p in b for s in p) for b in cut) < 64 + 2 * align.LONG
    n = sum(len(align.align_block(b, memory.slots).a) for b in cut)
    assert n == sum(len(whole(t)[0]) for _, t in data)


def test_stretches_one_by_one_are_the_text(paths, whole):
    rng = random.Random(8)
    letters = "ab é'sß1 2\n\t\r .,-({▁ ́漢😀"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 40))) for _ in range(3000)]
    memory = align.Stretches(*paths)
    for text, parts in zip(texts, memory.texts(texts)):
        ia, ib, ba, bb = whole(text)
        exact = b"".join(ba) == (" " + text).encode() == b"".join(bb)
        got = [np.frombuffer(b"".join(s[k] for s in parts), "<i4").tolist() for k in (0, 1)]
        assert got == ([ia, ib] if exact else [[], []]), repr(text)


def test_ids_of_all_code_points(paths):
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(paths[0])
    a.encode_special_tokens = True
    side = align.ByteSide(paths[0])
    texts = [f" a{c}1{c} {c}  {c}b '{c}s" for c in map(chr, [*range(0xD800), *range(0xE000, 0x32000, 1), *range(0xE0000, 0xE0200)])]
    for at in range(0, len(texts), 20_000):
        some = texts[at : at + 20_000]
        assert [side.encode(t) for t in some] == [e.ids for e in a.encode_batch_fast(some, add_special_tokens=False)]


def test_overlaps_cover_every_token(spark, paths):
    data = [(i, t) for i, t in enumerate(TEXTS[:19])]
    for r in align.tokens(spark.createDataFrame(data, "doc_id long, text string"), *paths).collect():
        a = list(zip([0, *r["a_ends"]], r["a_ends"]))
        b = list(zip([0, *r["b_ends"]], r["b_ends"]))
        want = [(i, j) for i, (s, e) in enumerate(a) for j, (u, v) in enumerate(b) if s < v and u < e]
        assert [tuple(p) for p in r["overlaps"]] == want
        same = [(r["a_groups"][i], r["b_groups"][j]) for i, j in want]
        assert all(x == y for x, y in same)


def test_slots_name_pairs_once(paths):
    slots = align.PairSlots([b"a", b"ab", b"b", b"cab"], [b"b", b"b", b"ab", b"zcab"])
    pairs = [(0, 2, False), (1, 0, True), (1, 1, True), (1, 2, True), (2, 0, True), (2, 1, True), (2, 2, True), (3, 0, True), (3, 2, True), (3, 3, True), (2, 3, True)]
    kept = [(a, b) for a, b, ends in pairs if ends]
    got = slots.of(np.array([a for a, _ in kept]), np.array([b for _, b in kept])).tolist()
    assert len(set(got)) == len(kept) and max(got) < slots.size
    b_of = slots.b_of_slots([b"a", b"ab", b"b", b"cab"], [b"b", b"b", b"ab", b"zcab"])
    assert b_of[got].tolist() == [b for _, b in kept]
