"""Operators against brute force, over nulls, empty and long texts, ties, repeated rows and extra columns."""

import os
import random
import re
import zlib
from collections import Counter
from math import log

import numpy as np
import pytest

from tests.llm import brute
from tierline.llm import decontaminate, licenses, packing, phrase_dedup, pii, quality_rules, sharding, simhash

ITEMS = [(1, "w1x w2x w3x"), (2, None), (3, ""), (4, "Zzz"), (None, "no id here at all")]


def by_row(df, *cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


def expected(rows, found):
    return Counter((i, *found[i]) for i, *_ in rows)


def test_decontamination(spark, docs, no_docs, rows):
    words = rows[5][1].split()
    items = ITEMS + [(5, " ".join(words[:14]).upper()), (5, "other " + " ".join(words[2:11])), (6, " ".join(words[2:13]) + " tail")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumnRenamed("item_id", "item_id")
    got = decontaminate.contamination(docs, bench)
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert by_row(got, *cols) == expected(rows, brute.decontaminate([r[:2] for r in rows], items))
    assert decontaminate.contamination(no_docs, bench).count() == 0
    clean = decontaminate.contamination(docs, bench.limit(0))
    assert by_row(clean, *cols) == expected(rows, brute.decontaminate([r[:2] for r in rows], []))


def test_simhash(docs, no_docs, rows):
    known = [r[:2] for r in rows if r[0] is not None]
    want = brute.simhash_classes(known)
    got = simhash.near_duplicates(docs)
    assert by_row(got.where("doc_id is not null"), "doc_id", "fingerprint", "component_id") == expected([r for r in rows if r[0] is not None], want)
    assert simhash.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("n", [1, 17, 3000])
def test_gray_index_is_exact(n):
    rng = np.random.default_rng(n)
    centre = rng.integers(0, 2**63, 5, dtype=np.uint64)
    fps = np.unique(centre[rng.integers(0, 5, n)] ^ (np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64)))
    fps = fps[np.argsort(simhash.gray_rank(fps))]
    i, j = simhash.GrayIndex(fps).search(fps, 2)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2
    assert {*zip(i.tolist(), j.tolist())} == {*zip(*(x.tolist() for x in np.nonzero(near)))}


def test_large_nodes_are_factored_exactly(spark):
    rng = np.random.default_rng(3)
    low = rng.choice(1 << 14, 1500, replace=False).astype(np.int64)
    fps = [(int(x), int(i)) for i, x in enumerate(low | (0x5A5A << 40))]
    df = spark.createDataFrame(fps, "fp long, v long")
    whole = {tuple(r) for r in simhash.components(simhash.links(df, 2, 4096)).collect()}
    cut = {tuple(r) for r in simhash.components(simhash.links(df, 2, 100)).collect()}
    assert whole == cut and whole


@pytest.mark.parametrize("most", [20_000, 1])
def test_phrase_dedup(docs, no_docs, rows, most):
    known = [r for r in rows if r[0] is not None]
    got = phrase_dedup.dedup(docs, max_segments=most)
    assert by_row(got.where("doc_id is not null"), "doc_id", "n_words", "n_removed", "kept_sha256") == expected(known, brute.repeats([r[:2] for r in known]))
    late = got.where("doc_id is null").first()
    assert late["n_removed"] == 130  # a null id comes after all others
    assert phrase_dedup.dedup(no_docs).count() == 0


def test_quality(docs, no_docs, rows):
    want = Counter((i, *brute.quality(t)) for i, t, *_ in rows)
    got = quality_rules.quality(docs, evidence=True)
    assert by_row(got, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == want
    assert got.where("base_failed and kept or kept <> (rejected_by is null)").count() == 0
    assert quality_rules.quality(no_docs).count() == 0


def test_cascade_order_follows_rejections_per_cost_and_not_the_verdict(docs):
    rules = quality_rules.RULES
    measured = [{"rule": r.name, "seconds": 1.0, "rejects": i / 10} for i, r in enumerate(rules)]
    assert [r.name for r in quality_rules.ordered(rules, measured)] == [r.name for r in reversed(rules)]
    one = by_row(quality_rules.quality(docs, rules), "doc_id", "kept")
    assert one == by_row(quality_rules.quality(docs, rules[::-1]), "doc_id", "kept")


def test_pii_base_spans(docs, no_docs, rows):
    want = Counter()
    for i, t, *_ in rows:
        s = brute.pii(t)
        n = Counter(k for k, _, _ in s)
        want[(i, n["email"], n["ip"], n["card"], n["phone"], brute.sha(",".join(f"{k}:{a}:{b}" for k, a, b in s)))] += 1
    assert by_row(pii.report(docs), "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == want
    assert pii.report(no_docs).count() == 0


def test_pii_hard_cases(spark):
    texts = ["a@b.c+d@e.f x@y", "1.2.3.4.5.6.7.8 0001.2.3.4 1.2.3.999", "+12345678+1 (23) 45-67-89+", "4111-1111 1111 1111 5500005555555559 1 2 3", "ü@x.de é a@b.c..d +" + "1" * 20, "9" * 30_000 + " " + "a." * 9000 + "@" + "b." * 9000 + "c"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.report(df).collect()}
    assert got == {i: ",".join(f"{k}:{a}:{b}" for k, a, b in brute.pii(t)) for i, t in enumerate(texts)}


def test_disclosing_terms_and_redaction(spark):
    lines = [f"ask Zyxwv about q{i} via boss@corp.example" for i in range(5)] + [f"plain about talk{i}q" for i in range(60)]
    rows = [(i, t) for i, t in enumerate(lines)] + [(99, "boss@corp.example and zyxwv\nthen about"), (98, lines[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'k' as key", "1 as flat")
    got = {r["doc_id"]: r["spans"] for r in pii.report(df).collect()}
    assert got[99] == "email:0:17,term:22:27"  # seen with the address alone; 'about' is not
    assert got[0] == "email:23:40,term:4:9" and got[10] == ""
    clean = {r["doc_id"]: r for r in pii.redact(df).collect()}
    assert clean[99]["text"] == "[EMAIL] and [TERM]\nthen about" and clean[99]["flat"] == 1
    assert clean[10]["text"] == lines[10]


def test_disclosing_terms_equal_counts_by_hand(spark):
    rng = random.Random(3)
    lines = []
    for _ in range(400):
        who = rng.randrange(6)
        near = f"helper{chr(97 + who)}{'abc'[rng.randrange(3)] * 4}" if rng.random() < 0.9 else "common"
        mail = f"p{who}@x.example" if rng.random() < 0.4 else ""
        lines.append(" ".join([near, "plain", chr(97 + rng.randrange(26)) * 5, mail]))
    lines += ["hot text p0@x.example"] * 300  # copies of one line count once
    df = spark.createDataFrame([("k", "\n".join(lines)), ("l", ""), ("m", "\n".join(lines[:50]))], "key string, text string")
    different = set(lines) | {""}
    terms = {x: {w for w in re.findall("[a-z]+", re.sub(r"\S+@\S+", " ", x)) if len(w) > 3} for x in different}
    everywhere = {x: {w for w in re.findall("[a-z]+", x) if len(w) > 3} for x in different}
    want, n = {}, len(different)
    for e in {f"p{i}@x.example" for i in range(6)}:
        own = [x for x in different if e in x]
        for t in set().union(*(terms[x] for x in own)):
            both, of_t = sum(t in terms[x] for x in own), sum(t in everywhere[x] for x in different)
            if both >= 3:
                share = log(both * n / (len(own) * of_t)) / log(n / len(own))
                if share >= 0.3:
                    want["0:" + e, t] = (round(share, 9), "remove" if share >= 0.5 else "generalise")
    got = pii.disclosing(df, 3, 0.5, 0.3, 4).collect()
    assert want and {(r["entity"], r["term"]): (round(r["share"], 9), r["action"]) for r in got} == want


def test_terms_on_other_lines_and_of_rare_entities_disclose(spark):
    letters = str.maketrans("0123456789", "abcdefghij")
    rows = [(i, f"plain talk number{str(i).translate(letters)} about towns") for i in range(300)]
    rows += [(1000 + i, f"about {w} towns\nZyxwv Qrstu\nboss@corp.example\nplain {w}x talk") for i, w in enumerate(["alpha", "beta"])]
    rows += [(2000 + i, "plain talk\nUvwxy\nonce@corp.example\nabout") for i in range(30)]  # copies of one text
    rows += [(3000, "Zyxwv wrote\n" + "plain talk\n" * 60 + "boss@corp.example")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    clean = {r["doc_id"]: r["text"] for r in pii.redact(df).collect()}
    for i, w in enumerate(["alpha", "beta"]):
        lines = clean[1000 + i].split("\n")
        assert lines[0] == f"about {w} towns" and set(lines[1].split()) <= {"[TERM]", "[WORD]"} and lines[2:] == ["[EMAIL]", f"plain {w}x talk"]
    assert clean[2000] == "plain talk\nUvwxy\n[EMAIL]\nabout" and clean[5] == rows[5][1]
    assert clean[3000].split()[0] in ("[TERM]", "[WORD]")


def test_copies_of_a_line_disclose_nothing(spark):
    df = spark.createDataFrame([(i, "ask Zyxwv via boss@corp.example") for i in range(30)], "doc_id long, text string")
    assert {r["spans"] for r in pii.report(df).collect()} == {"email:14:31"}


def test_sharding(docs, no_docs, rows):
    got = sharding.shard(docs, shards=4, slots=64)
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert by_row(got, "doc_id", "size", "text_crc32") == want
    places = {}
    for r in got.collect():
        places.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert sharding.shard(no_docs, shards=4).count() == 0


def test_slot_maps_balance_and_grow(spark, workdir):
    sizes = {s: 1000 + 37 * s % 501 for s in range(512)}
    old = sharding.deal(sizes, 8, 512)
    load = Counter()
    for s, shard in old.items():
        load[shard] += sizes[s]
    assert max(load.values()) - min(load.values()) <= max(sizes.values())
    new = sharding.rebalance(old, sizes, 9)
    moved = {s for s in old if old[s] != new[s]}
    assert moved and {new[s] for s in moved} == {8}
    sharding.save_map(spark, workdir, 1, old)
    sharding.save_map(spark, workdir, 2, new)
    assert {tuple(r) for r in sharding.load_map(spark, workdir, 2).collect()} == set(new.items())
    with pytest.raises(Exception, match="(?i)exist"):
        sharding.save_map(spark, workdir, 2, old)


@pytest.fixture(scope="module")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer(vocabulary):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary)


def test_packing(docs, no_docs, rows, vocabulary, tokenizer):
    size = 64
    got = packing.pack(docs, vocabulary, size=size).collect()
    want = Counter()
    for i, t, *_ in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for at in range(0, len(ids), size):
            part = np.array(ids[at : at + size], "<u4").tobytes()
            want[(i, at, len(part) // 4, zlib.crc32(part), len(ids))] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want
    ends = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= size and sorted(ends) == list(range(len(ends)))
    assert packing.pack(no_docs, vocabulary).count() == 0


def test_words_one_by_one_are_the_text(vocabulary, tokenizer):
    texts = ["Don't I'VE  'S x y", "ΟΔΟΣ İstanbul ﬁ Ångström é ́x", "a<|endoftext|>b", "1234 ½ x\x1cy 你好，世界 🙂🙂", "''' 't'T \r\n\t$$$###"]
    words = packing.WordIds(vocabulary)
    for t in texts:
        assert np.frombuffer(words.text(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_ids_equal_the_tokenizer_over_all_code_points(vocabulary, tokenizer):
    words = packing.WordIds(vocabulary)
    for at in range(0, 0x110000, 0x8000):
        # Younger code points take the tokenizer itself; one in 101 of them is enough to see that.
        points = [c for c in range(at, at + 0x8000) if not 0xD800 <= c <= 0xDFFF and (c % 101 == 0 or not packing.YOUNGER.match(chr(c)))]
        texts = [f"a{chr(c)}b {chr(c)} {chr(c)}X" for c in points]
        for t, e in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)):
            assert np.frombuffer(words.text(t), "<u4").tolist() == e.ids, ascii(t)


def test_ids_equal_the_tokenizer_over_random_texts(vocabulary, tokenizer):
    rng, words = random.Random(7), packing.WordIds(vocabulary)
    planes = [range(0x20, 0x250), range(0x20, 0x3000), range(0x10000), range(0x32000)]
    texts = ["".join(chr(c) for c in rng.choices(planes[i % 4], k=12) if not 0xD800 <= c <= 0xDFFF) for i in range(20_000)]
    for t, e in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(words.text(t), "<u4").tolist() == e.ids, ascii(t)


def test_patterns_hold_the_histogram():
    rng = np.random.default_rng(1)
    counts = Counter(rng.integers(1, 65, 5000).tolist())
    patterns = packing.pack_histogram(counts, 64)
    held = Counter()
    for lengths, packs in patterns:
        assert sum(lengths) <= 64
        for n in lengths:
            held[n] += packs
    assert held == counts
    assert sum(p for _, p in patterns) <= 1.02 * sum(k * v for k, v in counts.items()) / 64


def test_licenses(spark):
    files = [
        (1, "a/LICENSE", "Released under the MIT License."),
        (2, "a/x.py", "code"),
        (3, "a/b/c/y.py", "more code"),
        (4, "a/b/LICENSE", "Licensed under CC BY-NC 4.0."),
        (5, "d/z.py", "text\nThis work is licensed under the GNU General Public License, version 3.\n" + "word " * 200),
        (6, "d/q.py", "the license of the house"),
        (7, None, "none"),
        (8, "a/e.py", None),
        (9, "top.py", ""),
        (2, "a/x.py", "code"),
    ]
    df = spark.createDataFrame(files, "doc_id long, path string, text string").selectExpr("*", "'k' as key", "1 as n", "'f' as folder")
    got = Counter(map(tuple, licenses.scan(df).select("doc_id", "license", "origin", "source_path").collect()))
    assert got == Counter([
        (1, "MIT", "own", "a/LICENSE"), (2, "MIT", "inherited", "a/LICENSE"), (2, "MIT", "inherited", "a/LICENSE"),
        (3, "CC-BY-NC-4.0", "inherited", "a/b/LICENSE"), (4, "CC-BY-NC-4.0", "own", "a/b/LICENSE"), (5, "GPL-3.0", "own", "d/z.py"),
        (6, None, None, None), (7, None, None, None), (8, "MIT", "inherited", "a/LICENSE"), (9, None, None, None),
    ])
    assert licenses.scan(df.limit(0)).count() == 0


def test_licences_of_fixed_lines_at_growing_sizes(spark):
    fixed = [(0, "All rights reserved."), (1, "Copyright. All rights reserved."), (2, "Released under the MIT License.")]
    assert licenses._idf(10**9, 0) == licenses._idf(10**6, 0)
    for n in (30, 1_000, 30_000):
        plain = spark.range(10, n).selectExpr("id as doc_id", "concat('all that was reserved by rights', if(id % 3 = 0, '', concat(' word', id))) as text")
        plain = plain.selectExpr("doc_id", "if(doc_id % 150 = 0, text, 'other words of a town') as text")
        df = spark.createDataFrame(fixed, "doc_id long, text string").unionByName(plain).selectExpr("*", "cast(null as string) as path")
        got = {r["doc_id"]: (r["license"], r["similarity"]) for r in licenses.scan(df).where("doc_id < 10").collect()}
        assert got[0] == ("Proprietary", 1.0) and got[1] == ("Proprietary", 1.0) and got[2] == ("MIT", 1.0), n


def test_licence_cosines_count_all_words(spark):
    from tierline.llm.license_texts import HEADERS, TEXTS

    rng = random.Random(5)
    outside = [f"other{i}" for i in range(30)]
    lines = ["Our code and article: released under the MIT License."] * 3 + ["our code and article", "our article and code"] * 300 + ["some town"] * 500
    lines += [" ".join(rng.choices(licenses.VOCABULARY + outside, k=rng.randrange(1, 14))) for _ in range(40)]
    for _, text in licenses.TEMPLATES:
        lines += [" ".join([*licenses._split(text), *rng.choices(outside + ["our", "code"], k=k)]) for k in range(6)]
    n, held = len(lines), Counter(w for x in lines for w in set(licenses._split(x)))

    def unit(bag):
        x = {w: c * licenses._idf(n, held[w]) for w, c in bag.items()}
        norm = sum(v * v for v in x.values()) ** 0.5
        return {w: v / norm for w, v in x.items()}

    statements = [(name, unit(Counter(licenses._split(t)))) for name, t in licenses.TEMPLATES] + [(name, unit(b)) for name, b in HEADERS + TEXTS]
    want = {}
    for i, x in enumerate(unit(Counter(licenses._split(x))) for x in lines):
        like = [(-round(sum(v * t.get(w, 0) for w, v in x.items()), 6), name) for name, t in statements]
        if any(w in licenses.ANCHORS for w in x) and -min(like)[0] >= 0.7:
            want[i] = (min(like)[1], -min(like)[0])
    df = spark.createDataFrame([(i, None, x) for i, x in enumerate(lines)], "doc_id long, path string, text string")
    got = {r["doc_id"]: (r["license"], r["similarity"]) for r in licenses.scan(df, count_outside=True).collect() if r["license"]}
    assert got.keys() == want.keys() and len(want) > 40 and got[0][0] == "MIT"
    assert all(got[i][0] == want[i][0] and abs(got[i][1] - want[i][1]) < 3e-6 for i in want)
    assert 0 not in {r["doc_id"] for r in licenses.scan(df).where("license is not null").collect()}


MIT_TEXT = """MIT License

Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""


def test_licence_texts_and_headers(spark):
    from tierline.llm.license_texts import HEADERS, TEXTS

    bag = lambda items, name: [w for w, n in dict(items)[name].items() for _ in range(n)]
    wrap = lambda w, start="": "\n".join(start + " ".join(w[i : i + 9]) for i in range(0, len(w), 9))
    plain = [(100 + i, f"other/f{i}.txt", f"the story of a town and number{i} in it " * 9) for i in range(40)]
    files = [
        (1, "a/LICENSE", MIT_TEXT), (2, "a/b/x.py", "code"),
        (3, "c/notes.txt", MIT_TEXT.replace("\n", " ")), (4, "c/d/y.py", "code"),  # on one line, any name
        (5, "e/COPYING", wrap(bag(TEXTS, "GPL-3.0"))), (6, "e/z.py", "code"),
        (7, "g/COPYING", wrap(bag(TEXTS, "AGPL-3.0"))),
        (8, "h/m.c", wrap(bag(HEADERS, "Apache-2.0"), "# ") + "\nimport os\n" + "value of things\n" * 300), (9, "h/n.c", "code"),
        (10, "i/LICENSE.txt", "Released under the MIT License.\n" + "history of the house " * 30), (11, "i/o.c", "code"),
        (12, "j/readme", "Released under the MIT License.\n" + "history of the house " * 30), (13, "j/o.c", "code"),
        *plain,
    ]
    df = spark.createDataFrame(files + files[:2], "doc_id long, path string, text string")
    got = {r["doc_id"]: (r["license"], r["origin"]) for r in licenses.scan(df).collect()}
    assert {k: v for k, v in got.items() if k < 100} == {
        1: ("MIT", "own"), 2: ("MIT", "inherited"), 3: ("MIT", "own"), 4: ("MIT", "inherited"), 5: ("GPL-3.0", "own"), 6: ("GPL-3.0", "inherited"),
        7: ("AGPL-3.0", "own"), 8: ("Apache-2.0", "own"), 9: (None, None), 10: ("MIT", "own"), 11: ("MIT", "inherited"), 12: ("MIT", "own"), 13: (None, None),
    }
    assert {v for k, v in got.items() if k >= 100} == {(None, None)}


def test_licence_cosines_equal_counts_by_hand(spark):
    rng = random.Random(11)
    words = licenses.VOCABULARY + [f"other{i}" for i in range(30)]
    lines = [" ".join(rng.choices(words, k=rng.randrange(1, 14))) for _ in range(60)] + ["", "license " * 3000, "word " * 3000 + "license"]
    for _, text in licenses.TEMPLATES:  # statements with other words between
        lines += [" ".join([*licenses._split(text), *rng.choices(words, k=k), *["again"] * (k // 3)]) for k in range(8)]
    n, idf = len(lines), {}
    for w in {w for x in lines for w in licenses._split(x)} | set(licenses.VOCABULARY):
        idf[w] = licenses._idf(n, sum(w in licenses._split(x) for x in lines) if w in licenses.VOCABULARY else 0)

    def unit(text):
        x = {w: c * idf[w] for w, c in Counter(licenses._split(text)).items()}
        norm = sum(v * v for v in x.values()) ** 0.5
        return {w: v / norm for w, v in x.items()}

    vectors = [(name, unit(t)) for name, t in licenses.TEMPLATES]
    want = {}
    for i, x in enumerate(map(unit, lines)):
        like = [(-round(sum(v * t.get(w, 0) for w, v in x.items()), 6), name) for name, t in vectors]
        if any(w in licenses.ANCHORS for w in x) and -min(like)[0] >= 0.7:
            want[i] = (min(like)[1], -min(like)[0])
    df = spark.createDataFrame([(i, None, x) for i, x in enumerate(lines)], "doc_id long, path string, text string")
    got = {r["doc_id"]: (r["license"], r["similarity"]) for r in licenses.scan(df).collect() if r["license"]}
    assert got.keys() == want.keys() and len(want) > 40
    assert all(got[i][0] == want[i][0] and abs(got[i][1] - want[i][1]) < 3e-6 for i in want)
