"""Language identification against plain counts, and on held-out documents."""

import math
import unicodedata
import zlib

import numpy as np
import pytest

from tests.conftest import SF01
from tierline.llm import langid
from tierline.llm.langid import Params

WORDS = {
    "en": "the and of to in that it was for with house tree water green walking",
    "de": "der die und das nicht ein zu mit über Straße grün Wasser gehen Bäume",
    "fr": "le la les et à un être été eau vert maison avec pour dans marcher",
}


def make_rows():
    rng = np.random.default_rng(6)
    rows = []
    for i in range(150):
        lang = ["en", "de", "fr"][i % 3]
        text = " ".join(rng.choice(WORDS[lang].split(), rng.integers(1, 30))) + rng.choice([".", "\n", " 42!", ""])
        rows.append((i, str(text), lang))
    rows += [(200, None, "de"), (201, "", "en"), (202, " 12 + 34 \n\t", "fr"), (203, "a", "en"), (204, "Ω", None), (205, "the house", None)]
    rows += [(206, "ß. " * 200_000, "de"), (207, "x" * 300_000, "en"), (None, "der Baum", "de"), (208, "́́", "fr"), (3, rows[3][1], "en"), (3, rows[3][1], "en")]
    return rows


def grams(text, p):
    kept = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in text or "")
    low = "".join(c.lower() if len(c.lower()) == 1 else c for c in kept)
    padded = " " + " ".join(low.split()) + " " if low.strip() else " "
    mask, prime = (1 << 64) - 1, 0x9E3779B97F4A7C15
    for order in range(1, p.orders + 1):
        for i in range(len(padded) - order + 1):
            value = 0
            for k, c in enumerate(padded[i : i + order], 1):
                value = (value * prime + ord(c) + k) & mask
            yield (((value ^ (value >> 29)) * prime) & mask) >> (64 - p.bits)


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


def plain(rows, p=Params()):
    train = [(t, y) for i, t, y in rows if i is not None and y is not None and not held(i)]
    names = sorted({y for _, y in train})
    n = {y: np.zeros(1 << p.bits) for y in names}
    for t, y in train:
        np.add.at(n[y], list(grams(t, p)), 1)
    logs = {y: np.log((c + p.smoothing) / (c.sum() + p.smoothing * len(c))) for y, c in n.items()}
    prior = {y: math.log(sum(z == y for _, z in train) / len(train)) for y in names}
    out = []
    for i, t, _ in rows:
        if not any(unicodedata.category(c)[0] == "L" for c in t or ""):
            out.append((i, held(i), "und", 0.0))
            continue
        g = list(grams(t, p))
        s = np.array([prior[y] + logs[y][g].sum() for y in names])
        out.append((i, held(i), names[s.argmax()], 1 / np.exp(s - s.max()).sum()))
    return out


@pytest.fixture(scope="module")
def frame(spark):
    data = [(*r, "k", 1.0, True) for r in make_rows()]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, name string, score double, held_out boolean").repartition(5)


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0], r[2]))


@pytest.mark.parametrize("window", [langid.WINDOW, 1 << 12])
def test_predictions_equal_plain_counts(frame, window, monkeypatch):
    monkeypatch.setattr(langid, "WINDOW", window)
    got, want = in_order(langid.language_id(frame).collect()), in_order(plain(make_rows()))
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], atol=1e-6)
    by_id = {r[0]: r for r in got}
    assert by_id[200][2:] == by_id[202][2:] == by_id[208][2:] == ("und", 0.0) and by_id[203][2] in WORDS


def test_labels_of_held_out_documents_are_not_read(spark, frame):
    wrong = [(i, t, "xx" if held(i) or i is None else y) for i, t, y in make_rows()]
    got = langid.language_id(spark.createDataFrame(wrong, "doc_id long, text string, lang string"))
    assert in_order(r[:3] for r in got.collect()) == in_order(r[:3] for r in langid.language_id(frame).collect())


def test_nothing_to_learn_and_empty_tables(spark, frame):
    assert langid.language_id(frame.limit(0)).count() == 0
    none = spark.createDataFrame([(1, "some words", None), (None, "mehr", "de")], "doc_id long, text string, lang string")
    assert {tuple(r)[2:] for r in langid.language_id(none).collect()} == {("und", 0.0)}


def test_thinned_training_and_too_many_languages(frame):
    prose = frame.where("doc_id < 200")
    few = {r["doc_id"]: r["lang_pred"] for r in langid.language_id(prose, Params(rows_per_language=15)).collect()}
    right = [few[i] == y for i, t, y in make_rows()[:150] if len(t) > 30]
    assert np.mean(right) > 0.9
    with pytest.raises(ValueError, match="languages"):
        langid.fit(frame, Params(max_languages=2))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = langid.language_id(docs).alias("g").join(docs.select("doc_id", "lang"), "doc_id")
    some = got.where("held_out and lang is not null and lang_pred != 'und'").collect()
    assert len(some) > 100 and np.mean([r["lang_pred"] == r["lang"] for r in some]) > 0.97
