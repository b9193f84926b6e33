import random

import pytest

LANG = ["en", "de"]


def prose(rng, n, vocabulary=400):
    letters = str.maketrans("0123456789", "abcdefghij")
    return " ".join(f"w{str(rng.randrange(vocabulary)).translate(letters)}x" for _ in range(n))


def make_rows():
    rng = random.Random(7)
    rows = [(i, prose(rng, rng.randrange(3, 160)), "en", f"src{i % 3}") for i in range(40)]
    shared = prose(rng, 70)
    rows += [(40 + i, prose(rng, 20 + i) + "\n" + shared + "\n" + prose(rng, 12), "de", "src0") for i in range(4)]
    base = prose(rng, 130)
    words = base.split()
    for i in range(6):  # near copies, one word changed
        words[10 * i] = f"changed{i}"
        rows.append((50 + i, " ".join(words), "en", "src1"))
    rows += [(60 + i, base, "en", "src0") for i in range(12)]  # a group of copies
    rows += [(80, None, "en", "src2"), (81, "", None, None), (82, " \n\t ", "en", "src2"), (83, "One", "en", "src2"), (None, base + " end", "en", "src2")]
    rows += [(84, "Ä Straße été " * 4000, "de", "src1"), (85, "x" * 50_000, "en", "src1")]
    rows += [(1, rows[1][1], "en", "src1"), (60, base, "en", "src0")]  # rows repeated as a whole
    rows += [(86, f"reach me at a.b@c.example or +1 (555) 123-4567\nserver 10.0.0.256 10.1.2.3 card 4111 1111 1111 1111.", "en", "src1")]
    return rows


#: Further columns with names that the operators use themselves.
EXTRA = "key string, spans string, a int, w string, fp long, n_words string, score double, rank int, n_chars long"


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    data = [(*r, "k", "s", 1, "w", 2, "n", 0.5, 3, len(r[1] or "")) for r in rows]
    return spark.createDataFrame(data, f"doc_id long, text string, lang string, source string, {EXTRA}").repartition(5)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
