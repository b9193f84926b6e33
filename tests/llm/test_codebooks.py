"""Vector codes against plain rounds in Python integers, and against their SQL."""

import hashlib
import random
from collections import Counter
from math import floor, inf, isfinite, nan

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tierline.llm import codebooks
from tierline.llm.oracle import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error long, part int, n int"
COLS = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def plain(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [floor(4096 * x) for x in v], y) for i, v, y in rows if v and len(v) % parts == 0 and all(x is not None and isfinite(x) for x in v)]
    if not kept:
        return Counter()
    dims = Counter(len(v) for _, v, _ in kept)
    dim = max(dims, key=lambda d: (dims[d], d))
    kept = sorted((r for r in kept if len(r[1]) == dim), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = dim // parts
    cut = [[v[p * w : (p + 1) * w] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = [near(c[p], books[p])[1] for c in cut]
            for j in range(len(books[p])):
                some = [c[p] for c, o in zip(cut, own) if o == j]
                if some:
                    books[p][j] = [sum(x) // len(some) for x in zip(*some)]
    got = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    error = [sum(d for d, _ in g) for g in got]
    per = Counter()
    for (_, _, y), e in zip(kept, error):
        per[y] += e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter((i, "".join(f"{j:02x}" for _, j in g), e, per[y], sha) for (i, _, y), g, e in zip(kept, got, error))


def some_rows(n=400, dim=16, seed=5):
    rng = random.Random(seed)
    f = lambda x: float(np.float32(x))
    centres = [[rng.gauss(0, 0.2) for _ in range(dim)] for _ in range(9)]
    rows = [(3 * i - 50, [f(x + rng.gauss(0, 0.05)) for x in rng.choice(centres)], rng.choice([0, 1, 2, None])) for i in range(n)]
    rows += [(1000 + i, rows[7][1], 1) for i in range(n // 3)]  # one very common vector
    rows += rows[:5] + [(None, rows[9][1], 2), (rows[3][0], rows[4][1], 0)]  # repeated rows, no id, one id twice
    rows += [(5000, None, 0), (5001, [0.1] * (dim - 1) + [None], 0), (5002, [nan] * dim, 1), (5003, [inf] + [0.0] * (dim - 1), 1)]
    rows += [(5004, [], 1), (-9999, [0.5] * 8, 1), (5005, [0.5] * 9, 1), (5006, [0.0] * dim, 7)]
    rows.insert(0, (-60, [-0.3] * dim, None))
    return rows


@pytest.fixture(scope="module")
def vectors():
    return some_rows()


def table(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, 2, 3) for r in rows], SCHEMA).repartition(4)


def found(df):
    return Counter(tuple(r) for r in df.select(*COLS).collect())


def test_codes(spark, vectors, monkeypatch):
    want = plain(vectors)
    assert found(codebooks.codes(table(spark, vectors))) == want and len({r[3] for r in want}) == 5
    monkeypatch.setattr(codebooks, "CHUNK", 50)
    assert found(codebooks.codes(table(spark, vectors).repartition(2))) == want


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [nan] * 8, 1)], some_rows(20)[:5], [(1, [0.25] * 8, None)] * 3])
def test_few_vectors(spark, rows):
    assert found(codebooks.codes(table(spark, rows))) == plain(rows)


def test_columns_may_lack_their_types(spark):
    rows = [(1, [0.5] * 8, "a" * 200), (2, [-0.5] * 8, "a" * 200), (3, [0.25] * 8, None)]
    df = spark.createDataFrame(rows, "id int, v array<double>, kind string")
    got = codebooks.codes(df, id_col="id", vector_col="v", label_col="kind")
    assert found(got) == plain(rows)


def test_huge_components_are_refused(spark):
    with pytest.raises(Exception, match="too large"):
        codebooks.codes(table(spark, [(1, [1e30] * 8, 1)]))


def test_sql(vectors):
    for rows in (vectors, some_rows(20)[:5], []):
        con = duckdb.connect()
        types = [("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("label", pa.int32())]
        con.register("embeddings", pa.table({c: pa.array([r[k] for r in rows], t) for k, (c, t) in enumerate(types)}))
        assert Counter(con.execute(vector_codes()).fetchall()) == plain(rows)


@pytest.mark.parametrize("n", [1, 30, 1500])
def test_trees(n):
    rng = np.random.default_rng(n)
    run = rng.integers(-40, 40, (n, 4)).astype(np.int64)
    run[: n // 3] = run[0]
    tree = codebooks.CoverTree.build(run)
    assert sorted(tree.order.tolist()) == list(range(n)) and (run[tree.order] == tree.points).all()
    for node in tree.nodes:
        own = tree.points[node["lo"] : node["hi"]]
        reach = np.sqrt(((own - tree.points[node["centre"]]) ** 2).sum(1))
        assert reach.max() <= node["radius"]
        kids = tree.nodes[node["child"] : node["child"] + node["children"]]
        if len(kids):
            assert kids["lo"].tolist() == [node["lo"], *kids["hi"][:-1].tolist()] and kids["hi"][-1] == node["hi"]
            centres = tree.points[kids["centre"]]
            gaps = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(2))
            assert (gaps[~np.eye(len(kids), dtype=bool)] > node["radius"] / 2).all() and (kids["radius"] <= node["radius"] / 2).all()
    for k in (1, 2, 16):
        entries = run[rng.integers(0, n, k)]  # some equal
        square = ((run[:, None] - entries[None]) ** 2).sum(2)
        want = square.argmin(1)
        entry, error = tree.labels(entries)
        assert (entry == want).all() and (error == square.min(1)).all()
        count, total = tree.totals(entries)
        assert (count == np.bincount(want, minlength=k)).all()
        assert all((total[j] == run[want == j].sum(0)).all() for j in range(k))


def test_clear_groups_are_assigned_whole():
    rng = np.random.default_rng(2)
    run = np.concatenate([rng.integers(0, 50, (600, 4)), 100_000 + rng.integers(0, 50, (600, 4))]).astype(np.int64)
    whole, points, _ = codebooks.CoverTree.build(run).assign(run[[0, 700]])
    assert len(points) == 0 and sum(len(lo) for lo, _, _ in whole) < 20


def test_label_errors_beyond_the_broadcast(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["=hot"] * 5 + [f"={k}" for k in range(3000)] + [""]), "00", i) for i in range(4000)]
    df = spark.createDataFrame(rows, "vec_id long, label string, code string, error long")
    per = Counter()
    for i, y, _, e in rows:
        per[y] += e
    for most in (10, 10_000):
        got = codebooks.with_label_error(df, most).select("vec_id", "label_error").collect()
        assert Counter(map(tuple, got)) == Counter((i, per[y]) for i, y, _, _ in rows)
