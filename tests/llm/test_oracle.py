"""The SQL of the contracts against brute force, over the same edge cases as the operators."""

from collections import Counter

import duckdb
import pyarrow as pa

from tests.llm import brute
from tierline.llm import quality_rules
from tierline.llm.oracle import ORACLE_SQL
from tierline.llm.queries import QUERIES


def _rows(sql, **tables):
    con = duckdb.connect()
    for name, (kinds, rows) in tables.items():
        con.register(name, pa.table({c: pa.array(x, k) for (c, k), x in zip(kinds, zip(*rows))}))
    return Counter(con.execute(sql).fetchall())


def _documents(rows):
    return [("doc_id", pa.int64()), ("text", pa.string())], [r[:2] for r in rows]


def test_every_oracle_belongs_to_a_query():
    assert ORACLE_SQL.keys() <= QUERIES.keys()


def test_decontamination_sql(rows):
    words = rows[5][1].split()
    items = [(1, "w1x w2x"), (2, None), (3, ""), (4, "oNe"), (None, "no id here"), (5, " ".join(words[:14]).upper())]
    got = _rows(ORACLE_SQL["op5_decontamination"], documents=_documents(rows), benchmark=([("item_id", pa.int64()), ("text", pa.string())], items))
    found = brute.decontaminate([r[:2] for r in rows], items)
    assert got == Counter((i, *found[i]) for i, *_ in rows)


def test_phrase_dedup_sql(rows):
    known = [r for r in rows if r[0] is not None]
    got = _rows(ORACLE_SQL["op10_phrase_dedup"], documents=_documents(known))
    found = brute.repeats([r[:2] for r in known])
    assert got == Counter((i, *found[i]) for i, *_ in known)


def test_quality_sql(docs, rows):
    got = _rows(ORACLE_SQL["op4_quality_rules"], documents=_documents(rows))
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert got == Counter(map(tuple, quality_rules.quality(docs).select(*cols).collect()))
    base = Counter()
    for k, n in got.items():
        base[k[:-1]] += n
    assert base == Counter((i, *brute.quality(t)) for i, t, *_ in rows)
