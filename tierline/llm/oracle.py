"""DuckDB SQL of the contracts that SQL can express, over the whole tables and texts."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

_ITEM_WORDS = rf"regexp_extract_all(translate(text, '{ascii_uppercase}', '{ascii_lowercase}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: The cascade keeps what no rule rejects, in whatever order the rules ran.
OP4 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sizes AS (
  SELECT r, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    length(regexp_replace(t, '[^\p{L}]', '', 'g')) AS letters,
    length(regexp_replace(t, '[^\p{Lu}]', '', 'g')) AS capitals,
    len(list_filter(string_split_regex(t, '[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+'),
      lambda x: regexp_matches(x, '[\p{L}\p{Nl}\p{No}]'))) AS worded,
    len(list_distinct(w)) AS kinds
  FROM docs
),
lines AS (
  SELECT r, count(*) AS n_lines, CAST(count(*) - count(DISTINCT line) AS BIGINT) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM docs) AS x
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
),
places AS (SELECT r, w, unnest(generate_series(1, len(w) - 4)) AS i FROM docs WHERE len(w) >= 5),
runs AS (SELECT r, i, array_to_string(list_slice(w, i, i + 4), ' ') AS run FROM places),
twice AS (SELECT r, run FROM runs GROUP BY r, run HAVING count(*) > 1),
repeats AS (
  SELECT r, count(DISTINCT word) AS n_repeat_words
  FROM (SELECT r, unnest(generate_series(i, i + 4)) AS word FROM runs JOIN twice USING (r, run)) AS x GROUP BY r
),
facts AS (
  SELECT doc_id, n_words, word_chars, n_symbols, letters, capitals, worded, kinds, coalesce(n_lines, 0) AS n_lines,
    coalesce(n_dup_lines, 0) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM docs JOIN sizes USING (r) LEFT JOIN lines USING (r) LEFT JOIN repeats USING (r)
),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM facts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > 3 * n_words OR word_chars < 2 * n_words OR word_chars > 25 * n_words
    OR 2 * n_dup_lines > n_lines OR 10 * worded < 6 * n_words OR (2 * capitals > letters AND letters > 0)
    OR (n_words >= 50 AND 20 * kinds < n_words)) AS kept
FROM judged
"""

#: All runs of each window's size in the documents meet the windows by their words.
OP5 = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce({_ITEM_WORDS}, []) AS w FROM documents
),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, {_ITEM_WORDS} AS w FROM benchmark
),
starts AS (
  SELECT item_id, w, least(len(w), 10) AS n, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i
  FROM items WHERE len(w) > 0
),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win FROM starts
),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM docs JOIN sizes ON len(w) >= n
),
runs AS (SELECT r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win FROM places),
hits AS (SELECT r, i, n, item_id FROM runs JOIN windows USING (n, win)),
covered AS (
  SELECT r, count(DISTINCT word) AS n_hit
  FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS word FROM hits) AS c GROUP BY r
),
named AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM hits WHERE item_id IS NOT NULL) AS d GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""

#: A word goes if any of the 50 windows that may cover it starts in a smaller document, too.
OP10 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS place,
    coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
),
words AS (SELECT r, place, w, unnest(generate_series(1, len(w))) AS i FROM docs WHERE len(w) > 0),
runs AS (
  SELECT r, i, place, sha256(array_to_string(list_slice(w, i, i + 49), ' ')) AS win FROM words WHERE i + 49 <= len(w)
),
firsts AS (SELECT win, min(place) AS least FROM runs GROUP BY win),
again AS (SELECT r, i FROM runs JOIN firsts USING (win) WHERE place > least),
marked AS (
  SELECT words.r, words.i, list_extract(words.w, words.i) AS word,
    max(CASE WHEN again.i IS NULL THEN 0 ELSE 1 END) OVER (
      PARTITION BY words.r ORDER BY words.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM words LEFT JOIN again ON words.r = again.r AND words.i = again.i
),
kept AS (
  SELECT r, sum(gone) AS n_removed, string_agg(CASE WHEN gone = 0 THEN word END, ' ' ORDER BY i) AS text FROM marked GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""

def vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Lloyd's rounds over all kept vectors, one common table expression each."""
    sql = f"""
WITH finite AS (
  SELECT vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(embedding) % {parts} = 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
most AS (SELECT len(embedding) AS dim FROM finite GROUP BY dim ORDER BY count(*) DESC, dim DESC LIMIT 1),
whole AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM finite JOIN most ON len(embedding) = dim
),
kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r, * FROM whole),
long AS MATERIALIZED (
  SELECT r, (i - 1) // w AS part, (i - 1) % w AS place, v[i] AS x
  FROM (SELECT r, v, len(v) // {parts} AS w, unnest(generate_series(1, len(v))) AS i FROM kept) AS y
),
book0 AS MATERIALIZED (SELECT part, r - 1 AS entry, place, x AS c FROM long WHERE r <= {entries}),"""
    near = """
near{k} AS MATERIALIZED (
  SELECT r, part, min(d * {entries} + entry) AS m
  FROM (SELECT r, part, entry, sum((x - c) * (x - c)) AS d FROM long JOIN book{k} USING (part, place) GROUP BY r, part, entry) AS y
  GROUP BY r, part
),"""
    book = """
mean{k} AS (
  SELECT part, m % {entries} AS entry, place, sum(x) AS s, count(*) AS n FROM long JOIN near{k} USING (r, part) GROUP BY ALL
),
book{n} AS MATERIALIZED (
  SELECT part, entry, place, CAST(coalesce((s - ((s % n) + n) % n) // n, c) AS BIGINT) AS c
  FROM book{k} LEFT JOIN mean{k} USING (part, entry, place)
),"""
    for k in range(rounds):
        sql += near.format(k=k, entries=entries) + book.format(k=k, n=k + 1, entries=entries)
    sql += near.format(k=rounds, entries=entries)
    return (
        sql
        + f"""
coded AS (
  SELECT r, string_agg(printf('%02x', CAST(m % {entries} AS INTEGER)), '' ORDER BY part) AS code, sum(m // {entries}) AS error
  FROM near{rounds} GROUP BY r
)
SELECT vec_id, code, CAST(error AS BIGINT) AS error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, place)) FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (r)
"""
    )


ORACLE_SQL: dict[str, str] = {"op4_quality_rules": OP4, "op5_decontamination": OP5, "op10_phrase_dedup": OP10, "op11_vector_codes": vector_codes()}
