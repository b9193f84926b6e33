"""Personal data by patterns, and the terms that would reveal it (DataFrame functions only).

Base spans: e-mail addresses, IP addresses, card and phone numbers.  Their positions follow from the
lengths of the matches and of the gaps between them.

Disclosing terms: protected entities are the values of base spans, and a context is a distinct line.
With counts over all documents, a term's pointwise mutual information with an entity is compared
with the entity's own information: the share is 1 if the term never occurs without the entity.  Pairs
need ``min_support`` different lines, so copies of a line prove nothing.  Terms above ``generalise``
are to be generalised, above ``remove`` to be removed, in the documents that hold the entity.
The same is counted over the words around each entity, whatever their lines, with documents of different
text as contexts; there two contexts that differ are enough, and half a pair is taken off every count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, row_key, small_side

KINDS = ("email", "ip", "card", "phone")
TERM = len(KINDS)
NAMES = (*KINDS, "term")

# The patterns, with possessive repeats and starts that cannot lie inside a failed run,
# which match the same and keep the matcher linear and free of recursion.
PATTERNS = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"(?<![0-9])[0-9]++(?:[\x20-][0-9]++)*+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
WORDS = r"\p{L}++"
_BYTE = r"0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IP = rf"^{_BYTE}(\.{_BYTE}){{3}}$"


def _gate(kind: int, text: Column) -> Column:
    """A cheap necessary condition."""
    return (
        F.contains(text, F.lit("@")),
        text.rlike(r"[0-9]\.[0-9]"),
        text.rlike(r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]"),
        F.contains(text, F.lit("+")),
    )[kind]


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)
    doubled = lambda i: F.substr(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + doubled(i) - F.when(doubled(i) > 9, 9).otherwise(0))
    return total % 10 == 0


def _valid(kind: Column, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(digits)
    return (
        F.when(kind == 0, True)
        .when(kind == 1, m.rlike(IP))
        .when(kind == 2, F.when(n.between(16, 19), _luhn(digits)).otherwise(False))
        .when(kind == 3, n.between(8, 15))
        .otherwise(True)
    )


def _matches(text: Column, kind: int, pattern: str) -> Column:
    """``(kind, k, gap, m)`` of every match; the gap is what lies before it."""
    pairs = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda g, m: F.struct(F.char_length(g).alias("gap"), m.alias("m")))
    rows = F.transform(pairs, lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("k"), x["gap"].alias("gap"), x["m"].alias("m")))
    return F.filter(rows, lambda x: x["m"].isNotNull())


def _positions(found: DataFrame) -> DataFrame:
    """``(key, kind, start, end, m)`` from exploded matches; repeated rows of one key count once."""
    one = found.repartition("key").groupBy("key", "kind", "k").agg(F.first("gap").alias("gap"), F.first("m").alias("m"))
    so_far = Window.partitionBy("key", "kind").orderBy("k")
    end = F.sum(F.col("gap") + F.char_length("m")).over(so_far)
    return one.select("key", "kind", (end - F.char_length("m")).alias("start"), end.alias("end"), "m")


def base_spans(texts: DataFrame) -> DataFrame:
    """``(key, kind, start, end, m)`` of the base kinds in ``(key, text)``, code points, end exclusive."""
    none = F.array().cast("array<struct<kind:int,k:int,gap:int,m:string>>")
    parts = [F.when(_gate(i, F.col("text")), _matches(F.col("text"), i, p)).otherwise(none) for i, p in enumerate(PATTERNS)]
    found = texts.select("key", F.inline(F.concat(*parts)))
    return _positions(found).where(_valid(F.col("kind"), F.col("m")))


def entity(kind: Column, m: Column) -> Column:
    """One name for a value however it is written."""
    return F.concat(kind.cast("string"), F.lit(":"), F.when(kind.isin(2, 3), F.regexp_replace(m, "[^0-9]", "")).otherwise(F.lower(m)))


def _terms(line: Column, min_length: int) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(line), r"\P{L}+"), lambda w: F.char_length(w) >= min_length))


def disclosing(texts: DataFrame, min_support: int, remove: float, generalise: float, min_length: int) -> DataFrame:
    """``(entity, term, share, action)`` from the lines of all documents."""
    lines = texts.select(F.explode(F.split("text", "\n")).alias("line"))
    values, rest = [], F.col("line")
    for i, p in enumerate(PATTERNS):
        got = F.filter(F.regexp_extract_all("line", F.lit(p), F.lit(0)), lambda m, i=i: _valid(F.lit(i), m))
        values.append(F.when(_gate(i, F.col("line")), F.transform(got, lambda m, i=i: entity(F.lit(i), m))).otherwise(F.array().cast("array<string>")))
        rest = F.regexp_replace(rest, p, " ")
    some = _gate(0, F.col("line")) | _gate(1, F.col("line")) | _gate(2, F.col("line")) | _gate(3, F.col("line"))
    held = lines.where(some).distinct().select(rest.alias("rest"), F.explode(F.array_distinct(F.concat(*values))).alias("entity"))
    held = materialize(held, "entity-lines")
    n_entity = held.groupBy("entity").agg(F.count("*").alias("n_entity")).where(F.col("n_entity") >= min_support)
    # Counted before the join, so that an entity on very many lines is no single task.
    pairs = held.select("entity", F.explode(_terms(F.col("rest"), min_length)).alias("term")).groupBy("entity", "term")
    pairs = pairs.agg(F.count("*").alias("n_both")).where(F.col("n_both") >= min_support).join(n_entity, "entity")
    # Distinct lines are dealt out once; of their terms only counts are.  The empty term counts the lines.
    terms = F.array_append(_terms(F.col("line"), min_length), F.lit(""))
    n_term = lines.distinct().select(F.explode(terms).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    n_term = materialize(n_term, "term-lines")
    n = n_term.where("term = ''").agg(F.max("n_term").alias("n")).first()["n"] or 1
    both, e, t = F.col("n_both"), F.col("n_entity"), F.col("n_term")
    # Above both counts, so that no logarithm below the line is zero.
    size = F.greatest(F.lit(float(n)), e + 1.0, t + 1.0)
    share = F.log(both * size / (e * t)) / F.log(size / e)
    action = F.when(F.col("share") >= remove, "remove").when(F.col("share") >= generalise, "generalise")
    out = pairs.join(n_term, "term").select("entity", "term", share.alias("share"))
    return out.withColumn("action", action).where("action is not null")


#: Words on each side of an entity that are its window, and characters they are looked for in.
WINDOW, REACH = 20, 400


def disclosing_near(texts: DataFrame, base: DataFrame, remove: float, generalise: float, min_length: int) -> DataFrame:
    """``(entity, term, share, action)`` from the words around the base spans of all documents.

    A window counts once however often it is repeated, and so does a document's text.
    """
    places = base.groupBy("key").agg(F.collect_set(F.struct("start", "end", entity(F.col("kind"), F.col("m")).alias("entity"))).alias("places"))
    places = small_side(materialize(places, "places"), 20_000)

    def cleaned(piece: Column) -> Column:
        for p in PATTERNS:
            piece = F.regexp_replace(piece, p, " ")
        return F.filter(F.split(F.lower(piece), r"\P{L}+"), lambda w: w != "")

    def window(s: Column) -> Column:
        first = F.greatest(s["start"] - REACH, F.lit(0).cast("long"))
        left = cleaned(F.regexp_replace(F.substr("text", (first + 1).cast("int"), (s["start"] - first).cast("int")), F.when(first > 0, r"^\S*+").otherwise("^$"), ""))
        right = F.substr("text", (s["end"] + 1).cast("int"), F.lit(REACH))
        right = cleaned(F.regexp_replace(right, F.when(F.char_length(right) == REACH, r"(?<!\S)\S*+$").otherwise("^$"), ""))
        left = F.when(F.size(left) > WINDOW, F.slice(left, -WINDOW, WINDOW)).otherwise(left)
        return F.concat(left, F.slice(right, 1, WINDOW))

    around = texts.join(places, "key").select(F.xxhash64("text").alias("doc"), F.explode("places").alias("s"), "text")
    around = around.select("doc", F.col("s.entity").alias("entity"), window(F.col("s")).alias("near"))
    around = around.groupBy("entity", "near").agg(F.min("doc").alias("doc"))
    held = around.select("entity", "doc", F.explode(F.filter(F.array_distinct("near"), lambda w: F.char_length(w) >= min_length)).alias("term"))
    held = materialize(held.distinct(), "near-terms")
    contexts = held.select("entity", "doc").distinct().groupBy("entity").agg(F.count("*").alias("n_entity")).where("n_entity >= 2")
    pairs = held.groupBy("entity", "term").agg(F.count("*").alias("n_both")).where("n_both >= 2").join(contexts, "entity")
    pairs = materialize(pairs, "near-pairs")
    wanted = small_side(materialize(pairs.select("term").distinct(), "near-wanted"))
    # Texts are counted once: their copies are few and leave before any word is looked at.
    heads = texts.select(F.xxhash64("text").alias("doc")).groupBy("doc").agg(F.count("*").alias("rows"))
    heads = materialize(heads, "heads")
    n = heads.count() or 1
    copied = small_side(materialize(heads.where("rows > 1").select("doc"), "copied"))
    every = texts.select(F.xxhash64("text").alias("doc"), F.explode(_terms(F.col("text"), min_length)).alias("term")).join(wanted, "term", "left_semi")
    once = every.join(copied, "doc", "left_anti").groupBy("term").agg(F.count("*").alias("n"))
    again = every.join(copied, "doc", "left_semi").distinct().groupBy("term").agg(F.count("*").alias("n"))
    n_term = once.unionByName(again).groupBy("term").agg(F.sum("n").alias("n_term"))
    both, e, t = F.col("n_both") - 0.5, F.col("n_entity"), F.greatest("n_term", "n_both")
    size = F.greatest(F.lit(float(n)), e + 1.0, t + 1.0)
    share = F.log(both * size / (e * t)) / F.log(size / e)
    action = F.when(F.col("share") >= remove, "remove").when(F.col("share") >= generalise, "generalise")
    return pairs.join(n_term, "term").select("entity", "term", share.alias("share")).withColumn("action", action).where("action is not null")


def spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_support: int = 3,
    remove: float = 0.95,
    generalise: float = 0.8,
    min_length: int = 4,
) -> DataFrame:
    """``(key, spans)`` of every document with personal data; key is ``row_key`` of id and text.

    ``spans`` holds ``(kind, start, end, action)`` by kind, then start; kind 4 is a disclosing term, with
    the action to take on it.  Terms inside base spans are left to these.
    """
    texts = docs.select(row_key(F.col(id_col), F.col(text_col)).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = materialize(base_spans(texts), "base-spans")
    flagged = disclosing(texts, min_support, remove, generalise, min_length)
    flagged = materialize(flagged.unionByName(disclosing_near(texts, base, remove, generalise, min_length)), "disclosing")
    named = base.select("key", entity(F.col("kind"), F.col("m")).alias("entity")).distinct().join(flagged, "entity")
    named = named.groupBy("key", "term").agg(F.max("action").alias("action"))  # remove over generalise
    named = materialize(named, "document-terms")
    holders = small_side(materialize(named.select("key").distinct(), "holders"))
    places = _positions(texts.join(holders, "key").select("key", F.inline(_matches(F.col("text"), TERM, WORDS))))
    places = places.withColumn("term", F.lower("m")).join(named, ["key", "term"]).select("key", "kind", "start", "end", "action")
    every = base.select("key", "kind", "start", "end", F.lit("remove").alias("action")).unionByName(places)
    every = every.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end", "action"))).alias("spans"))
    own = F.filter("spans", lambda s: s["kind"] < TERM)
    inside = lambda t: F.exists("own", lambda b: (t["start"] < b["end"]) & (t["end"] > b["start"]))
    every = materialize(every.withColumn("own", own), "spans")
    return every.select("key", F.filter("spans", lambda s: (s["kind"] < TERM) | ~inside(s)).alias("spans"))


def _joined(spans: Column) -> Column:
    name = F.array(*map(F.lit, NAMES))
    one = lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)``, one row per input row.

    Null and empty texts hold nothing.  Repeated rows get equal results.  An empty table gives no
    rows; further columns are ignored.  Spans of different kinds may overlap, as each kind is found by
    itself.
    """
    found = materialize(spans(docs, id_col, text_col, **options), "found")
    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(F.col(id_col), F.col(text_col)).alias("key")).join(found, "key", "left")
    rows = rows.withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<kind:int,start:long,end:long,action:string>>")))
    base = F.filter("spans", lambda s: s["kind"] < TERM)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return rows.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans")
    )


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with base spans and removed terms replaced by ``[KIND]``, and generalised terms by ``[WORD]``.

    Overlapping spans are covered to their furthest end.  Rows, columns and other texts stay as they are.
    """
    found = spans(docs, id_col, text_col, **options)
    flat = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["action"].alias("action"))))
    found = materialize(found.where(F.size("spans") > 0).select(F.col("key").alias("__key"), flat.alias("__flat")), "flat")
    # Furthest end so far, one value per span.
    ends = F.transform("__flat", lambda s: s["end"])
    last = lambda a: F.coalesce(F.get(a, F.size(a) - 1), F.lit(0).cast("long"))
    until = F.aggregate(ends, F.array().cast("array<long>"), lambda a, e: F.concat(a, F.array(F.greatest(e, last(a)))))
    found = small_side(materialize(found.select("__key", "__flat", until.alias("__until")), "until"), 20_000)
    kind = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    label = lambda s: F.when(s["kind"] < TERM, F.get(kind, s["kind"])).when(s["action"] == "generalise", F.lit("[WORD]")).otherwise(F.lit("[TERM]"))
    before = lambda i: F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get("__until", i - 1))
    part = lambda s, i: F.substr("__text", (before(i) + 1).cast("int"), (s["start"] - before(i)).cast("int"))
    piece = lambda s, i: F.when(s["start"] >= before(i), F.concat(part(s, i), label(s))).otherwise(F.lit(""))
    rest = F.substr("__text", (last(F.col("__until")) + 1).cast("int"), F.char_length("__text"))
    rows = docs.withColumn("__key", row_key(F.col(id_col), F.col(text_col))).withColumn("__text", F.col(text_col))
    rows = rows.join(found, "__key", "left")
    clean = F.when(F.col("__flat").isNull(), F.col("__text")).otherwise(F.concat(F.array_join(F.transform("__flat", piece), ""), rest))
    return rows.select(*[clean.alias(c) if c == text_col else F.col(c) for c in docs.columns])
