"""Licence scan (DataFrame functions only).

Lines of documents are compared with licence statements by the cosine of sparse TF-IDF vectors.
Whole documents and blocks of joined lines (paragraphs and the leading comment) are compared with licence
texts, file headers and statements as well.  Document frequencies are counted for the templates' words and
for all words of what may match.  A document that is a licence
text, consists mainly of a statement, or holds one and is named like a licence file, is its folder's licence
file, and documents without a licence of their own inherit from the nearest ancestor folder that has
one, found by joining on path prefixes.
"""

from __future__ import annotations

import re
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, row_key, small_side
from .license_texts import HEADERS, TEXTS

# Licence statements as projects write them, by SPDX id.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("Proprietary", "Copyright. All rights reserved."),
    ("Proprietary", "All rights reserved."),
)
#: Words too common to make a line a candidate.
PLAIN = frozenset("the a an of and or to any is in this with that by under it be are you as for may not at 2 3 4 0 1 file work use free met without".split())


def _split(text: str) -> list[str]:
    return [w for w in re.split("[^a-z0-9]+", text.lower()) if w]


VOCABULARY = sorted({w for _, t in TEMPLATES for w in _split(t)})
ANCHORS = [w for w in VOCABULARY if w not in PLAIN]


#: A word in one of so many documents weighs as much as one in no document of a large corpus.
ABSENT = 1000
#: Names of licence files, whatever follows a dot, dash or underscore.
FILE_NAME = r"(?i)^(?:(?:un)?licen[cs]es?|copying)(?:[._-][^/]*)?$"
#: Lines at the start of a text that are comments or empty.
COMMENT = r"^(?:[ \t]*+(?:#|//|/\*|\*|--|;|%|<!--|\r?\n)[^\n]*+\n?+)++"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), "[^a-z0-9]+"), "")


def _candidates(lines: DataFrame, idf: dict[str, float], rare: float, threshold: float) -> DataFrame:
    """``(key, at, n, norm, terms)`` of the lines that can reach ``threshold``, without a shuffle.

    A template is a unit vector over the vocabulary, so a line's cosine is at most the norm of its
    vocabulary part divided by its whole norm.  Lines below that bound are out; ``terms`` holds the
    others' ``(word, x)`` inside the vocabulary.
    """
    known = F.create_map(*[F.lit(x) for w in VOCABULARY for x in (w, idf[w])])
    # A value bound to a lambda's variable is computed once, however often the body names it.
    bound = lambda value, body: F.get(F.transform(F.array(value), body), 0)
    square = lambda terms: F.aggregate(terms, F.lit(0.0), lambda a, t: a + t["x"] * t["x"])

    def terms(inside: Column) -> Column:
        count = lambda w: F.size(F.filter(inside, lambda x: x == w))
        return F.transform(F.array_distinct(inside), lambda w: F.struct(w.alias("word"), (count(w) * F.try_element_at(known, w)).alias("x")))

    def squares(outside: Column) -> Column:
        """Sum of squared counts of words: the k-th of a run of equal words adds 2k - 1."""
        start = F.struct(F.lit("").alias("word"), F.lit(0).cast("long").alias("run"), F.lit(0).cast("long").alias("sum"))
        run = lambda a, w: F.when(a["word"] == w, a["run"] + 1).otherwise(F.lit(1).cast("long"))
        step = lambda a, w: F.struct(w.alias("word"), run(a, w).alias("run"), (a["sum"] + 2 * run(a, w) - 1).alias("sum"))
        return F.aggregate(F.array_sort(outside), start, step, lambda a: a["sum"])

    def vector(w: Column) -> Column:
        own = bound(F.filter(w, lambda x: x.isin(VOCABULARY)), terms)
        others = squares(F.filter(w, lambda x: ~x.isin(VOCABULARY))) * F.lit(rare * rare)
        parts = F.struct(F.size(w).alias("n"), own.alias("terms"), others.alias("others"))
        return bound(parts, lambda p: F.struct(p["n"].alias("n"), F.sqrt(square(p["terms"]) + p["others"]).alias("norm"), p["terms"].alias("terms")))

    able = lambda v: F.sqrt(square(v["terms"])) >= (threshold - 1e-6) * v["norm"]
    some = lines.where(F.arrays_overlap("w", F.array(*map(F.lit, ANCHORS))))
    return some.select("key", "at", "w", F.inline(F.filter(F.transform(F.array("w"), vector), able)))


def _frequencies(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(word, n)``: rows that hold each of the ``wanted`` words, which come as one column of distinct ones."""
    held = rows.select(F.explode(F.array_distinct(words(F.col("text")))).alias("word"))
    return held.join(wanted, "word", "left_semi").groupBy("word").agg(F.count("*").alias("n"))


def _block_templates(counts: dict[str, int], total: int) -> list[tuple[int, str, bool, bool, int, str, float]]:
    """``(template, license, text, joined, size, word, weight)`` of what blocks are compared with."""
    bags = [(name, True, False, bag) for name, bag in TEXTS] + [(name, False, True, bag) for name, bag in HEADERS]
    bags += [(name, False, True, {w: _split(t).count(w) for w in _split(t)}) for name, t in TEMPLATES]
    out = []
    for i, (name, text, joined, bag) in enumerate(bags):
        x = {w: n * _idf(total, counts.get(w, 0)) for w, n in sorted(bag.items())}
        norm = sum(v * v for v in x.values()) ** 0.5
        out += [(i, name, text, joined, sum(bag.values()), w, v / norm) for w, v in x.items()]
    return out


def _heavy(weights: list[tuple], counts: dict[str, int], threshold: float) -> list[str]:
    """Words of which a text holds one at least if its cosine with a template reaches ``threshold``.

    The cosine is at most the norm of the part of the template whose words the text holds, and the
    template's commonest words alone fall short.
    """
    found = set()
    for i in {x[0] for x in weights}:
        light = 0.0
        for *_, w, weight in sorted((x for x in weights if x[0] == i), key=lambda x: (-counts.get(x[-2], 0), x[-1])):
            light += weight * weight
            if light >= threshold * threshold - 1e-6:
                found.add(w)
    return sorted(found)


def _blocks(rows: DataFrame, counts: dict[str, int], total: int, threshold: float, lines: DataFrame | None = None) -> DataFrame:
    """``(key, license, similarity, n, text)`` of whole documents, joined lines and given ``lines`` that match.

    Licence texts are compared with every block; file headers and statements with blocks of several lines,
    as single lines are compared by themselves; of such a block ``n`` is at most the length of the statement.
    ``text`` tells a match with a licence text.
    """
    spark = rows.sparkSession
    weights = _block_templates(counts, total)
    template = F.broadcast(spark.createDataFrame(weights, "template int, license string, text boolean, joined boolean, size int, word string, weight double"))
    some = rows.where(F.arrays_overlap(words(F.col("text")), F.array(*map(F.lit, _heavy(weights, counts, threshold)))))
    comment = F.regexp_extract("text", COMMENT, 0)
    paragraphs = F.filter(F.split("text", r"\n[ \t\r]*+\n"), lambda p: F.contains(p, F.lit("\n")))
    parts = F.array_distinct(F.concat(F.array(F.col("text"), comment), paragraphs))
    blocks = some.select("key", F.posexplode(parts).alias("at", "block")).withColumn("w", words(F.col("block")))
    several = F.contains(F.rtrim("block"), F.lit("\n"))
    blocks = blocks.select("key", (-1 - F.col("at")).alias("at"), F.size("w").alias("n"), several.alias("several"), F.lit(False).alias("line"), "w")
    if lines is not None:
        blocks = blocks.unionByName(lines.select("key", "at", "n", F.lit(True).alias("several"), F.lit(True).alias("line"), "w"))
    # A block can only match a template whose words it holds for threshold² of the squared weight; repeated rows add up.
    cover = blocks.select("key", "at", "several", F.explode(F.array_distinct("w")).alias("word")).join(template, "word")
    cover = cover.where(F.col("several") | ~F.col("joined")).groupBy("key", "at", "template").agg(F.sum(F.col("weight") * F.col("weight")).alias("part"))
    able = materialize(cover.where(F.col("part") >= threshold * threshold - 1e-6).select("key", "at").distinct(), "able")
    # Repeated rows multiply all counts of a block, which leaves its cosine.
    tf = blocks.join(small_side(able), ["key", "at"]).select("key", "at", "n", "several", "line", F.explode("w").alias("word"))
    tf = materialize(tf.groupBy("key", "at", "n", "several", "line", "word").agg(F.count("*").alias("c")), "block-words")
    known = spark.createDataFrame([(w, float(_idf(total, counts.get(w, 0)))) for w in BLOCK_WORDS], "word string, idf double")
    # No word weighs less than 1: blocks that fail with the others at 1 fail anyway, and their words need no count.
    least = tf.join(F.broadcast(known), "word", "left").withColumn("x", F.col("c") * F.coalesce("idf", F.lit(1.0)))
    norm = least.groupBy("key", "at").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    dots = least.join(template, "word").groupBy("key", "at", "template").agg(F.sum(F.col("x") * F.col("weight")).alias("dot"))
    near = dots.join(norm, ["key", "at"]).where(F.col("dot") >= (threshold - 1e-6) * F.col("norm")).select("key", "at").distinct()
    tf = materialize(tf.join(small_side(materialize(near, "near")), ["key", "at"]), "near-words")
    outside = small_side(materialize(tf.select("word").distinct().join(F.broadcast(known), "word", "left_anti"), "outside"))
    others = _frequencies(rows, outside).select("word", (F.log((1.0 + total) / (1 + F.col("n"))) + 1).alias("idf"))
    idf = small_side(materialize(known.unionByName(others), "idf"))
    x = tf.join(idf, "word").select("key", "at", "n", "several", "line", "word", (F.col("c") * F.col("idf")).alias("x"))
    norm = x.groupBy("key", "at").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    dots = x.join(template, "word").where(F.col("several") | ~F.col("joined")).withColumn("n", F.when(F.col("joined") & ~F.col("line"), F.least("n", "size")).otherwise(F.col("n")))
    dots = dots.groupBy("key", "at", "n", "license", "template", "text").agg(F.sum(F.col("x") * F.col("weight")).alias("dot"))
    like = dots.join(norm, ["key", "at"]).withColumn("similarity", F.round(F.col("dot") / F.col("norm"), 6))
    return like.where(F.col("similarity") >= threshold).select("key", "license", "similarity", "n", "text")


BLOCK_WORDS = sorted({*VOCABULARY, *(w for _, bag in TEXTS + HEADERS for w in bag)})


def scan(files: DataFrame, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text", threshold: float = 0.7, file_share: float = 0.5, count_outside: bool = False) -> DataFrame:
    """``(doc_id, path, license, similarity, origin, source_path)``, one row per input row.

    ``origin`` is ``own``, ``inherited`` or null without a licence.  Of several statements the most
    similar counts, ties go to the smaller licence name; a document that is a licence text as a whole has that
    licence.  Of several licence files in one folder the most similar counts, then the smallest path.  Null and
    empty texts hold no statement; a null path has no folder and inherits nothing.  ``count_outside`` gives
    the words of lines outside the statements their document frequencies too; without it they count as
    absent.  Repeated rows get equal results, an empty table gives no rows, further columns are ignored.
    """
    spark = files.sparkSession
    rows = files.select(
        row_key(F.col(id_col), F.concat_ws("\0", path_col, text_col)).alias("key"),
        F.col(id_col).alias("doc_id"),
        F.col(path_col).alias("path"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    lines = rows.select("key", F.posexplode(F.split("text", "\n")).alias("at", "line")).withColumn("w", words(F.col("line")))
    fixed = F.broadcast(spark.createDataFrame([(w,) for w in BLOCK_WORDS], "word string"))
    counts = {r["word"]: r["n"] for r in _frequencies(rows, fixed).collect()}  # one row per fixed word at most
    total = rows.count()
    idf = {w: float(_idf(total, counts.get(w, 0))) for w in VOCABULARY}
    if count_outside:
        # No word weighs less than 1, so that no line is lost by counting the others as 1 at first.
        like = _blocks(rows, counts, total, threshold, materialize(_candidates(lines, idf, 1.0, threshold).select("key", "at", "n", "w"), "lines"))
    else:
        weights = []
        for i, (name, text) in enumerate(TEMPLATES):
            tf = {w: _split(text).count(w) for w in _split(text)}
            norm = sum((n * idf[w]) ** 2 for w, n in tf.items()) ** 0.5
            weights += [(i, name, w, n * idf[w] / norm) for w, n in sorted(tf.items())]
        template = F.broadcast(spark.createDataFrame(weights, "template int, license string, word string, weight double"))
        near = _candidates(lines, idf, _idf(total, 0), threshold).distinct()
        near = near.select("key", "at", "n", "norm", F.inline("terms"))
        dots = near.join(template, "word").groupBy("key", "at", "n", "norm", "template", "license").agg(F.sum(F.col("x") * F.col("weight")).alias("dot"))
        like = dots.withColumn("similarity", F.round(F.col("dot") / F.col("norm"), 6)).where(F.col("similarity") >= threshold)
        like = like.select("key", "license", "similarity", "n", F.lit(False).alias("text")).unionByName(_blocks(rows, counts, total, threshold))
    like = materialize(like, "like")

    folder = F.regexp_replace("path", "/?[^/]*$", "")
    placed = rows.select("key", "doc_id", "path", folder.alias("folder"), F.size(words(F.col("text"))).alias("n_words"))
    placed = materialize(placed, "placed")
    # What a document holds counts for its folder if it fills the document or the document is named so.
    whole = F.col("n") >= file_share * F.col("n_words")
    named = F.coalesce(F.regexp_extract("path", "[^/]*$", 0).rlike(FILE_NAME), F.lit(False))
    rank = F.struct(~(whole & F.col("text")), (-F.col("similarity")).alias("s"), "license")
    sized = placed.select("key", "path", "n_words").join(small_side(like), "key")
    best = sized.groupBy("key").agg(F.min(rank).alias("b"), F.min(F.when(whole | named, rank)).alias("f"))
    best = materialize(best, "own")
    placed = placed.join(small_side(best), "key", "left")
    placed = placed.select("key", "doc_id", "path", "folder", "f", F.col("b.license").alias("license"), (-F.col("b.s")).alias("similarity"))
    is_file = F.col("f").isNotNull() & F.col("path").isNotNull()
    files_of = placed.where(is_file).select("folder", "path", F.col("f.license").alias("license"), (-F.col("f.s")).alias("similarity"))
    licence_files = files_of.groupBy("folder").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "path", "license")).alias("f"))
    licence_files = licence_files.select(F.col("folder").alias("ancestor"), F.col("f.path").alias("source_path"), F.col("f.license").alias("from_license"), (-F.col("f.s")).alias("from_similarity"))
    # Every folder is joined with its own prefixes; the deepest one with a licence file is the nearest.
    steps = F.split("folder", "/")
    prefixes = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda i: F.array_join(F.slice(steps, 1, i), "/"))
    folders = placed.where("folder is not null").select("folder").distinct().select("folder", F.explode(F.array_distinct(prefixes)).alias("ancestor"))
    nearest = folders.join(licence_files, "ancestor").groupBy("folder")
    nearest = nearest.agg(F.max(F.struct(F.length("ancestor").alias("depth"), "source_path", "from_license", "from_similarity")).alias("f"))
    # One row per folder; a folder may hold very many documents.
    nearest = small_side(materialize(nearest.select("folder", "f.*"), "nearest"))
    out = placed.join(nearest, "folder", "left")
    own = F.col("license").isNotNull()
    return out.select(
        "doc_id",
        "path",
        F.coalesce("license", "from_license").alias("license"),
        F.coalesce("similarity", "from_similarity").alias("similarity"),
        F.when(own, "own").when(F.col("from_license").isNotNull(), "inherited").alias("origin"),
        F.when(own, F.col("path")).otherwise(F.col("source_path")).alias("source_path"),
    )


def _idf(total: int, n: int) -> float:
    """Words absent from the corpus weigh at most what a word in one of ``ABSENT`` documents does, however large it is."""
    return log((1 + total) / (1 + n) if n else min(1 + total, ABSENT)) + 1
