"""License scans: fixed phrases, and an exact set-similarity join of text blocks with notices.

A block is a line of a text; a notice matches if at least `threshold` of its different words are in
the block. Words of the notices are ordered by their number in the corpus, rarest first. If a block
holds `need` of a notice's n words, it holds one of the n - need + 1 rarest (prefix filter); it has
`need` different words itself (length filter); and behind the k-th word of a notice only n - k words
can still match (positional filter, on both sides). What is left is compared word by word. The
table of notices is fixed, so all joins are broadcast joins of a known size and blocks stay where
they are. Everything is DataFrame functions.

Defined results: a null or empty text has no words, no labels and score 0. Equal rows get equal
rows; a null `doc_id` is a document like any other. Further columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from temblor.llm.common import alnum_words

THRESHOLD = 0.8
# The base phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Notices as their authors ask to state them, and their labels.
NOTICES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software"),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the "
                 "License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
              "General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("all-rights-reserved", "All rights reserved."),
]


def notice_words(text: str) -> list[str]:
    """The different words of a notice."""
    return sorted(set(re.findall("[0-9a-z]+", text.lower())))


def blocks(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, block, words: the different words of every line that has some."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    cut = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        F.posexplode(lines).alias("block", "line"),
    )
    return cut.select("doc_id", "text_hash", "block", F.array_distinct(alnum_words(F.col("line"))).alias("words"))


def matches(docs: DataFrame, notices=NOTICES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, text_hash, block, label, containment: the blocks that hold enough of a notice."""
    spark = docs.sparkSession
    rows = [(k, label, notice_words(text)) for k, (label, text) in enumerate(notices)]
    known = spark.createDataFrame(sorted({(w,) for _, _, words in rows for w in words}), "word string")
    every = blocks(docs)
    counted = every.select(F.explode("words").alias("word")).join(F.broadcast(known), "word").groupBy("word").count()
    number = {r["word"]: r["count"] for r in counted.collect()}  # a row per word of the notices

    prefixes = []
    for k, label, words in rows:
        ordered = sorted(words, key=lambda w: (number.get(w, 0), w))
        need = max(1, math.ceil(threshold * len(words) - 1e-9))
        prefixes += [(w, k, label, at, need, ordered) for at, w in enumerate(ordered[: len(words) - need + 1])]
    prefix = spark.createDataFrame(prefixes, "word string, notice int, label string, at int, need int, ordered array<string>")
    met = every.select("doc_id", "text_hash", "block", "words", F.explode("words").alias("word"))
    met = met.join(F.broadcast(prefix), "word").where(
        (F.size("words") >= F.col("need"))  # length
        & (F.size("ordered") - F.col("at") >= F.col("need"))  # position
    )
    shared = F.filter("ordered", lambda w: F.array_contains("words", w))
    met = met.withColumn("shared", shared).where(
        (F.size("shared") >= F.col("need")) & (F.get("shared", F.lit(0)) == F.col("word"))  # the first of its prefix words only
    )
    return met.select("doc_id", "text_hash", "block", "label", (F.size("shared") / F.size("ordered")).alias("containment"))


def _places(words: Column, phrase: str) -> Column:
    """Where a phrase stands in an array of words."""
    cut = phrase.split()

    def here(k):
        hit = F.get(words, k) == cut[0]
        for j, w in enumerate(cut[1:], 1):
            hit &= F.get(words, k + j) == w
        return hit

    at = F.filter(F.sequence(F.lit(0), F.size(words) - len(cut)), here)
    possible = (F.size(words) >= len(cut)) & F.array_contains(words, cut[-1])
    return F.when(possible, at).otherwise(F.array().cast("array<int>"))


def scan(docs: DataFrame, notices=NOTICES, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of `docs`: n_words, n_base, first_word, last_word, base_labels, labels, score."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        alnum_words(F.col("text")).alias("words"),
    )
    placed = rows.select(
        "doc_id", "text_hash", F.size("words").cast("long").alias("n_words"),
        F.array(*(_places(F.col("words"), p) for p in PHRASES)).alias("places"),
    )
    own = F.array(*(F.when(F.size(F.get("places", F.lit(k))) > 0, F.lit(v)) for k, v in enumerate(PHRASES.values())))
    found = matches(docs, notices, threshold).groupBy("doc_id", "text_hash").agg(
        F.collect_set("label").alias("more"), F.max("containment").alias("score")
    )
    both = placed.join(
        found, placed["doc_id"].eqNullSafe(found["doc_id"]) & (placed["text_hash"] == found["text_hash"]), "left"
    )
    base = F.sort_array(F.array_distinct(F.array_compact(own)))
    every = F.sort_array(F.array_union(base, F.coalesce("more", F.array().cast("array<string>"))))
    starts = F.flatten("places")
    return both.select(
        placed["doc_id"],
        "n_words",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.size(starts) > 0, F.lit(1.0)).otherwise(F.coalesce("score", F.lit(0.0))).alias("score"),
    )


def op10_licenses(spark, sf_dir: str) -> DataFrame:
    """Licenses named in all documents."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    def cut(text):
        return (
            f"list_filter(string_split_regex(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
            r" 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
        )

    notices = ", ".join(
        f"({k}, '{label}', [{', '.join(repr(w) for w in notice_words(text))}])" for k, (label, text) in enumerate(NOTICES)
    )
    phrases = ", ".join(f"('{v}', {p.split()})" for p, v in PHRASES.items())
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text, {cut('text')} AS words FROM documents),
p(label, phrase) AS (VALUES {phrases}),
n(notice, label, own) AS (VALUES {notices}),
z AS (SELECT r, label, s - 1 AS s FROM (SELECT r, words, label, phrase, unnest(range(1, len(words) - len(phrase) + 2)) AS s
    FROM d, p WHERE list_has_all(words, phrase)) WHERE list_slice(words, s, s + len(phrase) - 1) = phrase),
b AS (SELECT r, count(*) AS n_base, min(s) AS first_word, max(s) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM z GROUP BY r),
l AS (SELECT r, list_distinct({cut('line')}) AS words FROM (SELECT r, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM d)),
m AS (SELECT r, label, len(list_intersect(words, own)) / len(own) AS share FROM l, n
    WHERE len(list_intersect(words, own)) >= ceil({THRESHOLD} * len(own) - 1e-9)),
k AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM (SELECT r, label FROM m UNION SELECT r, label FROM z) GROUP BY r),
s AS (SELECT r, max(share) AS score FROM m GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
    last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
    CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(score, 0)::DOUBLE END AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN k USING (r) LEFT JOIN s USING (r)
"""


OP10_SQL = _sql()
