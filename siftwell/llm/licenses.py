"""License scans: fixed phrases, and an exact set-similarity join of text blocks with templates. DataFrame functions only."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm.common import ascii_lower, stored, table

# Phrases and their labels, and what separates words once A-Z are lower-cased.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Sentences by which licences are recognised, with their labels.
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "Released under the MIT License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
)
#: Share of a template's distinct words that a block must hold, in hundredths.
THRESHOLD = 80


def template_words(text: str) -> list[str]:
    return sorted(set(re.sub(SEPARATORS, " ", text.lower()).split()))


def needed(n: int, threshold: int = THRESHOLD) -> int:
    """The least number of n words that meets the threshold."""
    return -(-n * threshold // 100)


def _spaced(low: Column) -> Column:
    """Words with a space on each side of each, or an empty string: neighbours share no space, so places of a phrase never overlap."""
    words = F.trim(F.regexp_replace(low, SEPARATORS, "  "))
    return F.when(words == "", "").otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


def _words_in(spaced: Column) -> Column:
    return ((F.octet_length(spaced) - F.octet_length(F.replace(spaced, F.lit(" "), F.lit("")))) / 2).cast("long")


def _places(spaced: Column) -> dict[str, tuple[Column, Column, Column]]:
    """Of each phrase, its number of places and the first and last word it begins at (null: none)."""
    out = {}
    for phrase in PHRASES:
        key = " " + phrase.replace(" ", "  ") + " "
        held = spaced.contains(key)
        rest = F.octet_length(F.replace(spaced, F.lit(key), F.lit("")))
        count = F.when(held, ((F.octet_length(spaced) - rest) / len(key)).cast("long")).otherwise(F.lit(0).cast("long"))
        first = F.when(held, _words_in(F.substring(spaced, F.lit(1), F.instr(spaced, key) - 1)))
        before = F.length(spaced) - F.instr(F.reverse(spaced), key[::-1]) + 1 - len(key)
        last = F.when(held, _words_in(F.substring(spaced, F.lit(1), before)))
        out[phrase] = (count, first, last)
    return out


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, threshold: int = THRESHOLD) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row.

    Base labels come from PHRASES, whose words must stand one after the other. The others come from a
    join of text blocks (lines, and paragraphs between blank lines) with the templates: a block matches
    if it holds at least threshold hundredths of a template's distinct words. Words are ordered by the
    number of documents that hold them, rarest first, counted over all documents. A block that matches a
    template of n words misses n - needed of them at most, so it holds one of the template's first
    n - needed + 1 words (prefix); it has as many words as are needed (length); and from their first
    common word on, both must have enough words left (position). What passes is counted exactly.
    Templates are a parameter, and small: only they, their words and counts of these words are broadcast.

    score is 1 with a base place, else the largest share of a template found, else 0. A null or empty
    text has no words. Rows with equal or null ids are scanned like any other; other columns are ignored.
    """
    spark = docs.sparkSession
    sets = [(label, template_words(text)) for label, text in templates]
    sets = [(label, words) for label, words in sets if words]
    vocabulary = sorted({w for _, words in sets for w in words})
    low = ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    spaced = docs.select(F.col(id_col).alias("id"), low.alias("low")).withColumn("spaced", _spaced(F.col("low")))
    listed = F.array(*[F.lit(w) for w in vocabulary]).cast("array<string>")
    held = spaced.select(F.explode(F.array_intersect(F.split("spaced", " +"), listed)).alias("word"))
    count = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}
    order = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (count.get(w, 0), w)))}
    sets = [(label, sorted(words, key=order.__getitem__)) for label, words in sets]
    prefixes = sorted({w for _, words in sets for w in words[: len(words) - needed(len(words), threshold) + 1]})
    first_words = F.array(*[F.lit(w) for w in prefixes]).cast("array<string>")

    places = _places(F.col("spaced"))
    pieces = F.concat(F.split("low", "\n"), F.split("low", r"\n[ \t\r]*\n"))
    words = F.transform(F.array_distinct(pieces), lambda p: F.array_intersect(F.split(_spaced(p), " +"), listed))
    wanted = F.filter(words, lambda b: F.arrays_overlap(b, first_words))
    some = F.arrays_overlap(F.split("spaced", " +"), first_words)
    light = spaced.select(
        "id", F.monotonically_increasing_id().alias("row"), _words_in(F.col("spaced")).alias("n_words"),
        *[c.alias(f"{k} {i}") for i, p in enumerate(places.values()) for k, c in zip(("count", "first", "last"), p, strict=True)],
        F.when(some, wanted).alias("blocks"),
    )
    light = stored(light)

    schema = "template int, label string, size int, need int, words array<string>"
    known = spark.createDataFrame([(i, label, len(w), needed(len(w), threshold), w) for i, (label, w) in enumerate(sets)], schema)
    ranks = spark.createDataFrame(list(order.items()), "word string, rank int")
    prefix = known.select("*", F.posexplode(F.slice("words", F.lit(1), F.col("size") - F.col("need") + 1)).alias("at", "word"))
    block = light.select("row", F.explode("blocks").alias("held")).select("row", F.array_distinct("held").alias("held")).distinct()
    rank_of = F.create_map(*[F.lit(x) for w, i in order.items() for x in (w, i)]) if order else F.create_map().cast("map<string,int>")
    block = block.select("row", F.array_sort(F.transform("held", lambda w: rank_of[w])).alias("ranks"))
    token = block.select("row", "ranks", F.posexplode("ranks").alias("place", "rank"))
    near = token.join(F.broadcast(prefix.join(ranks, "word")), "rank")
    near = near.where(F.size("ranks") >= F.col("need"))
    near = near.where(F.least(F.col("size") - F.col("at"), F.size("ranks") - F.col("place")) >= F.col("need") - F.least("at", "place"))
    sized = F.size(F.array_intersect(F.transform("words", lambda w: rank_of[w]), F.col("ranks")))
    hits = near.withColumn("common", sized).where(F.col("common") >= F.col("need"))
    found = hits.groupBy("row").agg(F.collect_set("label").alias("more"), F.max(F.col("common") / F.col("size")).alias("share"))

    n = range(len(places))
    total = sum((F.col(f"count {i}") for i in n), F.lit(0).cast("long"))
    base = F.filter(F.array(*[F.when(F.col(f"count {i}") > 0, F.lit(label)) for i, label in enumerate(PHRASES.values())]), lambda x: x.isNotNull())
    return light.drop("blocks").join(found, "row", "left").select(
        F.col("id").alias(id_col), "n_words", total.alias("n_base"),
        F.least(*[F.col(f"first {i}") for i in n]).alias("first_word"), F.greatest(*[F.col(f"last {i}") for i in n]).alias("last_word"),
        _joined(base).alias("base_labels"), _joined(F.concat(base, F.coalesce("more", F.array().cast("array<string>")))).alias("labels"),
        F.when(total > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    lists = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    rows = ", ".join(f"('{label}', {lists(template_words(t))}, {needed(len(template_words(t)))})" for label, t in TEMPLATES)
    phrases = ", ".join(f"('{label}', {lists(p.split())})" for p, label in PHRASES.items())
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    return rf"""
WITH t(label, words, need) AS (VALUES {rows}), p(label, words) AS (VALUES {phrases}),
d AS (SELECT doc_id, row_number() OVER () AS r, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
w AS (SELECT doc_id, r, low, regexp_extract_all(low, {word}) AS ws FROM d),
places AS (SELECT r, label, unnest(list_filter(range(len(ws)), lambda i: ws[i + 1] = words[1] AND ws[i + 1 : i + len(words)] = words)) AS pos
  FROM w, p WHERE list_contains(ws, words[1])),
b AS (SELECT r, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list_distinct(list(label)) AS labels FROM places GROUP BY r),
blocks AS (SELECT r, unnest(list_distinct(string_split(low, chr(10)) || regexp_split_to_array(low, '\n[ \t\r]*\n'))) AS block FROM d),
sets AS (SELECT r, list_distinct(regexp_extract_all(block, {word})) AS ws FROM blocks),
hits AS (SELECT r, label, len(list_intersect(ws, words)) AS common, need, len(words) AS size FROM sets, t WHERE len(ws) >= need),
m AS (SELECT r, list_distinct(list(label)) AS labels, max(common / size) AS share FROM hits WHERE common >= need GROUP BY r)
SELECT doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  array_to_string(list_sort(coalesce(b.labels, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(coalesce(b.labels, []) || coalesce(m.labels, []))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM w LEFT JOIN b USING (r) LEFT JOIN m USING (r)
"""


ORACLE = _oracle()
