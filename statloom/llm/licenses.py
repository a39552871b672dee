r"""License scans by diagonal voting, with DataFrame functions only.

Base: places where the words of a few phrases stand consecutively. On top of
that, every word 4-gram hash of every document is joined to the positions of
the same hash in the license templates. A match votes for its offset diagonal
(document position less template position); votes are counted by (document,
template, diagonal), diagonals that lie within ``DRIFT`` of each other are
merged, since a few words put in or left out move a match to a neighbouring
diagonal, and a merged span is verified: enough distinct template positions
must be matched, over a document span not much longer than the template's.

The templates are a fixed list, so the broadcast side of the join has a fixed
size; matches are aggregated before anything is shuffled and texts never are.

Defined results: a null or empty text has no words, no labels and score 0;
rows of equal doc_id and text have equal results. Words are lower-cased as
Unicode letters, which changes no word boundary and none of the phrases.
Score is the best verified coverage of a template, 0 without one. Null doc_ids are
scanned like others; an empty table gives no rows; only doc_id and text are read,
so other columns may have any names; texts of any length are scanned whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GRAM = 4
DRIFT = 3
COVERAGE = 0.6
STRETCH = 1.5

# Phrases with their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Opening or operative sentences of public licenses, and usual notice lines.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("mit", "This project is released under the MIT license"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission"),
]


def words_of(text: Column) -> Column:
    """`[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the lower-cased text."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def _grams(words: Column) -> Column:
    """Hashes of the word GRAM-grams that start at each position."""
    hashes = F.transform(words, lambda w, i: F.xxhash64(w, *(F.get(words, i + k) for k in range(1, GRAM))))
    return F.slice(hashes, F.lit(1), F.greatest(F.size(words) - (GRAM - 1), F.lit(0)))


def template_positions(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """(template, label, n_grams, t_pos, gram) of the fixed list."""
    rows = spark.createDataFrame([(k, label, text) for k, (label, text) in enumerate(templates)], "template int, label string, text string")
    rows = rows.select("template", "label", words_of(F.col("text")).alias("w"))
    return rows.select("template", "label", F.greatest(F.size("w") - (GRAM - 1), F.lit(0)).alias("n_grams"), F.posexplode(_grams(F.col("w"))).alias("t_pos", "gram"))


def spans(spark: SparkSession, docs: DataFrame, templates: list[tuple[str, str]]) -> DataFrame:
    """(doc_id, text_key, template, label, first_word, last_word, coverage): verified template spans."""
    grams = docs.select("doc_id", "text_key", F.posexplode(_grams(F.col("words"))).alias("pos", "gram"))
    votes = grams.join(F.broadcast(template_positions(spark, templates)), "gram")
    key = ["doc_id", "text_key", "template", "label", "n_grams"]
    diagonals = votes.withColumn("diagonal", F.col("pos") - F.col("t_pos")).groupBy(*key, "diagonal").agg(F.collect_set("t_pos").alias("hits"), F.min("pos").alias("a"), F.max("pos").alias("b"))
    along = Window.partitionBy(*key).orderBy("diagonal")
    fresh = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > DRIFT, F.lit(True)).cast("int")
    merged = diagonals.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(along)).groupBy(*key, "run").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hit"), F.min("a").alias("first_word"), (F.max("b") + GRAM - 1).alias("last_word"))
    coverage = F.col("hit") / F.col("n_grams")
    return merged.where((coverage >= COVERAGE) & (F.col("last_word") - F.col("first_word") + 1 <= STRETCH * (F.col("n_grams") + GRAM - 1) + DRIFT)).select("doc_id", "text_key", "template", "label", "first_word", "last_word", coverage.alias("coverage"))


def scan(spark: SparkSession, docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row per document: base places, labels of both kinds, and the best coverage."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"), words_of(F.col("text")).alias("words"))
    found = spans(spark, rows, templates).groupBy("doc_id", "text_key").agg(F.collect_set("label").alias("found"), F.max("coverage").alias("coverage"))

    words = F.col("words")

    def place(w: Column, i: Column) -> Column:
        case = None
        for phrase, label in PHRASES.items():
            *before, last = phrase.split()
            here = w == last
            for back, other in enumerate(reversed(before), 1):
                here = here & F.coalesce(F.get(words, i - back) == other, F.lit(False))
            hit = F.struct((i - len(before)).cast("bigint").alias("at"), F.lit(label).alias("label"))
            case = F.when(here, hit) if case is None else case.when(here, hit)
        return case

    base = rows.select("doc_id", "text_key", F.size(words).cast("bigint").alias("n_words"), F.filter(F.transform(words, place), lambda x: x.isNotNull()).alias("places"))
    d, f = base.alias("d"), found.alias("f")
    joined = d.join(f, F.expr("d.doc_id <=> f.doc_id AND d.text_key = f.text_key"), "left")
    labels = F.array_distinct(F.transform("places", lambda x: x["label"]))
    return joined.select(
        "d.doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"),
        F.array_min(F.transform("places", lambda x: x["at"])).alias("first_word"), F.array_max(F.transform("places", lambda x: x["at"])).alias("last_word"),
        F.array_join(F.array_sort(labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(labels, F.coalesce("found", F.array().cast("array<string>")))), ",").alias("labels"),
        F.coalesce("coverage", F.lit(0.0)).alias("score"),
    )
