"""License scan: an exact set-similarity join of text blocks with license
templates, in DataFrame functions only.

Blocks are overlapping windows of a text's words: templates of up to 16
distinct words meet blocks of 32 words, longer ones blocks of 256 words, each
with half a block of overlap.  A block matches a template when it holds at
least ``THRESHOLD`` of the template's distinct words.  Words are ranked by the
number of documents that hold them, rarest first, counted over all documents.
By the pigeonhole principle a match shares a word of the template's prefix
(its |T| - need + 1 rarest words) and of the block's prefix; the join is on
those, with a length filter (the block has ``need`` template words at least)
and a positional filter (the words left in both suffice).  Survivors are
verified by the size of the intersection.  No block is skipped.

Null texts count as empty; repeated rows and doc_ids each keep a row of their
own; other columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domus.llm.common import id_and_text, materialise, table

THRESHOLD = 0.8
SHORT = 16
WINDOWS = {"short": 32, "long": 256}

# fixed values: the base phrases and labels
PHRASES = [(("mit", "license"), "mit"), (("apache", "license"), "apache"), (("general", "public", "license"), "gpl")]

# fixed values: wording of license notices
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "Released under the MIT License"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
               "with the License. You may obtain a copy of the License at"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation, either version 3 of the License, or any later version"),
    ("gpl", "licensed under the GNU General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("reserved", "All rights reserved"),
]

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def template_words(text: str) -> list:
    return sorted(set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())))


def with_words(docs: DataFrame) -> DataFrame:
    """(row, doc_id, pieces, skip, n_words): the split text; ``skip`` is 1 where it starts with a separator."""
    base = id_and_text(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id",
                                    F.split(F.lower(F.coalesce(F.col("text"), F.lit(""))), SEPARATORS, -1).alias("pieces"))
    skip = (F.get("pieces", F.lit(0)) == "").cast("int")
    tail = ((F.size("pieces") > 1) & (F.element_at("pieces", -1) == "")).cast("int")
    return base.withColumn("skip", skip).withColumn("n_words", (F.size("pieces") - F.col("skip") - tail).cast("long"))


def word_ranks(docs: DataFrame, vocabulary: list) -> dict:
    """Rank of each template word: fewest documents first, ties by the word.
    One row per template word reaches the driver."""
    own = F.array_intersect(F.split(F.lower("text"), SEPARATORS, -1), F.lit(vocabulary))
    rows = id_and_text(docs).select(F.explode(own).alias("word")).groupBy("word").count().collect()
    count = {r["word"]: r["count"] for r in rows}
    return {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (count.get(w, 0), w)))}


def _blocks(size: int, vocabulary):
    """Per document: for every window its distinct template words, as sorted ranks."""
    step = size // 2
    last = F.greatest(F.lit(0), F.ceil((F.size("pieces") - F.lit(size)) / F.lit(step))).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda b: F.array_sort(F.transform(
        F.array_intersect(F.slice("pieces", b * step + 1, F.lit(size)), F.map_keys(vocabulary)), lambda w: F.element_at(vocabulary, w))))


def base_places():
    """Starts (in words) of every base phrase's places, with its label."""
    def at(i, words):
        hit = F.lit(True)
        for k, w in enumerate(words):
            hit = hit & F.coalesce(F.get("pieces", i + (k - len(words) + 1)) == w, F.lit(False))
        return hit

    def place(w, i):
        out = F.lit(None).cast("struct<start:bigint,label:string>")
        for words, label in PHRASES:
            out = F.when((w == words[-1]) & at(i, words),
                         F.struct((i - len(words) + 1 - F.col("skip")).cast("long").alias("start"), F.lit(label).alias("label"))).otherwise(out)
        return out

    ends = sorted({words[-1] for words, _ in PHRASES})
    some = F.arrays_overlap("pieces", F.lit(ends))
    return F.when(some, F.filter(F.transform("pieces", place), lambda x: x.isNotNull())).otherwise(
        F.array().cast("array<struct<start:bigint,label:string>>"))


def scan_licenses(docs: DataFrame, templates=None, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, n_words, places (array of start, label), labels
    (array, base and template ones), matches (array of template, block,
    containment) and score (the best containment, else 0)."""
    spark = docs.sparkSession
    made = [(i, label, template_words(text)) for i, (label, text) in enumerate(templates or TEMPLATES)]
    ranks = word_ranks(docs, sorted({w for _, _, ws in made for w in ws}))
    index, firsts = [], set()
    for i, label, words in made:
        order = sorted(ranks[w] for w in words)
        need = max(1, math.ceil(threshold * len(order) - 1e-9))
        for p in range(len(order) - need + 1):
            index.append((order[p], i, label, "short" if len(order) <= SHORT else "long", p, len(order), need, order))
            firsts.add(order[p])
    prefix_words = [w for w, r in ranks.items() if r in firsts]
    vocabulary = F.create_map(*[x for w, r in ranks.items() for x in (F.lit(w), F.lit(r))])
    rows = with_words(docs).withColumn("places", base_places())
    some = F.arrays_overlap("pieces", F.lit(prefix_words))
    none = F.array().cast("array<array<int>>")
    rows = rows.select("row", "doc_id", "n_words", "places",
                       *[F.when(some, _blocks(size, vocabulary)).otherwise(none).alias(f"b_{kind}") for kind, size in WINDOWS.items()])
    rows = materialise(rows, "license-blocks")
    # the index has one row per template prefix word: its size is the templates'
    schema = "rank int, template int, label string, kind string, i int, size int, need int, words array<int>"
    templates_index = F.broadcast(spark.createDataFrame(index, schema))
    blocks = None
    for kind in WINDOWS:
        one = rows.select("row", F.lit(kind).alias("kind"), F.posexplode(f"b_{kind}").alias("block", "ranks"))
        blocks = one if blocks is None else blocks.unionByName(one)
    blocks = blocks.filter(F.size("ranks") > 0)
    found = blocks.select("row", "kind", "block", "ranks", F.posexplode("ranks").alias("j", "rank")).join(templates_index, ["rank", "kind"])
    n = F.size("ranks")
    found = found.filter((n >= F.col("need")) & (F.col("j") < n - F.col("need") + 1)
                         & (F.least(F.col("size") - F.col("i"), n - F.col("j")) >= F.col("need")))
    shared = F.size(F.array_intersect("ranks", "words"))
    hits = found.withColumn("shared", shared).filter(F.col("shared") >= F.col("need"))
    per_row = hits.groupBy("row").agg(
        F.array_sort(F.collect_set("label")).alias("own"), F.max(F.col("shared") / F.col("size")).alias("best"),
        F.array_sort(F.collect_set(F.struct("template", "block", (F.col("shared") / F.col("size")).alias("containment")))).alias("matches"))
    empty = F.array().cast("array<string>")
    base = F.array_sort(F.array_distinct(F.col("places")["label"]))
    out = rows.select("row", "doc_id", "n_words", "places").join(per_row, "row", "left")
    return out.select("doc_id", "n_words", "places", base.alias("base_labels"),
                      F.array_sort(F.array_union(base, F.coalesce("own", empty))).alias("labels"),
                      F.coalesce("matches", F.array().cast("array<struct<template:int,block:int,containment:double>>")).alias("matches"),
                      F.coalesce("best", F.lit(0.0)).alias("score"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = scan_licenses(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
                      F.array_min(F.col("places")["start"]).alias("first_word"), F.array_max(F.col("places")["start"]).alias("last_word"),
                      F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")
