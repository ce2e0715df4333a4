"""License scan: an exact set-similarity join of text blocks with license templates.

A block is a window of 2 * ``STEP`` words at every multiple of ``STEP``, so that any ``STEP`` + 1
consecutive words lie whole in one block. A block matches a template if it contains at least
ceil(threshold * size) of the template's distinct words. The join is exact:

* frequency order: template words are ordered by the number of documents that have them, counted
  over the whole corpus, rarest first;
* prefix filter: a block with enough of the ``n`` words of a template has one of its first
  n - need + 1 words in this order; only those words are indexed and joined;
* length filter: a block needs that many distinct template words at all;
* positional filter: at their first common word, the words that follow in both bound the overlap;
* surviving pairs are verified by intersecting the sets. Base phrases (threshold 1) are then
  looked up word by word in the block.

The index holds a few words per template, which is the bound of its broadcast; the word counts
that the driver gets are one number per template word. Everything is built-in functions.

Defined cases: null text is the empty text and has no words; rows that are alike in doc_id and text
are one document for the scan and all come back; doc_id may be null; ties in word counts go by the
word; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, WORD, read, text_key, words


class Template(NamedTuple):
    label: str
    text: str
    threshold: float = 0.8


# Phrases that count place by place.
BASE = [
    Template("mit", "under the mit license", 1.0),
    Template("apache-2", "apache license version 2", 1.0),
    Template("cc-by-nc", "cc by nc", 1.0),
]
# Opening words of well-known license notices.
NOTICES = [
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    Template("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("gpl", "licensed under the gnu general public license", 0.85),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    Template("lgpl", "licensed under the gnu lesser general public license", 0.95),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
    Template("cc0", "dedicated this work to the public domain by waiving all rights under copyright law"),
    Template("cc-by-sa", "licensed under a creative commons attribution sharealike license", 0.9),
    Template("cc-by-nc", "licensed under a creative commons attribution noncommercial license", 0.9),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license", 0.95),
]
TEMPLATES = BASE + NOTICES
STEP = 64


def _need(t: Template) -> int:
    return math.ceil(round(t.threshold * len(set(t.text.split())), 9))


def _array(values) -> F.Column:
    return F.array(*(F.lit(v) for v in values))


def template_order(docs: DataFrame, templates: list[Template]) -> dict[str, int]:
    """Rank of every template word by the number of documents with it, rarest first."""
    vocabulary = sorted({w for t in templates for w in t.text.split()})
    seen = docs.select(F.explode(F.array_intersect(words(F.col("text")), _array(vocabulary))).alias("word"))
    counts = {r.word: r["count"] for r in seen.groupBy("word").count().collect()}
    return {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}


def matches(docs: DataFrame, templates: list[Template] = TEMPLATES) -> DataFrame:
    """(doc_id, key, block, template, containment) of every block that meets a template."""
    rank = template_order(docs, templates)
    index = []
    for number, t in enumerate(templates):
        ordered = sorted({rank[w] for w in t.text.split()})
        prefix = ordered[:len(ordered) - _need(t) + 1]
        index += [(r, number, place, len(ordered), _need(t)) for place, r in enumerate(prefix)]
    index = docs.sparkSession.createDataFrame(index, "rank int, template int, place int, size int, need int")
    by_rank = sorted(rank, key=rank.get)
    indexed = _array(sorted({by_rank[r[0]] for r in index.select("rank").distinct().collect()}))
    to_rank = F.create_map(*(F.lit(x) for w, r in rank.items() for x in (w, r)))

    split = docs.select("doc_id", text_key(F.col("text")).alias("key"), words(F.col("text")).alias("words"))
    split = split.filter(F.arrays_overlap("words", indexed))
    starts = F.sequence(F.lit(0), F.size("words") - 1, F.lit(STEP))
    block = split.select("doc_id", "key", F.explode(F.transform(starts, lambda s: F.struct(
        (s / STEP).cast("int").alias("block"), F.slice("words", s + 1, F.lit(2 * STEP)).alias("words")))).alias("b"))
    block = block.select("doc_id", "key", "b.block", "b.words").filter(F.arrays_overlap("words", indexed))
    known = F.array_sort(F.transform(F.array_intersect("words", _array(by_rank)), lambda w: to_rank[w]))
    block = block.withColumn("known", known)
    token = block.select("doc_id", "key", "block", "words", "known", F.posexplode("known").alias("at", "rank"))
    found = token.join(F.broadcast(index), "rank").filter(
        (F.size("known") >= F.col("need"))
        & (1 + F.least(F.size("known") - F.col("at") - 1, F.col("size") - F.col("place") - 1) >= F.col("need")))
    sets = _array([]).cast("array<array<int>>") if not templates else F.array(*(_array(sorted({rank[w] for w in t.text.split()})) for t in templates))
    overlap = F.size(F.array_intersect("known", F.element_at(sets, F.col("template") + 1)))
    found = found.withColumn("overlap", overlap).filter(F.col("overlap") >= F.col("need"))
    return found.select("doc_id", "key", "block", "template", "words", (F.col("overlap") / F.col("size")).alias("containment"))


def _starts(phrase: list[str], last: F.Column) -> F.Column:
    """Word numbers where ``phrase`` stands, up to ``last`` in the block."""
    here = F.filter(F.sequence(F.lit(0), last), lambda p: F.slice("words", p + 1, len(phrase)) == _array(phrase))
    return F.transform(here, lambda p: (p + F.col("block") * STEP).cast("int"))


def places(found: DataFrame, templates: list[Template] = TEMPLATES) -> DataFrame:
    """Adds ``places``: for templates of threshold 1 the word numbers where the phrase begins in the
    block's first half (the next block has the rest). Blocks without such a place go."""
    phrases = {i: t.text.split() for i, t in enumerate(templates) if t.threshold == 1.0}
    at = F.array().cast("array<int>")
    for i, phrase in phrases.items():
        last = F.least(F.size("words") - len(phrase), F.lit(STEP - 1))
        at = F.when(F.col("template") == i, _starts(phrase, F.greatest(last, F.lit(0)))).otherwise(at)
    found = found.withColumn("places", at).drop("words")
    return found.filter((~F.col("template").isin(list(phrases))) | (F.size("places") > 0))


def scan(docs: DataFrame, templates: list[Template] = TEMPLATES) -> DataFrame:
    """A row per row of ``docs``: words, places of base phrases, labels and best containment."""
    label = F.element_at(_array([t.label for t in templates]), F.col("template") + 1)
    exact = F.element_at(_array([t.threshold == 1.0 for t in templates]), F.col("template") + 1)
    found = places(matches(docs, templates), templates)
    found = found.dropDuplicates(["doc_id", "key", "block", "template"])          # rows that are alike
    summed = found.groupBy("doc_id", "key").agg(
        F.sum(F.when(exact, F.size("places")).otherwise(0)).alias("n_base"),
        F.min(F.when(exact, F.array_min("places"))).alias("first_word"),
        F.max(F.when(exact, F.array_max("places"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(exact, label))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(label)), ",").alias("labels"),
        F.max("containment").alias("score"))
    left = docs.select("doc_id", text_key(F.col("text")).alias("key"), F.size(words(F.col("text"))).cast("long").alias("n_words")).alias("d")
    right = summed.alias("s")
    out = left.join(right, F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.key") == F.col("s.key")), "left")
    return out.select(
        "d.doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of every document."""
    return scan(read(spark, sf_dir, "documents"))


def _sql() -> str:
    """The scan by brute force: every block against every template."""
    rows = ",\n        ".join(
        f"({i}, '{t.label}', {str(t.threshold == 1.0).lower()}, [{', '.join(repr(w) for w in t.text.split())}], {_need(t)})"
        for i, t in enumerate(TEMPLATES))
    return f"""
WITH template(id, label, exact, phrase, need) AS (VALUES
        {rows}),
d AS (SELECT row_number() OVER () AS row_id, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
block AS (SELECT row_id, s, w[s + 1:s + {2 * STEP}] AS b FROM (SELECT row_id, w, unnest(range(0, len(w), {STEP})) AS s FROM d)),
hit AS (SELECT row_id, s, b, template.*, len(list_intersect(list_distinct(b), list_distinct(phrase))) AS overlap
        FROM block JOIN template ON len(list_intersect(list_distinct(b), list_distinct(phrase))) >= need),
place AS (SELECT *, CASE WHEN exact THEN list_filter(range(0, {STEP}), lambda p: b[p + 1:p + len(phrase)] = phrase) END AS spots FROM hit),
kept AS (SELECT *, list_transform(spots, lambda p: p + s) AS starts FROM place WHERE NOT exact OR len(spots) > 0),
summed AS (SELECT row_id, sum(CASE WHEN exact THEN len(starts) ELSE 0 END) AS n_base,
        min(CASE WHEN exact THEN list_min(starts) END) AS first_word, max(CASE WHEN exact THEN list_max(starts) END) AS last_word,
        string_agg(DISTINCT CASE WHEN exact THEN label END, ',' ORDER BY CASE WHEN exact THEN label END) AS base_labels,
        string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
        max(overlap / len(list_distinct(phrase))) AS score FROM kept GROUP BY row_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
    CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(CAST(score AS DOUBLE), 0.0) AS score
FROM d LEFT JOIN summed USING (row_id)"""


SQL = _sql()
