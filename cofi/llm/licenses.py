"""License scans (operator 10), DataFrame functions only.

Templates are grouped into classes by length; for the class of templates with up to n
shingles of five words, each document is cut into windows of 2n shingles, one every n, so
that a passage of n shingles lies whole in one of them. A window and a template share a
band if the smallest hash of their shingles under that band's hash function is the same
(one row per band). The number of bands follows from the lowest Jaccard similarity a
window with the required containment can have, so that it shares a band with the template
with probability ``1 - MISS`` or more. Windows that share one are verified: the
shingles themselves, as texts, must hold ``CONTAINED`` of the template's.

A window can only share a band if it holds the template's smallest shingle of that band.
So shingles are first looked up among these (a few per template and band), and the
signatures are computed for the windows that hold one; the retrieved pairs are the same.

Defined cases: words are runs of a-z and 0-9 of the lower-cased text; null, empty and
shorter texts have no shingles and no rows; rows that repeat a doc_id and a passage are
reported once; rows without a doc_id are documents of their own, each with its findings; ties between windows go to the earliest; a template with fewer than five
words is refused.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cofi.session import materialize

WORDS = 5            # words of a shingle
CONTAINED = 0.8      # share of a template's shingles a match holds
MISS = 1e-4          # probability that a window that holds a match shares no band with it
WORD = "[a-z0-9]+"

#: Public license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                         "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
                         "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                         "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
                "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                  "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                  "option) any later version.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
           "following conditions are met",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
}


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _starts(w: Column) -> Column:
    """Where the shingles of a list of words start, from 0."""
    return F.when(F.size(w) >= WORDS, F.sequence(F.lit(0), F.size(w) - WORDS)).otherwise(F.array().cast("array<int>"))


def shingles(w: Column) -> Column:
    return F.transform(_starts(w), lambda i: F.array_join(F.slice(w, i + 1, WORDS), " "))


def shingle_hashes(w: Column) -> Column:
    return F.transform(_starts(w), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WORDS)]))


def step_of(n: Column) -> Column:
    """The class of a template of ``n`` shingles: the power of two at or above it."""
    return F.pow(F.lit(2.0), F.ceil(F.log2(n.cast("double")))).cast("int")


def bands(contained: float = CONTAINED, miss: float = MISS) -> int:
    """With one row per band: a template has more than half of its class's n shingles, a window at most 2n,
    so a window that holds ``contained`` of them has a Jaccard similarity over s = c / (4 + 1 - c)."""
    lowest = contained / (5 - contained)
    return math.ceil(math.log(miss) / math.log(1 - lowest))


def band_value(hashes: Column, band: Column) -> Column:
    return F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, band)))


def signature(w: Column, n_bands: int) -> Column:
    """ARRAY<BIGINT> by band of a list of words."""
    h = shingle_hashes(w)
    return F.get(F.transform(F.array(h), lambda x: F.transform(
        F.sequence(F.lit(0), F.lit(n_bands - 1)), lambda b: band_value(x, b))), F.lit(0))


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """(template, words, step): the templates as literals of one row."""
    rows = F.array(*[F.struct(F.lit(k).alias("template"), F.lit(v).alias("text")) for k, v in templates.items()])
    x = spark.range(1).select(F.inline(rows)).select("template", words(F.col("text")).alias("words"))
    x = x.withColumn("shingles", F.array_distinct(shingles(F.col("words"))))
    return x.withColumn("step", F.when(F.size("shingles") > 0, step_of(F.size("shingles"))).otherwise(
        F.raise_error(F.concat(F.lit("template too short: "), F.col("template")))))


def windows(docs: DataFrame, anchors: DataFrame) -> DataFrame:
    """(doc_id, row, step, at, words): windows that hold an anchor, by doc_id and the place of the first
    shingle; ``anchors``: (anchor, step)."""
    x = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), words(F.col("text")).alias("words"),
                    F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).alias("row"))
    x = x.select("doc_id", "row", "words", F.posexplode(shingle_hashes(F.col("words"))).alias("pos", "anchor"))
    x = x.join(anchors, "anchor")  # as large as templates x bands: its measured size decides how
    first = F.floor(F.col("pos") / F.col("step")).cast("int")
    x = x.select("doc_id", "row", "step", "words", F.explode(F.when(first > 0, F.array(first - 1, first)).otherwise(
        F.array(first))).alias("w"))
    at = F.col("w") * F.col("step")
    return x.select("doc_id", "row", "step", at.alias("at"), F.slice("words", at + 1, 2 * F.col("step") + WORDS - 1)
                    .alias("words")).distinct()


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, contained: float = CONTAINED,
         miss: float = MISS) -> DataFrame:
    """(doc_id, template, n_windows, at_word, containment): per document and template found, the windows that
    hold it, the first of the best ones (its first word, from 0) and the share of the template there."""
    n_bands = bands(contained, miss)
    known = materialize(template_table(docs.sparkSession, templates), "license-templates")
    banded = materialize(known.select(
        "template", "step", F.col("words"), F.posexplode(signature(F.col("words"), n_bands)).alias("band", "value")),
        "license-bands")
    holder = F.filter(shingle_hashes(F.col("words")), lambda h: F.xxhash64(h, F.col("band")) == F.col("value"))
    anchors = materialize(banded.select("step", F.explode(holder).alias("anchor")).distinct(), "license-anchors")
    found = materialize(windows(docs, anchors), "license-windows")
    probes = found.select("doc_id", "row", "step", "at", "words", F.posexplode(signature(F.col("words"), n_bands)).alias("band", "value"))
    pairs = probes.join(banded.select("template", "step", "band", "value"), ["step", "band", "value"]).select(
        "doc_id", "row", "template", "at", "words").distinct()
    share = F.size(F.array_intersect(shingles(F.col("words")), F.col("shingles"))) / F.size("shingles")
    hits = pairs.join(known.select("template", "shingles"), "template").withColumn("containment", share).where(
        F.col("containment") >= contained)
    best = F.max(F.struct("containment", (-F.col("at")).alias("back")))
    return hits.groupBy("doc_id", "row", "template").agg(F.count_distinct("at").alias("n_windows"), best.alias("b")).select(
        "doc_id", "template", "n_windows", (-F.col("b.back")).cast("bigint").alias("at_word"),
        F.round("b.containment", 6).alias("containment"))


def oracle_sql(templates: dict[str, str] = TEMPLATES, contained: float = CONTAINED) -> str:
    """DuckDB SQL: every window's share of every template, without bands."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ", ".join(f"({quote(k)}, {quote(v)})" for k, v in templates.items())
    cut = f"list_transform(range(0, len(w) - {WORDS - 1}), lambda i: array_to_string(w[i + 1:i + {WORDS}], ' '))"
    return f"""
WITH templates(template, text) AS (VALUES {rows}),
  tw AS (SELECT template, regexp_extract_all(lower(text), '{WORD}') AS w FROM templates),
  ts AS (SELECT template, unnest(list_distinct({cut})) AS s FROM tw),
  tn AS (SELECT template, count(*) AS n, pow(2, ceil(log2(count(*))))::BIGINT AS step FROM ts GROUP BY template),
  dw AS (SELECT doc_id, CASE WHEN doc_id IS NULL THEN row_number() OVER () END AS rid,
    regexp_extract_all(lower(text), '{WORD}') AS w FROM documents),
  dl AS (SELECT doc_id, rid, {cut} AS l FROM dw WHERE len(w) >= {WORDS}),
  ds AS (SELECT doc_id, rid, unnest(l) AS s, unnest(range(len(l))) AS pos FROM dl),
  h AS (SELECT doc_id, rid, template, s, n, step, pos // step AS w FROM ds JOIN ts USING (s) JOIN tn USING (template)),
  hw AS (SELECT doc_id, rid, template, s, n, step, w FROM h UNION ALL SELECT doc_id, rid, template, s, n, step, w - 1 FROM h WHERE w > 0),
  m AS (SELECT doc_id, rid, template, w * step AS pos, count(DISTINCT s) / n AS containment FROM hw GROUP BY doc_id, rid, template, w, step, n)
SELECT doc_id, template, count(*) AS n_windows, arg_max(pos, (containment, -pos))::BIGINT AS at_word,
  round(max(containment), 6) AS containment FROM m WHERE containment >= {contained} GROUP BY doc_id, rid, template"""
