"""Licence scans by a positional rare-token index, in DataFrame functions only.

A template is a run of words with a label and one mandatory phrase inside it.
The index holds, for each template, the postings (template, position) of the
rarest words of its mandatory phrase; rarity is the inverse document frequency
over all documents.  For each file the indexed words are looked up, every
(word place - template position) is a possible place of the template, the
second rare word must agree at the same place, and then the mandatory phrase
must stand there whole and the matched words carry ``MIN_SHARE`` of the
template's idf weight.  An accepted place contains its phrase, so it contains
its rare words: the index loses nothing.

The phrases of the contract (``BASE``) are templates that are all phrase.
Everything is an expression on one row, without joins or shuffles, apart from
the document frequencies (one row per template word).

Words: ``[0-9a-z]`` and any non-ASCII character, A-Z lower-cased.  (Spark's
``lower`` makes an ASCII letter of no other character than the Kelvin sign,
which is replaced by another non-ASCII letter first.)

Defined cases: null text is empty (0 words, empty labels, score 0); repeated
rows give repeated result rows; an empty table gives no rows; extra columns
are ignored; equal frequencies go by position in the template; a text's cost
grows with its length, also where a phrase fills it.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import pick, table

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MIN_SHARE = 0.6

# Phrases and labels of the contract.
BASE = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
# Openings of common licence texts and notices, [mandatory phrase] in brackets.
TEMPLATES = [
    ("mit", "[permission is hereby granted free of charge] to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "[licensed under the apache license version 2] 0 the license you may not use this file except in compliance with the license"),
    ("apache-2", "[licensed under the apache license version 2] 0"),
    ("bsd", "[redistribution and use in source and binary forms] with or without modification are permitted provided that the following conditions are met"),
    ("isc", "[permission to use copy modify and or distribute this software] for any purpose with or without fee is hereby granted"),
    ("gpl", "licensed under the [gnu general public license]"),
    ("gpl-2", "[gnu general public license version 2]"),
    ("gpl-3", "[gnu general public license version 3]"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the [gnu general public license]"),
    ("lgpl", "[gnu lesser general public license]"),
    ("agpl", "[gnu affero general public license]"),
    ("mpl-2", "this source code form is subject to the terms of the [mozilla public license v 2 0]"),
    ("cc-by-nc", "licensed under [cc by nc] 4 0"),
    ("cc-by-sa", "licensed under [cc by sa] 4 0"),
    ("unlicense", "[this is free and unencumbered software released into the public domain]"),
    ("all-rights-reserved", "[all rights reserved]"),
]


def parsed() -> list[tuple[str, list[str], list[int], bool]]:
    """(label, words, positions of the mandatory phrase, is a base phrase)."""
    out = [(label, p.split(), list(range(len(p.split()))), True) for label, p in BASE]
    for label, t in TEMPLATES:
        before, rest = t.split("[")
        phrase = rest.split("]")[0].split()
        a = len(before.split())
        out.append((label, t.replace("[", "").replace("]", "").split(), list(range(a, a + len(phrase))), False))
    return out


def words_column(text: Column) -> Column:
    low = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("Å")))
    # splitting between words is five times as fast as extracting them; only the ends can be empty
    return F.array_remove(F.split(low, BETWEEN), "")


def document_frequencies(words: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Documents, and documents with each vocabulary word; ``words`` has the column w."""
    hit = F.array_intersect("w", F.array(*map(F.lit, vocabulary)))
    counted = words.select(F.explode_outer(F.array_union(hit, F.array(F.lit("")))).alias("word")).groupBy("word").count()
    found = {r["word"]: r["count"] for r in counted.collect()}  # one row per vocabulary word
    return found.pop("", 0), found


def license_scan(docs: DataFrame, templates=None) -> DataFrame:
    """One row per document: places of base phrases, labels and score."""
    templates = templates or parsed()
    words = pick(docs, "doc_id", "text").select("doc_id", words_column(F.col("text")).alias("w"))
    vocabulary = sorted({x for _, t, _, _ in templates for x in t})
    n, df = document_frequencies(words, vocabulary)
    idf = {x: math.log((n + 1) / (df.get(x, 0) + 1)) + 1.0 for x in vocabulary}

    # the index: rarest word of each mandatory phrase -> (template, position); the second rarest must agree
    postings: dict[str, list[tuple[int, int]]] = {}
    second = []
    for k, (_, t, must, _) in enumerate(templates):
        rare = sorted(must, key=lambda q: (df.get(t[q], 0), q))
        postings.setdefault(t[rare[0]], []).append((k, rare[0]))
        second.append(rare[1] if len(rare) > 1 else rare[0])
    rare_words = sorted(postings)
    lists = F.array(*[F.array(*[F.struct(F.lit(k).alias("t"), F.lit(q).alias("q")) for k, q in postings[x]]) for x in rare_words])
    rare = F.array(*map(F.lit, rare_words))
    t_words = F.array(*[F.array(*map(F.lit, t)) for _, t, _, _ in templates])
    t_weight = F.array(*[F.array(*[F.lit(idf[x]) for x in t]) for _, t, _, _ in templates])
    t_total = F.array(*[F.lit(sum(idf[x] for x in t)) for _, t, _, _ in templates])
    t_must = F.array(*[F.array(*map(F.lit, m)) for _, _, m, _ in templates])
    t_second = F.array(*map(F.lit, second))
    t_label = F.array(*[F.lit(label) for label, _, _, _ in templates])
    t_base = F.array(*[F.lit(b) for _, _, _, b in templates])

    w = F.col("w")
    holds = lambda c, q: F.get(w, c["o"] + q).eqNullSafe(F.get(F.get(t_words, c["t"]), q))
    places = F.filter(F.transform(w, lambda x, i: F.struct(i.alias("i"), F.array_position(rare, x).cast("int").alias("r"))), lambda s: s["r"] > 0)
    # a template has one posting, so candidates are distinct
    candidates = F.flatten(F.transform(places, lambda s: F.transform(
        F.get(lists, s["r"] - 1), lambda p: F.struct(p["t"].alias("t"), (s["i"] - p["q"]).alias("o")))))
    candidates = F.when(F.arrays_overlap(w, rare), candidates)  # the row by row part only where an indexed word stands
    agreeing = F.filter(candidates, lambda c: holds(c, F.get(t_second, c["t"])))
    whole = F.filter(agreeing, lambda c: F.forall(F.get(t_must, c["t"]), lambda q: holds(c, q)))
    weighed = F.transform(whole, lambda c: F.struct(
        c["t"].alias("t"), c["o"].alias("o"),
        (F.aggregate(F.transform(F.get(t_weight, c["t"]), lambda x, q: F.when(holds(c, q), x).otherwise(F.lit(0.0))),
                     F.lit(0.0), lambda a, x: a + x) / F.get(t_total, c["t"])).alias("share")))

    found = words.select("doc_id", "w", weighed.alias("found")).select(
        "doc_id", F.size("w").cast("long").alias("n_words"),
        F.filter(F.coalesce("found", F.array().cast("array<struct<t:int,o:int,share:double>>")),
                 lambda c: c["share"] >= MIN_SHARE).alias("found"))
    base = F.transform(F.filter("found", lambda c: F.get(t_base, c["t"])), lambda c: c["o"])
    labels = lambda arr: F.array_join(F.array_sort(F.array_distinct(F.transform(arr, lambda c: F.get(t_label, c["t"])))), ",")
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(base).cast("long").alias("first_word"), F.array_max(base).cast("long").alias("last_word"),
        labels(F.filter("found", lambda c: F.get(t_base, c["t"]))).alias("base_labels"), labels(F.col("found")).alias("labels"),
        F.least(F.coalesce(F.array_max(F.transform("found", lambda c: c["share"])), F.lit(0.0)), F.lit(1.0)).alias("score"))


def q_op4(spark, sf_dir):
    return license_scan(table(spark, sf_dir, "documents"))


def _values() -> str:
    rows = []
    for k, (label, t, must, base) in enumerate(parsed()):
        rows += [f"({k}, '{label}', {q}, '{x}', {q in must}, {base}, {len(must)})" for q, x in enumerate(t)]
    return ", ".join(rows)


ORACLE_OP4 = rf"""
WITH t(t, label, q, word, must, base, n_must) AS (VALUES {_values()}),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws FROM documents),
w AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS pos FROM d),
df AS (SELECT word, count(DISTINCT rid) AS df FROM w WHERE word IN (SELECT word FROM t) GROUP BY word),
idf AS (SELECT v.word, ln(((SELECT count(*) FROM d) + 1) / (coalesce(df, 0) + 1)) + 1 AS idf
        FROM (SELECT DISTINCT word FROM t) v LEFT JOIN df ON v.word = df.word),
total AS (SELECT t, sum(idf) AS total FROM t JOIN idf USING (word) GROUP BY t),
hit AS (SELECT rid, t.t, any_value(label) AS label, any_value(base) AS base, pos - q AS o, sum(idf) AS weight,
          count(*) FILTER (must) AS musts, any_value(n_must) AS n_must
        FROM w JOIN t ON w.word = t.word JOIN idf ON idf.word = t.word GROUP BY rid, t.t, pos - q),
ok AS (SELECT rid, label, base, o, weight / total AS share FROM hit JOIN total USING (t)
       WHERE musts = n_must AND weight / total >= {MIN_SHARE}),
per AS (SELECT rid, count(*) FILTER (base) AS n_base, min(o) FILTER (base) AS first_word, max(o) FILTER (base) AS last_word,
          string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
          string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM ok GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  least(CAST(coalesce(score, 0) AS DOUBLE), 1.0::DOUBLE) AS score
FROM d LEFT JOIN per ON d.rid = per.rid
"""
