"""License scans: an exact set-similarity join of text blocks with templates.

A text's words, lower-cased (A-Z), stand in blocks of 32 words that begin every
16 words, so any passage of 17 words lies in one block whole. A template is a
set of words with a threshold; a block meets it if it holds at least that share
of the template's words (containment). Longer templates are cut into pieces of
16 words. All blocks that meet a template are found:

* **order**: the templates' words are ordered by how often the corpus has them,
  the rarest first;
* **prefix filter**: a block that lacks the ``size - need + 1`` rarest words of a
  template cannot reach ``need`` of them, so only blocks around such words are
  cut out of the text, and meet the templates by an equality join on the word;
* **length filter**: the block needs ``need`` template words at least;
* **positional filter**: with the first common prefix word at place i of the
  template and j of the block (both in global order) at most
  ``1 + min(size - i - 1, len - j - 1)`` words can be common;
* the overlap of what is left is counted exactly.

Base phrases are templates with threshold 1 whose blocks are then searched for
the phrase itself (an exact check). A place counts in the block in whose first
half it begins, which is one block.

All of it is DataFrame functions. The documents are read twice (word counts, then
blocks); only blocks around prefix words travel. The templates are arguments, so
what is sent to every task (their words, under ``MAX_WORDS``) does not grow with
the documents. Empty and null texts have no words and no labels; a repeated row
is a row of its own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm import staged

# Fixed values of the contract: phrase and label.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Notices as they are commonly printed, by label.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache": ("Licensed under the Apache License, Version 2.0",),
    "bsd": ("Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met",),
    "cc-by": ("Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0",),
    "cc0": ("CC0 1.0 Universal Public Domain Dedication",),
    "gpl": ("This work is licensed under the GNU General Public License, version 3",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    "mit": ("Released under the MIT License",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License",),
}
THRESHOLD = 0.8
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
STRIDE = 16                # words from block to block; a block has twice as many
MAX_WORDS = 5_000          # distinct words of all templates together

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text (array<string>); none for null."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(WORD), F.lit(0))


def split_words(text: str) -> list[str]:
    """``words`` for a template."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return "".join(c if c.isascii() and c.isalnum() or not c.isascii() else " " for c in low).split(" ")


def pieces(templates: Mapping[str, Sequence[str]], base: Mapping[str, str], threshold: float) -> list[dict]:
    """Templates of at most STRIDE words: label, words (distinct), the phrase
    (empty if the order of the words is free) and how many words are needed."""
    out = []
    for label, texts in templates.items():
        for text in texts:
            ws = [w for w in split_words(text) if w]
            for i in range(0, len(ws), STRIDE):
                own = list(dict.fromkeys(ws[i:i + STRIDE]))
                # (a tail of few words would be no evidence)
                if i == 0 or len(own) * 2 >= STRIDE:
                    out.append({"label": label, "words": own, "phrase": [], "need": math.ceil(threshold * len(own) - 1e-9)})
    for phrase, label in base.items():
        ws = [w for w in split_words(phrase) if w]
        if len(ws) > STRIDE + 1:
            raise ValueError(f"a phrase has at most {STRIDE + 1} words: {phrase!r}")
        own = list(dict.fromkeys(ws))
        out.append({"label": label, "words": own, "phrase": ws, "need": len(own)})
    if not all(p["words"] for p in out):
        raise ValueError("a template without words")
    if len({w for p in out for w in p["words"]}) > MAX_WORDS:
        raise ValueError(f"the templates have over {MAX_WORDS} distinct words")
    return out


def word_order(docs: DataFrame, vocabulary: Sequence[str], text_col: str) -> list[str]:
    """``vocabulary`` by how often the texts have each word, the rarest first.
    At most one row a word of the templates reaches the driver."""
    found = docs.select(F.explode(words(F.col(f"`{text_col}`"))).alias("w")).where(F.col("w").isin(list(vocabulary)))
    counts = {r["w"]: r["n"] for r in found.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def _strings(xs: Sequence[str]) -> Column:
    return F.array(*[F.lit(x) for x in xs]) if xs else F.array().cast("array<string>")


def _index(spark, parts: Sequence[Mapping], rank: Mapping[str, int]) -> DataFrame:
    """A row per (template, prefix word): the word, its place i in the template
    (in global order) and the template."""
    rows = []
    for tid, p in enumerate(parts):
        own = sorted(p["words"], key=rank.__getitem__)
        prefix = own[:len(own) - p["need"] + 1]
        for i, w in enumerate(prefix):
            rows.append(F.struct(
                F.lit(w).alias("t_word"), F.lit(i).alias("i"), F.lit(tid).alias("tid"), F.lit(p["label"]).alias("label"),
                F.lit(p["need"]).alias("need"), _strings(own).alias("t_words"), _strings(prefix).alias("t_prefix"),
                _strings(p["phrase"]).alias("phrase")))
    return F.broadcast(spark.range(1).select(F.inline(F.array(*rows))))  # the size of the templates (MAX_WORDS)


def candidate_blocks(docs: DataFrame, prefix_words: Sequence[str], id_col: str, text_col: str) -> DataFrame:
    """(uid, id_col, n_words, blocks): a row per document with the blocks, of 32
    words from word 16 * block on, that hold a prefix word. Staged."""
    w = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(f"`{id_col}`").alias("id"),
                    words(F.col(f"`{text_col}`")).alias("ws"))
    # the places of prefix words, then the (one or two) blocks around each
    hit = F.filter(F.transform("ws", lambda x, i: F.when(x.isin(list(prefix_words)), F.floor(i / STRIDE).cast("int"))),
                   lambda b: b.isNotNull())
    found = w.select("uid", "id", "ws", F.size("ws").cast("long").alias("n_words"), F.array_distinct(hit).alias("own"))
    around = F.array_union("own", F.filter(F.transform("own", lambda b: b - 1), lambda b: b >= 0))
    cut = F.transform(around, lambda b: F.struct(b.alias("block"), F.slice("ws", b * STRIDE + 1, 2 * STRIDE).alias("words")))
    return staged.stage(found.select("uid", "id", "n_words", cut.alias("blocks")), "license_blocks")[0]


def links(blocks: DataFrame, order: Sequence[str], parts: Sequence[Mapping]) -> DataFrame:
    """All (uid, id, n_words, block, label, is_base, overlap, size, starts): a row
    per block and template that meet, or nulls for a document without any.
    ``starts``: places of a base phrase in the block's first half."""
    rank = {w: i for i, w in enumerate(order)}
    index = _index(blocks.sparkSession, parts, rank)
    one = blocks.select("uid", "id", "n_words", F.explode_outer("blocks").alias("b"))
    own = one.select("uid", "id", "n_words", F.col("b.block").alias("block"), F.col("b.words").alias("words"),
                     # distinct template words of the block in global order
                     F.array_intersect(_strings(order), F.col("b.words")).alias("own"))
    keyed = own.withColumn("word", F.explode_outer("own"))
    met = keyed.join(index, F.col("word") == F.col("t_word"), "left")
    size, length = F.size("t_words"), F.size("own")
    j = F.array_position("own", F.col("word")) - 1
    first = F.element_at(F.array_intersect("t_prefix", "own"), 1) == F.col("word")
    possible = (length >= F.col("need")) & (1 + F.least(size - F.col("i") - 1, length - j - 1) >= F.col("need"))
    overlap = F.size(F.array_intersect("t_words", "own"))
    n_phrase = F.size("phrase")
    starts = F.filter(F.sequence(F.lit(0), F.lit(STRIDE - 1)),
                      lambda s: F.slice(F.col("words"), s + 1, F.greatest(n_phrase, F.lit(1))) == F.col("phrase"))
    is_base = n_phrase > 0
    out = met.select("uid", "id", "n_words", "block", "label", size.alias("size"), is_base.alias("is_base"),
                     F.when(first & possible & (overlap >= F.col("need")), overlap).alias("overlap"),
                     F.when(is_base, F.transform(starts, lambda s: s.cast("long") + F.col("block") * STRIDE)).alias("starts"))
    linked = F.col("overlap").isNotNull() & (~F.col("is_base") | (F.size("starts") > 0))
    return out.select("uid", "id", "n_words", *[F.when(linked, F.col(c)).alias(c) for c in
                                                ("block", "label", "is_base", "overlap", "size", "starts")])


def license_scan(docs: DataFrame, templates: Mapping[str, Sequence[str]] = TEMPLATES, base: Mapping[str, str] = BASE,
                 threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id_col, n_words, n_base (places of base phrases),
    first_word and last_word (their smallest and largest start), base_labels and
    labels (distinct, sorted, comma-joined), n_links (pairs of a block and a
    template that it meets) and score (the largest containment, 0 without any)."""
    parts = pieces(templates, base, threshold)
    order = word_order(docs, sorted({w for p in parts for w in p["words"]}), text_col)
    rank = {w: i for i, w in enumerate(order)}
    prefixes = sorted({w for p in parts for w in sorted(p["words"], key=rank.__getitem__)[:len(p["words"]) - p["need"] + 1]})
    found = links(candidate_blocks(docs, prefixes, id_col, text_col), order, parts)
    joined = lambda labels: F.array_join(F.array_sort(labels), ",")
    based = F.coalesce(F.col("is_base"), F.lit(False))
    per = found.groupBy("uid", "id", "n_words").agg(
        F.sum(F.when(based, F.size("starts")).otherwise(0)).cast("long").alias("n_base"),
        F.min(F.when(based, F.array_min("starts"))).alias("first_word"), F.max(F.when(based, F.array_max("starts"))).alias("last_word"),
        F.collect_set(F.when(based, F.col("label"))).alias("base_labels"), F.collect_set("label").alias("labels"),
        F.count("overlap").alias("n_links"), F.coalesce(F.max(F.col("overlap") / F.col("size")), F.lit(0.0)).alias("score"))
    return per.select(F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
                      joined(F.col("base_labels")).alias("base_labels"), joined(F.col("labels")).alias("labels"),
                      "n_links", "score")


def oracle_sql(templates: Mapping[str, Sequence[str]] = TEMPLATES, base: Mapping[str, str] = BASE,
               threshold: float = THRESHOLD) -> str:
    """DuckDB SQL of ``license_scan`` over ``documents``: every block against
    every template, without filters."""
    parts = pieces(templates, base, threshold)
    text = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]::VARCHAR[]"
    values = ",\n  ".join(f"('{p['label']}', {text(p['words'])}, {text(p['phrase'])}, {p['need']})" for p in parts)
    return rf"""
WITH t(label, ws, phrase, need) AS (VALUES
  {values}
), d AS (
  SELECT row_number() OVER () AS uid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), b AS (
  SELECT uid, unnest(range(0, len(words), {STRIDE})) AS s, words FROM d
), blocks AS (
  SELECT uid, s, words[s + 1:s + {2 * STRIDE}] AS w FROM b
), met AS (
  SELECT uid, s, label, len(phrase) > 0 AS is_base, len(list_intersect(ws, w)) AS overlap, len(ws) AS size,
         list_filter(range(0, {STRIDE}), lambda i: len(phrase) > 0 AND w[i + 1:i + len(phrase)] = phrase) AS places
  FROM blocks, t WHERE len(list_intersect(ws, w)) >= need
), linked AS (
  SELECT * FROM met WHERE NOT is_base OR len(places) > 0
), per AS (
  SELECT uid, CAST(sum(CASE WHEN is_base THEN len(places) ELSE 0 END) AS BIGINT) AS n_base,
         min(CASE WHEN is_base THEN s + list_min(places) END) AS first_word,
         max(CASE WHEN is_base THEN s + list_max(places) END) AS last_word,
         string_agg(DISTINCT CASE WHEN is_base THEN label END, ',' ORDER BY CASE WHEN is_base THEN label END) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, count(*) AS n_links, max(overlap / size) AS score
  FROM linked GROUP BY uid
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(n_links, 0) AS n_links,
       coalesce(score, 0.0::DOUBLE) AS score
FROM d LEFT JOIN per USING (uid)
"""
