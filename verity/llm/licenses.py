"""Licence scan: named phrases, and an exact set-similarity join of text blocks
with licence-notice templates.

A text block is a run of ``BLOCK`` words that starts at a multiple of half a
block (the last ones may be shorter), so every run of up to half a block lies
in one. A template is found in a block that holds at least ``threshold`` of its
distinct words.

The join is exact and needs no shuffle of the texts. Template words are ordered
by their document frequency over all documents, rarest first. A block can reach
the threshold only if it holds one of the template's first
``size - need + 1`` words (prefix filter), has at least ``need`` distinct words
(length filter), and has enough words left from the first shared one on
(positional filter); the blocks that pass are verified on the full sets. Since
the templates are a short fixed list, each document meets the index inside its
own row, whatever its source or size. Only DataFrame functions are used.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verity.llm.common import text_of

# Characters between words, and inside words, before case folding.
SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
WORD_CHAR = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"
BLOCK = 48

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Customary notices (at most BLOCK / 2 words) and their labels.
TEMPLATES = [
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License"),
    ("lgpl", "licensed under the terms of the GNU Lesser General Public License"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution International License"),
    ("cc-by-sa", "licensed under the Creative Commons Attribution ShareAlike License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]  # distinct, rarest first
    need: int

    @property
    def prefix(self) -> tuple[str, ...]:
        return self.words[:len(self.words) - self.need + 1]


def template_words(text: str) -> list[str]:
    """The distinct words of a template, in text order."""
    chars = "".join(c.lower() if c.isascii() and c.isalpha() else c if c.isdigit() or not c.isascii() else " "
                    for c in text)
    return list(dict.fromkeys(chars.split()))


def _array(words) -> Column:
    return F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")


def words_of(text: Column) -> Column:
    """All words, A-Z lower-cased. Of the other letters ``lower`` folds, only
    two give ASCII ones; they are taken out before."""
    folded = F.lower(F.regexp_replace(text, "[İK]", "ı"))
    return F.array_remove(F.split(folded, f"{SEPARATOR}+", -1), "")


def document_frequencies(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In how many documents each word occurs: at most ``len(vocabulary)``
    rows, whatever the number of documents."""
    held = F.array_intersect(words_of(text_of("text")), _array(vocabulary))
    rows = docs.select(F.explode(held).alias("w")).groupBy("w").count().collect()
    return {w: 0 for w in vocabulary} | {r["w"]: r["count"] for r in rows}


def order_templates(templates, frequencies: dict[str, int], threshold: float) -> list[Template]:
    out = []
    for label, text in templates:
        words = sorted(template_words(text), key=lambda w: (frequencies.get(w, 0), w))
        # The smallest whole number of words that is at least the threshold's share.
        need = math.ceil(round(threshold * len(words), 9))
        out.append(Template(label, tuple(words), max(1, need)))
    return out


def _matches(words: Column, templates: list[Template], vocabulary_order: list[str]) -> Column:
    """Array of ``label, start, share`` of the blocks that meet a template."""
    half = BLOCK // 2
    starts = F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1, F.lit(half))) \
        .otherwise(F.array().cast("array<int>"))
    order = _array(vocabulary_order)
    # A block's template words in global order, and its number of distinct words.
    blocks = F.transform(starts, lambda i: F.struct(
        i.alias("start"), F.array_distinct(F.slice(words, i + 1, F.lit(BLOCK))).alias("all")))
    blocks = F.filter(blocks, lambda b: F.arrays_overlap(
        b["all"], _array(sorted({w for t in templates for w in t.prefix}))))
    blocks = F.transform(blocks, lambda b: F.struct(
        b["start"].alias("start"), F.size(b["all"]).alias("n"),
        F.array_intersect(order, b["all"]).alias("held")))

    def join(b: Column) -> Column:
        found = []
        for t in templates:
            own = _array(t.words)
            shared = F.array_intersect(own, b["held"])
            # Places of the first shared word in the template and in the block.
            at = F.array_position(own, shared[0])
            rest = F.size(b["held"]) - F.array_position(b["held"], shared[0])
            passes = ((b["n"] >= t.need) & F.arrays_overlap(b["held"], _array(t.prefix))
                      & (1 + F.least(len(t.words) - at, rest) >= t.need))
            found.append(F.when(passes & (F.size(shared) >= t.need), F.struct(
                F.lit(t.label).alias("label"), b["start"].cast("long").alias("start"),
                (F.size(shared) / F.lit(len(t.words))).alias("share"))))
        return F.filter(F.array(*found), lambda x: x.isNotNull())

    return F.flatten(F.transform(blocks, join))


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """``docs`` with ``n_words, n_base, first_word, last_word, base_labels,
    labels, score, notices``.

    ``n_base`` counts the places of the phrases, ``first_word`` and
    ``last_word`` are the smallest and largest word number at which one starts
    (null without any). ``notices`` lists the blocks that meet a template as
    ``label, start, share``; ``labels`` has the labels of both, distinct,
    sorted, comma-joined, and empty without any. ``score`` is 1 with a phrase,
    else the largest share of a notice, else 0. A null or empty text has no
    words; repeated rows get the same answer each.
    """
    vocabulary = sorted({w for _, text in templates for w in template_words(text)})
    frequencies = document_frequencies(docs, vocabulary)
    ordered = order_templates(templates, frequencies, threshold)
    global_order = sorted(vocabulary, key=lambda w: (frequencies[w], w))
    prefix = sorted({w for t in ordered for w in t.prefix})

    phrases = "|".join(f"{SEPARATOR}+".join(p.split()) for p in PHRASES)
    pattern = f"(?i)(?<!{WORD_CHAR})(?:{phrases})(?!{WORD_CHAR})"
    text = text_of("text")

    def count(c: Column) -> Column:
        return F.regexp_count(c, F.lit(f"{WORD_CHAR}+")).cast("long")

    label = F.create_map(*[F.lit(x) for p, name in PHRASES.items() for x in (p.split()[0], name)])
    out = (docs.withColumn("__hit", text.rlike(pattern))
           .withColumn("__words", words_of(text))
           .withColumn("n_words", F.size("__words").cast("long")))
    places = F.when(F.col("__hit"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    gaps = F.when(F.col("__hit"), F.split(text, pattern, -1))
    out = (out
           .withColumn("__places", places).withColumn("__gaps", gaps)
           .withColumn("n_base", F.when(F.col("__hit"), F.size("__places")).otherwise(0).cast("long"))
           .withColumn("first_word", F.when(F.col("__hit"), count(F.col("__gaps")[0])))
           .withColumn("last_word", F.when(F.col("__hit"), F.col("n_words") - count(F.element_at("__gaps", -1))
                                           - count(F.element_at("__places", -1))))
           .withColumn("__base", F.when(F.col("__hit"), F.transform(
               "__places", lambda p: label[F.lower(F.regexp_extract(p, "^[A-Za-z]+", 0))]))
               .otherwise(F.array().cast("array<string>")))
           .withColumn("notices", F.when(
               F.arrays_overlap("__words", _array(prefix)), _matches(F.col("__words"), ordered, global_order))
               .otherwise(F.array().cast("array<struct<label:string,start:bigint,share:double>>")))
           .withColumn("base_labels", F.array_join(F.array_sort(F.array_distinct("__base")), ","))
           .withColumn("labels", F.array_join(F.array_sort(F.array_union(
               F.col("__base"), F.col("notices")["label"])), ","))
           .withColumn("score", F.when(F.col("__hit"), 1.0).otherwise(
               F.coalesce(F.array_max(F.col("notices")["share"]), F.lit(0.0)))))
    return out.drop("__hit", "__words", "__places", "__gaps", "__base")
