"""License scans: phrases at their places, and an exact set-similarity join of text blocks with license templates."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import let, row_key

# What separates words, as the inside of a character class, and the same with A-Z as word characters.
SEPARATOR = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
_RAW = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Phrases of the base rule and their labels.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

# Opening words and notices of common licenses, and their labels.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
            " documentation files (the Software), to deal in the Software without restriction"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"
               " http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl", "licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
            " Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
            " the following conditions are met"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
            " hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]

#: Templates are a parameter; beyond this many words they would not be small enough to go into a plan.
MOST_WORDS = 20_000


_BLOCKS = "array<struct<stride: int, block: int, set: array<string>, prefix: array<string>>>"


@dataclass(frozen=True)
class Template:
    """Distinct words of a template, the number of them that a block has to hold, and half the length of its blocks."""

    label: str
    words: tuple[str, ...]
    need: int
    stride: int


def templates_of(texts: Iterable[tuple[str, str]], threshold: float) -> list[Template]:
    """A template of up to 8, 16, 32 ... words is sought in blocks of twice as many, which start every 8, 16, 32 ... words.

    So any stretch as long as the template lies in one block.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold has to lie above 0 and be 1 at most")
    made = []
    for label, text in texts:
        parts = re.findall(f"[^{SEPARATOR}]+", text.translate(str.maketrans(_CAPITALS, _SMALL)))
        if not parts or "," in label:
            raise ValueError(f"a template has words, and a label without commas: {label!r}")
        distinct = tuple(sorted(set(parts)))
        made.append(Template(label, distinct, ceil(threshold * len(distinct) - 1e-9), max(8, 1 << (len(parts) - 1).bit_length())))
    if sum(len(t.words) for t in made) > MOST_WORDS:
        raise ValueError(f"templates of more than {MOST_WORDS} words")
    return made


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _CAPITALS, _SMALL)
    return F.array_remove(F.split(lowered, f"[{SEPARATOR}]+"), "")


def frequency_order(docs: DataFrame, text: str, templates: list[Template]) -> list[str]:
    """All words of the templates, from the one in the fewest texts of the corpus to the one in the most."""
    known = sorted({w for t in templates for w in t.words})
    held = docs.select(F.explode(F.array_intersect(words_of(docs[text]), _array(known))).alias("word"))
    # One row per word of the templates at most.
    counts = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return sorted(known, key=lambda w: (counts.get(w, 0), w))


def matches(docs: DataFrame, id: str, text: str, templates: list[Template]) -> DataFrame:
    """``k1``, ``k2`` (the row's key), ``stride``, ``block``, ``label`` and ``containment`` of every block that meets a template.

    A block meets a template if it holds ``need`` of its distinct words. Both are sets in one order, the rarest word of
    the corpus first. Then:

    - prefix: two sets with ``need`` words in common share one of the first ``size - need + 1`` of either, so only
      those are joined; as they are the rarest, most texts have none and are left out before any block is made;
    - length: a block with fewer than ``need`` words of templates of its length is left out;
    - position: behind their first common word both sets must have room for the rest.

    What is left is compared as a whole. The first common word alone yields the pair, so no pair comes twice.
    """
    spark = docs.sparkSession
    order = frequency_order(docs, text, templates)
    place = {w: k for k, w in enumerate(order)}
    ranked = {t: sorted(t.words, key=place.__getitem__) for t in templates}
    prefixes = [
        (t.stride, word, i, len(t.words), t.need, t.label, ranked[t])
        for t in templates for i, word in enumerate(ranked[t][: len(t.words) - t.need + 1])
    ]
    # At most one row per word of the templates, which MOST_WORDS bounds.
    sought = F.broadcast(spark.createDataFrame(
        prefixes, "stride int, word string, i int, size int, need int, label string, set array<string>"
    ))
    strides: dict[int, list[Template]] = {}
    for t in templates:
        strides.setdefault(t.stride, []).append(t)

    def blocks(words: Column) -> Column:
        """Blocks of all lengths; none of a length whose rare words the text has none of."""
        kinds = [F.array().cast(_BLOCKS)]
        for stride, group in sorted(strides.items()):
            rare = _array(sorted({p[1] for p in prefixes if p[0] == stride}))
            vocabulary = _array([w for w in order if any(w in t.words for t in group)])
            made = _blocks(words, stride, vocabulary, min(t.need for t in group))
            kinds.append(F.when(F.arrays_overlap(words, rare), made).otherwise(F.array().cast(_BLOCKS)))
        return F.concat(*kinds)

    k1, k2 = row_key(docs[id], docs[text])
    rows = docs.select(k1.alias("k1"), k2.alias("k2"), F.explode(let(words_of(docs[text]), blocks)).alias("it"))
    held = rows.select("k1", "k2", "it.stride", "it.block", F.col("it.set").alias("held"), F.posexplode("it.prefix").alias("j", "word"))

    room = F.least(F.col("size") - F.col("i"), F.size("held") - F.col("j"))
    pairs = held.join(sought, ["stride", "word"]).filter((F.size("held") >= F.col("need")) & (room >= F.col("need")))
    pairs = pairs.withColumn("common", F.array_intersect("set", "held"))
    met = pairs.filter((F.size("common") >= F.col("need")) & (F.get("common", F.lit(0)) == F.col("word")))
    return met.select("k1", "k2", "stride", "block", "label", (F.size("common") / F.col("size")).alias("containment"))


def scan(
    docs: DataFrame, id: str = "doc_id", text: str = "text", phrases: list[tuple[str, str]] = PHRASES,
    templates: list[tuple[str, str]] = TEMPLATES, threshold: float = 0.9,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels`` and ``score``.

    Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased. ``n_base`` counts the places where
    the words of a phrase stand one after another, whatever separates them; ``first_word`` and ``last_word`` are the
    smallest and largest start of one, counted in words from 0, null where there is none. ``base_labels`` are the labels
    of phrases found; ``labels`` has those of the templates that a block of the text meets as well (see ``matches``; a
    block is 16, 32, 64 ... words long). Both are distinct, sorted and joined by commas, empty where there is none.
    ``score`` is the largest share of a template found in a block that meets it; 1 where a phrase is found, 0 where
    nothing is.

    A null text counts as empty and has no words. Texts of any length are read whole. Rows that are equal in id and text
    have equal results; ids may be null or repeat. All columns are passed on; columns named like the results are
    replaced. An empty table gives an empty result.

    Phrases are regular expressions over the text as it is; only rows with a block that meets a template are exchanged
    before the results are joined with the rows.
    """
    sought = templates_of(templates, threshold)
    own = F.coalesce(docs[text], F.lit(""))
    places = [_places(words) for words, _ in phrases]
    counts = [F.regexp_count(own, F.lit(p)) for p in places]
    anywhere = "(?:" + "|".join(places) + ")" if places else r"(?!)"
    k1, k2 = row_key(docs[id], docs[text])
    found = docs.withColumn("_found", F.struct(
        F.regexp_count(own, F.lit(f"[^{_RAW}]+")).cast("bigint").alias("n_words"), F.array(F.lit(0), *counts).alias("counts"),
        k1.alias("k1"), k2.alias("k2"),
    ))
    n_base = F.aggregate("_found.counts", F.lit(0), lambda total, n: total + n).cast("bigint")

    def start(before: str) -> Column:
        ahead = F.regexp_extract(own, f"(?s)^({before}){anywhere}", 1)
        return F.when(n_base > 0, F.regexp_count(ahead, F.lit(f"[^{_RAW}]+")).cast("bigint"))

    names = [F.when(F.get("_found.counts", F.lit(k + 1)) > 0, label) for k, (_, label) in enumerate(phrases)]
    base = F.array_compact(F.array(F.lit(None).cast("string"), *names))
    based = found.withColumn("_found", F.struct(
        "_found.k1", "_found.k2", "_found.n_words", n_base.alias("n_base"), start(".*?").alias("first_word"),
        start(".*").alias("last_word"), base.alias("base"),
    ))
    met = matches(docs, id, text, sought).groupBy(F.col("k1").alias("_m1"), F.col("k2").alias("_m2")).agg(
        F.collect_set("label").alias("_labels"), F.max("containment").alias("_score")
    )
    joined = based.join(met, (F.col("_found.k1") == F.col("_m1")) & (F.col("_found.k2") == F.col("_m2")), "left")

    def listed(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    more = F.coalesce("_labels", F.array().cast("array<string>"))
    return joined.withColumns({
        **{c: F.col(f"_found.{c}") for c in ("n_words", "n_base", "first_word", "last_word")},
        "base_labels": listed(F.col("_found.base")), "labels": listed(F.concat(F.col("_found.base"), more)),
        "score": F.when(F.col("_found.n_base") > 0, 1.0).otherwise(F.coalesce("_score", F.lit(0.0))),
    }).drop("_found", "_m1", "_m2", "_labels", "_score")


def _places(phrase: str) -> str:
    """The first word of a phrase where the others follow, each a whole word; A-Z match a-z, no other letter does."""
    first, *rest = (re.escape(w) for w in phrase.split())
    follow = "".join(f"[{_RAW}]+{w}" for w in rest)
    return f"(?i:(?<![^{_RAW}]){first}(?={follow}(?![^{_RAW}])))"


def _blocks(words: Column, stride: int, vocabulary: Column, least: int) -> Column:
    """All blocks of a text with ``least`` or more words of the vocabulary: these words, in its order, and their prefix.

    The last block reaches the end.
    """
    last = F.greatest(F.lit(0), F.ceil(F.size(words) / stride).cast("int") - 2)

    def made(k: Column) -> Column:
        held = F.array_intersect(vocabulary, F.slice(words, k * stride + 1, F.lit(2 * stride)))
        return let(held, lambda set: F.struct(
            F.lit(stride).alias("stride"), k.alias("block"), set.alias("set"),
            F.slice(set, F.lit(1), F.greatest(F.lit(0), F.size(set) - least + 1)).alias("prefix"),
        ))

    return F.filter(F.transform(F.sequence(F.lit(0), last), made), lambda it: F.size(it["prefix"]) > 0)


def _array(words: list[str]) -> Column:
    return F.array(*(F.lit(w) for w in words)).cast("array<string>")
