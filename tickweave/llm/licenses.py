"""License scans: phrases by place, and license notices by an exact set-similarity join.

Words are runs of ASCII letters, digits and all characters beyond ASCII, with A-Z lower-cased. *Base* labels come from
phrases whose words stand one after another. The method adds the labels of templates (short license notices): a text block
holds a template if it has at least ``min_pct`` per cent of the template's distinct words. A block is a line, or, of a line with
more than ``block_words`` words, each stretch of so many words that starts at a multiple of half of them; so every stretch of
half the block's words lies whole in some block, and templates may not be longer than that.

The join never compares all blocks with all templates. Words are ordered by the number of documents that have them, over all
documents, rarest first. Only words of templates can count, so blocks are reduced to these. To share ``need`` words with a
template of ``size`` words, a block must have one of the template's first ``size - need + 1`` words (*prefix*), among the first
``b - need + 1`` of its own ``b``, with ``b >= need`` (*length*), and enough words must follow on both sides (*position*). Pairs that
pass are verified on the whole sets, so the filters lose nothing and let nothing wrong through.

Everything is a Spark expression. Texts are read twice (frequencies, then blocks) and never shuffled; rows without any prefix
word end there, and the others carry their reduced blocks only. What is collected or broadcast is bounded by the templates.

Defined results: null or empty texts have no words, no places and score 0; repeated rows give repeated results; ids of any
kind pass through; extra columns do not matter, whatever their names; an empty table gives an empty table. The score is 1
where a phrase stands, else the largest share of a template's words in one block among the templates held, else 0.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tickweave.llm.common import LOWER, UPPER, settled, text_of

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MIN_PCT, BLOCK_WORDS = 90, 64

# Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Wording of common license notices.
TEMPLATES = [
    ("agpl-3.0", "GNU Affero General Public License as published by the Free Software Foundation, either version 3"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("reserved", "All rights reserved"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]


def template_words(text: str) -> list[str]:
    lowered = text.translate({ord(a): b for a, b in zip(UPPER, LOWER)})
    return [w for w in re.split(SEPARATORS, lowered) if w]


def needed(size: int, min_pct: int) -> int:
    """Least number of shared words that makes up ``min_pct`` per cent of ``size``."""
    return -(-min_pct * size // 100)


def _strings(values: Sequence[str]) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>")


def words_of(lowered: Column) -> Column:
    return F.filter(F.split(lowered, SEPARATORS), lambda w: w != "")


def _places(words: Column, phrase: str) -> Column:
    """Where the words of a phrase stand one after another."""
    first, *rest = phrase.split()

    def here(w: Column, i: Column) -> Column:
        stands = w == first
        for k, x in enumerate(rest, 1):
            stands = stands & (F.get(words, i + k) == x)
        return F.when(stands, i)

    return F.filter(F.transform(words, here), lambda i: i.isNotNull())


def _blocks(lowered: Column, block_words: int) -> Column:
    """The word lists of all blocks of a text."""
    step = block_words // 2

    def stretches(w: Column) -> Column:
        last = F.ceil(F.greatest(F.size(w) - block_words, F.lit(0)) / step).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(w, k * step + 1, block_words))

    lines = F.transform(F.split(lowered, "\n"), words_of)  # each line is split once, not once per stretch
    return F.flatten(F.transform(lines, stretches))


def document_frequencies(df: DataFrame, vocabulary: Sequence[str], text: str = "text") -> dict[str, int]:
    """How many documents have each word of the vocabulary; one row per word comes to the driver."""
    lowered = F.translate(text_of(text), UPPER, LOWER)
    each = df.select(F.explode(F.array_intersect(_strings(vocabulary), words_of(lowered))).alias("w")).groupBy("w").count()
    return {**dict.fromkeys(vocabulary, 0), **{r["w"]: r["count"] for r in each.collect()}}


def _template_rows(df: DataFrame, templates: Sequence[tuple[str, list[str]]], min_pct: int) -> DataFrame:
    """``template, label, has, size, need``; a row per template."""
    rows = [
        F.struct(F.lit(k).alias("template"), F.lit(label).alias("label"), _strings(words).alias("has"), F.lit(len(words)).alias("size"), F.lit(needed(len(words), min_pct)).alias("need"))
        for k, (label, words) in enumerate(templates)
    ]
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def joined_blocks(blocks: DataFrame, templates: DataFrame, least: int) -> DataFrame:
    """Blocks (``has``: distinct words in the global order) with the templates that they hold: all columns, ``label`` and ``share``."""
    probes = blocks.withColumn("_b", F.size("has")).select("*", F.posexplode(F.slice("has", 1, F.greatest(F.col("_b") - (least - 1), F.lit(0)))).alias("_j", "_word"))
    index = templates.withColumnRenamed("has", "_has").select("*", F.posexplode(F.slice("_has", 1, F.col("size") - F.col("need") + 1)).alias("_i", "_token"))
    pairs = probes.join(F.broadcast(index), F.col("_word") == F.col("_token"))  # at most as many rows as the templates have words
    pairs = pairs.filter(
        (F.col("_b") >= F.col("need")) & (F.col("_j") <= F.col("_b") - F.col("need"))
        & (F.least(F.col("size") - F.col("_i"), F.col("_b") - F.col("_j")) >= F.col("need"))
    )
    pairs = pairs.withColumn("_both", F.size(F.array_intersect("has", "_has"))).filter(F.col("_both") >= F.col("need"))
    return pairs.withColumn("share", F.col("_both") / F.col("size")).drop("template", "size", "need", "_has", "_b", "_j", "_word", "_i", "_token", "_both")


def scan_licenses(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", phrases: dict[str, str] | None = None, templates: Sequence[tuple[str, str]] | None = None,
    min_pct: int = MIN_PCT, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` (labels as sorted arrays)."""
    phrases = PHRASES if phrases is None else phrases
    given = [(label, template_words(t)) for label, t in (TEMPLATES if templates is None else templates)]
    if any(len(words) > block_words // 2 for _, words in given):
        raise ValueError("a template may have at most half the words of a block")
    known = [(label, sorted(set(words))) for label, words in given if words]
    vocabulary = sorted({w for _, words in known for w in words})
    often = document_frequencies(df, vocabulary, text) if vocabulary else {}
    order = sorted(vocabulary, key=lambda w: (often[w], w))
    place = {w: k for k, w in enumerate(order)}
    known = [(label, sorted(words, key=place.get)) for label, words in known]
    prefixes = sorted({w for _, words in known for w in words[: len(words) - needed(len(words), min_pct) + 1]})
    least = min((needed(len(words), min_pct) for _, words in known), default=1)

    rows = df.select(F.col(doc_id).alias("doc_id"), F.translate(text_of(text), UPPER, LOWER).alias("t"))
    rows = rows.withColumn("words", words_of(F.col("t")))
    first = F.arrays_overlap("words", _strings(sorted({p.split()[0] for p in phrases})))  # most texts end here
    rows = rows.withColumns({f"p{k}": F.when(first, _places(F.col("words"), p)) for k, p in enumerate(phrases)})
    places = F.concat(F.array().cast("array<int>"), *[F.coalesce(f"p{k}", F.array().cast("array<int>")) for k in range(len(phrases))])
    labels = F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(F.size(f"p{k}") > 0, F.lit(v)) for k, v in enumerate(phrases.values())]).cast("array<string>"))))
    held = F.transform(_blocks(F.col("t"), block_words), lambda b: F.array_intersect(_strings(order), b))
    held = F.filter(held, lambda b: (F.size(b) >= least) & F.arrays_overlap(b, _strings(prefixes)))
    rows = rows.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), places.alias("places"), labels.alias("base_labels"),
        F.when(F.arrays_overlap("words", _strings(prefixes)), held).alias("blocks"),
    )
    rows = settled(rows, "license-blocks").select("*", F.struct(F.col("_metadata.file_name"), F.col("_metadata.row_index")).alias("row"))
    blocks = rows.filter(F.size("blocks") > 0).select("row", F.explode("blocks").alias("has"))
    matches = joined_blocks(blocks, _template_rows(df, known, min_pct), least) if known else blocks.select("row", F.lit("").alias("label"), F.lit(0.0).alias("share")).limit(0)
    best = matches.groupBy("row").agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))  # a set of at most all labels
    out = rows.drop("blocks").join(best, "row", "left")
    n = F.size("places")
    return out.select(
        "doc_id", "n_words", n.cast("long").alias("n_base"), F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"), "base_labels",
        F.array_sort(F.array_union("base_labels", F.coalesce("more", F.array().cast("array<string>")))).alias("labels"),
        F.when(n > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
