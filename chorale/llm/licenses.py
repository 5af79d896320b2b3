"""License scan: an exact set-similarity join of text blocks with license templates.

Blocks are the paragraphs of a text (runs of lines that aren't blank). A block matches a
template if a run of its words, ``RUN_RATIO`` times as long as the template has distinct
words, holds at least ``threshold`` of these, and with them all that names the license: the
template's marks, one or more words in a row each (``mit license``, ``gnu general public
license`` and ``3``). One rule holds for blocks of any length, and a block may match several
templates.

Words are ordered by the number of documents that hold them, rarest first, counted over all
documents. A match must share one of the template's first ``size - ceil(threshold * size) + 1``
words in that order (its prefix), so blocks and templates are joined on those. Of the
candidates, a block with too few words for any match (length) goes, then one whose words from
the shared one on can't reach the needed number (position), then one that lacks a word of the
marks; in the rest every run is counted exactly.

Only words of the templates are looked at, so all that is shuffled are word counts and
matches. The templates are a fixed list in this module, which bounds what is broadcast.

Defined results for odd input: a null text is empty and has no words, no places and no
labels; equal rows get equal results; further columns are left out of the result. An
empty table gives an empty table.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
#: Words in a run, as a multiple of the template's distinct words.
RUN_RATIO = 2
# Words, what parts them, and the base phrases.
WORD = r"[0-9a-z\x80-\x{10FFFF}]+"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Openings of public license texts and usual one-line notices.
TEMPLATES = {
    "agpl-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3",
        """This program is free software: you can redistribute it and/or modify it under the terms of
        the GNU Affero General Public License as published by the Free Software Foundation, either
        version 3 of the License, or (at your option) any later version.""",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at""",
    ],
    "bsd": [
        """Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met""",
    ],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0"],
    "epl-2.0": [
        """This program and the accompanying materials are made available under the terms of the
        Eclipse Public License 2.0""",
    ],
    "gpl-2.0": [
        "This work is licensed under the GNU General Public License, version 2",
        """This program is free software; you can redistribute it and/or modify it under the terms of
        the GNU General Public License as published by the Free Software Foundation; either version 2
        of the License, or (at your option) any later version.""",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        """This program is free software: you can redistribute it and/or modify it under the terms of
        the GNU General Public License as published by the Free Software Foundation, either version 3
        of the License, or (at your option) any later version.""",
    ],
    "isc": [
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this permission
        notice appear in all copies.""",
    ],
    "lgpl-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3",
        """This library is free software: you can redistribute it and/or modify it under the terms of
        the GNU Lesser General Public License as published by the Free Software Foundation, either
        version 3 of the License, or (at your option) any later version.""",
    ],
    "mit-license": ["Released under the MIT License"],
    "mit-permission": [
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
        and associated documentation files, to deal in the Software without restriction""",
    ],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
}
# What names each license, without which no text is under it.
MARKS = {
    "agpl-3.0": ["gnu affero general public license", "3"],
    "apache-2.0": ["apache", "2 0"],
    "bsd": ["redistribution", "binary", "permitted"],
    "cc-by-nc": ["cc by", "nc"],
    "cc-by-sa": ["cc by", "sa"],
    "epl-2.0": ["eclipse public", "2 0"],
    "gpl-2.0": ["gnu general public license", "2"],
    "gpl-3.0": ["gnu general public license", "3"],
    "isc": ["permission", "fee", "granted"],
    "lgpl-3.0": ["gnu lesser general public license", "3"],
    "mit-license": ["mit license"],
    "mit-permission": ["permission", "free", "charge", "granted"],
    "mpl-2.0": ["mozilla", "2 0"],
    "unlicense": ["unencumbered", "public domain"],
}


def _literal(pattern: str) -> str:
    return "r'" + pattern + "'"


def _words(text: str) -> str:
    """Words after lower-casing. ``lower`` also maps letters beyond ASCII, which changes neither
    where words end nor any word of the phrases (no such letter maps to one of theirs alone)."""
    return f"regexp_extract_all(lower({text}), {_literal(WORD)}, 0)"


def template_words() -> dict[tuple[str, int], list[str]]:
    """The distinct words of each template, by label and number."""
    return {
        (label, n): sorted(set(re.findall("[0-9a-z]+", text.lower())))
        for label, texts in TEMPLATES.items()
        for n, text in enumerate(texts)
    }


def _needed(words: list[str], threshold: float) -> int:
    return math.ceil(threshold * len(words) - 1e-9)


def _strings(values: list[str]) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def with_base(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_words`` and the base ``places`` (label, place).

    Only a text that one search finds a phrase in is cut into words.
    """
    per_phrase = []
    for phrase, label in PHRASES.items():
        equal = " AND ".join(f"get(words, i + {k}) = '{w}'" for k, w in enumerate(phrase.split()))
        places = f"filter(sequence(0, size(words) - 1), i -> {equal})"
        per_phrase.append(
            f"transform({places}, i -> named_struct('label', '{label}', 'place', CAST(i AS BIGINT)))"
        )
    any_phrase = "|".join(p.replace(" ", BETWEEN) for p in PHRASES)
    has_phrase = f"regexp_like(lower(text), {_literal(any_phrase)})"
    found = f"flatten(transform(array({_words('text')}), words -> concat({', '.join(per_phrase)})))"
    empty = "CAST(array() AS array<struct<label:string,place:bigint>>)"
    return docs.withColumn("places", F.expr(f"CASE WHEN {has_phrase} THEN {found} ELSE {empty} END")).withColumn(
        "n_words", F.expr(f"CAST(coalesce(regexp_count(lower(text), {_literal(WORD)}), 0) AS BIGINT)")
    )


def word_order(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(word, n_docs): in how many texts each word of the vocabulary is, 0 included."""
    held = docs.select(
        F.explode(F.expr(f"array_intersect({_words('text')}, {_strings(vocabulary)})")).alias("word")
    )
    every = docs.sparkSession.createDataFrame([(w,) for w in vocabulary], "word string")
    return (
        every.withColumn("n", F.lit(0).cast("bigint"))
        .unionByName(held.withColumn("n", F.lit(1).cast("bigint")))
        .groupBy("word")
        .agg(F.sum("n").alias("n_docs"))
    )


def _templates(docs: DataFrame, order: DataFrame, threshold: float) -> DataFrame:
    """(label, number, size, needed, marks, tokens): tokens rarest first."""
    rows = [
        (label, n, len(words), _needed(words, threshold), [m.split() for m in MARKS[label]], w)
        for (label, n), words in template_words().items()
        for w in words
    ]
    schema = "label string, number int, size int, needed int, marks array<array<string>>, word string"
    ranked = docs.sparkSession.createDataFrame(rows, schema).join(order, "word")
    return ranked.groupBy("label", "number", "size", "needed", "marks").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("n_docs", "word"))), lambda x: x["word"]
        ).alias("tokens")
    )


def matches(docs: DataFrame, keys: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """(keys, label, containment) of every block with each license that it matches."""
    vocabulary = sorted({w for words in template_words().values() for w in words})
    order = word_order(docs, vocabulary)
    templates = _templates(docs, order, threshold)
    prefixes = templates.select(
        "*", F.posexplode(F.expr("slice(tokens, 1, size - needed + 1)")).alias("place", "word")
    )
    # A template's first words alone decide which texts are cut into blocks. No word is
    # outside the vocabulary, whose size bounds this array.
    firsts = prefixes.agg(F.collect_set("word").alias("firsts")).select("firsts").scalar()
    blocks = r"array_distinct(split(text, '\n[\\x20\\x09-\\x0D]*\n'))"
    # Of a block only the words of templates are kept, each with its place.
    placed = f"""filter(transform({_words('block')}, (w, i) -> named_struct('at', i, 'word', w)),
        h -> array_contains({_strings(vocabulary)}, h.word))"""
    own = (
        docs.where(F.col("text").isNotNull())
        .select(*keys, "text", F.expr(f"array_intersect({_words('text')}, {_strings(vocabulary)})").alias("held"))
        .where(F.arrays_overlap("held", firsts))
        .select(*keys, F.posexplode(F.expr(blocks)).alias("number_in_text", "block"))
        .select(*keys, "number_in_text", F.expr(placed).alias("hits"))
        .withColumn("held", F.expr("array_distinct(transform(hits, h -> h.word))"))
    )
    candidates = own.withColumn("word", F.explode("held")).join(F.broadcast(prefixes), "word")
    common = F.size(F.array_intersect("held", "tokens"))
    # Words of the template before the shared one can be matched too, but at most ``place`` of them.
    rest = F.expr("size(array_intersect(held, slice(tokens, place + 1, size)))")
    named = F.size(F.array_except(F.flatten("marks"), "held")) == 0
    # A run begins with a word that matters. What matters stands in order, so a run holds no
    # more of it than its length, and the work grows as the block.
    span = f"{RUN_RATIO} * size"
    runs = f"""flatten(transform(array(filter(hits, h -> array_contains(tokens, h.word))), own ->
        transform(own, (first, i) -> filter(slice(own, i + 1, {span}), h -> h.at < first.at + {span}))))"""
    marked = """forall(marks, mark -> exists(run, h -> forall(
        transform(mark, (w, k) -> named_struct('at', h.at + k, 'word', w)), x -> array_contains(run, x))))"""
    n_held = "size(array_distinct(transform(run, h -> h.word)))"
    # 0 where no run matches, as ``needed`` is above 0.
    most = F.expr(
        f"""aggregate(filter({runs}, run -> {n_held} >= needed AND {marked}), 0,
        (most, run) -> greatest(most, {n_held}))"""
    )
    return (
        candidates.where(F.size("held") >= F.col("needed"))
        .where(F.col("place") + rest >= F.col("needed"))
        .where((common >= F.col("needed")) & named)
        .select(*keys, "number_in_text", "label", (most / F.col("size")).alias("containment"))
        .where("containment > 0")
        .groupBy(*keys, "number_in_text", "label")
        .agg(F.max("containment").alias("containment"))
        .select(*keys, "label", "containment")
    )


def scanned(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for each row.

    ``score`` is the best containment among matched templates, 1 where a base phrase
    is found and 0 where nothing is.
    """
    # Rows equal in id and text have equal results, so their digest may stand for them.
    row_key: Column = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "text"))
    docs = docs.select("doc_id", "text", row_key.alias("row_key"))
    by_row = (
        matches(docs, ["row_key"], threshold)
        .groupBy("row_key")
        .agg(F.collect_set("label").alias("found"), F.max("containment").alias("best"))
    )
    base = with_base(docs).select(
        "doc_id",
        "row_key",
        "n_words",
        F.expr("CAST(size(places) AS BIGINT)").alias("n_base"),
        F.expr("array_min(transform(places, x -> x.place))").alias("first_word"),
        F.expr("array_max(transform(places, x -> x.place))").alias("last_word"),
        F.expr("array_sort(array_distinct(transform(places, x -> x.label)))").alias("base"),
    )
    return base.join(by_row, "row_key", "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.expr("array_join(array_sort(array_union(base, coalesce(found, CAST(array() AS array<string>)))), ',')").alias("labels"),
        F.expr("CASE WHEN n_base > 0 THEN 1D ELSE coalesce(best, 0D) END").alias("score"),
    )
