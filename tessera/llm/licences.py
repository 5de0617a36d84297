"""Operator 8: licence notices by a trained paragraph classifier (DataFrame functions only).

A paragraph is a line of text, or a run of adjacent lines (no blank line between
them) whose line breaks count as spaces, so that hard-wrapped notices are found as
well as one-line notices amid prose. Its features are the words and word pairs of
it that occur in the licence templates. A sparse multinomial logistic regression
(Spark ML), trained on varied templates and on other paragraphs of the corpus,
gives a log-odds per licence family and for "no licence". A second, one-column
regression on paragraphs the first has not seen calibrates the margin between
the best family and "no licence"; below one half the paragraph is unknown. A
prediction is confirmed when the paragraph also holds most of the word pairs of
one of the family's templates. Of confirmed paragraphs that overlap, the one that
holds most pairs counts, then the one of fewest lines, then the first; a line inside
a confirmed run is no paragraph of its own.

Every line that holds words is scored (rules and bullets are not, and do not part a run). Runs are scored in blocks (lines between blank lines) that
hold most pairs of some template, as no run of another block can be confirmed; a run
goes on until it has ``RUN_WORDS`` words, so it has no more lines than that.

Scoring is expressions over the rows of the table: no shuffle, no Python. Every
feature holds an anchor word (a template word that is no function word); a text
without one has no features at all, so its paragraphs are unknown without being
scored. Training takes a bounded sample next to the templates: ``SAMPLE_LINES`` lines
of each of ``SAMPLE_DOCS`` texts, picked by hash, so the model is the same however the
table is partitioned. Null and empty texts have no paragraphs; very long ones are scored
whole; copies and ties get equal results; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.text import NON_SPACE_CLASS, only, text_or_empty

#: documents whose paragraphs serve as examples of no licence, and lines taken of each
SAMPLE_DOCS, SAMPLE_LINES = 400, 8
#: varied copies made of each template
VARIANTS = 24
#: share of a template's word pairs that confirms a prediction
CONFIRM = 0.6
NONE = "none"
TOKEN = r"([a-z0-9]+(?:[.\-+][a-z0-9]+)*)"

# fixed values: usual notices, by licence family
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction, including without limitation the rights to "
            "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the "
                   "License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or any later "
                "version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License version 2 as published by the Free Software Foundation."),
    ("LGPL", "This library is licensed under the GNU Lesser General Public License."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("BSD", "Use of this source code is governed by a BSD-style license."),
    ("BSD", "Released under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0."),
    ("CC0", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
    ("Proprietary", "Copyright. All rights reserved. No part of this publication may be reproduced without prior written permission."),
)

# fixed values: sentences with licence words that are no notices
OTHER = (
    "You need a driving license to rent this car.", "The film was released under a new title in 2004.",
    "Version 2.0 of the report is out now.", "Public transport is free of charge on Sunday.",
    "The general public may use the source of the river.", "She granted permission to copy the form.",
    "The author has a right to modify the terms of the work.", "All seats reserved for members.",
    "The software is easy to use and to distribute.", "His license was revoked by the city.",
    "Creative work and the commons of the village.", "The GNU project and the MIT campus were mentioned.",
    "The Apache people lived in the south.", "Please read the notice at the door.",
    "A copy of the book is in the library, version 3 is not.", "The foundation published a free program of talks.",
    "Human rights are the rights of all.", "The conditions are met by most of the files.",
)

# fixed values: function words that are no anchors
FUNCTION_WORDS = frozenset(
    "a all and any are as at be by can except for from has have in into is it its may most no not of on or other out part "
    "prior provided that the their this to was were will with without you your he she his her they one either later above "
    "following each new now use work form people author person".split())


def _tokens(text: str) -> list[str]:
    """Words of a template; the driver's form of ``words`` (templates only)."""
    import re

    return re.findall(TOKEN, text.lower())


def _pairs(tokens: list[str]) -> list[str]:
    return [f"{a} {b}" for a, b in zip(tokens, tokens[1:])]


#: words after which a run of lines is not carried on: twice the longest template
RUN_WORDS = 2 * max(len(_tokens(t)) for _, t in TEMPLATES)
BLANK_LINES = r"\n[\x20\x09-\x0D]*\n"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(1))


def grams(tokens: Column) -> Column:
    """Distinct words and adjacent pairs."""
    n = F.size(tokens)
    pairs = F.when(n > 1, F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.concat_ws(
        " ", F.get(tokens, i - 1), F.get(tokens, i)))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(tokens, pairs))


def anchors() -> list[str]:
    return sorted({t for _, text in TEMPLATES for t in _tokens(text)} - FUNCTION_WORDS)


def vocabulary() -> list[str]:
    """Template words and pairs that hold an anchor."""
    known = set(anchors())
    pairs = {p for _, text in TEMPLATES for p in _pairs(_tokens(text)) if known & set(p.split())}
    return sorted(known | pairs)


def families() -> list[str]:
    return sorted({f for f, _ in TEMPLATES})


@dataclass(frozen=True)
class Model:
    """Class names (``NONE`` first), bias per class, weights per feature, and the calibration of the margin."""

    names: list[str]
    bias: list[float]
    weights: dict[str, list[float]]
    slope: float
    offset: float


def _array(values, kind: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")


def _logits(present: Column, model: Model) -> Column:
    """Log-odds per class of one paragraph's features."""
    if not model.weights:
        return _array(model.bias, "double")
    table = F.map_from_arrays(_array(model.weights, "string"),
                              F.array(*[_array(w, "double") for w in model.weights.values()]))
    return F.aggregate(present, _array(model.bias, "double"), lambda acc, g: F.zip_with(acc, table[g], lambda a, b: a + b))


def _margin(logits: Column) -> Column:
    """Best family's log-odds over "no licence"."""
    return F.array_max(F.slice(logits, 2, 1 << 20)) - F.get(logits, F.lit(0))


def _literal_rows(spark: SparkSession, rows: list[tuple[int, int, str]]) -> DataFrame:
    """``label, k, text`` rows of a fixed list, as literals of the plan."""
    structs = [F.struct(F.lit(a).alias("label"), F.lit(k).alias("k"), F.lit(t).alias("text")) for a, k, t in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def training_rows(docs: DataFrame, text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``label, present, part``: varied templates, and paragraphs of the corpus and fixed sentences as no licence.

    A variant leaves out about one word in ten, by a hash, and is set among
    words of an ordinary sentence. ``part`` splits the rows for fit and calibration.
    """
    spark = docs.sparkSession
    classes = families()
    known = _literal_rows(spark, [(classes.index(f) + 1, k, t) for k, (f, t) in enumerate(TEMPLATES)])
    known = known.select("label", "k", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))).alias("v"), "text") \
        .withColumn("t", words(F.col("text")))
    filler = words(F.element_at(_array(OTHER, "string"), (F.pmod(F.hash("k", "v"), F.lit(len(OTHER))) + 1).cast("int")))
    known = known.withColumn("t", F.when(F.col("v") % 3 == 0, F.col("t")).otherwise(F.filter(
        "t", lambda x, i: F.pmod(F.hash("k", "v", i), F.lit(10)) != 0))) \
        .withColumn("t", F.when(F.col("v") % 2 == 1, F.concat(filler, F.col("t"))).otherwise(F.col("t")))
    fixed = _literal_rows(spark, [(0, k, t) for k, t in enumerate(OTHER)]) \
        .select("label", "k", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("v"), words(F.col("text")).alias("t"))
    # lines of the corpus that hold half the pairs of a template may be notices and teach nothing about others
    # (words and grams are bound to a name wherever a lambda reads them, or they would be made anew for every element)
    once = lambda t: _let(t, lambda x: grams(x))
    notice = lambda t: _let(once(t), lambda g: F.when(F.arrays_overlap(g, pairs), reduce(lambda a, b: a | b, [
        F.size(F.array_intersect(g, _array(p, "string"))) >= 0.5 * len(p) for p in (_pairs(_tokens(t)) for _, t in TEMPLATES)]))
        .otherwise(F.lit(False)))
    pairs = _array([v for v in vocabulary() if " " in v], "string")
    # so may lines with template pairs in a block that holds half a template: pieces of a wrapped notice
    blocks = sample_texts(docs, text_col, sample_docs) \
        .select("doc", F.explode(F.split("text", BLANK_LINES)).alias("block")) \
        .select("doc", F.split("block", "\n").alias("lines"), notice(words(F.col("block"))).alias("piece"))
    lines = blocks.select("doc", "piece", F.explode("lines").alias("text")) \
        .select("doc", "piece", F.xxhash64("text").alias("k"), words(F.col("text")).alias("t"))
    lines = lines.filter((F.size("t") > 0) & ~(notice(F.col("t")) | (F.col("piece") & F.arrays_overlap(once(F.col("t")), pairs)))) \
        .dropDuplicates(["doc", "k"])
    first = Window.partitionBy("doc").orderBy("k")
    lines = lines.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= SAMPLE_LINES) \
        .select(F.lit(0).alias("label"), "k", F.lit(0).alias("v"), "t")
    rows = known.select("label", F.col("k").cast("long"), "v", "t") \
        .unionByName(fixed.withColumn("k", F.col("k").cast("long"))).unionByName(lines)
    return rows.select("label", F.array_intersect(once(F.col("t")), _array(vocabulary(), "string")).alias("present"),
                       F.pmod(F.hash("label", "k", "v"), F.lit(3)).alias("part"))


def sample_texts(docs: DataFrame, text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``doc, text`` of the ``sample_docs`` distinct texts of smallest hash: the hashes are picked first, then the texts of
    those alone are read, so the pick depends on nothing but the texts."""
    hashed = only(docs, text_col).select(text_or_empty(text_col).alias("text")).withColumn("doc", F.xxhash64("text"))
    picked = [r["doc"] for r in hashed.select("doc").distinct().orderBy("doc").limit(sample_docs).collect()]
    return hashed.filter(F.col("doc").isin(picked)).dropDuplicates(["doc"])


def fit(docs: DataFrame, text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Train on two thirds of the rows and calibrate on the rest (both bounded)."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    names, vocab = [NONE, *families()], vocabulary()
    # one bounded partition in one order: the same weights however the table is partitioned
    rows = training_rows(docs, text_col, sample_docs).repartition(1).sortWithinPartitions("label", "part", "present").cache()
    try:
        dense = F.transform(_array(vocab, "string"), lambda g: F.array_contains("present", g).cast("double"))
        data = rows.filter("part < 2").select(F.col("label").cast("double"), array_to_vector(dense).alias("features"))
        lr = LogisticRegression(family="multinomial", regParam=2e-3, elasticNetParam=0.5, maxIter=60, standardization=False)
        fitted = lr.fit(data)
        coef, bias = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
        weights = {g: [float(x) for x in coef[:, j]] for j, g in enumerate(vocab) if abs(coef[:, j]).max() > 1e-6}
        model = Model(names, [float(b) for b in bias], weights, 1.0, 0.0)
        known = F.filter("present", lambda g: F.array_contains(_array(weights or [""], "string"), g))
        margin = rows.filter("part = 2").select((F.col("label") > 0).cast("double").alias("label"),
                                                _margin(_logits(known, model)).alias("m"))
        calibrated = LogisticRegression(regParam=1e-3, standardization=False).fit(
            margin.select("label", array_to_vector(F.array("m")).alias("features")))
        return Model(names, model.bias, weights, float(calibrated.coefficients[0]), float(calibrated.intercept))
    finally:
        rows.unpersist()


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _held(g: Column, name: str | None = None) -> Column:
    """Most pairs of one template (of the family ``name``, or of any) that a paragraph's features confirm; 0: none."""
    def confirmed(pairs: list[str]) -> Column:
        return _let(F.size(F.array_intersect(g, _array(pairs, "string"))),
                    lambda n: F.when(n >= CONFIRM * len(pairs), n).otherwise(F.lit(0)))

    return F.array_max(F.array(*map(confirmed, _template_pairs(name))))


def _may_hold(block: Column) -> Column:
    """Whether the lines of a block together hold most pairs of a template (some of which always hold an anchor)."""
    pairs = _array([v for v in vocabulary() if " " in v], "string")
    return _let(F.flatten(block), lambda t: _let(grams(t), lambda g: F.when(
        F.arrays_overlap(g, pairs), _held(g) > 0).otherwise(F.lit(False))))


def _template_pairs(name: str | None) -> list[list[str]]:
    return [sorted(set(_pairs(_tokens(t)))) for f, t in TEMPLATES if name in (None, f)]


def _best(g: Column, model: Model) -> Column:
    """The best class of a paragraph's features, and its calibrated chance."""
    known = _array(model.weights or [""], "string")
    return _let(_logits(F.array_intersect(g, known), model), lambda x: F.struct(
        (1 / (1 + F.exp(-(F.lit(model.slope) * _margin(x) + F.lit(model.offset))))).alias("p"),
        (F.array_position(F.slice(x, 2, 1 << 20), F.array_max(F.slice(x, 2, 1 << 20)))).cast("int").alias("k")))


def _judged(toks: Column, model: Model) -> Column:
    """``p, k, held`` of one paragraph: best class, its chance, and the template pairs that confirm it."""
    def held(g: Column, k: Column) -> Column:
        out = F.lit(0)
        for i, name in enumerate(model.names[1:]):
            out = F.when(k == i + 1, _held(g, name)).otherwise(out)
        return out

    return _let(grams(toks), lambda g: _let(_best(g, model), lambda b: F.struct(
        b["p"].alias("p"), b["k"].alias("k"), F.when(b["p"] >= 0.5, held(g, b["k"])).otherwise(F.lit(0)).alias("held"))))


def _runs(lines: Column, first: Column) -> Column:
    """Words of the runs of lines that begin at line ``first`` (from 0): of the line alone, with the next line, and so on.

    A longer run needs only the end of its first line and the beginning of the others, and every line holds a word.
    """
    tail = lambda t: F.when(F.size(t) > RUN_WORDS, F.slice(t, -RUN_WORDS, RUN_WORDS)).otherwise(t)
    line = F.get(lines, first)
    rest = F.aggregate(
        F.slice(lines, first + 2, 2 * RUN_WORDS), F.array(tail(line)),
        lambda acc, x: F.when(F.size(F.element_at(acc, -1)) >= 2 * RUN_WORDS, acc).otherwise(
            F.concat(acc, F.array(F.concat(F.element_at(acc, -1), F.slice(x, 1, RUN_WORDS))))))
    return F.concat(F.array(line), F.slice(rest, 2, 1 << 30))


def _confirmed(lines: Column, model: Model) -> Column:
    """``first, last, k, p`` of the confirmed paragraphs of a block, no two of which overlap."""
    def of_line(s: Column) -> Column:
        judged = F.transform(_runs(lines, s), lambda toks, j: F.struct(
            j.alias("more"), _judged(toks, model).alias("x")))
        # a run that holds no more than a shorter one of the same beginning is never chosen
        return _let(F.filter(judged, lambda r: r["x"]["held"] > 0), lambda found: F.transform(
            F.filter(found, lambda r: ~F.exists(found, lambda q: (q["more"] < r["more"]) & (q["x"]["held"] >= r["x"]["held"]))),
            lambda r: F.struct((-r["x"]["held"]).alias("rank"), r["more"].alias("more"), s.alias("first"),
                               (s + r["more"]).alias("last"), r["x"]["k"].alias("k"), r["x"]["p"].alias("p"))))

    found = F.array_sort(F.flatten(F.transform(F.sequence(F.lit(0), F.size(lines) - 1), of_line)))
    none = F.array().cast("array<struct<rank:int,more:int,first:int,last:int,k:int,p:double>>")
    return F.aggregate(found, none, lambda acc, c: F.when(
        F.exists(acc, lambda x: (x["first"] <= c["last"]) & (c["first"] <= x["last"])), acc).otherwise(
            F.concat(acc, F.array(c))))


def scan(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_paragraphs, n_licence, n_confirmed, families, unconfirmed, score`` of every document.

    ``n_paragraphs`` counts the lines that are not blank; ``n_licence`` and
    ``n_confirmed`` count notices, a wrapped one once. ``families`` lists the confirmed
    licence families, ``unconfirmed`` those of predicted lines that no template confirms
    (sorted, comma-joined); ``score`` is the best paragraph's calibrated chance of being
    a licence notice.
    """
    model = fit(docs, text_col) if model is None else model
    rows = only(docs, id_col, text_col).select(F.col(f"`{id_col}`"), text_or_empty(text_col).alias("_text"))
    filled = lambda a: F.filter(a, lambda x: x.rlike(NON_SPACE_CLASS))
    rows = rows.select(id_col, "_text", F.size(filled(F.split("_text", "\n"))).cast("long").alias("n_paragraphs"),
                       F.arrays_overlap(words(F.col("_text")), _array(anchors(), "string")).alias("_any"))
    none = F.array().cast("array<array<array<string>>>")
    rows = rows.withColumn("_blocks", F.when(F.col("_any"), F.transform(
        filled(F.split("_text", BLANK_LINES)), lambda b: F.filter(
            F.transform(filled(F.split(b, "\n")), words), lambda t: F.size(t) > 0))).otherwise(none))
    rows = rows.withColumn("_lines", F.transform("_blocks", lambda b: F.transform(
        b, lambda toks: _best(grams(toks), model))))
    empty = F.array().cast("array<struct<rank:int,more:int,first:int,last:int,k:int,p:double>>")
    rows = rows.withColumn("_sure", F.transform("_blocks", lambda b: F.when(
        _may_hold(b), _confirmed(b, model)).otherwise(empty)))
    rows = rows.withColumn("_unsure", F.flatten(F.zip_with("_lines", "_sure", lambda lines, sure: F.filter(
        F.transform(lines, lambda x, i: F.when((x["p"] >= 0.5) & ~F.exists(
            sure, lambda c: (c["first"] <= i) & (i <= c["last"])), x)), lambda x: x.isNotNull())))) \
        .withColumn("_sure", F.flatten("_sure"))
    names = _array(model.names[1:], "string")
    pick = lambda found: F.array_join(F.array_sort(F.array_distinct(F.transform(
        found, lambda x: F.get(names, x["k"] - 1)))), ",")
    chances = F.concat(F.transform(F.flatten("_lines"), lambda x: x["p"]), F.transform("_sure", lambda x: x["p"]))
    return rows.select(
        id_col, "n_paragraphs", (F.size("_sure") + F.size("_unsure")).cast("long").alias("n_licence"),
        F.size("_sure").cast("long").alias("n_confirmed"),
        pick(F.col("_sure")).alias("families"), pick(F.col("_unsure")).alias("unconfirmed"),
        F.coalesce(F.array_max(chances), F.lit(0.0)).alias("score"))
