"""Licence scans: a trained classifier of sentences of paragraphs, made of DataFrame functions only.

A sentence goes on over the line ends of its paragraph, so a notice wrapped at some column is judged whole. Words and pairs of words of a paragraph fall into hashed buckets. One logistic regression over them says whether the
paragraph is a licence notice at all, calibrated so that the rest is the probability of the unknown class; a second
one says which family. What is predicted is compared with the family's templates and so confirmed or not. The
weights are fitted by the driver on a bounded sample; scoring is a lookup of array elements.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.llm.labelled import sampled

# Buckets of the hashed features.
BUCKETS = 1 << 15
# Variants of each template, documents and paragraphs of them that the classifier is fitted on.
VARIANTS = 40
TRAINING_DOCUMENTS = 1_000
TRAINING_PARAGRAPHS = 4_000

LINE_END = r"\r\n|\r|\n"
SENTENCE_END = r"\s(?<=[.!?]\s)\s*(?=\p{Lu})"
# What a comment has at the beginning of its lines.
COMMENT = r"^[ \t]*(?:(?:#+|/\*+|\*+/|\*+|//+|--+|;+|%+|<!--)(?=[ \t]|$)[ \t]*)+"
# No text is wrapped at more columns; longer lines are paragraphs of their own.
WRAP_COLUMNS = 200
# Stand around a line's number where lines are put together, and before groups and sentences: noncharacters. In a text they are
# read as U+FFFD, the sign for what is no character.
_MARK, _END, _NEXT = "\ufdd0", "\ufdd1", "\ufdd2"

# Notices by family, with a name for each.
TEMPLATES = (
    ("MIT", "MIT-short", "Released under the MIT License."),
    ("MIT", "MIT-licensed", "This project is licensed under the MIT License, see the LICENSE file for details."),
    ("MIT", "MIT-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files, to deal in the Software without restriction, including without limitation the rights "
     "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software."),
    ("Apache-2.0", "Apache-short", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
     "except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL", "GPL-short", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "GPL-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
     "option) any later version."),
    ("LGPL", "LGPL-short", "This library is licensed under the GNU Lesser General Public License, version 2.1 or later."),
    ("AGPL", "AGPL-short", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "BSD-short", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD", "BSD-licensed", "Released under the 3-Clause BSD License."),
    ("BSD", "BSD-grant", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
     "that the following conditions are met"),
    ("MPL-2.0", "MPL-header", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
     "the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC-BY", "CC-BY-short", "Licensed under CC BY 4.0."),
    ("CC-BY", "CC-BY-long", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA", "CC-BY-SA-short", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA", "CC-BY-SA-long", "Content is available under the Creative Commons Attribution-ShareAlike License."),
    ("CC-BY-NC", "CC-BY-NC-short", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC", "CC-BY-NC-long", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0", "CC0-short", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("CC0", "CC0-dedication", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("ISC", "ISC-short", "Released under the ISC License."),
    ("ISC", "ISC-grant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
     "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "Unlicense-short", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All-rights", "All rights reserved. No part of this publication may be reproduced without prior written permission."),
)
# What licence identifiers of a family begin with, in lines such as "SPDX-License-Identifier: MIT".
IDENTIFIERS = (
    ("MIT", "MIT"), ("Apache-2.0", "Apache-2.0"), ("GPL", "GPL"), ("LGPL", "LGPL"), ("AGPL", "AGPL"), ("BSD", "BSD"),
    ("MPL-2.0", "MPL-2.0"), ("CC-BY", "CC-BY"), ("CC-BY-SA", "CC-BY-SA"), ("CC-BY-NC", "CC-BY-NC"), ("CC0", "CC0-1.0"),
    ("ISC", "ISC"), ("Unlicense", "Unlicense"),
)
IDENTIFIER_LINE = "SPDX-License-Identifier: "
# Paragraphs with words of licences that are none.
ORDINARY = (
    "You need a driving licence to rent a car.", "The license plate of the car was found under the bridge.",
    "She works as a copyright lawyer in the public domain of politics.", "The software was released in version 3 last year.",
    "This work is about the general public and its rights.", "Copies of the book are sold without any warranty.",
    "The university is located in Massachusetts, and MIT is its name.", "The Apache helicopter landed under heavy fire.",
    "Free of charge for any person over sixty.", "The terms of the agreement were published by the foundation.",
    "A commercial break interrupted the creative work.", "Permission to land was granted by the tower.",
)


def normalised(text: Column) -> Column:
    """Lower-case letters and digits with one space between words."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _pairs(words: Column) -> Column:
    n = F.size(words)
    later = F.slice(words, 2, F.greatest(n - 1, F.lit(0)))
    return F.filter(F.zip_with(words, later, lambda a, b: F.concat(a, F.lit(" "), b)), lambda p: p.isNotNull())


def _buckets(grams: Column) -> Column:
    return F.transform(grams, lambda g: F.pmod(F.xxhash64(g), F.lit(BUCKETS)).cast("int"))


def _once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """df with the column; filters on it are not pushed below, where they would compute it again for each use."""
    return df.select("*", F.explode(F.array(column)).alias(name))


def with_features(paragraphs: DataFrame, text: str = "paragraph") -> DataFrame:
    """paragraphs with ``words`` and ``features``, the bucket of each word and each pair of words."""
    worded = _once(paragraphs, "words", F.split(normalised(F.col(text)), " "))
    return _once(worded, "features", _buckets(F.concat("words", _pairs(F.col("words")))))


@dataclass(frozen=True)
class Model:
    """Weights by bucket: of being a licence at all, with its calibration, and of each family."""

    families: tuple[str, ...]
    gate: np.ndarray
    gate_bias: float
    slope: float
    shift: float
    family: np.ndarray
    family_bias: np.ndarray


def _constant(values, kind: str) -> Column:
    """An array of numbers as a constant of the plan."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float, rounds: int = 300) -> tuple[np.ndarray, np.ndarray]:
    """Softmax regression by accelerated gradient steps; y has one column for each class."""
    w, b = np.zeros((x.shape[1], y.shape[1])), np.zeros(y.shape[1])
    v, c, step = w.copy(), b.copy(), 4.0 / (1 + 4 * ridge)
    for k in range(rounds):
        z = x @ v + c
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        new_w = v - step * (x.T @ (p - y) / len(x) + ridge * v)
        new_b = c - step * (p - y).mean(axis=0)
        v, c = new_w + k / (k + 3) * (new_w - w), new_b + k / (k + 3) * (new_b - b)
        w, b = new_w, new_b
    return w, b


def fit(features: list[list[int]], families: list[str | None], ridge: float = 1e-5) -> Model:
    """A model of paragraphs given by their buckets and family (None: no licence).

    The gate is fitted on four fifths and calibrated on the rest; buckets of no licence paragraph weigh nothing.
    """
    names = tuple(sorted({f for f in families if f}))
    used = sorted({i for x, f in zip(features, families) if f for i in x})
    place = {bucket: i for i, bucket in enumerate(used)}
    x = np.zeros((len(features), len(used)))
    for row, buckets in enumerate(features):
        for bucket in buckets:
            if bucket in place:
                x[row, place[bucket]] += 1 / np.sqrt(len(buckets))
    licence = np.array([f is not None for f in families])
    rest = np.arange(len(features)) % 5 == 4
    w, b = _logistic(x[~rest], np.stack([~licence[~rest], licence[~rest]], axis=1).astype(float), ridge)
    gate, bias = w[:, 1] - w[:, 0], float(b[1] - b[0])
    margin, target = x[rest] @ gate + bias, licence[rest].astype(float)
    design, beta = np.stack([np.ones(len(margin)), margin], axis=1), np.array([0.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        beta -= np.linalg.solve((design.T * (p * (1 - p))) @ design + 0.1 * np.eye(2),
                                design.T @ (p - target) + 0.1 * (beta - [0, 1]))
    own = np.array([[f == n for n in names] for f in families if f], dtype=float)
    fw, fb = _logistic(x[licence], own, ridge)

    def spread(weights: np.ndarray) -> np.ndarray:
        full = np.zeros((BUCKETS, *weights.shape[1:]))
        full[used] = weights
        return full

    return Model(names, spread(gate), bias, float(beta[1]), float(beta[0]), spread(fw), fb)


def _variants(spark: SparkSession) -> DataFrame:
    """Templates with some of their words left out, and with foreign words around, by a hash."""
    texts = [(f, t) for f, _, t in TEMPLATES] + [(f, IDENTIFIER_LINE + name) for f, name in IDENTIFIERS]
    templates = spark.createDataFrame(texts, "family string, text string")
    each = templates.withColumn("text", F.explode(F.split("text", SENTENCE_END))).withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))))
    words = F.split(normalised(F.col("text")), " ")
    kept = F.filter(words, lambda w, i: F.pmod(F.xxhash64("v", w, i), F.lit(20)) >= F.col("v") % 5)
    foreign = F.transform(F.sequence(F.lit(1), F.col("v") % 3), lambda k: F.concat(F.lit("x"), F.hex(F.xxhash64("v", k) % 9999)))
    around = F.when(F.col("v") % 3 == 0, kept).when(F.col("v") % 3 == 1, F.concat(foreign, kept)).otherwise(F.concat(kept, foreign))
    return each.select("family", F.array_join(around, " ").alias("paragraph"))


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, line, nth, paragraph, parts): the sentences of each text, but for blank ones.

    ``line`` is where the sentence begins, ``nth`` its place there, both from 0. A sentence goes on over line ends
    up to a blank line, a line of more than WRAP_COLUMNS or a sentence end; comment marks are no part of it. One of
    several lines has ``parts``, what stands in each of them: (line, nth, paragraph).
    """
    marks = F.contains(text, F.lit(_MARK)) | F.contains(text, F.lit(_END)) | F.contains(text, F.lit(_NEXT))
    plain = F.when(marks, F.translate(text, _MARK + _END + _NEXT, "\ufffd" * 3)).otherwise(F.col(text))
    lines = _once(docs.select(F.col(id_col).alias("id"), plain.alias("text")), "lines", F.split("text", LINE_END))
    lines = _once(lines, "cleaned", F.transform("lines", lambda x: F.when(
        F.substring(F.ltrim(x), 1, 1).rlike("[#/*;%<\\t-]"), F.regexp_replace(x, COMMENT, "")).otherwise(x))).select(
        "id", F.col("cleaned").alias("lines"))

    def begins(line: Column, i: Column) -> Column:
        before = F.get("lines", i - 1)
        apart = (F.trim(before) == "") | (F.trim(line) == "") | (F.length(before) > WRAP_COLUMNS) | (F.length(line) > WRAP_COLUMNS)
        return (i == 0) | apart | (F.substring(F.rtrim(before), -1, 1).isin(".", "!", "?") & F.substring(F.ltrim(line), 1, 1).rlike(r"\p{Lu}"))

    # A group is a line and those that go on from it, each behind its number between marks.
    marked = F.transform("lines", lambda x, i: F.concat(
        F.when(begins(x, i), F.lit(_END)).otherwise(F.lit(" ")), F.lit(_MARK), i.cast("string"), F.lit(_MARK), x))
    groups = lines.select("id", F.explode(F.split(F.substring(F.array_join(marked, ""), 2, (1 << 31) - 1), _END)).alias("group"))
    number = rf"{_MARK}(\d+){_MARK}"
    groups = _once(groups, "sentences", F.split("group", SENTENCE_END.replace(r"(?=", rf"(?=(?:{number})?")))
    # A block is a sentence in which lines begin and those after it in which none does.
    blocked = F.transform("sentences", lambda x: F.concat(F.when(F.contains(x, F.lit(_MARK)), F.lit(_END)).otherwise(F.lit(_NEXT)), x))
    blocks = groups.select("id", F.split(F.substring(F.array_join(blocked, ""), 2, (1 << 31) - 1), _END).alias("blocks"))
    blocks = _once(blocks, "sentences", F.transform("blocks", lambda x: F.split(x, _NEXT))).drop("blocks")
    blocks = _once(blocks, "placed", F.transform("sentences", lambda x: F.struct(
        F.regexp_extract(x[0], rf"(?s)^.*{number}", 1).try_cast("int").alias("last"), x.alias("sentences")))).drop("sentences")
    blocks = blocks.select("id", F.explode(F.transform("placed", lambda x, i: F.struct(
        x["last"].alias("last"), x["sentences"].alias("sentences"),
        F.get("placed", i - 1)["last"].alias("before"), F.size(F.get("placed", i - 1)["sentences"]).alias("behind")))).alias("block"))
    each = blocks.select("id", "block.last", "block.before", "block.behind", F.posexplode("block.sentences").alias("k", "sentence"))
    lead = F.when(F.startswith("sentence", F.lit(_MARK)), F.regexp_extract("sentence", rf"^{number}", 1).try_cast("int"))
    each = _once(each, "lead", lead)
    each = each.withColumn("seen", F.when(F.col("k") > 0, F.col("last")).otherwise(F.coalesce("lead", "before")))
    each = each.withColumn("nth", F.when(F.col("k") > 0, F.col("k")).when(F.col("lead").isNotNull(), 0).otherwise(F.col("behind")))
    pieces = F.split("sentence", rf"(?={number})")
    parts = F.transform(pieces, lambda x: F.struct(
        F.coalesce(F.regexp_extract(x, rf"^{number}", 1).try_cast("int"), F.col("seen")).alias("line"),
        F.when(F.startswith(x, F.lit(_MARK)), 0).otherwise(F.col("nth")).alias("nth"),
        F.trim(F.regexp_replace(x, number, "")).alias("paragraph")))
    several = (F.col("k") == 0) & (F.col("lead").isNull() | (F.col("lead") < F.col("last")))
    text = F.when(F.contains("sentence", F.lit(_MARK)), F.regexp_replace("sentence", number, "")).otherwise(F.col("sentence"))
    split = each.select("id", F.col("seen").alias("line"), "nth", text.alias("paragraph"),
                        F.when(several, parts).alias("parts"))
    return split.filter(F.trim("paragraph") != "")


def train(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> Model:
    """A model fitted on variants of the templates and on at most TRAINING_PARAGRAPHS paragraphs of the documents.

    Paragraphs that share three words in a row with a template are no examples of the unknown class.
    """
    spark = docs.sparkSession
    ids = sampled(docs.select(id_col).filter(F.col(id_col).isNotNull()).distinct(), id_col, TRAINING_DOCUMENTS)
    some = paragraphs(docs.join(F.broadcast(ids), id_col), id_col, text)
    some = some.orderBy(F.xxhash64("id", "line", "nth"), "id", "line", "nth").limit(TRAINING_PARAGRAPHS)
    ordinary = spark.createDataFrame([(t,) for t in ORDINARY for _ in range(5)], "paragraph string")
    known = {g for _, _, t in TEMPLATES for g in _triples(_plain(t))}
    unknown = with_features(some.select("paragraph").union(ordinary)).select("words", "features").collect()
    licences = with_features(_variants(spark)).select("family", "features").collect()
    examples = [(r[1], r[0]) for r in licences if r[1]]
    examples += [(r[1], None) for r in unknown if known.isdisjoint(_triples(r[0])) or len(r[0]) < 3]
    order = np.random.default_rng(1).permutation(len(examples))
    return fit([list(examples[i][0]) for i in order], [examples[i][1] for i in order])


def _plain(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def _triples(words: list[str]) -> set[tuple[str, ...]]:
    return set(zip(words, words[1:], words[2:]))


def _template_table() -> Column:
    """The templates as an array of structs: family, name, pairs of words, and whether only all of them count, as of an identifier."""
    texts = [(f, n, t, False) for f, n, t in TEMPLATES]
    texts += [(f, f"{f}-identifier", IDENTIFIER_LINE + name, True) for f, name in IDENTIFIERS]
    rows = [{"family": f, "name": n, "whole": whole, "pairs": sorted({" ".join(p) for p in zip(w, w[1:])})}
            for f, n, t, whole in texts for w in [_plain(t)]]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<family:string,name:string,whole:boolean,pairs:array<string>>>")


def _summed(weights: Column) -> Column:
    """The weights of all features of a paragraph together."""
    return F.aggregate("features", F.lit(0.0), lambda total, i: total + F.get(weights, i))


def _licensed(rows: DataFrame, model: Model) -> DataFrame:
    """rows with their features and ``licence``, the probability that a paragraph is a licence notice at all."""
    gate = _constant(np.round(model.gate, 5).tolist(), "array<double>")
    margin = _summed(gate) / F.sqrt(F.size("features")) + model.gate_bias
    return _once(with_features(rows), "licence", 1 / (1 + F.exp(-(F.lit(model.slope) * margin + model.shift))))


def _named(rows: DataFrame, model: Model, at_least: float) -> DataFrame:
    """rows with the ``best`` family, its ``share`` of the probability, and the ``template`` of it that is most alike; null for no licence."""
    norm, scores = F.sqrt(F.size("features")), []
    for k, name in enumerate(model.families):
        weights = _constant(np.round(model.family[:, k], 5).tolist(), "array<double>")
        score = _summed(weights) / norm + float(model.family_bias[k])
        scores.append(F.struct(score.alias("score"), F.lit(-k).alias("order"), F.lit(name).alias("family")))
    scored = _once(rows, "scores", F.when(F.col("licence") >= at_least, F.array(*scores))).withColumn("best", F.array_max("scores"))
    rest = F.aggregate("scores", F.lit(0.0), lambda total, s: total + F.exp(s["score"] - F.col("best.score")))
    scored = _once(scored.withColumn("share", 1 / rest), "pairs", F.array_distinct(_pairs(F.col("words"))))
    own = F.filter(_template_table(), lambda t: t["family"] == F.col("best.family"))

    def compared(t: Column, i: Column) -> Column:
        common = F.size(F.array_intersect(t["pairs"], F.col("pairs")))
        shared = common / F.greatest(F.lit(1), F.least(F.size(t["pairs"]), F.size("pairs")))
        similarity = F.when(~t["whole"], shared).otherwise(F.floor(common / F.size(t["pairs"])).cast("double"))
        return F.struct(similarity.alias("similarity"), (-i).alias("order"), t["name"].alias("name"), (common / F.size(t["pairs"])).alias("held"))

    return _once(scored, "template", F.array_max(F.transform(own, compared)))


def found(docs: DataFrame, model: Model, at_least: float = 0.5, similar: float = 0.6, id_col: str = "doc_id",
          text: str = "text") -> DataFrame:
    """The paragraphs of the texts, sentence by sentence, that are licence notices.

    Columns: id, paragraph (its line, from 0), sentence (its place in the line), text, family, probability (of this family), unknown (probability that
    it is no licence), template, similarity, confirmed. A paragraph is given if it is no licence with a probability
    under ``1 - at_least``, and confirmed if it shares ``similar`` of its pairs of words, or of the template's if
    those are fewer, with a template of the family. A sentence of several lines is judged as one; its lines are
    given, too, if it is not confirmed, or if they hold as much of a template of another family; and given instead of it if
    one of them alone holds what it shares with the template. Null and empty texts
    give no rows, nor do documents without notices; U+FDD0 to U+FDD2 are given as U+FFFD. A line with a licence identifier is
    confirmed if that begins with one of the family's; of several identifiers in a line one is named. Repeated rows and ids give their rows again; ties go to the family
    and template that comes first.
    """
    kept = ["id", "line", "nth", "paragraph"]
    wholes = _licensed(paragraphs(docs, id_col, text), model).filter((F.col("licence") >= at_least) | F.col("parts").isNotNull())
    wholes = _once(_named(wholes, model, at_least), "whole", F.when(
        (F.col("licence") >= at_least) & (F.col("template.similarity") >= similar), F.col("best.family")))
    best = F.filter(_template_table(), lambda t: (t["family"] == F.col("whole")) & (t["name"] == F.col("template.name")))[0]["pairs"]

    def shared(text: Column) -> Column:
        return F.size(F.array_intersect(best, _pairs(F.split(normalised(text), " "))))

    wholes = _once(wholes, "alone", F.when(F.col("whole").isNotNull() & F.col("parts").isNotNull(), F.exists(
        "parts", lambda p: shared(p["paragraph"]) >= shared(F.col("paragraph")))).otherwise(False))
    wholes = wholes.withColumn("whole", F.when(~F.col("alone"), F.col("whole")))
    own = F.when((F.col("licence") >= at_least) & ~F.col("alone"), F.array(F.struct(*kept[1:], F.lit(None).cast("string").alias("whole"))))
    lines = F.transform("parts", lambda p: F.struct(*(p[c].alias(c) for c in kept[1:]), F.coalesce("whole", F.lit("")).alias("whole")))
    nothing = F.filter(lines, lambda _: F.lit(False))
    candidates = F.when(F.col("parts").isNull(), own).otherwise(F.concat(F.coalesce(own, nothing), lines))
    judged = wholes.select("id", F.inline(candidates))
    judged = _named(_licensed(judged, model).filter(F.col("licence") >= at_least), model, at_least)
    other = (F.col("best.family") != F.col("whole")) & (F.col("template.held") >= similar) & (F.col("template.similarity") >= similar)
    given = judged.filter(F.col("whole").isNull() | (F.col("whole") == "") | other)
    return given.select(
        F.col("id").alias(id_col), F.col("line").cast("long").alias("paragraph"), F.col("nth").cast("long").alias("sentence"),
        F.col("paragraph").alias(text), F.col("best.family").alias("family"), (F.col("licence") * F.col("share")).alias("probability"),
        (1 - F.col("licence")).alias("unknown"), F.col("template.name").alias("template"),
        F.col("template.similarity").alias("similarity"), (F.col("template.similarity") >= similar).alias("confirmed"))
