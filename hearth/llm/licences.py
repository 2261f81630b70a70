"""Licence scans: a trained paragraph classifier, confirmed by templates.

A paragraph is a line. Its features are the words and word pairs that the
model knows (those of the templates, less the words that are common in
ordinary paragraphs). Multinomial logistic regression over them tells licence
families, other licences (``unknown``) and ordinary text (``none``) apart.
Probabilities are calibrated by a temperature on rows held out of a first fit,
for the unknown class whole licences of it. A family below the least
probability, not like any of its templates, or no more like one of them than
like another licence's wording, becomes ``unknown``.

The model is fitted by the driver on the templates, varied, and on at most
``sample`` paragraphs of the corpus. Scanning uses DataFrame functions only,
row by row, without a shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.lines import normal_words
from hearth.llm.text import once

NONE, UNKNOWN = "none", "unknown"
# Customary wordings of each family (fixed values).
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Released under the BSD 3-Clause License.",
    ],
    "proprietary": ["All rights reserved.", "Proprietary and confidential. All rights reserved."],
}
# Wordings of other licences, from which the unknown class is learned (fixed values).
OTHERS = [
    "Licensed under the Eclipse Public License, version 1.0.",
    "This file is subject to the terms of the Mozilla Public License, version 1.1.",
    "Released under the Artistic License.",
    "This work is licensed under the European Union Public Licence.",
    "Distributed under the terms of the zlib license.",
    "Licensed under the Open Database License.",
    "Released under the Boost Software License.",
    "This work is released under a custom license.",
    # near relatives of the families
    "Licensed under CC BY-SA 4.0.",
    "Licensed under CC BY 4.0.",
    "Licensed under CC BY-ND 4.0.",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "Released under the BSD 2-Clause License.",
    "Licensed under the Apache License, Version 1.1.",
    "This work is licensed under the GNU General Public License, version 2.",
    "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "This work is licensed under the GNU Affero General Public License, version 3.",
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or any later version.",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
]


def grams(words: list[str]) -> list[str]:
    return [*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))]


def plain_words(text: str) -> list[str]:
    """Words of ``lines.normal_words``, for the templates (ASCII)."""
    return [w for w in "".join(c if c.isalnum() else " " for c in text.lower()).split(" ") if w]


def column_grams(words: Column) -> Column:
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1))), lambda i: F.concat_ws(" ", words[i - 1], F.try_element_at(words, (i + 1).cast("int"))))
    return F.concat(words, F.when(F.size(words) > 1, pairs).otherwise(F.array().cast("array<string>")))


def paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.posexplode(F.split(text_col, "\n", -1)).alias("paragraph", "text"))
    return rows.select("*", once(normal_words(F.col("text"))).alias("words"))


@dataclass
class Model:
    """``weights`` (class, gram) and ``bias`` per class, already divided by the temperature; ``classes`` ends in unknown, none."""

    classes: list[str]
    vocabulary: list[str]
    weights: np.ndarray
    bias: np.ndarray
    least: float
    similarity: float

    def features(self, words: list[str]) -> list[str]:
        known = set(self.vocabulary)
        return sorted(set(grams(words)) & known)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, classes: int, l2: float = 0.02, steps: int = 300) -> tuple[np.ndarray, np.ndarray]:
    """Multinomial logistic regression by accelerated gradient steps."""
    x1 = np.column_stack([x, np.ones(len(x))])
    target, w = np.eye(classes)[y], np.zeros((classes, x1.shape[1]))
    weight = weight / weight.sum()
    step = 1.0 / (0.5 * (weight * (x1**2).sum(axis=1)).sum() + l2)
    ahead, t = w, 1.0
    for _ in range(steps):
        slope = ((_softmax(x1 @ ahead.T) - target) * weight[:, None]).T @ x1
        slope[:, :-1] += l2 * 0.01 * ahead[:, :-1]
        new, t_new = ahead - step * slope, (1 + np.sqrt(1 + 4 * t * t)) / 2
        w, ahead, t = new, new + (t - 1) / t_new * (new - w), t_new
    return w[:, :-1], w[:, -1]


def variants(text: str) -> Iterable[list[str]]:
    """A template's words, whole, less each one, and inside other words."""
    words = plain_words(text)
    yield words
    for i in range(len(words) if len(words) > 4 else 0):
        yield words[:i] + words[i + 1 :]
    yield ["copyright", "2020", *words]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 2000, common: float = 0.01, least: float = 0.5, similarity: float = 0.6) -> Model:
    """A model from the templates and the ``sample`` paragraphs with the smallest hashes (equal paragraphs once).

    Sampled paragraphs that hold a template are learned as its family, the
    others as ordinary. Words in more than ``common`` of the ordinary ones are
    no features. Every fifth row and every fourth of the other licences, with
    all its variants, are held out of a first fit to set the temperature; the
    model is fitted on all rows.
    """
    each = docs.select(F.explode(F.split(text_col, "\n", -1)).alias("text")).select("text", F.xxhash64("text").alias("h"))
    chosen = each.select("h").distinct().orderBy("h").limit(sample)
    found = each.join(F.broadcast(chosen), "h").groupBy("h").agg(F.max("text").alias("text")).orderBy("h")  # at most ``sample`` rows
    texts = [r.words for r in found.select(normal_words(F.col("text")).alias("words")).collect() if r.words]
    whole = {tuple(plain_words(t)): c for c, ts in TEMPLATES.items() for t in ts} | {tuple(plain_words(t)): UNKNOWN for t in OTHERS}
    labelled = [(v, c) for c, ts in TEMPLATES.items() for t in ts for v in variants(t)]
    first = len(labelled)
    labelled += [(v, UNKNOWN) for t in OTHERS for v in variants(t)]
    unseen = [False] * first + [k % 4 == 3 for k, t in enumerate(OTHERS) for _ in variants(t)]
    ordinary = []
    for words in texts:
        joined = f" {' '.join(words)} "
        held = [c for t, c in whole.items() if f" {' '.join(t)} " in joined]
        labelled.append((words, held[0] if held else NONE))
        if not held:
            ordinary.append(set(words))
    often = {w for w, n in Counter(chain.from_iterable(ordinary)).items() if n > common * len(ordinary)}
    vocabulary = sorted({g for t in whole for g in grams(list(t))} - often)
    classes = [*TEMPLATES, UNKNOWN, NONE]
    place = {g: i for i, g in enumerate(vocabulary)}
    x = np.zeros((len(labelled) + 1, len(vocabulary)))  # the last: a paragraph without features
    for r, (words, _) in enumerate(labelled):
        x[r, [place[g] for g in grams(words) if g in place]] = 1
    y = np.array([*(classes.index(c) for _, c in labelled), len(classes) - 1])
    weight = 1 / np.bincount(y, minlength=len(classes))[y]
    held = np.arange(len(y)) % 5 == 4
    held[first : len(unseen)] = unseen[first:]
    w, b = _fit(x[~held], y[~held], weight[~held], len(classes))
    scores = x[held] @ w.T + b
    loss = lambda t: -np.log(np.maximum(_softmax(scores / t)[np.arange(len(scores)), y[held]], 1e-12)).mean()
    temperature = min(np.geomspace(0.2, 5, 41), key=loss) if held.any() else 1.0
    w, b = _fit(x, y, weight, len(classes))
    return Model(classes, vocabulary, w / temperature, b / temperature, least, similarity)


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, paragraph, text, family, probability, similarity, confirmed) of the paragraphs that are not ordinary.

    ``paragraph`` counts lines from 0. ``similarity`` is the largest part of a
    template of the predicted family that the paragraph holds, in known words
    and pairs. ``confirmed`` rows have at least the model's probability and
    similarity, and hold a larger part of that template than of any other
    licence's wording; the others are ``unknown``. A paragraph without any known word
    or pair is ordinary. Null and empty texts have no paragraphs to show; of
    equal probabilities the family listed first wins; null ids and repeated
    rows are rows like others; other columns are ignored; an empty table gives
    no rows. Texts and lines of any length are scanned whole.
    """
    vocabulary = F.lit(model.vocabulary) if model.vocabulary else F.array().cast("array<string>")
    known = F.array_intersect(column_grams(F.col("words")), vocabulary)
    rows = paragraphs(docs, id_col, text_col).select("*", once(known).alias("known")).where("size(known) > 0")
    rows = rows.select("*", once(F.transform("known", lambda g: F.array_position(vocabulary, g).cast("int"))).alias("at"))
    total = lambda c: F.aggregate("at", F.lit(float(model.bias[c])), lambda a, i: a + F.element_at(F.lit(model.weights[c].tolist()), i))
    rows = rows.select("*", once(F.array(*(total(c) for c in range(len(model.classes))))).alias("scores"))
    rows = rows.withColumn("top", F.array_max("scores")).withColumn("best", F.array_position("scores", F.col("top")).cast("int"))
    rows = rows.where(F.col("best") < len(model.classes))  # the last is none
    rows = rows.withColumn("probability", 1 / F.aggregate("scores", F.lit(0.0), lambda a, s: a + F.exp(s - F.col("top"))))
    like = [F.lit(0.0)] * len(model.classes)
    for c, texts in enumerate([*TEMPLATES.values(), OTHERS]):
        parts = [p for p in (model.features(plain_words(t)) for t in texts) if p]
        shares = [F.size(F.array_intersect("known", F.lit(p))) / float(len(p)) for p in parts]
        like[c] = F.array_max(F.array(F.lit(0.0), *shares))
    rows = rows.select("*", once(F.array(*like)).alias("like"))
    other = F.element_at("like", model.classes.index(UNKNOWN) + 1)
    similarity = F.when(F.col("best") <= len(TEMPLATES), F.element_at("like", F.col("best"))).otherwise(0.0)
    rows = rows.withColumn("similarity", similarity).withColumn("other", other)
    sure = (F.col("probability") >= model.least) & (F.col("similarity") >= model.similarity) & (F.col("similarity") > F.col("other"))
    rows = rows.withColumn("confirmed", sure)
    family = F.when(F.col("confirmed"), F.element_at(F.lit(model.classes), F.col("best"))).otherwise(UNKNOWN)
    return rows.select("id", "text_hash", "paragraph", "text", family.alias("family"), "probability", "similarity", "confirmed")
