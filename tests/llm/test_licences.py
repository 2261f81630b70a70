import numpy as np
import pytest

from hearth.llm import licences
from tests.llm.helpers import documents, frame


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def model(corpus):
    return licences.train(corpus)


def brute(model, text):
    """(family, probability, similarity) of a paragraph, or None."""
    known = model.features(licences.plain_words(text))
    if not known:
        return None
    at = [model.vocabulary.index(g) for g in known]
    z = model.weights[:, at].sum(axis=1) + model.bias
    p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    best = int(p.argmax())
    if model.classes[best] == licences.NONE:
        return None
    like = 0.0
    for t in licences.TEMPLATES.get(model.classes[best], []):
        part = model.features(licences.plain_words(t))
        like = max(like, len(set(part) & set(known)) / len(part)) if part else like
    others = [set(model.features(licences.plain_words(t))) for t in licences.OTHERS]
    other = max(len(o & set(known)) / len(o) for o in others if o)
    sure = p[best] >= model.least and like >= model.similarity and like > other
    return (model.classes[best] if sure else licences.UNKNOWN, round(float(p[best]), 9), round(like, 9))


TEXTS = [
    "Released under the MIT License.",
    "released under MIT license",
    "This program is licensed under the GNU General Public License, version 3, or later.",
    "Licensed under CC BY-NC 4.0. All rights reserved.",
    "This work is licensed under the Foobar Public License.",
    "Distributed under the terms of the Eclipse Public License.",
    "The version of the story that we heard was free of charge.",
    "",
    "mit",
    "Nothing to see",
]


def test_against_plain_scores(spark, model):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    got = {r.id: (r.family, round(r.probability, 9), round(r.similarity, 9)) for r in licences.scan(docs, model).collect()}
    assert got == {i: b for i, t in enumerate(TEXTS) if (b := brute(model, t))}
    assert [got[i][0] for i in (0, 2)] == ["MIT", "GPL-3.0"]
    assert got[4][0] == got[5][0] == licences.UNKNOWN and 6 not in got and 9 not in got


def test_every_template_is_known(model):
    for family, texts in licences.TEMPLATES.items():
        for t in texts:
            assert brute(model, t)[0] == family, t


RELATIVES = [
    "Licensed under CC BY-SA 4.0.",
    "Released under the BSD 2-Clause License.",
    "This library is distributed under the GNU Lesser General Public License, version 2.1.",
    "Licensed under the GNU Affero General Public License, version 3, or any later version.",
    "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
]


def test_relatives_are_not_confirmed(spark, model):
    docs = spark.createDataFrame(list(enumerate(RELATIVES)), "doc_id long, text string")
    got = {r.id: r for r in licences.scan(docs, model).collect()}
    assert set(got) == set(range(len(RELATIVES)))
    assert not [RELATIVES[i] for i, r in got.items() if r.confirmed or r.family != licences.UNKNOWN]


def test_corpus_lines(corpus, model):
    """Every licence line of the corpus is found, and no other line."""
    marks = {"MIT License": "MIT", "Apache License": "Apache-2.0", "GNU General": "GPL-3.0", "CC BY-NC": "CC-BY-NC-4.0", "All rights": "proprietary"}
    want = sorted((r.doc_id, i, f) for r in corpus.collect() for i, line in enumerate(r.text.split("\n")) for m, f in marks.items() if m in line)
    got = sorted((r.id, r.paragraph, r.family) for r in licences.scan(corpus, model).collect())
    assert got == want and len(want) > 30


def test_awkward_rows(spark, model):
    docs = frame(spark, [*documents(), (1, "one\nReleased under the MIT License.", *[None] * 6), (1, "one\nReleased under the MIT License.", *[None] * 6)])
    got = licences.scan(docs, model).collect()
    assert [(r.id, r.paragraph, r.family) for r in got] == [(1, 1, "MIT")] * 2
    assert licences.scan(frame(spark, []), model).count() == 0
    bare = licences.train(frame(spark, []))
    assert licences.scan(docs, bare).where("family = 'MIT'").count() >= 2


def test_plan_has_no_python(corpus, model):
    plan = licences.scan(corpus, model)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
