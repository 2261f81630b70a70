from itertools import product

import numpy as np

from hearth.llm import languages
from tests.llm.helpers import documents, frame

EN = "the cat and the dog went to the house with their friends and the other animals of the town "
FR = "le chat et le chien sont dans la maison avec les amis et tous les autres animaux de la ville "
RU = "кошка и собака пошли в дом вместе с друзьями и другими животными города "


def corpus(spark):
    return spark.createDataFrame([(1, EN * 5, "en"), (2, FR * 5, "fr"), (3, RU * 5, "ru"), (4, None, "en"), (5, EN, None)], "doc_id long, text string, lang string")


def test_best_paths_against_all_paths():
    rng = np.random.default_rng(0)
    for _ in range(150):
        n, k = rng.integers(0, 7, size=rng.integers(1, 8)), int(rng.integers(1, 4))
        first = np.concatenate([[0], np.cumsum(n)])
        scores = (rng.normal(size=(n.sum(), k)) * 3).astype(np.float32)
        path = languages.best_paths(scores, first, 2.0)
        for a, b in zip(first, first[1:], strict=False):
            s = scores[a:b]
            value = lambda q, s=s: sum(s[i, x] for i, x in enumerate(q)) - 2.0 * sum(x != y for x, y in zip(q, q[1:], strict=False))
            if len(s):
                assert value(path[a:b].tolist()) >= max(value(q) for q in product(range(k), repeat=len(s))) - 1e-3


def test_mixed_text_spans(spark):
    model = languages.learn(corpus(spark))
    assert model.languages == ["en", "fr", "ru"]
    rows = [(1, EN + FR), (2, RU + EN), (3, None), (4, "12 34 !?"), (5, ""), (6, "ქართული"), (None, FR)]
    got = {r.id: r for r in languages.label(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    n = len(EN.split())
    assert [(s.begin, s.stop, s.lang) for s in got[1].spans] == [(0, n, "en"), (n, n + len(FR.split()), "fr")]
    assert [s.lang for s in got[2].spans] == ["ru", "en"]
    for k in (3, 4, 5):
        assert (got[k].lang_pred, got[k].score, got[k].spans) == ("und", 0.0, [])
    assert got[None].lang_pred == "fr" and got[6].lang_pred in model.languages


def test_scripts_narrow():
    letters = languages.Letters(["abc где 漢字 1 αβ", "", "Z"])
    names = ["", *languages.SCRIPTS, "other"]
    assert [names[letters.script[w]] for w in letters.words] == ["latin", "cyrillic", "han", "greek", "latin"]
    assert letters.first.tolist() == [0, 4, 4, 5]


def test_marks_belong_to_the_letter_before():
    letters = languages.Letters(["हिन्दी भाषा", "ที่นี่", "e\u0301te\u0301 \u0301 1\u0301", "\u0301"])
    names = ["", *languages.SCRIPTS, "other"]
    assert letters.first.tolist() == [0, 2, 3, 4, 4]
    assert [names[letters.script[w]] for w in letters.words] == ["devanagari", "devanagari", "thai", "latin"]


def test_awkward_rows(spark):
    docs = frame(spark)
    got = languages.label(docs, languages.learn(docs)).collect()
    assert len(got) == len(documents())
    assert all(r.lang_pred in ("en", "fr", "und") and 0 <= r.score <= 1 for r in got)
    empty = languages.learn(frame(spark, []))
    assert empty.languages == [] and languages.label(frame(spark, []), empty).count() == 0
    assert {r.lang_pred for r in languages.label(docs, empty).collect()} == {"und"}


def test_pieces_do_not_change_the_result(spark, monkeypatch):
    model = languages.learn(corpus(spark))
    texts = [r[1] for r in documents()]
    want = languages.label_texts(texts, model)
    monkeypatch.setattr(languages, "PIECE_CHARS", 100)
    monkeypatch.setattr(languages, "PATH_CELLS", 50)
    assert languages.label_texts(texts, model) == want


def test_registered_query_on_held_out_documents(spark):
    from hearth.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = [r for r in QUERIES["op5_languages"](spark, sf).collect() if r.held_out]
    assert len(got) > 150 and sum(r.lang_pred == lang[r.doc_id] for r in got) >= 0.98 * len(got)
