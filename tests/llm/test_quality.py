from collections import Counter

import numpy as np

from hearth.llm import quality
from tests.llm.helpers import documents, frame, words


def base(text):
    w = words(text)
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines, doubled = set(), 0
    for line in (text or "").split("\n"):
        doubled += bool(words(line)) and line in lines
        lines.add(line)
    n = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), doubled, len(covered))
    return (*n, len(w) < 10 or 100 * len(covered) > 20 * len(w))


def test_base_counts(spark):
    got = quality.judge(frame(spark)).collect()
    want = Counter((r[0], *base(r[1])) for r in documents())
    names = ["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert Counter(tuple(r[n] for n in names) for r in got) == want
    assert not any(r.kept for r in got if r.base_failed)
    assert all(0 <= r.quality <= 1 and r.kept is not None for r in got)


def test_stage_keeps_what_is_judged_good(spark):
    docs = frame(spark)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    want = Counter((r.id, r.text_hash) for r in quality.judge(docs).where("kept").collect())
    assert Counter((r[0], r[1]) for r in kept.selectExpr("doc_id", "xxhash64(text)").collect()) == want


def test_empty_table(spark):
    assert quality.judge(frame(spark, [])).count() == 0
    assert quality.keep_good(frame(spark, [])).count() == 0


def test_em_finds_the_classes():
    """Votes drawn from known accuracies: the posterior finds most classes, abstentions say nothing."""
    rng = np.random.default_rng(5)
    accuracy, good = np.array([0.9, 0.85, 0.8, 0.75, 0.7]), rng.random(4000) < 0.7
    votes = np.where(rng.random((4000, 5)) < accuracy, 1, -1) * np.where(good, 1, -1)[:, None]
    votes[rng.random(votes.shape) < 0.3] = 0
    patterns, back, times = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior, share, table = quality.estimate(patterns, times)
    assert abs(share - 0.7) < 0.05
    assert ((posterior[back.ravel()] > 0.5) == good).mean() > 0.9
    assert np.abs(table[1, :, 1] - accuracy).max() < 0.08


def test_registered_query_on_labelled_documents(spark):
    from hearth.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op2_quality"](spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    good = [got[r.doc_id] for r in labels if r.quality == 1]
    bad = [got[r.doc_id] for r in labels if r.quality == 0]
    assert all(r.kept for r in good if not r.base_failed)
    assert sum(not r.kept for r in bad) >= 0.95 * len(bad)
