"""Line groups against edit similarity alone, without any hash."""

import random

from hearth.llm import lines
from tests.llm.helpers import SCHEMA, documents
from tests.llm.test_lines import distance, form


def alike(a, b):
    return distance(a, b) <= int(max(len(a), len(b)) * 0.2 + 1e-9)


def edited(rnd, words, n):
    """The words with ``n`` of them spelt otherwise."""
    words = list(words)
    for i in rnd.sample(range(len(words)), n):
        words[i] = words[i][:-1] + rnd.choice("aeiou") + rnd.choice("mnp")
    return words


def table(spark, texts):
    return spark.createDataFrame([(i, t, *[None] * 6) for i, t in enumerate(texts)], SCHEMA)


def test_edited_lines(spark):
    """One word of a line changed: a 64-bit hash finds most long lines and few short ones (figures in the README)."""
    rnd = random.Random(5)
    common = ["the", "of", "and", "to", "in", "a", "is", "that"]
    word = lambda: rnd.choice(common) if rnd.random() < 0.4 else "".join(rnd.choice("bcdfglnrstaeiou") for _ in range(rnd.randint(4, 9)))
    pairs, sizes = [], (10, 30, 60, 100)
    for size in sizes:
        for _ in range(40):
            line = [word() for _ in range(size)]
            pairs.append((" ".join(line), " ".join(edited(rnd, line, 1))))
    truth = [alike(a, b) for a, b in pairs]
    got = {r.id: r.group for r in lines.fuzzy_lines(table(spark, [t for p in pairs for t in p])).collect()}
    linked = [got[2 * k] == got[2 * k + 1] for k in range(len(pairs))]
    assert not any(x and not t for x, t in zip(linked, truth, strict=True))
    share = {size: sum(linked[40 * k : 40 * k + 40]) / sum(truth[40 * k : 40 * k + 40]) for k, size in enumerate(sizes)}
    assert share[60] >= 0.6 and share[100] >= 0.6 and share[30] >= 0.35


def test_links_are_alike(spark):
    """No group joins lines that no chain of alike lines joins."""
    texts = [" ".join(form(x)) for r in documents() if len(r[1] or "") < 2000 for x in (r[1] or "").split("\n")][:120]
    got = {r.id: r.group for r in lines.fuzzy_lines(table(spark, texts)).collect()}
    for i in got:
        others = [j for j in got if j != i and got[j] == got[i]]
        assert not others or any(alike(texts[i], texts[j]) for j in others)
