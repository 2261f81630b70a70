"""Connected components against union-find, and the rounds they take."""

import random

import pytest

from hearth.llm import components as module
from hearth.llm.components import components
from tests.llm.helpers import groups


def found(spark, links, **more):
    return {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), **more).collect()}


def test_components(spark):
    rnd = random.Random(4)
    links = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(110)] + [(300 + i, 301 + i) for i in range(40)] + [(None, 1), (2, None), (7, 7)]
    whole = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    truth = groups(400, whole)
    assert found(spark, links) == {x: truth[x] for p in whole for x in p}
    assert found(spark, []) == {}


def test_stars_take_no_round(spark, monkeypatch):
    """Nodes that all hang on their least one are components already."""
    monkeypatch.setattr(module, "_star", None)
    links = [(10 * k, 10 * k + i) for k in range(3) for i in range(1, 5)]
    assert found(spark, links + [(b, a) for a, b in links]) == {x: x // 10 * 10 for p in links for x in p}


def test_too_few_rounds(spark):
    chain = [(i, i + 1) for i in range(50)]
    with pytest.raises(RuntimeError):
        found(spark, chain, max_rounds=1)
