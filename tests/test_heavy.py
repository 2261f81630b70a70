"""Most frequent values by sketch against the full count."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hearth.operators.heavy import distinct_estimates, sketch, top_values


@pytest.fixture(scope="module")
def rows(spark):
    """A skewed column, a near-unique one with a few frequent values, a key, one of few values, and one of nulls."""
    rnd = random.Random(3)
    data = []
    for i in range(30_000):
        skewed = None if i % 17 == 0 else f"v{int(rnd.paretovariate(0.7)) % 100_000}"
        near = f"hot{rnd.randrange(8)}" if i % 9 == 0 else f"x{i}"
        data.append((skewed, near, i, i % 3 == 0, None))
    return spark.createDataFrame(data, "skewed string, near string, key long, flag boolean, none string").cache()


def plain(rows, columns, k):
    data = rows.collect()
    out = []
    for c in columns:
        counts = Counter(str(r[c]).lower() if isinstance(r[c], bool) else str(r[c]) for r in data if r[c] is not None)
        out += [(c, i + 1, v, n) for i, (v, n) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k])]
    return sorted(out)


@pytest.mark.parametrize(("k", "bits"), [(10, 16), (10, 8), (3, 10), (1, 4), (200, 16)])
def test_against_the_full_count(rows, k, bits):
    columns = ["skewed", "near", "key", "flag", "none"]
    assert sorted(map(tuple, top_values(rows, columns, k, bits).collect())) == plain(rows, columns, k)


def test_sketch_is_bounded_and_adds_up(rows):
    values = rows.select(F.lit("near").alias("column"), F.col("near").alias("value"))
    got = sketch(values, 6).collect()
    assert len(got) <= 2 * 64
    assert {r: sum(x.n for x in got if x.row == r) for r in (0, 1)} == {0: 30_000, 1: 30_000}


def test_empty_table_and_bad_k(rows):
    assert top_values(rows.limit(0), ["near", "key"], 5).count() == 0
    assert {(r.column, r.n_distinct) for r in distinct_estimates(rows.limit(0), ["near", "none"]).collect()} == {("near", 0), ("none", 0)}
    with pytest.raises(ValueError):
        top_values(rows, ["near"], 0)


def test_estimates_within_the_bound(rows):
    columns = ["skewed", "near", "key", "flag", "none"]
    true = {c: rows.where(F.col(c).isNotNull()).select(c).distinct().count() for c in columns}
    got = {r.column: r.n_distinct for r in distinct_estimates(rows, columns, 0.02).collect()}
    assert set(got) == set(true) and got["none"] == 0 and got["flag"] == 2
    assert all(abs(got[c] - true[c]) <= 3 * 0.02 * true[c] for c in columns)
