import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearth.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int, v string, ids int"


def table(seed=0, n=600, dim=8):
    rng = np.random.default_rng(seed)
    rows = [(int(i), rng.normal(size=dim).astype(np.float32).tolist(), 1, "v", None) for i in range(n)]
    same = rows[20][1]
    rows += [(n + i, same, None, None, 3) for i in range(90)]  # a large group of copies, with queries in it
    rows += [(2000, None, 1, "a", 1), (2020, [0.0] * dim, 1, "a", 1), (2040, [math.nan] * dim, 1, "a", 1), (2060, [math.inf] + [1.0] * (dim - 1), 1, "a", 1)]
    rows += [(2080, [None] + [1.0] * (dim - 1), 1, "a", 1), (None, same, 1, "a", 1), rows[40], rows[40], (2100, [1.0, 2.0, 3.0], 1, "a", 1), (2101, [1.0, 2.0, 2.0], 1, "a", 1)]
    return rows


def brute(rows, k):
    use = {(r[0], tuple(r[1])) for r in rows if r[0] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])}
    out = {}
    for q, v in use:
        if q % 20 == 0:
            scores = [(-float(np.dot(np.array(v, float), np.array(u, float))), i) for i, u in use if len(u) == len(v) and i != q]
            out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def found(spark, rows, **options):
    got = {}
    for r in neighbours.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, k=20, **options).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.id, r.score))
    return {q: sorted(x) for q, x in got.items()}


def test_whole_ascent_is_exact(spark):
    """With all rows asked for, results equal brute force, ties and copies too."""
    rows = table()
    got, want = found(spark, rows, share=100.0, block_rows=128), brute(rows, 20)
    assert set(got) == {q for q, x in want.items() if x}
    for q, x in got.items():
        assert [r for r, _, _ in x] == list(range(1, len(x) + 1))
        assert [i for _, i, _ in x] == [i for i, _ in want[q]]
        assert np.allclose([s for _, _, s in x], [s for _, s in want[q]], atol=1e-12)


def test_the_ascent_stops_at_the_longest_prefix_with_enough():
    rng = np.random.default_rng(3)
    x, q = rng.normal(size=(500, 16)), rng.normal(size=(9, 16))
    forest = neighbours.Forest(x, trees=5, bits=20)
    low, high = forest.ranges(q, 100)
    a, b = neighbours.hash_strings(neighbours.equal_lengths(x), 5, 20, 0), neighbours.hash_strings(np.column_stack([q, np.zeros(9)]), 5, 20, 0)
    for i in range(9):
        common = np.array([[20 - int(int(s) ^ int(b[t, i])).bit_length() for s in a[t]] for t in range(5)])
        level = max(v for v in range(21) if (common >= v).sum() >= 100)
        for t in range(5):
            assert sorted(forest.order[t, low[t, i] : high[t, i]].tolist()) == np.flatnonzero(common[t] >= level).tolist()


def test_recall_of_the_registered_query(spark):
    from hearth.llm.queries import QUERIES

    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute([(*r, 1) for r in rows], 20)
    got = {}
    for r in QUERIES["op1_neighbours"](spark, sf).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert all(len(got[q]) == 20 for q in want)
    assert sum(len(got[q] & {i for i, _ in x}) for q, x in want.items()) / (20 * len(want)) >= 0.9


def lengths(sigma, n=6000, dim=64):
    rng = np.random.default_rng(11)
    v = rng.normal(size=(n, dim))
    v *= (np.exp(sigma * rng.normal(size=n)) / np.linalg.norm(v, axis=1))[:, None]
    return [(i, x, 1, "v", None) for i, x in enumerate(v.astype(np.float32).tolist())]


@pytest.mark.parametrize("sigma", [0.1, 0.5, 1.0])
def test_recall_at_unequal_lengths(spark, sigma):
    rows = lengths(sigma)
    v = np.array([r[1] for r in rows], dtype=float)
    got = found(spark, rows)
    hits = 0
    for q in range(0, len(rows), 20):
        scores = v @ v[q]
        scores[q] = -np.inf
        hits += len({i for _, i, _ in got[q]} & set(np.argsort(-scores)[:20].tolist()))
    assert hits / (20 * len(range(0, len(rows), 20))) >= 0.9


def test_results_do_not_depend_on_partitions_or_batches(spark):
    rows = lengths(0.5, 3000, 16)
    results = []
    for parts, batch in ((1, 8192), (7, 8192), (3, 40)):
        docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        out = neighbours.nearest(docs, F.col("vec_id") % 20 == 0, block_rows=300, least=100, batch_rows=batch)
        results.append(sorted((r.query_id, r["rank"], r.id, r.score) for r in out.collect()))
    assert results[0] == results[1] == results[2]


def test_few_and_no_rows(spark):
    assert found(spark, []) == {}
    assert found(spark, [(0, [1.0, 0.0], 1, "a", 1)]) == {}
    assert found(spark, [(0, [1.0, 0.0], 1, "a", 1), (1, [0.5, 0.0], 1, "a", 1)]) == {0: [(1, 1, 0.5)]}
