from itertools import combinations

import numpy as np
import xxhash

from hearth.llm import simhash
from tests.llm.helpers import documents, frame, groups, words


def fingerprint(text, k=3):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + k]).encode(), 42) for i in range(max(1, len(w) - k + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows):
    fp = [fingerprint(r[1]) for r in rows]
    found = groups(len(rows), [(a, b) for a, b in combinations(range(len(rows)), 2) if (fp[a] ^ fp[b]).bit_count() <= 2])
    least = {}
    for r, g in zip(rows, found, strict=True):
        if r[0] is not None:
            least[g] = min(r[0], least.get(g, r[0]))
    return [(r[0], f, least.get(g)) for r, f, g in zip(rows, fp, found, strict=True)]


def test_against_brute_force(spark):
    got = simhash.near_duplicates(frame(spark)).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r.id, r.fp % (1 << 64), r.component) for r in got), key=key) == sorted(brute(documents()), key=key)


def test_one_of_each_group_stays(spark):
    docs = frame(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    want = {c for _, _, c in brute(documents())}
    assert sorted((i for i in ids if i is not None)) == sorted(c for c in want if c is not None)
    assert len(ids) == len(want)


def test_empty_table(spark):
    assert simhash.near_duplicates(frame(spark, [])).count() == 0
    assert simhash.keep_one(frame(spark, [])).count() == 0


def test_every_close_pair_meets_at_an_anchor():
    rng, code = np.random.default_rng(1), simhash.Anchors(2)
    fp = rng.integers(-(1 << 63), 1 << 63, size=300)
    for bits in [(), (0,), (63,), (22, 23), (5, 9), (30, 44), (45, 46), (3, 60)]:
        other = fp ^ np.int64(sum((1 << b) if b < 63 else -(1 << 63) for b in bits))
        home = code.home(fp)
        who, anchor = code.near(other)
        reached = set(zip(who.tolist(), anchor.tolist(), strict=True))
        assert all((i, h) in reached for i, h in enumerate(home.tolist()))


def test_covering_radius_and_copies():
    patterns, weights, first = simhash.cosets(3)
    assert (np.diff(first) == 1).all() and weights.max() == 3  # one leader each: a perfect code
    code = simhash.Anchors(2)
    who, _ = code.near(np.random.default_rng(2).integers(-(1 << 63), 1 << 63, size=2000))
    assert 50 < len(who) / 2000 < 75


def test_a_chain_of_fingerprints_is_one_component(spark):
    from hearth.llm.components import components

    chain = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1000), (7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
