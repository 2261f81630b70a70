from collections import Counter

import pytest
import xxhash

from hearth.llm import sharding
from tests.llm.helpers import frame

SHARDS = [f"s{i}" for i in range(7)]


def brute_table(shards, size):
    """Turns over explicit preference lists."""
    orders = []
    for s in shards:
        offset, skip = xxhash.xxh64_intdigest(s, 1) % size, xxhash.xxh64_intdigest(s, 2) % (size - 1) + 1
        orders.append(iter([(offset + j * skip) % size for j in range(size)]))
    table = {}
    while True:
        for i, order in enumerate(orders):
            table[next(x for x in order if x not in table)] = i
            if len(table) == size:
                return [table[k] for k in range(size)]


def test_table_and_balance():
    assert sharding.fill(SHARDS, 211).tolist() == brute_table(SHARDS, 211)
    counts = Counter(sharding.fill(SHARDS, 65537).tolist())
    assert max(counts.values()) - min(counts.values()) <= 1


def test_few_keys_move_when_a_shard_goes():
    before, after = sharding.fill(SHARDS, 65537), sharding.fill(SHARDS[:-1], 65537)
    others = before < 6
    assert (before[others] != after[others]).mean() < 0.15


def test_bad_tables():
    for shards, size in [(SHARDS, 210), ([], 211), (["a", "a"], 211), (SHARDS, 5)]:
        with pytest.raises(ValueError):
            sharding.fill(shards, size)


def test_placement(spark):
    docs = frame(spark).withColumnRenamed("h", "slot")
    got = sharding.place(docs, ["doc_id"], SHARDS, 211, out_col="source")
    assert sorted(got.columns) == sorted(docs.columns) and got.count() == docs.count()
    table = brute_table(SHARDS, 211)
    for r in got.selectExpr("pmod(xxhash64(doc_id), 211L) AS k", "source").collect():
        assert r.source == SHARDS[table[r.k]]
    assert sharding.place(frame(spark, []), ["doc_id"], SHARDS, 211).count() == 0


def test_registered_query_spreads_the_documents(spark):
    from hearth.llm.queries import QUERIES, SHARDS

    got = Counter(r.shard for r in QUERIES["op4_sharding"](spark, "/root/testdata/sf0.1").collect())
    assert set(got) == set(SHARDS) and max(got.values()) < 1.6 * 10_000 / 64
