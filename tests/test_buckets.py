"""Bucketed tables: what an upsert reads and writes, lookups, interrupted commits."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from hearth.session import scratch_path
from hearth.sources.buckets import BucketStore
from tests.test_plans import formatted

SCHEMA = "k long, v string, d double"


def files(root, table="t"):
    """Content hash of each data file by its bucket."""
    out, base = {}, root.replace("file:", "") + f"/{table}/data"
    for folder, _, names in os.walk(base):
        for n in names:
            if n.endswith(".parquet"):
                with open(f"{folder}/{n}", "rb") as f:
                    out.setdefault(os.path.basename(folder), []).append((n, hashlib.sha256(f.read()).hexdigest()))
    return out


@pytest.fixture
def store(spark):
    s = BucketStore(spark, scratch_path(spark, "buckets"))
    s.create("t", spark.createDataFrame([], SCHEMA).schema, ["k"], 8)
    return s


def rows(spark, ids, v="a"):
    return spark.createDataFrame([(i, v, 1.5 if i is None or i % 2 else None) for i in ids], SCHEMA)


def content(store, table="t"):
    return sorted(store.read(table).collect(), key=str)


def test_one_changed_key_writes_one_bucket(spark, store):
    assert store.read("t").count() == 0
    first = store.upsert({"t": rows(spark, range(500))})["t"]
    assert first["written"] == list(range(8)) and first["read"] == []
    before = files(store.root)
    report = store.upsert({"t": rows(spark, [7], "b")})["t"]
    after = files(store.root)
    assert len(report["written"]) == 1 and report["written"] == report["touched"] == report["read"]
    changed = f"bucket={report['written'][0]}"
    assert {b for b in before if before[b] != after[b]} == {changed} and before.keys() == after.keys()
    want = sorted([*rows(spark, [i for i in range(500) if i != 7]).collect(), *rows(spark, [7], "b").collect()], key=str)
    assert content(store) == want


def test_the_same_rows_write_nothing_and_are_not_read(spark, store):
    store.upsert({"t": rows(spark, range(500))})
    before = files(store.root)
    report = store.upsert({"t": rows(spark, range(499, -1, -1)).repartition(5)})["t"]
    assert report["touched"] == list(range(8)) and report["read"] == report["written"] == []
    part = store.upsert({"t": rows(spark, [3, 4])})["t"]  # part of a bucket: read, merged, found equal
    assert part["read"] == part["touched"] != [] and part["written"] == []
    assert store.upsert({"t": rows(spark, [])})["t"] == {"touched": [], "read": [], "written": []}
    assert files(store.root) == before


def test_null_keys_nulls_and_new_keys(spark, store):
    store.upsert({"t": spark.createDataFrame([(None, "x", None), (1, None, 1.0)], SCHEMA)})
    store.upsert({"t": spark.createDataFrame([(None, None, 2.0), (2, "n", None)], SCHEMA)})
    assert content(store) == sorted(spark.createDataFrame([(None, None, 2.0), (1, None, 1.0), (2, "n", None)], SCHEMA).collect(), key=str)
    assert [r.d for r in store.lookup("t", k=None).collect()] == [2.0]


def test_nulls_count_by_their_place(spark):
    s = BucketStore(spark, scratch_path(spark, "places"))
    s.create("t", spark.createDataFrame([], "k long, a string, b string").schema, ["k"], 1)
    s.upsert({"t": spark.createDataFrame([(1, "x", None)], "k long, a string, b string")})
    assert s.upsert({"t": spark.createDataFrame([(1, None, "x")], "k long, a string, b string")})["t"]["written"] == [0]


def test_keys_only(spark):
    s = BucketStore(spark, scratch_path(spark, "keys"))
    s.create("t", spark.createDataFrame([], "k long").schema, ["k"], 4)
    s.upsert({"t": spark.range(10).toDF("k")})
    s.upsert({"t": spark.range(5, 15).toDF("k")})
    assert sorted(r.k for r in s.read("t").collect()) == list(range(15))


def scan_metrics(df):
    """Metrics of the file scan of an executed frame."""
    plan = df._jdf.queryExecution().executedPlan()
    while plan.nodeName().strip() != "Scan parquet":
        plan = plan.executedPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan.children().head()
    m = plan.metrics()
    return {k: m.apply(k).value() for k in ("numFiles", "numOutputRows")}


def test_lookup_reads_one_bucket_and_skips_pages(spark, store):
    n = 200_000
    store.upsert({"t": spark.range(n).select((F.col("id") * 2).alias("k"), F.col("id").cast("string").alias("v"), F.lit(1.0).alias("d"))})
    found = store.lookup("t", k=2 * 1234)
    assert found.collect() == [(2468, "1234", 1.0)]
    m = scan_metrics(found)
    assert m["numFiles"] == 1 and m["numOutputRows"] < n / 8  # the bucket's other pages are skipped by the sorted key
    text = formatted(found)
    assert "PartitionFilters: [isnotnull(bucket" in text and "EqualTo(k,2468)" in text
    absent = store.lookup("t", k=2 * 1234 + 1)
    assert absent.collect() == [] and scan_metrics(absent)["numOutputRows"] == 0  # within the range: the bloom filter says no
    with pytest.raises(ValueError):
        store.lookup("t", v="1")


def test_near_reads_only_touched_buckets(spark, store):
    store.upsert({"t": rows(spark, range(500))})
    near = store.near("t", rows(spark, [7]))
    assert 7 in [r.k for r in near.collect()]
    assert scan_metrics(near)["numFiles"] == 1


def test_a_marked_commit_is_finished_by_the_next_open(spark, store, monkeypatch):
    store.create("u", spark.createDataFrame([], SCHEMA).schema, ["k"], 2)
    store.upsert({"t": rows(spark, range(20)), "u": rows(spark, range(20))})
    replace, calls = BucketStore._replace, []

    def dies(self, out, folder):
        calls.append(folder)
        if folder == "u/data":
            raise RuntimeError("executor lost")
        replace(self, out, folder)

    monkeypatch.setattr(BucketStore, "_replace", dies)
    with pytest.raises(RuntimeError):
        store.upsert({"t": rows(spark, range(10), "new"), "u": rows(spark, range(10), "new")})
    monkeypatch.setattr(BucketStore, "_replace", replace)
    again = BucketStore(spark, store.root)
    for table in ("t", "u"):
        assert sorted((r.k, r.v) for r in again.read(table).collect()) == [(i, "new" if i < 10 else "a") for i in range(20)]
        assert again.upsert({table: rows(spark, range(10), "new")})[table]["written"] == []
    assert again.recover() == []


def test_an_unmarked_commit_leaves_no_trace(spark, store, monkeypatch):
    store.upsert({"t": rows(spark, range(20))})
    before = files(store.root)
    monkeypatch.setattr(BucketStore, "_put", lambda self, *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError):
        store.upsert({"t": rows(spark, range(20), "new")})
    monkeypatch.undo()
    again = BucketStore(spark, store.root)
    assert files(again.root) == before and {r.v for r in again.read("t").collect()} == {"a"}
    again.upsert({"t": rows(spark, range(20), "new")})
    assert {r.v for r in again.read("t").collect()} == {"new"}


def test_layout_is_fixed_and_staged_rows_expire(spark, store):
    schema = spark.createDataFrame([], SCHEMA).schema
    store.create("t", schema, ["k"], 8)
    for keys, n in ((["k"], 16), (["k", "v"], 8), (["nope"], 8), (["k"], 0)):
        with pytest.raises(ValueError):
            store.create("t", schema, keys, n)
    assert store.tables() == ["t"]
    for i in range(3):
        store.upsert({"t": rows(spark, range(9), str(i))})
    assert store.expire(keep=1) == 2 and {r.v for r in store.read("t").collect()} == {"2"}
