"""Integrity rules, upsert semantics and the ingest job."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hearth.operators import integrity as R
from hearth.operators.upsert import merge_upsert
from hearth.plans.ingest import IntegrityError, ingest
from hearth.schema import LISTING_SCHEMA
from hearth.session import scratch_path
from hearth.sources.files import write_feed
from hearth.sources.fixture import raw_listings
from hearth.sources.tables import TableStore

D1, D2 = dt.datetime(2020, 1, 1), dt.datetime(2021, 1, 1)


def listing_frame(spark, rows):
    names = LISTING_SCHEMA.fieldNames()
    full = []
    for r in rows:
        base = dict(listing_id=None, transaction_type="SELL", item_subcategory="VILLA", start_date=D1, change_date=D1,
                    price=1.0, city="c", zipcode="75001")
        base.update(r)
        full.append(tuple(base.get(n) for n in names))
    return spark.createDataFrame(full, LISTING_SCHEMA)


def rules(df):
    return sorted((r.rule, r.key, r.column) for r in df.collect())


def test_row_rules(spark):
    df = listing_frame(spark, [
        dict(listing_id=1),
        dict(listing_id=2, city=None, price=-1.0),
        dict(listing_id=3, item_subcategory="HOUSE", transaction_type="LEASE"),
        dict(listing_id=4, zipcode="1234567", change_date=dt.datetime(2019, 1, 1)),
        dict(listing_id=5, zipcode="75 01", room_count=-1),
    ])
    got = rules(R.listing_row_violations(df))
    assert got == sorted([
        ("R1_not_null", "2", "city"), ("R2_non_negative", "2", "price"),
        ("R3_enum", "3", "item_subcategory"), ("R3_enum", "3", "transaction_type"),
        ("R4_format", "4", "zipcode"), ("R6_change_after_start", "4", "change_date"),
        ("R4_format", "5", "zipcode"), ("R2_non_negative", "5", "room_count"),
    ])
    strict = rules(R.row_violations(df, "listing_id", R.non_negative_hits(df, strict_measures=True)))
    assert ("R2_non_negative", "2", "price") in strict and len(strict) == 2


def test_key_fk_and_update_rules(spark):
    lst = listing_frame(spark, [dict(listing_id=1), dict(listing_id=1), dict(listing_id=2, item_subcategory="CHALET")])
    cats = spark.createDataFrame([("VILLA", "HOUSE")], "subcategory string, category string")
    assert rules(R.key_violations(lst, "listing_id")) == [("R7_primary_key", "1", "listing_id")]
    assert rules(R.foreign_key_violations(lst, cats)) == [("R5_foreign_key", "2", "item_subcategory")]
    old = listing_frame(spark, [dict(listing_id=1, change_date=D2), dict(listing_id=2, start_date=D2, change_date=D2)])
    new = listing_frame(spark, [dict(listing_id=1, change_date=D1), dict(listing_id=2, start_date=D1, change_date=D2),
                                dict(listing_id=3)])
    assert rules(R.update_violations(old, new)) == [
        ("R8_start_date_immutable", "2", "start_date"), ("R9_change_date_monotonic", "1", "change_date")]


def test_upsert_update_and_do_nothing(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(2, None), (3, "c")], "k long, v string")
    assert sorted(tuple(r) for r in merge_upsert(old, new, ["k"]).collect()) == [(1, "a"), (2, None), (3, "c")]
    keys_old, keys_new = old.select("k"), new.select("k")
    assert sorted(r.k for r in merge_upsert(keys_old, keys_new, ["k"]).collect()) == [1, 2, 3]
    assert merge_upsert(merge_upsert(old, new, ["k"]), new, ["k"]).count() == 3


def test_ingest_fail_reject_and_idempotence(spark):
    feed = write_feed(raw_listings(spark, "/root/testdata/sf0.001"), scratch_path(spark, "t-feed"), "json")
    root = scratch_path(spark, "t-store")
    with pytest.raises(IntegrityError):
        ingest(spark, feed, root, "json", enforce="fail")
    store = TableStore(spark, root)
    assert store.versions("listing") == []  # nothing written on failure
    rep = ingest(spark, feed, root, "json", enforce="reject")
    assert rep.metrics["raw_rows"] > 0 and rep.metrics["max_start_year"] is not None
    assert rep.metrics["rejected_listings"] > 0 and rep.metrics["category_rows"] > 0
    first = sorted(tuple(r) for r in store.read("listing").collect())
    bad = store.read("rejects")
    assert bad.filter(F.col("rule") == "R4_format").count() > 0
    ingest(spark, feed, root, "json", enforce="reject")
    assert store.versions("listing") == [1, 2]
    assert sorted(tuple(r) for r in store.read("listing").collect()) == first
    with pytest.raises(ValueError):
        ingest(spark, feed, root, "json", enforce="maybe")


def test_duplicate_keys_without_dedup_fail(spark):
    from hearth.plans.ingest import ingest_frame
    from hearth.plans.policies import TransformPolicy
    from hearth.schema import RAW_SCHEMA

    base = {f.name: None for f in RAW_SCHEMA.fields}
    row = {**base, "listing_id": 5, "transaction_type": "SELL", "item_type": "HOUSE", "item_subtype": "VILLA",
           "start_date": 1_600_000_000_000, "change_date": 1_600_000_000_000, "price": 1.0, "city": "c", "zipcode": "75001"}
    df = spark.createDataFrame([tuple({**row, "price": p}[f.name] for f in RAW_SCHEMA.fields) for p in (1.0, 2.0)], RAW_SCHEMA)
    with pytest.raises(IntegrityError, match="R7_primary_key"):
        ingest_frame(df, scratch_path(spark, "dup-store"), TransformPolicy(deduplicate=False), enforce="fail")
    rep = ingest_frame(df, scratch_path(spark, "dup-store2"), TransformPolicy(), enforce="fail")
    assert rep.metrics["batch_listings"] == 1


def test_ingest_command_line(spark, capsys):
    import json

    from hearth.plans.ingest import main

    feed = write_feed(raw_listings(spark, "/root/testdata/sf0.001"), scratch_path(spark, "cli-feed"), "json")
    root = scratch_path(spark, "cli-store")
    main(["--input", feed, "--store", root, "--enforce", "reject", "--listing-partitions", "2"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["metrics"]["batch_listings"] > 0 and "listing" in out["written"]
    assert 1 <= len(TableStore(spark, root).read("listing").inputFiles()) <= 2  # S8: two write partitions


def test_null_keys_are_rejected_once_each_and_never_stored(spark):
    from hearth.plans.ingest import ingest_frame
    from hearth.schema import RAW_SCHEMA

    base = {f.name: None for f in RAW_SCHEMA.fields}
    row = {**base, "transaction_type": "SELL", "item_type": "HOUSE", "item_subtype": "VILLA", "start_date": 1_600_000_000_000,
           "change_date": 1_600_000_000_000, "price": 1.0, "city": "c", "zipcode": "75001"}
    ids = [1, None, 2, None, None]
    df = spark.createDataFrame([tuple({**row, "listing_id": i}[f.name] for f in RAW_SCHEMA.fields) for i in ids], RAW_SCHEMA)
    root = scratch_path(spark, "null-keys")
    store = TableStore(spark, root)
    for _ in range(2):
        rep = ingest_frame(df, root, enforce="reject")
        assert rep.metrics["null_key_rows"] == 3
        assert sorted(r.listing_id for r in store.read("listing").collect()) == [1, 2]
        missing = store.read("rejects").filter("`column` = 'listing_id' AND rule = 'R1_not_null'")
        assert missing.count() == 3
    with pytest.raises(IntegrityError, match="R1_not_null"):
        ingest_frame(df, scratch_path(spark, "null-keys-fail"), enforce="fail")


def test_upsert_matches_null_keys(spark):
    old = spark.createDataFrame([(1, "a"), (None, "b")], "k long, v string")
    new = spark.createDataFrame([(None, "c")], "k long, v string")
    got = merge_upsert(old, new, ["k"])
    assert sorted(got.collect(), key=str) == sorted(merge_upsert(got, new, ["k"]).collect(), key=str) and got.count() == 2
