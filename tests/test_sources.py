"""Readers and writers: JSON / CSV round trips, option pass-through, errors."""

import pytest
from pyspark.sql import Row

from hearth.plans.pipeline import clean_listings
from hearth.schema import RAW_SCHEMA
from hearth.session import scratch_path
from hearth.sources import files as FS
from hearth.sources.tables import TableStore, is_empty


def sample(spark):
    base = {f.name: None for f in RAW_SCHEMA.fields}
    rows = [
        {**base, "listing_id": 1, "transaction_type": "T.SELL", "item_type": "ITEM_TYPE.HOUSE", "start_date": 1_600_000_000_000,
         "change_date": 1_600_000_100_000, "price": 12.5, "city": "Paris", "zipcode": " 75001 ", "has_garden": True,
         "description_fr": 'ligne "un",\ndeux; trois'},
        {**base, "listing_id": 2, "transaction_type": "T.RENT", "item_type": "ITEM_TYPE.PLOT", "start_date": 1_600_000_000_000,
         "price": 3.0, "city": "Lyon", "zipcode": "69", "description_fr": ""},
    ]
    return spark.createDataFrame([Row(**r) for r in rows], RAW_SCHEMA)


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_round_trip_through_feed(spark, fmt):
    df = sample(spark)
    path = FS.write_feed(df, scratch_path(spark, f"rt-{fmt}"), fmt)
    back = FS.read_input(spark, path, fmt)
    a = sorted(tuple(r) for r in clean_listings(df)[1].collect())
    b = sorted(tuple(r) for r in clean_listings(back)[1].collect())
    assert a == b and len(a) == 2
    if fmt == "json":
        descr = {r.listing_id: r.description_fr for r in back.collect()}
        assert descr["1"] == 'ligne "un",\ndeux; trois'


def test_untyped_and_typed_loads(spark):
    path = FS.write_feed(sample(spark), scratch_path(spark, "rt-u"), "json")
    u = FS.read_untyped(spark, path)
    assert dict(u.dtypes)["listing_id"] == "string"
    t = FS.read_typed(spark, path)
    assert dict(t.dtypes)["start_date"] == "timestamp_ntz"


def test_unknown_format_raises(spark):
    with pytest.raises(ValueError):
        FS.read_input(spark, "/nowhere", "xml")


def test_table_store_versions(spark):
    store = TableStore(spark, scratch_path(spark, "ts"))
    assert store.read("t") is None and store.versions("t") == []
    store.write_version("t", spark.range(3))
    store.write_version("t", spark.range(5), partitions=1)
    assert store.versions("t") == [1, 2]
    assert store.read("t").count() == 5
    assert is_empty(spark.range(0)) and not is_empty(spark.range(1))


def test_register_views_for_sql(spark):
    from hearth.plans.pipeline import clean_listings
    from hearth.sources.fixture import raw_listings

    cats, lst = clean_listings(raw_listings(spark, "/root/testdata/sf0.001"))
    store = TableStore(spark, scratch_path(spark, "views"))
    store.write_version("listing", lst)
    store.write_version("item_category", cats)
    assert store.register_views(prefix="v_") == ["v_listing", "v_item_category"]
    n = spark.sql(
        "SELECT count(*) AS n FROM v_listing l JOIN v_item_category c ON l.item_subcategory = c.subcategory "
        "WHERE c.category = 'HOUSE'"
    ).first().n
    assert n == lst.join(cats, lst.item_subcategory == cats.subcategory).filter("category = 'HOUSE'").count()


def test_a_write_after_an_interrupted_one(spark):
    """A folder without _SUCCESS is neither read nor in the way."""
    store = TableStore(spark, scratch_path(spark, "interrupted"))
    store.write_version("t", spark.range(3))
    spark.conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        spark.range(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{store.root}/t/v=000002")
    finally:
        spark.conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert store.versions("t") == [1] and store.read("t").count() == 3
    assert store.write_version("t", spark.range(5)).endswith("v=000003")
    assert store.versions("t") == [1, 3] and store.read("t").count() == 5


def test_json_values_are_cast_and_bad_ones_raise(spark, tmp_path):
    import json

    from hearth.plans.ingest import IntegrityError, ingest
    from hearth.plans.policies import TransformPolicy

    row = {"transaction_type": "SELL", "item_type": "HOUSE", "item_subtype": "VILLA", "start_date": 1300000000123.0, "change_date": "1300000000123",
           "price": 1.0, "city": "c", "zipcode": "75001"}
    lines = [json.dumps({**row, "listing_id": "2", "area": "60.5", "has_garden": "true"}), json.dumps({**row, "listing_id": 3.0})]
    good, bad = tmp_path / "good.json", tmp_path / "bad.json"
    good.write_text("\n".join([*lines, "{no record"]))
    bad.write_text(json.dumps({**row, "listing_id": 4, "price": "abc"}))
    got = {r.listing_id: r for r in clean_listings(FS.read_input(spark, str(good)))[1].collect()}
    assert sorted(got) == [2, 3] and got[2].area == 60.5 and got[2].has_garden is True
    assert str(got[3].start_date) == str(got[2].change_date) == "2011-03-13 07:06:40"
    with pytest.raises(Exception, match="abc"):
        clean_listings(FS.read_input(spark, str(bad)))[1].collect()
    lenient = TransformPolicy(on_bad_cast="null")
    assert clean_listings(FS.read_input(spark, str(bad)), lenient)[1].collect()[0].price is None
    root = scratch_path(spark, "corrupt")
    with pytest.raises(IntegrityError, match="1 lines"):
        ingest(spark, str(good), root, enforce="fail")
    rep = ingest(spark, str(good), root, enforce="reject")
    assert rep.metrics["corrupt_lines"] == 1
    assert [r[0] for r in TableStore(spark, root).read("corrupt_lines").collect()] == ["{no record"]


def test_text_dates_of_a_json_feed(spark, tmp_path):
    import json

    from hearth.plans.policies import TransformPolicy

    path = tmp_path / "dates.json"
    path.write_text(json.dumps({"listing_id": 1, "zipcode": "75001", "start_date": "2020-01-02 03:04:05", "change_date": "2020-02-03 00:00:00"}))
    got = clean_listings(FS.read_input(spark, str(path)), TransformPolicy(date_as_unixtime=False))[1].collect()
    assert str(got[0].start_date) == "2020-01-02 03:04:05"


def test_csv_splits_only_without_multi_line(spark, tmp_path):
    """One file of many lines: a task for each split, or one task for all where a text may go over several lines."""
    path = tmp_path / "feed.csv"
    path.write_text("listing_id,city\n" + "".join(f"{i},City {i}\n" for i in range(200_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 << 10))
    try:
        one, many = (FS.read_csv(spark, str(path), {"multiLine": m}) for m in ("true", "false"))
        assert one.rdd.getNumPartitions() == 1 and many.rdd.getNumPartitions() > 8
        assert one.count() == many.count() == 200_000 and one.exceptAll(many).isEmpty()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_feeds_are_compressed_files_of_bounded_size(spark, monkeypatch, fmt):
    """One task reads such a file whole: neither the table's size nor the writing partitions may set its size."""
    monkeypatch.setitem(FS.FEED_OPTIONS, "maxRecordsPerFile", 300)
    df = sample(spark).crossJoin(spark.range(1000)).drop("id").coalesce(1)
    path = FS.write_feed(df, scratch_path(spark, f"bounded-{fmt}"), fmt)
    back = FS.read_input(spark, path, fmt)
    files = back.inputFiles()
    assert len(files) == 7 and all(f.endswith(f".{fmt}.lz4") for f in files)
    assert back.count() == 2000
    plain = FS.write_feed(df, scratch_path(spark, f"plain-{fmt}"), fmt, {"compression": "none"})
    assert sorted(map(str, FS.read_input(spark, plain, fmt).collect())) == sorted(map(str, back.collect()))
