"""Clean steps on tiny inline frames: one test per semantic note."""

import datetime as dt
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from hearth.operators import clean as C
from hearth.plans.pipeline import clean_listings
from hearth.plans.policies import TransformPolicy
from hearth.schema import LISTING_SCHEMA, RAW_SCHEMA


def raw_rows(spark, rows):
    base = {f.name: None for f in RAW_SCHEMA.fields}
    return spark.createDataFrame([Row(**{**base, **r}) for r in rows], RAW_SCHEMA)


def test_normalize_enum_keeps_last_segment_and_null(spark):
    df = spark.createDataFrame([("A.B.C",), ("ABC",), (None,)], "item_type string")
    out = [r.item_type for r in C.normalize_enum(df, ["item_type", "absent"]).collect()]
    assert out == ["C", "ABC", None]


def test_fill_subtype_and_missing_column_guard(spark):
    df = spark.createDataFrame([("HOUSE", None), ("HOUSE", "VILLA"), (None, None)], "item_type string, item_subtype string")
    assert [r.item_subtype for r in C.fill_subtype(df).collect()] == ["HOUSE", "VILLA", None]
    only = df.select("item_type")
    assert C.fill_subtype(only).columns == ["item_type"]


def test_epoch_ms_truncates_toward_zero_and_ignores_session_zone(spark):
    df = spark.createDataFrame([(-1500, 1698543000999), (0, None)], "start_date long, change_date long")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
        rows = C.to_timestamps(df).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert rows[0].start_date == dt.datetime(1969, 12, 31, 23, 59, 59)
    # 2023-10-29 01:30:00.999 UTC (autumn clock change in Paris) stays 01:30:00
    assert rows[0].change_date == dt.datetime(2023, 10, 29, 1, 30, 0)
    assert rows[1].change_date is None
    assert C.to_timestamps(df).schema["start_date"].dataType.simpleString() == "timestamp_ntz"


def test_non_negative_keeps_null_and_nan_and_negative_floor(spark):
    df = spark.createDataFrame(
        [(1, -1.0, 0.0, -3.0), (2, None, 1.0, 0.0), (3, float("nan"), 1.0, 0.0), (4, 5.0, -0.5, 1.0)],
        "id int, price double, area double, floor double",
    )
    ids = sorted(r.id for r in C.enforce_non_negative(df).collect())
    assert ids == [2, 3]
    df2 = df.filter("id = 1").drop("price")
    assert [r.id for r in C.enforce_non_negative(df2).collect()] == [1]  # floor is not checked


def test_zipcode_cleanup(spark):
    df = spark.createDataFrame([(" F-34230 ",), ("n/a",), (None,), ("75",), ("75.0",), ("1234567",)], "zipcode string")
    out = [r.zipcode for r in C.clean_zipcode(df).collect()]
    assert out == ["34230", "75000", "750", "1234567"]
    kept = [r.zipcode for r in C.clean_zipcode(df, drop_invalid=False, expand_two_digits=False).collect()]
    assert kept == ["34230", "", None, "75", "750", "1234567"]


def test_build_year_adjust_uses_global_max(spark):
    df = spark.createDataFrame(
        [(19601970.0, dt.datetime(2020, 1, 1)), (19320.0, dt.datetime(2010, 1, 1)), (2024.0, dt.datetime(2010, 1, 1)),
         (1999.0, None), (None, dt.datetime(2015, 1, 1))],
        "build_year double, start_date timestamp_ntz",
    )
    out = [r.build_year for r in C.adjust_build_year(df, "adjust").collect()]
    # max start year is 2020: 19601970 -> 1960, 19320 -> 1932, 2024 -> 2024 (prefix of 4 digits)
    assert out == [1960, 1932, 2024, 1999, None]
    assert [r.build_year for r in C.adjust_build_year(df, "adjust", max_year=20000000).collect()][:2] == [19601970, 19320]


def test_build_year_adjust_without_start_dates_is_identity(spark):
    df = spark.createDataFrame([(1999.0, None)], "build_year double, start_date timestamp_ntz")
    assert C.adjust_build_year(df, "adjust").collect()[0].build_year == 1999


def test_build_year_drop_uses_own_year_and_drops_null_start(spark):
    df = spark.createDataFrame(
        [(1, 2030.0, dt.datetime(2020, 1, 1)), (2, 2010.0, dt.datetime(2020, 1, 1)), (3, 1990.0, None), (4, None, None)],
        "id int, build_year double, start_date timestamp_ntz",
    )
    assert sorted(r.id for r in C.adjust_build_year(df, "drop").collect()) == [2, 4]


def test_change_date_policies(spark):
    d1, d2 = dt.datetime(2020, 1, 1), dt.datetime(2021, 1, 1)
    df = spark.createDataFrame([(1, d2, d1), (2, d1, None), (3, d1, d2), (4, None, d1)],
                               "id int, start_date timestamp_ntz, change_date timestamp_ntz")
    adj = {r.id: r.change_date for r in C.adjust_change_date(df, "adjust").collect()}
    assert adj == {1: d2, 2: d1, 3: d2, 4: d1}
    assert sorted(r.id for r in C.adjust_change_date(df, "drop").collect()) == [3]


def test_unknown_policies_raise(spark):
    df = spark.createDataFrame([(1.0, dt.datetime(2020, 1, 1))], "build_year double, start_date timestamp_ntz")
    with pytest.raises(ValueError):
        C.adjust_build_year(df, "clip")
    with pytest.raises(ValueError):
        C.adjust_change_date(df, "keep")
    with pytest.raises(ValueError):
        TransformPolicy(adjust_build_year_policy="nope")


def test_strict_and_lenient_casts(spark):
    df = spark.createDataFrame([("abc", "3.7")], "price string, floor string")
    with pytest.raises(Exception):
        C.cast_known_columns(df).collect()
    r = C.cast_known_columns(df, on_bad_cast="null").collect()[0]
    assert r.price is None and r.floor == 3.7
    big = spark.createDataFrame([(40000.0, 3.7)], "floor double, room_count double")
    with pytest.raises(Exception):
        C.finalize_types(big).collect()
    assert C.finalize_types(big.select("room_count")).collect()[0].room_count == 3


def test_keep_latest_is_deterministic_under_ties(spark):
    d = dt.datetime(2020, 1, 1)
    rows = [(1, d, 5.0, "b"), (1, d, 3.0, "a"), (1, None, 1.0, "c"), (2, None, 9.0, "x"), (2, None, 8.0, "y")]
    survivors = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "listing_id int, change_date timestamp_ntz, price double, city string")
        survivors.add(tuple(sorted(tuple(r) for r in C.keep_latest(df.repartition(3)).collect())))
    assert survivors == {((1, d, 3.0, "a"), (2, None, 8.0, "y"))}


def test_item_categories_min_and_empty(spark):
    df = spark.createDataFrame([("X", "B"), ("X", "A"), ("Y", None), (None, "C")], "item_subtype string, item_type string")
    out = {r.subcategory: r.category for r in C.item_categories(df).collect()}
    assert out == {"X": "A", "Y": None}
    empty = C.item_categories(spark.createDataFrame([(1,)], "x int"))
    assert empty.count() == 0 and empty.columns == ["subcategory", "category"]


def test_listing_projection_fills_typed_nulls(spark):
    df = spark.createDataFrame([(1, "VILLA")], "listing_id long, item_subtype string")
    out = C.listing_projection(df)
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in LISTING_SCHEMA.fields]
    assert out.collect()[0].item_subcategory == "VILLA"


def test_clean_pipeline_house_subtype_and_dedup(spark):
    ms = 1_600_000_000_000
    df = raw_rows(spark, [
        dict(listing_id=1, transaction_type="T.SELL", item_type="ITEM_TYPE.HOUSE", item_subtype=None,
             start_date=ms, change_date=ms + 1000, price=10.0, city="c", zipcode="75", build_year=19601970.0),
        dict(listing_id=1, transaction_type="T.SELL", item_type="ITEM_TYPE.HOUSE", item_subtype=None,
             start_date=ms, change_date=ms - 5000, price=11.0, city="c", zipcode="75"),
        dict(listing_id=2, transaction_type="T.RENT", item_type="ITEM_TYPE.APARTMENT", item_subtype="ITEM_TYPE.APARTMENT.DUPLEX",
             start_date=ms, change_date=None, price=-1.0, city="c", zipcode="75001"),
    ])
    cats, lst = clean_listings(df)
    rows = lst.collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.listing_id, r.item_subcategory, r.zipcode, r.build_year, r.price) == (1, "HOUSE", "75000", 1960, 10.0)
    assert r.change_date == dt.datetime(2020, 9, 13, 12, 26, 41)
    assert {(c.subcategory, c.category) for c in cats.collect()} == {("HOUSE", "HOUSE")}
    assert lst.schema == LISTING_SCHEMA
    drop = TransformPolicy(adjust_change_date_policy="drop", deduplicate=False)
    assert clean_listings(df, drop)[1].count() == 1


def test_keep_latest_plans_partial_limit_before_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("listing_id"), F.col("id").cast("timestamp").alias("change_date"))
    plan = C.keep_latest(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_materialized_clean_equals_lazy(spark):
    from hearth.sources.fixture import raw_listings

    raw = raw_listings(spark, "/root/testdata/sf0.001")
    lazy_c, lazy_l = clean_listings(raw)
    mat_c, mat_l = clean_listings(raw, materialize=True)
    assert sorted(tuple(r) for r in lazy_l.collect()) == sorted(tuple(r) for r in mat_l.collect())
    assert sorted(tuple(r) for r in lazy_c.collect()) == sorted(tuple(r) for r in mat_c.collect())


def test_clean_pipeline_with_few_columns(spark):
    ms = 1_600_000_000_000
    df = spark.createDataFrame(
        [(1, ms, ms + 5000, 10.0), (1, ms, ms + 9000, 12.0), (2, ms, None, -1.0), (3, ms, None, 3.0)],
        "listing_id long, start_date long, change_date long, price double",
    )
    cats, lst = clean_listings(df)
    assert lst.schema == LISTING_SCHEMA
    rows = sorted((r.listing_id, r.price, r.city, r.build_year) for r in lst.collect())
    assert rows == [(1, 12.0, None, None), (3, 3.0, None, None)]
    assert cats.count() == 0 and cats.columns == ["subcategory", "category"]
    mat_c, mat_l = clean_listings(df, materialize=True)
    assert sorted(tuple(r) for r in mat_l.collect()) == sorted(tuple(r) for r in lst.collect())


def test_text_dates_are_parsed_when_not_epoch(spark):
    df = spark.createDataFrame([(1, "2020-01-02 03:04:05", "2020-01-01 00:00:00", 1.0)],
                               "listing_id long, start_date string, change_date string, price double")
    _, lst = clean_listings(df, TransformPolicy(date_as_unixtime=False))
    r = lst.collect()[0]
    assert r.start_date == dt.datetime(2020, 1, 2, 3, 4, 5)
    assert r.change_date == r.start_date  # earlier change date clamped to the start
