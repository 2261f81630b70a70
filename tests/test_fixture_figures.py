"""The clean pipeline reproduces the figures recorded for sf0.01 (FIXTURES.md §4)."""

from pyspark.sql import functions as F

from hearth.plans.pipeline import clean_listings
from hearth.sources.fixture import raw_listings


def test_sf001_figures(spark):
    raw = raw_listings(spark, "/root/testdata/sf0.01")
    r = raw.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("listing_id").alias("ids"), F.sum("listing_id").alias("sum_id"),
        F.sum("start_date").alias("sum_start"), F.sum("change_date").alias("sum_change"),
        F.count("area").alias("area"), F.count("zipcode").alias("zipcode"), F.count("item_subtype").alias("subtype"),
        F.count_if(F.col("has_garden")).alias("garden"), F.count_if(F.col("change_date") < F.col("start_date")).alias("inv"),
    ).first()
    assert (r.rows, r.ids, r.sum_id) == (60000, 14743, 451230286)
    assert (r.sum_start, r.sum_change) == (87871224717780000, 85153157754207064)
    assert (r.area, r.zipcode, r.subtype, r.garden, r.inv) == (55457, 54055, 38695, 19957, 6301)

    cats, lst = clean_listings(raw)
    secs = lambda c: F.unix_micros(F.col(c).cast("timestamp")) / 1_000_000  # noqa: E731  (UTC session)
    c = lst.agg(
        F.count(F.lit(1)).alias("n"), F.sum("listing_id").alias("sum_id"),
        F.sum(secs("change_date")).cast("bigint").alias("sum_change"), F.sum(secs("start_date")).cast("bigint").alias("sum_start"),
        F.sum("build_year").alias("sum_by"), F.max("build_year").alias("max_by"),
        F.count_if(F.col("zipcode") == "75000").alias("z75"), F.count_distinct("item_subcategory").alias("subs"),
        F.count_if(F.col("item_subcategory") == "HOUSE").alias("house"), F.count_if(F.length("zipcode") > 5).alias("long_zip"),
    ).first()
    assert (c.n, c.sum_id) == (11752, 88177580)
    assert (c.sum_change, c.sum_start) == (17800686236800, 17209640512000)
    assert (c.sum_by, c.max_by) == (20739564, 2034)
    assert (c.z75, c.subs, c.house, c.long_zip) == (1469, 7, 136, 1461)
