"""Plan shapes that carry the scale properties (checked with .explain output)."""

import pytest
from pyspark.sql import functions as F

from hearth.operators import clean as C
from hearth.operators import search as S
from hearth.operators.upsert import merge_upsert
from hearth.plans.pipeline import clean_listings
from hearth.sources.fixture import raw_listings


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    """The text ``df.explain("formatted")`` prints."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture
def no_auto_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_dedup_limits_before_its_shuffle(spark, no_auto_broadcast):
    _, lst = clean_listings(raw_listings(spark, "/root/testdata/sf0.001"))
    p = plan(lst)
    assert p.count("WindowGroupLimit") == 2  # partial (map side) + final
    assert p.index("WindowGroupLimit") < p.index("Exchange hashpartitioning(listing_id")


def test_small_batch_upsert_scans_the_table_without_shuffle(spark):
    existing = spark.range(1000).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    incoming = spark.range(990, 1010).select(F.col("id").alias("k"), F.lit("b").alias("v"))
    p = plan(merge_upsert(existing, incoming, ["k"]))
    assert "BroadcastHashJoin" in p and "LeftAnti" in p
    assert "Exchange hashpartitioning" not in p


def test_pages_are_top_k_and_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "listing")
    _, lst = clean_listings(raw_listings(spark, "/root/testdata/sf0.001"))
    lst.write.parquet(path)
    stored = spark.read.parquet(path)
    page, total = S.search_listings(stored, None, transaction_type="RENT", min_price=10.0, sort_by_change_date="desc")
    p = formatted(page)
    assert "TakeOrderedAndProject" in p
    assert "EqualTo(transaction_type,RENT)" in p and "GreaterThanOrEqual(price,10.0)" in p
    assert "PushedFilters" in p
    assert "ReadSchema: struct<transaction_type:string,price:float>" in formatted(total)


def test_no_unpartitioned_window_anywhere(spark):
    cats, lst = clean_listings(raw_listings(spark, "/root/testdata/sf0.001"))
    for df in (lst, cats, C.keep_latest(lst)):
        assert "Exchange SinglePartition" not in plan(df).split("Subquery")[0]


def test_materialized_clean_reads_the_staged_table_not_the_feed(spark):
    from hearth.plans.pipeline import materialized_frame
    from hearth.session import scratch_path
    from hearth.sources.files import read_input, write_feed

    feed = write_feed(raw_listings(spark, "/root/testdata/sf0.001"), scratch_path(spark, "plan-feed"), "json")
    df, metrics = materialized_frame(read_input(spark, feed, "json"))
    p = plan(df)
    assert "FileScan parquet" in p and "FileScan json" not in p
    assert metrics["prepared_rows"] > 0 and metrics["max_start_year"] is not None
