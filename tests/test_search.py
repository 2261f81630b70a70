"""Search: seeded versions of the property tests, enum and paging checks."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hearth.operators import search as S
from hearth.schema import CATEGORIES, SUBCATEGORIES, TRANSACTION_TYPES
from tests.test_plans import formatted


def random_params(rng):
    p = {"limit": rng.randint(1, 200)}
    for name, pool in (("subcategory", SUBCATEGORIES), ("category", CATEGORIES), ("transaction_type", TRANSACTION_TYPES)):
        v = rng.choice(list(pool) + [None] * 3)
        if v:
            p[name] = v
    if rng.random() < 0.3:
        p["city"] = rng.choice(["nation_1", "NATION", "city n", "zz"])
    if rng.random() < 0.3:
        p["zipcode"] = str(rng.randint(0, 99))
    for lo, hi, a, b in (("min_price", "max_price", 0, 100000), ("min_area", "max_area", 0, 200),
                         ("min_build_year", "max_build_year", 1800, 2100)):
        if rng.random() < 0.3:
            p[lo] = rng.uniform(a, b) if "year" not in lo else rng.randint(a, b)
        if rng.random() < 0.3:
            p[hi] = rng.uniform(a, b) if "year" not in hi else rng.randint(a, b)
    for flag in ("has_build_year", "has_garden", "has_passenger_lift", "is_new_construction", "has_cellar", "is_furnished"):
        v = rng.choice([None, None, True, False])
        if v is not None:
            p[flag] = v
    p["sort_by_change_date"] = rng.choice([None, "asc", "desc", "DESC", "other"])
    p["skip"] = rng.choice([0, 0, 5])
    return p


@pytest.mark.parametrize("seed", range(12))
def test_search_properties(small_tables, seed):
    cats, lst = small_tables
    rng = random.Random(seed)
    p = random_params(rng)
    page, total = S.search_listings(lst, cats, p)
    rows = page.collect()
    count = total.collect()[0]["count"]
    assert len(rows) <= p["limit"]
    assert count >= len(rows)
    cat_of = {r.subcategory: r.category for r in cats.collect()}
    for r in rows:
        if p.get("subcategory"):
            assert r.item_subcategory == p["subcategory"]
        if p.get("category"):
            assert cat_of[r.item_subcategory] == p["category"]
        if p.get("transaction_type"):
            assert r.transaction_type == p["transaction_type"]
        if p.get("city"):
            assert p["city"].lower() in r.city.lower()
        if p.get("zipcode"):
            assert p["zipcode"] in r.zipcode
        for col, lo, hi in (("price", "min_price", "max_price"), ("area", "min_area", "max_area"),
                            ("build_year", "min_build_year", "max_build_year")):
            if p.get(lo) is not None:
                assert getattr(r, col) >= p[lo]
            if p.get(hi) is not None:
                assert getattr(r, col) <= p[hi]
        if p.get("has_build_year") is not None:
            assert (r.build_year is not None) == p["has_build_year"]
        for flag in ("has_garden", "has_passenger_lift", "is_new_construction", "has_cellar", "is_furnished"):
            if p.get(flag) is not None:
                assert getattr(r, flag) == p[flag]
    key = (p["sort_by_change_date"] or "").lower()
    if key in ("asc", "desc"):
        dates = [r.change_date for r in rows]
        assert dates == sorted(dates, reverse=(key == "desc"))
    # the total equals the unpaged filtered count
    assert count == S.search(lst, cats, p).count()


def test_pages_tile_the_result(small_tables):
    cats, lst = small_tables
    p = {"transaction_type": "SELL", "sort_by_change_date": "desc"}
    everything = [r.listing_id for r in S.search_listings(lst, cats, p, limit=100000)[0].collect()]
    pages = []
    for skip in range(0, len(everything), 37):
        pages += [r.listing_id for r in S.search_listings(lst, cats, p, skip=skip, limit=37)[0].collect()]
    assert pages == everything


def test_enum_parameters_are_exact(small_tables):
    cats, lst = small_tables
    with pytest.raises(ValueError):
        S.search_listings(lst, cats, category="house")
    with pytest.raises(ValueError):
        S.category_by_subcategory(cats, "house")
    with pytest.raises(ValueError):
        S.search_categories(cats, "house")
    with pytest.raises(ValueError):
        S.search_listings(lst, cats, skip=-1)
    with pytest.raises(ValueError):
        S.search_listings(lst, cats, colour="red")


def test_text_filters_are_literal(spark):
    df = spark.createDataFrame([(1, "City 50% off", "12_45"), (2, "City 5000", "12345")], "listing_id long, city string, zipcode string")
    df = df.withColumn("change_date", F.current_timestamp())
    assert [r.listing_id for r in S.search(df, city="0%").collect()] == [1]
    assert [r.listing_id for r in S.search(df, zipcode="2_4").collect()] == [1]
    assert S.search(df, city="").count() == 2  # empty text = no filter


def test_zero_is_a_bound(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 5.0)], "listing_id long, price float")
    assert [r.listing_id for r in S.search(df, max_price=0.0).collect()] == [1]


def test_lookups(small_tables):
    cats, lst = small_tables
    some = lst.select("listing_id").first().listing_id
    assert [r.listing_id for r in S.listing_by_id(lst, some).collect()] == [some]
    assert S.listing_by_id(lst, -1).count() == 0
    for row in cats.collect():
        if row.subcategory in SUBCATEGORIES:
            got = S.category_by_subcategory(cats, row.subcategory).collect()
            assert [(g.subcategory, g.category) for g in got] == [(row.subcategory, row.category)]
            page, total = S.search_categories(cats, row.category)
            assert row.subcategory in [r.subcategory for r in page.collect()]


@pytest.mark.parametrize("seed", range(4))
def test_one_scan_fetch_equals_page_and_total(small_tables, seed):
    cats, lst = small_tables
    p = random_params(random.Random(100 + seed))
    page, total = S.search_listings(lst, cats, p)
    rows, count = S.fetch_listings(lst, cats, p)
    assert [tuple(r) for r in rows] == [tuple(r) for r in page.collect()]
    assert count == total.collect()[0]["count"]


def test_public_projection(small_tables):
    cats, lst = small_tables
    assert S.public_listing(lst).columns == lst.columns
    assert S.public_category(cats).columns == ["subcategory", "category"]


def test_fetch_with_zero_limit_returns(small_tables):
    cats, lst = small_tables
    rows, count = S.fetch_listings(lst, cats, limit=0)
    assert rows == [] and count == lst.count()


def test_null_change_dates_follow_row_store_order(spark):
    import datetime as dt

    df = spark.createDataFrame(
        [(1, dt.datetime(2020, 1, 1)), (2, None), (3, dt.datetime(2021, 1, 1)), (4, None)],
        "listing_id long, change_date timestamp_ntz",
    )
    asc = [r.listing_id for r in S.search_listings(df, sort_by_change_date="asc")[0].collect()]
    desc = [r.listing_id for r in S.search_listings(df, sort_by_change_date="DESC")[0].collect()]
    assert asc == [1, 3, 2, 4] and desc == [2, 4, 3, 1]


def test_fetch_total_when_input_is_already_in_page_order(spark):
    # The clean pipeline's dedup sorts by listing_id, the default page order:
    # the total must still count every matching row, not just those read.
    from hearth.plans.pipeline import clean_listings
    from hearth.sources.fixture import raw_listings

    cats, lst = clean_listings(raw_listings(spark, "/root/testdata/sf0.001"))
    rows, count = S.fetch_listings(lst, cats, city="nation_1")
    assert count == S.search(lst, cats, city="nation_1").count() and count > len(rows) == 100


@pytest.mark.parametrize("order", ["asc", "desc", None])
def test_seek_pages_equal_the_sorted_rows(spark, order):
    """Ties, nulls, and a page size that does not divide the rows."""
    rows = [(i, None if i % 5 == 0 else datetime(2024, 1, 1 + i % 3)) for i in range(97)]
    df = spark.createDataFrame(rows, "listing_id long, change_date timestamp_ntz").repartition(4)
    want = [r.listing_id for r in df.orderBy(*S.change_date_order(order)).collect()]
    got, after = [], None
    while (after := S.cursor(page := S.seek_page(df, order, after, 10))) is not None:
        got += [r.listing_id for r in page.collect()]
    assert got == want
    assert S.cursor(S.seek_page(df.limit(0), order)) is None


def test_seek_pages_are_bounded_and_pushed_down(spark, tmp_path):
    for limit in (0, -1, S.MAX_PAGE + 1):
        with pytest.raises(ValueError):
            S.seek_page(spark.range(1).withColumnRenamed("id", "listing_id"), None, None, limit)
    path = str(tmp_path / "seek")
    rows = spark.range(1000).selectExpr("id AS listing_id", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, int(id)) AS change_date")
    rows.repartitionByRange(4, "change_date").write.parquet(path)
    page = S.seek_page(spark.read.parquet(path), "desc", (datetime(2024, 6, 1), 5), 10)
    text = formatted(page)
    assert "TakeOrderedAndProject" in text and "Or(LessThan(change_date" in text
    assert [r.listing_id for r in page.collect()] == list(range(152, 142, -1))  # day 152 ties with the cursor, behind it by id


def test_a_row_added_between_pages_shifts_nothing(spark):
    df = spark.createDataFrame([(i, datetime(2024, 1, 1 + i)) for i in range(20)], "listing_id long, change_date timestamp_ntz")
    first = S.seek_page(df, "desc", None, 5)
    more = df.unionByName(spark.createDataFrame([(99, datetime(2025, 1, 1))], df.schema))
    assert [r.listing_id for r in S.seek_page(more, "desc", S.cursor(first), 5).collect()] == [14, 13, 12, 11, 10]


@pytest.mark.parametrize("order", ["asc", "desc", None])
def test_all_pages_at_once_equal_the_pages_one_by_one(spark, order):
    """Ties, nulls, and a page size that does not divide the rows; no job a page."""
    rows = [(i, None if i % 5 == 0 else datetime(2024, 1, 1 + i % 3)) for i in range(97)]
    df = spark.createDataFrame(rows, "listing_id long, change_date timestamp_ntz").repartition(4)
    want, after, number = [], None, 0
    while (after := S.cursor(page := S.seek_page(df, order, after, 10))) is not None:
        want += [(r.listing_id, number) for r in page.collect()]
        number += 1
    got = S.seek_pages(df, order, None, 10)
    assert got.dtypes == [*df.dtypes, ("page", "bigint")]
    assert sorted((r.listing_id, r.page) for r in got.collect()) == sorted(want)
    behind = S.seek_pages(df, order, S.cursor(S.seek_page(df, order, None, 10)), 10)
    assert sorted((r.listing_id, r.page + 1) for r in behind.collect()) == sorted(x for x in want if x[1])
    assert S.seek_pages(df.limit(0), order).count() == 0
    with pytest.raises(ValueError):
        S.seek_pages(df, order, None, S.MAX_PAGE + 1)


def test_the_paged_query_runs_no_job_a_page(spark, monkeypatch):
    from hearth import registry

    rows = spark.range(300).select(F.col("id").alias("listing_id"), F.lit(None).cast("timestamp_ntz").alias("change_date"), F.lit(True).alias("has_garden"))
    monkeypatch.setattr(registry, "listing", lambda *_: rows)
    monkeypatch.setattr(S, "MAX_PAGE", 5)
    calls = []
    page = S.seek_page
    monkeypatch.setattr(S, "seek_page", lambda *a: calls.append(a) or page(*a))
    got = registry._seek_pages(None, {"has_garden": True})(spark, "")
    assert len(calls) == 1  # of 60 pages
    assert sorted((r.listing_id, r.page) for r in got.collect()) == [(i, i // 5) for i in range(300)]
    monkeypatch.setattr(registry, "listing", lambda *_: rows.limit(0))
    assert registry._seek_pages(None, {"has_garden": True})(spark, "").count() == 0
