"""Layouts for search: the rows of a scan, from the blocks that can hold them."""

import random

import pytest
from pyspark.sql import functions as F

from hearth.operators.search import search
from hearth.schema import LISTING_SCHEMA
from hearth.session import scratch_path
from hearth.sources.layouts import SearchLayout, curve_key, grams, needle_grams


@pytest.fixture(scope="module")
def listing(spark):
    """40,000 listings; a third of them in one city, some without city, price or build year."""
    pick = lambda n, salt: F.pmod(F.xxhash64(F.col("id"), F.lit(salt)), F.lit(n))
    columns = {
        "listing_id": F.col("id"),
        "city": F.when(pick(3, 1) == 0, "Grande Ville").when(pick(50, 2) > 0, F.concat(F.lit("Ville-"), pick(400, 3).cast("string"), F.lit(" Éz"))),
        "zipcode": F.lpad((pick(900, 4) + 1000).cast("string"), 5, "0"),
        "price": F.when(pick(40, 5) > 0, F.pow(F.lit(1.001), pick(9000, 6)).cast("float")).otherwise(F.lit(None)),
        "area": (pick(3000, 7) / 10).cast("float"),
        "build_year": F.when(pick(4, 8) > 0, (pick(150, 9) + 1870).cast("smallint")),
    }
    rows = spark.range(40_000).select(*(columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in LISTING_SCHEMA))
    path = scratch_path(spark, "layout-listing")
    rows.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def by_curve(spark, listing):
    return SearchLayout.build(listing, scratch_path(spark, "layout-curve"), 64)


@pytest.fixture(scope="module")
def by_text(spark, listing):
    return SearchLayout.build(listing, scratch_path(spark, "layout-text"), 64, order=("city", "zipcode"))


def scan(df):
    """Metrics of the file scan of an executed frame."""
    plan = df._jdf.queryExecution().executedPlan()
    while plan.nodeName().strip() != "Scan parquet":
        plan = plan.executedPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan.children().head()
    return {k: plan.metrics().apply(k).value() for k in ("numFiles", "filesSize")}


def ids(df):
    return sorted(r.listing_id for r in df.select("listing_id").collect())


SEARCHES = [
    {"city": "vILLE-17"}, {"city": "éZ"}, {"city": "le-3"}, {"city": "g"}, {"city": "Grande"}, {"city": "nowhere"}, {"city": "9 é"},
    {"zipcode": "0100"}, {"zipcode": "17"}, {"zipcode": "5"}, {"zipcode": "99999"}, {"city": "-25", "zipcode": "012"},
    {"min_price": 10.0, "max_price": 20.0}, {"max_area": 12.5}, {"min_build_year": 2010}, {"min_price": 0.0}, {"max_price": -1.0},
    {"min_price": 30.0, "max_price": 90.0, "min_area": 100.0, "max_area": 140.0, "min_build_year": 1900, "max_build_year": 1930},
    {"city": "ville", "min_area": 290.0, "has_build_year": False}, {"has_build_year": True}, {"city": "", "zipcode": ""}, {},
]


@pytest.mark.parametrize("params", SEARCHES, ids=str)
def test_rows_of_a_scan(listing, by_curve, by_text, params):
    want = ids(search(listing, None, params))
    assert ids(by_curve.search(None, params)) == want
    assert ids(by_text.search(None, params)) == want


def test_random_searches(listing, by_curve, by_text):
    rnd = random.Random(5)
    for _ in range(8):
        a, b = sorted(rnd.choice((0.0, 1.0, 5.0, 50.0, 500.0, 8000.0)) for _ in range(2))
        p = {"min_price": a, "max_price": b, "min_area": rnd.choice((None, 10.0, 200.0)), "city": rnd.choice((None, "1", "-1", "e-2", "VILLE")),
             "max_build_year": rnd.choice((None, 1900, 1990))}
        want = ids(search(listing, None, p))
        assert ids(by_curve.search(None, p)) == want == ids(by_text.search(None, p))


def test_ranges_read_few_blocks(listing, by_curve):
    box = SEARCHES[17]
    found, whole = by_curve.search(None, box), by_curve.rows()
    found.collect()
    whole.collect()
    assert scan(found)["filesSize"] < scan(whole)["filesSize"] / 4
    assert len(by_curve.blocks_of(box)) <= 16
    assert len(by_curve.blocks_of({"min_price": 10.0, "max_price": 20.0})) <= 40  # one of three dimensions
    assert by_curve.blocks_of({"max_price": -1.0}) == [] and by_curve.blocks_of({"has_build_year": True}) is None


def test_needles_read_few_blocks(by_text):
    found = by_text.search(None, city="ville-177")
    found.collect()
    assert 1 <= scan(found)["numFiles"] <= 4
    counts = {r.verified: r["count"] for r in by_text.candidates("city", "lle-lle").groupBy("verified").count().collect()}
    assert counts == {}  # "-ll" is in no city
    counts = {r.verified: r["count"] for r in by_text.candidates("city", "VILLE-1").groupBy("verified").count().collect()}
    assert counts == {True: 111}
    assert by_text.blocks_of(city="nowhere") == []


def test_candidates_are_verified(spark):
    rows = spark.createDataFrame([("abcabd",), ("bcabab",), ("abcab",), (None,), ("",)], "city string")
    layout = SearchLayout.build(rows, scratch_path(spark, "layout-grams"), 2, order=("city",))
    # all grams of the needle, but not in a row
    assert {(r.value, r.verified) for r in layout.candidates("city", "bcabd").collect()} == {("abcabd", True)}
    rows = spark.createDataFrame([("abcd bcda",), ("abcda",)], "city string")
    layout = SearchLayout.build(rows, scratch_path(spark, "layout-grams"), 2, order=("city",))
    assert {(r.value, r.verified) for r in layout.candidates("city", "ABCDA").collect()} == {("abcd bcda", False), ("abcda", True)}


def test_a_city_with_many_rows_fills_several_blocks(by_text):
    sizes = {r.block: r["rows"] for r in by_text.zones().collect()}
    assert sum(sizes.values()) == 40_000 and max(sizes.values()) < 4 * 40_000 / 64
    assert by_text.values().where("column = 'city' AND value = 'grande ville'").count() >= 15


def test_equal_rows_and_empty_tables(spark, listing):
    empty = SearchLayout.build(listing.limit(0), scratch_path(spark, "layout-empty"), 4)
    assert ids(empty.search(None, city="a", min_price=1.0)) == [] and ids(empty.search()) == []
    copies = listing.where("listing_id = 7").crossJoin(spark.range(5000).select(F.lit(1).alias("one"))).drop("one")
    layout = SearchLayout.build(copies, scratch_path(spark, "layout-copies"), 8)
    assert layout.search().count() == 5000 and max(r["rows"] for r in layout.zones().collect()) < 2500
    with pytest.raises(ValueError):
        SearchLayout.build(listing.withColumn("block", F.lit(1)), scratch_path(spark, "layout-bad"), 4)


def test_curve_interleaves_cells(spark):
    rows = spark.createDataFrame([(float(a), float(b)) for a in range(16) for b in range(16)] + [(None, 3.0)], "price double, area double")
    got = rows.select("price", "area", curve_key(rows, ("price", "area"), 2).alias("k")).collect()
    cell = lambda v: 0 if v is None else sum(v >= c for c in (4, 8, 12))
    place = lambda a, b: sum((a >> k & 1) << 2 * k | (b >> k & 1) << 2 * k + 1 for k in range(2))
    off = [r for r in got if r.k != place(cell(r.price), cell(r.area))]
    assert len(off) <= 64  # quantiles may fall one value beside
    assert len({r.k for r in got}) == 16


def test_grams(spark):
    got = spark.createDataFrame([("aéa",), ("",), ("x",)], "t string").select(grams(F.col("t")).alias("g")).collect()
    assert [sorted(r.g) for r in got] == [sorted({"a", "é", "aé", "éa", "aéa"}), [], ["x"]]
    assert needle_grams("abcd") == ["abc", "bcd"] and needle_grams("ab") == ["ab"]
