"""Listing-shaped raw feed derived from the driver's TPC-H style tables.

One raw listing record per line item: the order is the listing, each line is
one version of it, and the planted defects (duplicates, ties, null and
inverted dates, negative prices, dirty zipcodes, malformed build years)
follow from key arithmetic. The DuckDB text of the same projection lives in
``hearth.oracle`` and gives the same rows.

Join order is chosen for scale: orders are first narrowed to
``(o_orderkey, city)`` through customer and nation (the nation side is tiny
and is broadcast by Spark's size check). Line items meet the order side
first and ``part`` second. The other order (part first) would leave the feed
hash-partitioned by the listing key and save the keep-latest window its
shuffle, but then a listing key holding a large share of all rows makes the
order join skewed with nothing AQE may split (splitting would break the
window's required partitioning). With this order both sort-merge joins can
be split by AQE's skew handling, and the window's own shuffle is preceded
by a partial top-1, so a hot listing sends one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAY_MS = 86_400_000
EPOCH_BASE_MS = 1_300_000_000_123


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (``{sf_dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null() -> Column:
    return F.lit(None)


def raw_listings(
    spark: SparkSession,
    sf_dir: str,
    lineitem_filter: Column | None = None,
    start_shift_mod: int | None = None,
) -> DataFrame:
    """The raw listing feed (23 columns, dates in epoch ms).

    ``lineitem_filter`` restricts the line items first (used to split a feed
    into an existing and an incoming batch); ``start_shift_mod`` adds one day
    to ``start_date`` of every listing whose key is a multiple of it.
    """
    li = read_table(spark, sf_dir, "lineitem")
    if lineitem_filter is not None:
        li = li.filter(lineitem_filter)
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")

    order_city = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .select("o_orderkey", F.concat(F.lit("City "), F.col("n_name")).alias("city"))
    )
    rows = li.join(order_city, li.l_orderkey == order_city.o_orderkey).join(
        part, li.l_partkey == part.p_partkey
    )

    ok, pk, sk, ln = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    qty = F.col("l_quantity")
    pk6 = pk % 6
    start = F.lit(EPOCH_BASE_MS) + (ok % 4000) * F.lit(DAY_MS)
    if start_shift_mod is not None:
        start = start + F.when(ok % start_shift_mod == 0, F.lit(DAY_MS)).otherwise(F.lit(0))
    change = F.when(sk % 23 == 0, _null()).otherwise(
        F.lit(EPOCH_BASE_MS)
        + (ok % 4000) * F.lit(DAY_MS)
        + (((pk * 37 + ln * 1013) % 900) - 100) * F.lit(DAY_MS)
    )
    zip_kind = ok % 10
    return rows.select(
        ok.alias("listing_id"),
        F.when(ok % 3 == 0, "TRANSACTION_TYPE.RENT").otherwise("TRANSACTION_TYPE.SELL").alias("transaction_type"),
        F.when(pk6 <= 1, "ITEM_TYPE.HOUSE")
        .when(pk6 <= 3, "ITEM_TYPE.APARTMENT")
        .when(pk6 == 4, "ITEM_TYPE.PARKING")
        .otherwise("ITEM_TYPE.PLOT")
        .alias("item_type"),
        F.when(sk % 29 == 0, _null())
        .when(pk6 == 0, "ITEM_TYPE.HOUSE.VILLA")
        .when(pk6 == 1, "ITEM_TYPE.HOUSE.CHALET")
        .when(pk6 == 2, "ITEM_TYPE.APARTMENT.APARTMENT")
        .when(pk6 == 3, "ITEM_TYPE.APARTMENT.DUPLEX_OR_TRIPLEX")
        .otherwise(_null())
        .cast("string")
        .alias("item_subtype"),
        start.cast("bigint").alias("start_date"),
        change.cast("bigint").alias("change_date"),
        F.when(sk % 41 == 0, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice")).alias("price"),
        F.when(pk % 13 == 0, _null()).otherwise(qty * 4).cast("double").alias("area"),
        F.when(pk % 5 == 0, qty * 40).otherwise(_null()).cast("double").alias("site_area"),
        ((ln % 9) - 2).cast("double").alias("floor"),
        (ln % 6).cast("double").alias("room_count"),
        F.when(pk % 4 == 0, _null()).otherwise((pk % 3).cast("double")).cast("double").alias("balcony_count"),
        F.when(pk % 7 == 0, _null()).otherwise((pk % 2).cast("double")).cast("double").alias("terrace_count"),
        F.when(pk % 3 == 0, _null()).otherwise(sk % 2 == 0).cast("boolean").alias("has_garden"),
        F.col("city"),
        F.when(zip_kind == 0, "75")
        .when(zip_kind == 1, "n/a")
        .when(zip_kind == 2, _null())
        .when(zip_kind == 3, " F-34230 ")
        .when(zip_kind == 4, "1234567")
        .otherwise((F.lit(10000) + (ok * 31) % 80000).cast("string"))
        .cast("string")
        .alias("zipcode"),
        F.when(sk % 4 == 0, _null()).otherwise(sk % 3 == 0).cast("boolean").alias("has_passenger_lift"),
        (ln == 1).alias("is_new_construction"),
        F.when(pk % 11 == 0, _null())
        .when(pk % 97 == 0, F.lit(19601970.0))
        .when(pk % 89 == 0, F.lit(19320.0))
        .otherwise((F.lit(1850) + pk % 185).cast("double"))
        .cast("double")
        .alias("build_year"),
        F.when(pk % 2 == 0, _null()).otherwise(qty).cast("double").alias("terrace_area"),
        (sk % 5 == 0).alias("has_cellar"),
        F.when(F.col("l_returnflag") == "N", _null())
        .otherwise(F.col("l_returnflag") == "A")
        .cast("boolean")
        .alias("is_furnished"),
        F.concat(F.lit('ligne "'), F.col("p_name"), F.lit('"')).alias("description_fr"),
    )
