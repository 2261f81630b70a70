"""Integrity rules of the stored tables as DataFrame checks.

A check returns violation rows ``(rule, key, column, value)``; an empty
result means the rule holds. Row-level rules (R1–R4, R6) are evaluated in one
scan: each row yields an array of rule hits that is exploded, so adding a
rule adds an expression, not a pass over the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.schema import (
    CATEGORIES,
    CITY_MAX_LENGTH,
    FLOAT_COLUMNS,
    REQUIRED_CATEGORY_COLUMNS,
    REQUIRED_LISTING_COLUMNS,
    SMALLINT_COLUMNS,
    SUBCATEGORIES,
    TRANSACTION_TYPES,
    ZIPCODE_MAX_LENGTH,
    ZIPCODE_PATTERN,
)

VIOLATION_COLUMNS = ("rule", "key", "column", "value")


def _hit(rule: str, column: str, broken: Column, value: Column) -> Column:
    return F.when(
        broken,
        F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("column"), value.cast("string").alias("value")),
    )


def row_violations(df: DataFrame, key: str, hits: list[Column]) -> DataFrame:
    """Explode the non-null rule hits of every row into violation rows."""
    if not hits:
        return empty_violations(df)
    arr = F.filter(F.array(*hits), lambda h: h.isNotNull())
    return (
        df.select(F.col(key).cast("string").alias("key"), F.explode(arr).alias("h"))
        .select("h.rule", "key", "h.column", "h.value")
    )


def empty_violations(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], "rule string, key string, column string, value string")


# ------------------------------------------------------------------ row rules
def not_null_hits(df: DataFrame, cols) -> list[Column]:
    """Required columns must not be null."""
    return [_hit("R1_not_null", c, F.col(c).isNull(), F.lit(None)) for c in cols if c in df.columns]


def non_negative_hits(df: DataFrame, strict_measures: bool = False) -> list[Column]:
    """R2: counts and measures >= 0; ``strict_measures`` demands measures > 0."""
    out = []
    for c in SMALLINT_COLUMNS:
        if c in df.columns and c != "floor":
            out.append(_hit("R2_non_negative", c, F.col(c) < 0, F.col(c)))
    for c in FLOAT_COLUMNS:
        if c in df.columns:
            bad = F.col(c) <= 0 if strict_measures else F.col(c) < 0
            out.append(_hit("R2_non_negative", c, bad, F.col(c)))
    return out


def enum_hits(df: DataFrame, members: dict[str, tuple[str, ...]]) -> list[Column]:
    """Coded columns must hold an enum member (null is R1's business)."""
    return [
        _hit("R3_enum", c, F.col(c).isNotNull() & ~F.col(c).isin(*vals), F.col(c))
        for c, vals in members.items()
        if c in df.columns
    ]


def format_hits(df: DataFrame) -> list[Column]:
    """Zipcode all digits and at most 5 characters; city at most 255."""
    out = []
    if "zipcode" in df.columns:
        z = F.col("zipcode")
        bad = z.isNotNull() & (~z.rlike(ZIPCODE_PATTERN) | (F.length(z) > ZIPCODE_MAX_LENGTH))
        out.append(_hit("R4_format", "zipcode", bad, z))
    if "city" in df.columns:
        out.append(_hit("R4_format", "city", F.length("city") > CITY_MAX_LENGTH, F.col("city")))
    return out


def date_order_hits(df: DataFrame) -> list[Column]:
    """change_date >= start_date."""
    if not {"start_date", "change_date"} <= set(df.columns):
        return []
    return [_hit("R6_change_after_start", "change_date", F.col("change_date") < F.col("start_date"), F.col("change_date"))]


LISTING_ENUMS = {"transaction_type": TRANSACTION_TYPES, "item_subcategory": SUBCATEGORIES}
CATEGORY_ENUMS = {"subcategory": SUBCATEGORIES, "category": CATEGORIES}


def listing_row_violations(listing: DataFrame, strict_measures: bool = False) -> DataFrame:
    """R1, R2, R3, R4, R6 on listing rows, one scan."""
    hits = (
        not_null_hits(listing, REQUIRED_LISTING_COLUMNS)
        + non_negative_hits(listing, strict_measures)
        + enum_hits(listing, LISTING_ENUMS)
        + format_hits(listing)
        + date_order_hits(listing)
    )
    return row_violations(listing, "listing_id", hits)


def category_row_violations(item_category: DataFrame) -> DataFrame:
    """R1 and R3 on category rows."""
    hits = not_null_hits(item_category, REQUIRED_CATEGORY_COLUMNS) + enum_hits(item_category, CATEGORY_ENUMS)
    return row_violations(item_category, "subcategory", hits)


# ------------------------------------------------------------------ set rules
def foreign_key_violations(listing: DataFrame, item_category: DataFrame) -> DataFrame:
    """Listing subcategories absent from the category table.

    Left-anti join; the category side is small and Spark's size check
    (static or AQE runtime) broadcasts it.
    """
    cats = item_category.select(F.col("subcategory").alias("__sub"))
    return (
        listing.filter(F.col("item_subcategory").isNotNull())
        .join(cats, F.col("item_subcategory") == F.col("__sub"), "left_anti")
        .select(
            F.lit("R5_foreign_key").alias("rule"),
            F.col("listing_id").cast("string").alias("key"),
            F.lit("item_subcategory").alias("column"),
            F.col("item_subcategory").alias("value"),
        )
    )


def key_violations(df: DataFrame, key: str, rule: str = "R7_primary_key") -> DataFrame:
    """Keys that occur more than once (null keys are R1's business).

    A plain ``groupBy(key).count()``: partial aggregation collapses a hot key
    on the map side, so a skewed key costs one row per map task.
    """
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .select(
            F.lit(rule).alias("rule"),
            F.col(key).cast("string").alias("key"),
            F.lit(key).alias("column"),
            F.col("n").cast("string").alias("value"),
        )
    )


def update_violations(existing: DataFrame, incoming: DataFrame, key: str = "listing_id") -> DataFrame:
    """R8 start_date must not change; R9 change_date must not decrease.

    Only keys present on both sides are updates; one join, both rules.
    """
    old = existing.select(
        F.col(key).alias("__k"), F.col("start_date").alias("__old_start"), F.col("change_date").alias("__old_change")
    )
    inc = incoming.select(key, "start_date", "change_date")
    j = inc.join(old, F.col(key) == F.col("__k"))
    hits = [
        _hit("R8_start_date_immutable", "start_date", F.col("start_date") != F.col("__old_start"), F.col("start_date")),
        _hit("R9_change_date_monotonic", "change_date", F.col("change_date") < F.col("__old_change"), F.col("change_date")),
    ]
    return row_violations(j, key, hits)


def reject(df: DataFrame, violations: DataFrame, key: str, rules_prefix: tuple[str, ...] | None = None) -> DataFrame:
    """Rows of ``df`` whose key has no violation (the 'reject' policy's keep set).

    A null key breaks R1 and names no row, so its rows are never kept.
    """
    v = violations
    if rules_prefix:
        cond = F.lit(False)
        for p in rules_prefix:
            cond = cond | F.col("rule").startswith(p)
        v = v.filter(cond)
    bad = v.select(F.col("key").alias("__bad")).distinct()
    return df.filter(F.col(key).isNotNull()).join(bad, F.col(key).cast("string") == F.col("__bad"), "left_anti")
