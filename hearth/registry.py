"""Registered queries: one Spark callable per operator, with its DuckDB oracle.

Every query reads the driver's tables under ``sf_dir`` (through the
listing-shaped feed of ``hearth.sources.fixture``) or data Spark derives
from them, and runs over the whole feed. Oracle text is built with
``hearth.oracle`` from the same column lists.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth import oracle as O
from hearth.functions.columns import parent_path
from hearth.operators import clean as C
from hearth.operators import integrity as R
from hearth.operators import profile as PR
from hearth.operators import search as S
from hearth.operators.dependencies import discover_dependencies
from hearth.operators.heavy import distinct_estimates, top_values
from hearth.operators.upsert import merge_upsert
from hearth.plans.ingest import ingest, keyed_tables
from hearth.plans.pipeline import clean_frame, clean_listings, prepare
from hearth.plans.policies import TransformPolicy
from hearth.schema import (
    CATEGORICAL_COLUMNS,
    CORRUPT_COLUMN,
    FLAG_COLUMNS,
    INTEGER_COLUMNS,
    ITEM_CATEGORY_KEY,
    ITEM_CATEGORY_SCHEMA,
    LISTING_KEY,
    LISTING_SCHEMA,
    MEASURE_COLUMNS,
    NON_NEGATIVE_COLUMNS,
    REQUIRED_LISTING_COLUMNS,
)
from hearth.session import scratch_path
from hearth.sources import files as FS
from hearth.sources import footers as FT
from hearth.sources.buckets import BucketStore
from hearth.sources.fixture import raw_listings
from hearth.sources.footers import footer_counts
from hearth.sources.layouts import SearchLayout
from hearth.sources.tables import TableStore, is_empty

NUMERIC_COLUMNS = MEASURE_COLUMNS + INTEGER_COLUMNS
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# ---------------------------------------------------------------------------
# shared frames
# ---------------------------------------------------------------------------
def raw(spark, sf) -> DataFrame:
    return raw_listings(spark, sf)


def typed(spark, sf) -> DataFrame:
    """The exploration load: declared types, both dates parsed, codes as given."""
    return C.to_timestamps(C.cast_known_columns(raw(spark, sf))).drop("description_fr")


def tables(spark, sf, policy: TransformPolicy = TransformPolicy(), materialize: bool = False, **raw_kw):
    """(item_category, listing); ``materialize`` where a query reads them more than once."""
    return clean_listings(raw_listings(spark, sf, **raw_kw), policy, materialize=materialize)


def listing(spark, sf) -> DataFrame:
    return tables(spark, sf)[1]


def categories(spark, sf) -> DataFrame:
    return tables(spark, sf)[0]


def cleaned(spark, sf) -> DataFrame:
    """The deduplicated frame with item_type and item_subtype (for profiles)."""
    return clean_frame(raw(spark, sf))


TYPED_CTE = (
    "typed_eda AS (SELECT * EXCLUDE (description_fr) REPLACE ({s} AS start_date, {c} AS change_date) FROM raw)"
).format(s=O.ts_from_ms("start_date"), c=O.ts_from_ms("change_date"))


def W(body: str, extra: str = "", **kw) -> str:
    """SQL over the clean-pipeline CTEs (plus optional extra CTEs)."""
    ctes = O.clean_ctes(**kw)
    if extra:
        ctes += ",\n" + extra
    return f"WITH {ctes}\n{body}"


def WT(body: str, extra: str = "") -> str:
    return W(body, TYPED_CTE + ((",\n" + extra) if extra else ""))


def union_all(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def q(name: str) -> str:
    """A quoted SQL identifier (``column`` is a keyword in DuckDB)."""
    return f'"{name}"'


# ---------------------------------------------------------------------------
# The clean pipeline
# ---------------------------------------------------------------------------
query("k1_listing", W("SELECT * FROM listing"))(lambda spark, sf: listing(spark, sf))
query("k1_item_category", W("SELECT * FROM item_category"))(lambda spark, sf: categories(spark, sf))

DROP_POLICY = TransformPolicy(adjust_build_year_policy="drop", adjust_change_date_policy="drop")
query(
    "k1_listing_drop_policies",
    W("SELECT * FROM listing", build_year_policy="drop", change_date_policy="drop"),
)(lambda spark, sf: tables(spark, sf, DROP_POLICY)[1])

NO_DEDUP = TransformPolicy(deduplicate=False)
query("k1_listing_no_dedup", W("SELECT * FROM listing", deduplicate=False))(
    lambda spark, sf: tables(spark, sf, NO_DEDUP)[1]
)

query(
    "w1_keep_latest",
    WT(f"SELECT * EXCLUDE (__rn) FROM (SELECT *, row_number() OVER (PARTITION BY listing_id "
       f"ORDER BY {O.dedup_order_sql()}) AS __rn FROM typed_eda) WHERE __rn = 1"),
)(lambda spark, sf: C.keep_latest(typed(spark, sf)))

# ---------------------------------------------------------------------------
# P1–P12 projections
# ---------------------------------------------------------------------------
query("p1_cast_known_columns", W("SELECT * FROM raw"))(lambda spark, sf: C.cast_known_columns(raw(spark, sf)))

query(
    "p2_fill_subtype",
    W("SELECT listing_id, item_type, coalesce(item_subtype, item_type) AS item_subtype FROM raw"),
)(lambda spark, sf: C.fill_subtype(raw(spark, sf)).select("listing_id", "item_type", "item_subtype"))

query(
    "p3_normalize_enum",
    W("SELECT listing_id, split_part(transaction_type, '.', -1) AS transaction_type, "
      "split_part(item_type, '.', -1) AS item_type, split_part(item_subtype, '.', -1) AS item_subtype FROM raw"),
)(lambda spark, sf: C.normalize_enum(raw(spark, sf)).select("listing_id", "transaction_type", "item_type", "item_subtype"))

query(
    "p4_epoch_ms_to_timestamp",
    WT("SELECT listing_id, start_date, change_date FROM typed_eda"),
)(lambda spark, sf: C.to_timestamps(raw(spark, sf)).select("listing_id", "start_date", "change_date"))

query(
    "p5_zipcode_digits",
    W(f"SELECT listing_id, {O.digits_sql()} AS zipcode FROM raw"),
)(lambda spark, sf: C.clean_zipcode(raw(spark, sf), drop_invalid=False, expand_two_digits=False).select("listing_id", "zipcode"))

query(
    "p6_zipcode_two_digit_expansion",
    W(f"SELECT listing_id, {O.expand_zip_sql(O.digits_sql())} AS zipcode FROM raw"),
)(lambda spark, sf: C.clean_zipcode(raw(spark, sf), drop_invalid=False, expand_two_digits=True).select("listing_id", "zipcode"))

P7_SQL = (
    "CAST(CASE WHEN CAST(trunc(build_year) AS INTEGER) > (SELECT max(year(start_date)) FROM prepared) "
    "THEN CAST(substring(CAST(CAST(trunc(build_year) AS INTEGER) AS VARCHAR), 1, 4) AS SMALLINT) "
    "ELSE CAST(trunc(build_year) AS INTEGER) END AS INTEGER)"
)
query(
    "p7_build_year_adjust",
    W(f"SELECT listing_id, start_date, {P7_SQL} AS build_year FROM prepared"),
)(lambda spark, sf: C.adjust_build_year(prepare(raw(spark, sf)), "adjust").select("listing_id", "start_date", "build_year"))

query(
    "p8_change_date_adjust",
    WT("SELECT listing_id, start_date, CASE WHEN change_date IS NULL OR change_date < start_date "
       "THEN start_date ELSE change_date END AS change_date FROM typed_eda"),
)(lambda spark, sf: C.adjust_change_date(typed(spark, sf), "adjust").select("listing_id", "start_date", "change_date"))

P9_COLS = ("floor", "room_count", "balcony_count", "terrace_count", "build_year", "price", "area", "site_area", "terrace_area")
query(
    "p9_final_types",
    W(
        "SELECT listing_id, "
        + ", ".join(O.smallint(c) + f" AS {c}" for c in ("floor", "room_count", "balcony_count", "terrace_count"))
        + f", CAST({P7_SQL} AS SMALLINT) AS build_year, "
        + ", ".join(f"CAST({c} AS FLOAT) AS {c}" for c in MEASURE_COLUMNS)
        + " FROM prepared"
    ),
)(
    lambda spark, sf: C.finalize_types(C.adjust_build_year(prepare(raw(spark, sf)), "adjust")).select(
        "listing_id", *P9_COLS
    )
)


def _p10(spark, sf):
    return C.listing_projection(prepare(raw(spark, sf)).drop("site_area", "has_cellar"))


_p10_cols = []
for _f in LISTING_SCHEMA.fields:
    if _f.name == "item_subcategory":
        _p10_cols.append("item_subtype AS item_subcategory")
    elif _f.name == "site_area":
        _p10_cols.append("CAST(NULL AS FLOAT) AS site_area")
    elif _f.name == "has_cellar":
        _p10_cols.append("CAST(NULL AS BOOLEAN) AS has_cellar")
    else:
        _p10_cols.append(_f.name)
query("p10_listing_projection_missing_columns", W(f"SELECT {', '.join(_p10_cols)} FROM prepared"))(_p10)

query(
    "p12_parent_path",
    W("SELECT listing_id, item_subtype, array_to_string(string_split(item_subtype, '.')[1:-2], '.') AS parent_path FROM raw"),
)(lambda spark, sf: raw(spark, sf).select("listing_id", "item_subtype", parent_path("item_subtype").alias("parent_path")))

# ---------------------------------------------------------------------------
# F1–F4 clean filters
# ---------------------------------------------------------------------------
query(
    "f1_non_negative",
    W(f"SELECT listing_id, {', '.join(NON_NEGATIVE_COLUMNS)} FROM raw WHERE {O.non_negative_sql()}"),
)(lambda spark, sf: C.enforce_non_negative(raw(spark, sf)).select("listing_id", *NON_NEGATIVE_COLUMNS))

query(
    "f2_drop_invalid_zipcode",
    W("SELECT listing_id, zipcode FROM zip1_f WHERE regexp_matches(zipcode, '^\\d+$')",
      f"zip1_f AS (SELECT listing_id, {O.digits_sql()} AS zipcode FROM raw)"),
)(lambda spark, sf: C.clean_zipcode(raw(spark, sf), drop_invalid=True, expand_two_digits=False).select("listing_id", "zipcode"))

query(
    "f3_build_year_drop",
    W("SELECT listing_id, start_date, build_year FROM prepared WHERE build_year IS NULL OR build_year <= year(start_date)"),
)(lambda spark, sf: C.adjust_build_year(prepare(raw(spark, sf)), "drop").select("listing_id", "start_date", "build_year"))

query(
    "f4_change_date_drop",
    WT("SELECT listing_id, start_date, change_date FROM typed_eda WHERE change_date IS NOT NULL AND change_date >= start_date"),
)(lambda spark, sf: C.adjust_change_date(typed(spark, sf), "drop").select("listing_id", "start_date", "change_date"))

# ---------------------------------------------------------------------------
# search
# ---------------------------------------------------------------------------
LISTING_COLS_SQL = ", ".join(f"l.{c}" for c in LISTING_SCHEMA.fieldNames())


def _search(params: dict):
    def run(spark, sf):
        cats, lst = tables(spark, sf, materialize="category" in params)
        return S.search(lst, cats, params)

    return run


def _search_sql(where: str, join_category: str | None = None) -> str:
    j = ""
    if join_category:
        j = (f" JOIN item_category ic ON l.item_subcategory = ic.subcategory AND ic.category = '{join_category}'")
    w = f" WHERE {where}" if where else ""
    return W(f"SELECT {LISTING_COLS_SQL} FROM listing l{j}{w}")


SEARCHES = {
    "f6_subcategory_equals": ({"subcategory": "VILLA"}, "l.item_subcategory = 'VILLA'", None),
    "f7_category_join": ({"category": "HOUSE"}, "", "HOUSE"),
    "f8_transaction_type_equals": ({"transaction_type": "RENT"}, "l.transaction_type = 'RENT'", None),
    "f9_city_contains_ci": ({"city": "nAtIoN_1"}, "contains(lower(l.city), 'nation_1')", None),
    "f10_zipcode_contains": ({"zipcode": "75"}, "contains(l.zipcode, '75')", None),
    "f11_price_range": ({"min_price": 1000.0, "max_price": 20000.0}, "l.price >= 1000.0 AND l.price <= 20000.0", None),
    "f12_area_range": ({"min_area": 20.0, "max_area": 100.0}, "l.area >= 20.0 AND l.area <= 100.0", None),
    "f13_build_year_range": ({"min_build_year": 1900, "max_build_year": 2000}, "l.build_year >= 1900 AND l.build_year <= 2000", None),
    "f14_has_build_year": ({"has_build_year": False}, "l.build_year IS NULL", None),
    "f15_flag_filters": (
        {"has_garden": True, "has_passenger_lift": False, "is_new_construction": False, "has_cellar": False, "is_furnished": True},
        "l.has_garden = true AND l.has_passenger_lift = false AND l.is_new_construction = false "
        "AND l.has_cellar = false AND l.is_furnished = true",
        None,
    ),
    "f16_composed_search": (
        {"category": "APARTMENT", "transaction_type": "SELL", "city": "a", "min_price": 5000.0, "max_price": 60000.0,
         "min_area": 10.0, "has_build_year": True, "has_cellar": False},
        "l.transaction_type = 'SELL' AND contains(lower(l.city), 'a') AND l.price >= 5000.0 AND l.price <= 60000.0 "
        "AND l.area >= 10.0 AND l.build_year IS NOT NULL AND l.has_cellar = false",
        "APARTMENT",
    ),
}
for _name, (_params, _where, _cat) in SEARCHES.items():
    query(_name, _search_sql(_where, _cat))(_search(_params))

LAYOUT_BLOCKS = 32


def _layout(spark, sf, **kw) -> SearchLayout:
    path = scratch_path(spark, "layout")
    listing(spark, sf).write.parquet(f"{path}/listing")
    return SearchLayout.build(spark.read.parquet(f"{path}/listing"), f"{path}/blocks", LAYOUT_BLOCKS, **kw)


def _layout_search(params: dict, **kw):
    def run(spark, sf):
        return _layout(spark, sf, **kw).search(categories(spark, sf) if "category" in params else None, params)

    return run


BY_TEXT = {"order": ("city", "zipcode")}
BOX = {"min_price": 1000.0, "max_price": 20000.0, "min_area": 20.0, "max_area": 100.0, "min_build_year": 1900, "max_build_year": 2000}
query("f9_indexed_city", ORACLE["f9_city_contains_ci"])(_layout_search(SEARCHES["f9_city_contains_ci"][0], **BY_TEXT))
query("f10_indexed_zipcode", ORACLE["f10_zipcode_contains"])(_layout_search(SEARCHES["f10_zipcode_contains"][0], **BY_TEXT))
query(
    "f11_f13_clustered_ranges",
    _search_sql(" AND ".join(SEARCHES[n][1] for n in ("f11_price_range", "f12_area_range", "f13_build_year_range"))),
)(_layout_search(BOX))
query("f16_clustered_search", ORACLE["f16_composed_search"])(_layout_search(SEARCHES["f16_composed_search"][0]))

# needles that some texts hold, only the grams of, or not at all
NEEDLES = {"city": ("nAtIoN_1", "on_11", "a", "tion_2", "n_1_n", "zzz"), "zipcode": ("75", "000", "0101", "1010", "12345")}


def _needle_counts(spark, sf):
    """What the index finds for each needle: candidates by their grams, and those that hold it."""
    layout = _layout(spark, sf, **BY_TEXT)
    parts = [
        layout.candidates(c, n).agg(F.count("*").alias("candidates"), F.count_if("verified").alias("verified")).select(F.lit(c).alias("column"), F.lit(n).alias("needle"), "candidates", "verified")
        for c, ns in NEEDLES.items() for n in ns
    ]
    return reduce(DataFrame.unionAll, parts)


def _needle_sql(column: str, needle: str) -> str:
    """Distinct texts with all grams of a needle, and with the needle."""
    text, low = (f"lower({column})", needle.lower()) if column == "city" else (column, needle)
    size = min(3, len(low))
    held = " AND ".join(f"contains(v, '{low[i:i + size]}')" for i in range(len(low) - size + 1))
    return (f"SELECT '{column}' AS {q('column')}, '{needle}' AS needle, count(*) FILTER (WHERE {held}) AS candidates, "
            f"count(*) FILTER (WHERE contains(v, '{low}')) AS verified FROM (SELECT DISTINCT {text} AS v FROM listing)")


query("f9_f10_index_candidates", W(union_all(_needle_sql(c, n) for c, ns in NEEDLES.items() for n in ns)))(_needle_counts)

ENTRY_PARAMS = {
    "category": "HOUSE",
    "transaction_type": "RENT",
    "min_price": 1000.0,
    "max_price": 100000.0,
    "sort_by_change_date": "desc",
    "limit": 100,
}
ENTRY_WHERE = "l.transaction_type = 'RENT' AND l.price >= 1000.0 AND l.price <= 100000.0"


def entry_page(spark, sf):
    cats, lst = tables(spark, sf)
    return S.search_listings(lst, cats, ENTRY_PARAMS)[0]


def entry_total(spark, sf):
    cats, lst = tables(spark, sf)
    return S.search_listings(lst, cats, ENTRY_PARAMS)[1]


_entry_from = "FROM listing l JOIN item_category ic ON l.item_subcategory = ic.subcategory AND ic.category = 'HOUSE'"
query(
    "l3_search_page_desc",
    W(f"SELECT {LISTING_COLS_SQL} {_entry_from} WHERE {ENTRY_WHERE} "
      "ORDER BY l.change_date DESC NULLS FIRST, l.listing_id ASC LIMIT 100"),
)(entry_page)
query("a1_search_total", W(f"SELECT count(*) AS count {_entry_from} WHERE {ENTRY_WHERE}"))(entry_total)


def _page(params: dict):
    def run(spark, sf):
        cats, lst = tables(spark, sf)
        return S.search_listings(lst, cats, params)[0]

    return run


query(
    "l1_sort_asc_page",
    W(f"SELECT {LISTING_COLS_SQL} FROM listing l WHERE l.item_subcategory = 'APARTMENT' "
      "ORDER BY l.change_date ASC NULLS LAST, l.listing_id ASC LIMIT 100"),
)(_page({"subcategory": "APARTMENT", "sort_by_change_date": "ASC"}))
query(
    "l2_offset_limit_page",
    W(f"SELECT {LISTING_COLS_SQL} FROM listing l WHERE l.transaction_type = 'SELL' "
      "ORDER BY l.change_date ASC NULLS LAST, l.listing_id ASC LIMIT 25 OFFSET 50"),
)(_page({"transaction_type": "SELL", "sort_by_change_date": "asc", "skip": 50, "limit": 25}))
query(
    "l2_unsorted_page",
    W(f"SELECT {LISTING_COLS_SQL} FROM listing l WHERE l.has_garden = true ORDER BY l.listing_id LIMIT 40 OFFSET 10"),
)(_page({"has_garden": True, "sort_by_change_date": "sideways", "skip": 10, "limit": 40}))



def _seek_pages(order: str | None, params: dict):
    """All pages of a search, with their numbers: the first, and from its cursor all others."""

    def run(spark, sf):
        path = scratch_path(spark, "seek")
        listing(spark, sf).write.parquet(path)  # read several times
        matched = S.search(spark.read.parquet(path), None, params)
        size = min(S.MAX_PAGE, max(1, -(-matched.count() // 6)))
        first = S.seek_page(matched, order, None, size)
        after = S.cursor(first)
        first = first.withColumn("page", F.lit(0).cast("long"))
        if after is None:
            return first
        return first.unionByName(S.seek_pages(matched, order, after, size).withColumn("page", F.col("page") + 1))

    return run


def _seek_sql(order: str, where: str) -> str:
    return W(f"SELECT *, (row_number() OVER (ORDER BY {order}, listing_id) - 1) // least(10000, greatest(1, CAST(ceil(count(*) OVER () / 6) AS BIGINT))) AS page "
             f"FROM listing WHERE {where}")


query("l2_seek_pages_desc", _seek_sql("change_date DESC NULLS FIRST", "transaction_type = 'SELL'"))(_seek_pages("desc", {"transaction_type": "SELL"}))
query("l2_seek_pages_asc", _seek_sql("change_date ASC NULLS LAST", "price >= 20000"))(_seek_pages("asc", {"min_price": 20000.0}))
query("l2_seek_pages_by_id", _seek_sql("1", "has_garden = true"))(_seek_pages(None, {"has_garden": True}))

LOOKUP_ID = 7


def _by_id(spark, sf):
    return S.listing_by_id(listing(spark, sf), LOOKUP_ID)


query("f17_listing_by_id", W(f"SELECT * FROM listing WHERE listing_id = {LOOKUP_ID}"))(_by_id)
query("f18_category_by_subcategory", W("SELECT * FROM item_category WHERE subcategory = 'VILLA'"))(
    lambda spark, sf: S.category_by_subcategory(categories(spark, sf), "VILLA")
)
query(
    "f19_categories_page",
    W("SELECT * FROM item_category WHERE category = 'HOUSE' ORDER BY subcategory LIMIT 100"),
)(lambda spark, sf: S.search_categories(categories(spark, sf), "HOUSE")[0])
query("f19_categories_total", W("SELECT count(*) AS count FROM item_category WHERE category = 'APARTMENT'"))(
    lambda spark, sf: S.search_categories(categories(spark, sf), "APARTMENT")[1]
)
query(
    "l4_two_key_sort",
    WT("SELECT listing_id, change_date, start_date, price FROM typed_eda ORDER BY listing_id ASC, change_date DESC"),
)(
    lambda spark, sf: typed(spark, sf)
    .select("listing_id", "change_date", "start_date", "price")
    .orderBy(*S.two_key_order())
)
query(
    "p11_public_listing_page",
    W(f"SELECT {LISTING_COLS_SQL} FROM listing l WHERE l.is_furnished = true ORDER BY l.listing_id LIMIT 100 OFFSET 20"),
)(lambda spark, sf: S.public_listing(_page({"is_furnished": True, "skip": 20})(spark, sf)))
query("l5_preview", W("SELECT * FROM listing ORDER BY listing_id LIMIT 5"))(
    lambda spark, sf: S.preview(listing(spark, sf))
)

# ---------------------------------------------------------------------------
# integrity
# ---------------------------------------------------------------------------
def _viol(rule, key_sql, col, value_sql, src, where) -> str:
    return (f"SELECT '{rule}' AS rule, CAST({key_sql} AS VARCHAR) AS key, '{col}' AS {q('column')}, "
            f"CAST({value_sql} AS VARCHAR) AS value FROM {src} WHERE {where}")


def listing_rule_sql(src: str) -> list[str]:
    parts = [_viol("R1_not_null", "listing_id", c, "NULL", src, f"{c} IS NULL") for c in REQUIRED_LISTING_COLUMNS]
    for c in ("room_count", "balcony_count", "terrace_count", "build_year"):
        parts.append(_viol("R2_non_negative", "listing_id", c, c, src, f"{c} < 0"))
    for c in MEASURE_COLUMNS:
        parts.append(_viol("R2_non_negative", "listing_id", c, c, src, f"{c} < 0"))
    parts.append(_viol("R3_enum", "listing_id", "transaction_type", "transaction_type", src,
                       f"transaction_type IS NOT NULL AND transaction_type NOT IN ({O.ENUM_SQL['transaction_types']})"))
    parts.append(_viol("R3_enum", "listing_id", "item_subcategory", "item_subcategory", src,
                       f"item_subcategory IS NOT NULL AND item_subcategory NOT IN ({O.ENUM_SQL['subcategories']})"))
    parts.append(_viol("R4_format", "listing_id", "zipcode", "zipcode", src,
                       "zipcode IS NOT NULL AND (NOT regexp_matches(zipcode, '^\\d+$') OR length(zipcode) > 5)"))
    parts.append(_viol("R4_format", "listing_id", "city", "city", src, "length(city) > 255"))
    parts.append(_viol("R6_change_after_start", "listing_id", "change_date", "change_date", src, "change_date < start_date"))
    return parts


def category_rule_sql(src: str) -> list[str]:
    parts = [_viol("R1_not_null", "subcategory", c, "NULL", src, f"{c} IS NULL") for c in ("subcategory", "category")]
    parts.append(_viol("R3_enum", "subcategory", "subcategory", "subcategory", src,
                       f"subcategory IS NOT NULL AND subcategory NOT IN ({O.ENUM_SQL['subcategories']})"))
    parts.append(_viol("R3_enum", "subcategory", "category", "category", src,
                       f"category IS NOT NULL AND category NOT IN ({O.ENUM_SQL['categories']})"))
    return parts


query("r_listing_row_rules", W(union_all(listing_rule_sql("listing"))))(
    lambda spark, sf: R.listing_row_violations(listing(spark, sf))
)
query("r_category_row_rules", W(union_all(category_rule_sql("item_category"))))(
    lambda spark, sf: R.category_row_violations(categories(spark, sf))
)

RAW_LISTING_CTE = (
    "raw_listing AS (SELECT " + ", ".join(
        "item_subtype AS item_subcategory" if c == "item_subcategory" else c for c in LISTING_SCHEMA.fieldNames()
    ) + " FROM typed_eda)"
)


def _raw_listing(spark, sf):
    return C.listing_projection(typed(spark, sf))


query("r1_r6_rules_on_raw", WT(union_all(listing_rule_sql("raw_listing")), RAW_LISTING_CTE))(
    lambda spark, sf: R.listing_row_violations(_raw_listing(spark, sf))
)
query(
    "r2_strict_measures",
    W(union_all(
        [_viol("R2_non_negative", "listing_id", c, c, "free", f"{c} < 0") for c in ("room_count", "balcony_count", "terrace_count", "build_year")]
        + [_viol("R2_non_negative", "listing_id", c, c, "free", f"{c} <= 0") for c in MEASURE_COLUMNS]
    ), "free AS (SELECT * REPLACE (CASE WHEN listing_id % 13 = 0 THEN CAST(0 AS FLOAT) ELSE price END AS price) FROM listing)"),
)(lambda spark, sf: _strict(_free(listing(spark, sf))))


def _free(lst: DataFrame) -> DataFrame:
    """Every 13th listing costs nothing, which only the strict form forbids."""
    return lst.withColumn("price", F.when(F.col("listing_id") % 13 == 0, F.lit(0).cast("float")).otherwise(F.col("price")))


def _strict(lst: DataFrame) -> DataFrame:
    return R.row_violations(lst, "listing_id", R.non_negative_hits(lst, True))


VALID_CATS = (f"valid_cat AS (SELECT * FROM item_category WHERE subcategory IN ({O.ENUM_SQL['subcategories']}) "
              f"AND category IN ({O.ENUM_SQL['categories']}))")


def _valid_cats(cats: DataFrame) -> DataFrame:
    return R.reject(cats, R.category_row_violations(cats), "subcategory")


def _foreign_keys(spark, sf):
    cats, lst = tables(spark, sf, materialize=True)
    return R.foreign_key_violations(lst, _valid_cats(cats))


query(
    "r5_foreign_key",
    W("SELECT 'R5_foreign_key' AS rule, CAST(listing_id AS VARCHAR) AS key, 'item_subcategory' AS \"column\", "
      "item_subcategory AS value FROM listing l WHERE item_subcategory IS NOT NULL AND NOT EXISTS "
      "(SELECT 1 FROM valid_cat v WHERE v.subcategory = l.item_subcategory)", VALID_CATS),
)(_foreign_keys)

query(
    "r7_primary_key_raw",
    W("SELECT 'R7_primary_key' AS rule, CAST(listing_id AS VARCHAR) AS key, 'listing_id' AS \"column\", "
      "CAST(count(*) AS VARCHAR) AS value FROM raw WHERE listing_id IS NOT NULL GROUP BY listing_id HAVING count(*) > 1"),
)(lambda spark, sf: R.key_violations(raw(spark, sf), "listing_id"))

# Upsert variant: existing = line numbers 1..3, incoming = the rest with the
# start date of every 37th listing moved by one day.
EXISTING_FILTER = "l.l_linenumber <= 3"
INCOMING_FILTER = "coalesce(l.l_linenumber, 4) > 3"
SHIFT_MOD = 37
E_KW = dict(raw=O.raw_sql(EXISTING_FILTER), prefix="e_")
I_KW = dict(raw=O.raw_sql(INCOMING_FILTER, SHIFT_MOD), prefix="i_")
UPSERT_CTES = O.clean_ctes(**E_KW) + ",\n" + O.clean_ctes(**I_KW)


def _existing(spark, sf):
    return tables(spark, sf, materialize=True, lineitem_filter=F.col("l_linenumber") <= 3)


def _incoming(spark, sf):
    return tables(spark, sf, materialize=True, lineitem_filter=F.coalesce(F.col("l_linenumber"), F.lit(4)) > 3, start_shift_mod=SHIFT_MOD)


def _update_rules(spark, sf):
    return R.update_violations(_existing(spark, sf)[1], _incoming(spark, sf)[1])


query(
    "r8_r9_update_rules",
    f"WITH {UPSERT_CTES}\n" + union_all([
        "SELECT 'R8_start_date_immutable' AS rule, CAST(i.listing_id AS VARCHAR) AS key, 'start_date' AS \"column\", "
        "CAST(i.start_date AS VARCHAR) AS value FROM i_listing i JOIN e_listing e ON i.listing_id = e.listing_id "
        "WHERE i.start_date <> e.start_date",
        "SELECT 'R9_change_date_monotonic' AS rule, CAST(i.listing_id AS VARCHAR) AS key, 'change_date' AS \"column\", "
        "CAST(i.change_date AS VARCHAR) AS value FROM i_listing i JOIN e_listing e ON i.listing_id = e.listing_id "
        "WHERE i.change_date < e.change_date",
    ]),
)(_update_rules)

query(
    "j3_upsert_listing",
    f"WITH {UPSERT_CTES}\nSELECT * FROM e_listing e WHERE NOT EXISTS (SELECT 1 FROM i_listing i WHERE i.listing_id = e.listing_id)"
    "\nUNION ALL SELECT * FROM i_listing",
)(lambda spark, sf: merge_upsert(_existing(spark, sf)[1], _incoming(spark, sf)[1], ("listing_id",)))
query(
    "j3_upsert_category",
    f"WITH {UPSERT_CTES}\nSELECT * FROM e_item_category e WHERE NOT EXISTS (SELECT 1 FROM i_item_category i "
    "WHERE i.subcategory = e.subcategory)\nUNION ALL SELECT * FROM i_item_category",
)(lambda spark, sf: merge_upsert(_existing(spark, sf)[0], _incoming(spark, sf)[0], ("subcategory",)))
query(
    "j3_upsert_keys_only",
    f"WITH {UPSERT_CTES}\nSELECT listing_id FROM e_listing UNION ALL SELECT listing_id FROM i_listing i "
    "WHERE NOT EXISTS (SELECT 1 FROM e_listing e WHERE e.listing_id = i.listing_id)",
)(
    lambda spark, sf: merge_upsert(
        _existing(spark, sf)[1].select("listing_id"), _incoming(spark, sf)[1].select("listing_id"), ("listing_id",)
    )
)

# ---------------------------------------------------------------------------
# Sources, sinks and the ingest job (write then read back)
# ---------------------------------------------------------------------------
def _feed(spark, sf, fmt: str) -> str:
    return FS.write_feed(raw(spark, sf), scratch_path(spark, f"feed-{fmt}"), fmt)


def _k1_from(fmt: str):
    def run(spark, sf):
        df = FS.read_input(spark, _feed(spark, sf, fmt), fmt)
        return clean_listings(df)[1]

    return run


query("s1_json_source_clean", W("SELECT * FROM listing"))(_k1_from("json"))


def _quoted_feed(spark, sf):
    """Ids and flags quoted, dates with a fraction: P1 and P4 give the same rows."""
    r = raw(spark, sf)
    quoted = {"listing_id", *FLAG_COLUMNS}
    cols = [F.col(c).cast("string") if c in quoted else F.col(c).cast("double") if c in ("start_date", "change_date") else F.col(c) for c in r.columns]
    path = FS.write_feed(r.select(*[x.alias(c) for x, c in zip(cols, r.columns)]), scratch_path(spark, "feed-quoted"), "json")
    return clean_listings(FS.read_input(spark, path, "json"))[1]


query("s1_json_quoted_values_clean", W("SELECT * FROM listing"))(_quoted_feed)
query("s2_csv_source_clean", W("SELECT * FROM listing"))(_k1_from("csv"))
query(
    "s4_untyped_load",
    W("SELECT " + ", ".join(f"CAST({c} AS {'DOUBLE' if c in NUMERIC_COLUMNS else 'VARCHAR'}) AS {c}" for c in O.RAW_COLUMNS) + " FROM raw"),
)(
    # every value is text; numbers are compared as such, since the two sides write them differently
    lambda spark, sf: FS.read_untyped(spark, _feed(spark, sf, "json")).select(
        *[F.col(c).cast("double") if c in NUMERIC_COLUMNS else F.col(c) for c in O.RAW_COLUMNS]
    )
)
query(
    "s5_typed_load",
    WT("SELECT * FROM typed_eda"),
)(lambda spark, sf: FS.read_typed(spark, _feed(spark, sf, "json")).drop("description_fr", CORRUPT_COLUMN))


def _partitioned_write(spark, sf):
    """The table written in three parts, and read back with its file count."""
    store = TableStore(spark, scratch_path(spark, "parts"))
    store.write_version("listing", listing(spark, sf), partitions=3)
    back = store.read("listing")
    return back.agg(F.count("*").alias("listings"), F.sum("listing_id").alias("id_sum")).withColumn("files", F.lit(len(back.inputFiles())).cast("long"))


query(
    "s8_write_parallelism",
    W("SELECT count(*) AS listings, CAST(sum(listing_id) AS BIGINT) AS id_sum, CAST(3 AS BIGINT) AS files FROM listing"),
)(_partitioned_write)


def _emptiness(spark, sf):
    """Which of the tables, and of an impossible filter, are empty."""
    cats, lst = tables(spark, sf)
    found = [("item_category", is_empty(cats)), ("listing", is_empty(lst)), ("negative_prices", is_empty(lst.filter("price < 0")))]
    return spark.createDataFrame(found, "name string, empty boolean")


query(
    "s10_emptiness",
    W("SELECT 'item_category' AS name, count(*) = 0 AS empty FROM item_category UNION ALL SELECT 'listing', count(*) = 0 FROM listing "
      "UNION ALL SELECT 'negative_prices', count(*) = 0 FROM listing WHERE price < 0"),
)(_emptiness)

ACCEPTED_SQL = W(
    "SELECT * FROM listing l WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in REQUIRED_LISTING_COLUMNS)
    + " AND " + " AND ".join(f"({c} IS NULL OR {c} >= 0)" for c in ("room_count", "balcony_count", "terrace_count", "build_year") + MEASURE_COLUMNS)
    + f" AND transaction_type IN ({O.ENUM_SQL['transaction_types']})"
    + " AND regexp_matches(zipcode, '^\\d+$') AND length(zipcode) <= 5 AND length(city) <= 255"
    + " AND change_date >= start_date"
    + " AND EXISTS (SELECT 1 FROM valid_cat v WHERE v.subcategory = l.item_subcategory)",
    VALID_CATS,
)


def _ingest_store(spark, sf) -> TableStore:
    root = scratch_path(spark, "store")
    feed = _feed(spark, sf, "json")
    ingest(spark, feed, root, "json", enforce="reject")
    return TableStore(spark, root)


query("k2_ingest_listing", ACCEPTED_SQL)(lambda spark, sf: _ingest_store(spark, sf).read("listing"))
query(
    "s6_ingest_item_category",
    W("SELECT * FROM valid_cat", VALID_CATS),
)(lambda spark, sf: _ingest_store(spark, sf).read("item_category"))


def _ingest_twice(spark, sf):
    """Idempotence: the same batch ingested twice leaves the tables unchanged."""
    root = scratch_path(spark, "store2")
    feed = _feed(spark, sf, "json")
    ingest(spark, feed, root, "json", enforce="reject")
    ingest(spark, feed, root, "json", enforce="reject")
    return TableStore(spark, root).read("listing")


query("s7_ingest_twice_idempotent", ACCEPTED_SQL)(_ingest_twice)


def _incremental(spark, sf):
    """K2 as a stream: the feed lands as two files (listings split by a hash of
    the key, so every listing's versions arrive together) and is ingested
    micro-batch by micro-batch; the result equals the batch ingest."""
    from hearth.streaming import start_incremental_ingest

    r = raw(spark, sf)
    landing = scratch_path(spark, "landing")
    half = F.pmod(F.xxhash64("listing_id"), F.lit(2))  # null and negative ids too
    FS.write_feed(r.filter(half == 0), landing + "/part-0", "json")
    FS.write_feed(r.filter(half == 1), landing + "/part-1", "json")
    root = scratch_path(spark, "stream-store")
    q = start_incremental_ingest(spark, landing + "/*", root, scratch_path(spark, "stream-ckpt"), available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"incremental ingest failed: {q.exception()}")
    return TableStore(spark, root).read("listing")


query("k2_incremental_ingest_listing", ACCEPTED_SQL)(_incremental)

# ---------------------------------------------------------------------------
# Tables in key buckets
# ---------------------------------------------------------------------------
BUCKETS = {"listing": 16}


def _ingest_buckets(spark, sf) -> BucketStore:
    root = scratch_path(spark, "keyed")
    ingest(spark, _feed(spark, sf, "json"), root, "json", enforce="reject", buckets=BUCKETS)
    return keyed_tables(spark, root)


query("k2_ingest_buckets_listing", ACCEPTED_SQL)(lambda spark, sf: _ingest_buckets(spark, sf).read("listing"))
query("k2_ingest_buckets_category", W("SELECT * FROM valid_cat", VALID_CATS))(
    lambda spark, sf: _ingest_buckets(spark, sf).read("item_category")
)


def _listing_buckets(spark, rows) -> BucketStore:
    store = BucketStore(spark, scratch_path(spark, "buckets"))
    store.create("listing", LISTING_SCHEMA, LISTING_KEY, BUCKETS["listing"])
    store.upsert({"listing": rows})
    return store


def _bucket_upsert(spark, sf):
    """A batch merged into a table that holds rows already."""
    store = _listing_buckets(spark, _existing(spark, sf)[1])
    store.upsert({"listing": _incoming(spark, sf)[1]})
    return store.read("listing")


query("j3_bucket_upsert_listing", ORACLE["j3_upsert_listing"])(_bucket_upsert)


def _touched_buckets(spark, sf):
    """What three batches write: the stored rows again, one changed row, and a batch of every third listing."""
    base = _existing(spark, sf)[1]
    store = _listing_buckets(spark, base)
    files = lambda: {f.rsplit("/", 2)[1]: f for f in store.read("listing").inputFiles()}
    out, before = [], files()
    one = base.orderBy("listing_id").limit(1).withColumn("city", F.lit("Elsewhere"))
    third = base.where("listing_id % 3 = 0").withColumn("price", F.lit(1.0))
    for name, batch in (("same", base), ("one_changed", one), ("every_third", third)):
        written = store.upsert({"listing": batch})["listing"]["written"]
        after = files()
        changed = {b for b in after if after[b] != before.get(b)}
        out.append((name, len(written), len(changed), changed == {f"bucket={b}" for b in written}))
        before = after
    found = spark.createDataFrame(out, "batch string, buckets_written long, files_changed long, only_those boolean")
    return found.crossJoin(store.read("listing").agg(F.count_if(F.col("price") == 1.0).alias("repriced"), F.count_if(F.col("city") == "Elsewhere").alias("moved")))


query(
    "s7_buckets_written",
    f"WITH {O.clean_ctes(**E_KW)}, first AS (SELECT min(listing_id) AS id FROM e_listing), "
    "w(batch, n) AS (VALUES ('same', 0), ('one_changed', 1), ('every_third', 16)) "
    "SELECT batch, CAST(n AS BIGINT) AS buckets_written, CAST(n AS BIGINT) AS files_changed, true AS only_those, "
    "(SELECT count(*) FROM e_listing WHERE listing_id % 3 = 0 OR price = 1.0) AS repriced, "
    "(SELECT count(*) FROM e_listing WHERE (listing_id = (SELECT id FROM first) AND listing_id % 3 <> 0) OR city = 'Elsewhere') AS moved FROM w",
)(_touched_buckets)
query("f17_lookup_in_bucket", ORACLE["f17_listing_by_id"])(
    lambda spark, sf: _listing_buckets(spark, listing(spark, sf)).lookup("listing", listing_id=LOOKUP_ID)
)


def _category_lookup(spark, sf):
    store = BucketStore(spark, scratch_path(spark, "buckets"))
    store.create("item_category", ITEM_CATEGORY_SCHEMA, ITEM_CATEGORY_KEY, 4)
    store.upsert({"item_category": categories(spark, sf)})
    return store.lookup("item_category", subcategory="VILLA")


query("f18_lookup_in_bucket", ORACLE["f18_category_by_subcategory"])(_category_lookup)

# ---------------------------------------------------------------------------
# profile
# ---------------------------------------------------------------------------
def _stage_counts(spark, sf):
    """The counts that the ingest job reports."""
    report = ingest(spark, _feed(spark, sf, "json"), scratch_path(spark, "counts"), "json", enforce="reject")
    m = report.metrics
    found = [(m["raw_rows"], m["prepared_rows"], m["batch_listings"], m["category_rows"], footer_counts(spark.read.parquet(report.written["listing"]))["rows"])]
    return spark.createDataFrame(found, "raw_rows long, prepared_rows long, batch_listings long, category_rows long, listing_rows long")


query(
    "a2_stage_counts",
    ACCEPTED_SQL.replace("SELECT * FROM listing l WHERE", "SELECT (SELECT count(*) FROM raw) AS raw_rows, (SELECT count(*) FROM prepared) AS prepared_rows, "
                         "(SELECT count(*) FROM listing) AS batch_listings, (SELECT count(*) FROM valid_cat) AS category_rows, count(*) AS listing_rows FROM listing l WHERE"),
)(_stage_counts)


def _written_listing(spark, sf):
    path = scratch_path(spark, "footers")
    listing(spark, sf).write.parquet(path)
    return spark.read.parquet(path)
query("a3_max_start_year", W("SELECT CAST(max(year(start_date)) AS INTEGER) AS max_start_year FROM prepared"))(
    lambda spark, sf: prepare(raw(spark, sf)).agg(F.max(F.year("start_date")).alias("max_start_year"))
)



def summary_sql(src: str, cols, cast_double: bool = True) -> str:
    sel = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
    return (
        f"SELECT {q('column')}, count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, "
        "min(value) AS min, round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50, "
        "round(quantile_cont(value, 0.75), 6) AS q75, max(value) AS max "
        f"FROM (UNPIVOT (SELECT {sel} FROM {src}) ON {', '.join(cols)} INTO NAME {q('column')} VALUE value) "
        f"GROUP BY {q('column')}"
    )


query("a5_numeric_summary_raw", WT(summary_sql("typed_eda", NUMERIC_COLUMNS)))(
    lambda spark, sf: PR.numeric_summary(typed(spark, sf), NUMERIC_COLUMNS)
)
query("a5_numeric_summary_clean", W(summary_sql("cleaned", NUMERIC_COLUMNS)))(
    lambda spark, sf: PR.numeric_summary(cleaned(spark, sf), NUMERIC_COLUMNS)
)
query(
    "a13_zipcode_length_summary",
    W(summary_sql("(SELECT CAST(length(zipcode) AS DOUBLE) AS zipcode_length FROM raw)", ["zipcode_length"])),
)(lambda spark, sf: PR.length_summary(raw(spark, sf), "zipcode"))

# Spark type names of the exploration load's columns.
TYPED_DTYPES = {
    "listing_id": "bigint", "transaction_type": "string", "item_type": "string", "item_subtype": "string",
    "start_date": "timestamp_ntz", "change_date": "timestamp_ntz", "price": "double", "area": "double",
    "site_area": "double", "floor": "double", "room_count": "double", "balcony_count": "double",
    "terrace_count": "double", "has_garden": "boolean", "city": "string", "zipcode": "string",
    "has_passenger_lift": "boolean", "is_new_construction": "boolean", "build_year": "double",
    "terrace_area": "double", "has_cellar": "boolean", "is_furnished": "boolean",
}
query(
    "a6_column_info",
    WT(union_all(
        f"SELECT '{c}' AS {q('column')}, count({c}) AS non_null, '{t}' AS dtype FROM typed_eda"
        for c, t in TYPED_DTYPES.items()
    )),
)(lambda spark, sf: PR.column_info(typed(spark, sf)))
query(
    "a7_integer_safe",
    WT(union_all(f"SELECT '{c}' AS {q('column')}, coalesce(bool_and({c} % 1 = 0), true) AS integer_safe FROM typed_eda" for c in INTEGER_COLUMNS)),
)(lambda spark, sf: PR.integer_safe(typed(spark, sf), INTEGER_COLUMNS))
query(
    "a8_boolean_safe",
    WT(union_all(
        f"SELECT '{c}' AS {q('column')}, count(DISTINCT {c}) AS n_distinct, count(DISTINCT {c}) <= 2 AS boolean_safe FROM typed_eda"
        for c in FLAG_COLUMNS
    )),
)(lambda spark, sf: PR.boolean_safe(typed(spark, sf), FLAG_COLUMNS))


def vc_sql(src: str, cols, cast: str = "VARCHAR") -> str:
    sel = ", ".join(f"CAST({c} AS {cast}) AS {c}" for c in cols)
    return (f"SELECT {q('column')}, value, count(*) AS count FROM (UNPIVOT (SELECT {sel} FROM {src}) ON "
            f"{', '.join(cols)} INTO NAME {q('column')} VALUE value) GROUP BY {q('column')}, value")


query("a9_value_counts", W(vc_sql("cleaned", CATEGORICAL_COLUMNS)))(
    lambda spark, sf: PR.value_counts(cleaned(spark, sf), CATEGORICAL_COLUMNS)
)
query(
    "a10_two_digit_zip_city_pairs",
    W("SELECT zipcode, city, count(*) AS count FROM raw WHERE length(zipcode) = 2 GROUP BY zipcode, city"),
)(lambda spark, sf: PR.pair_counts(raw(spark, sf), "zipcode", "city", F.length("zipcode") == 2))

LEVEL_COLUMNS = CATEGORICAL_COLUMNS + FLAG_COLUMNS
query(
    "a11_level_shares",
    W(f"SELECT v.{q('column')}, v.value, v.count, round(v.count / t.total, 6) AS share, t.n_levels, t.n_levels < 20 AS show_share "
      f"FROM vc v JOIN (SELECT {q('column')}, sum(count) AS total, count(*) AS n_levels FROM vc GROUP BY {q('column')}) t "
      f"ON v.{q('column')} = t.{q('column')}",
      f"vc AS ({vc_sql('cleaned', LEVEL_COLUMNS)})"),
)(lambda spark, sf: PR.level_shares(cleaned(spark, sf), LEVEL_COLUMNS))
TOP_COLUMNS = ("listing_id", "city", "zipcode", "build_year", "item_subcategory")
TOP = 25
query(
    "a9_top_values",
    W(f"SELECT {q('column')}, CAST(rank AS INTEGER) AS rank, value, count FROM (SELECT *, row_number() OVER (PARTITION BY {q('column')} "
      f"ORDER BY count DESC, value) AS rank FROM ({vc_sql('listing', TOP_COLUMNS)})) WHERE rank <= {TOP}"),
)(lambda spark, sf: top_values(_written_listing(spark, sf), TOP_COLUMNS, TOP))


def _estimates(spark, sf):
    """Each column's distinct count, and whether the estimate is within three times its stated error."""
    rows = _written_listing(spark, sf)
    true = rows.agg(*(F.count_distinct(c).alias(c) for c in TOP_COLUMNS)).unpivot([], list(TOP_COLUMNS), "column", "n_distinct")
    found = distinct_estimates(rows, TOP_COLUMNS).withColumnRenamed("n_distinct", "estimate")
    return true.join(found, "column").select("column", "n_distinct", (F.abs(F.col("estimate") - F.col("n_distinct")) <= 3 * F.col("error") * F.col("n_distinct")).alias("within"))


query(
    "a12_distinct_estimates",
    W(union_all(f"SELECT '{c}' AS {q('column')}, count(DISTINCT {c}) AS n_distinct, true AS within FROM listing" for c in TOP_COLUMNS)),
)(_estimates)
query("a12_distinct_build_years", W("SELECT DISTINCT build_year FROM raw"))(
    lambda spark, sf: PR.distinct_values(raw(spark, sf), "build_year")
)
query(
    "a14_missing_share",
    W(union_all(
        f"SELECT '{c}' AS variable, CAST(count_if({c} IS NULL) AS BIGINT) AS missing, "
        f"round(count_if({c} IS NULL) / count(*), 6) AS share FROM listing"
        for c in LISTING_SCHEMA.fieldNames()
    )),
)(lambda spark, sf: PR.missing_share(listing(spark, sf)))

DUP_CTE = "dup_in AS (SELECT * FROM raw UNION ALL SELECT * FROM raw WHERE listing_id % 50 = 0)"


def _dup_input(spark, sf):
    r = raw(spark, sf)
    return r.unionByName(r.filter(F.col("listing_id") % 50 == 0))


query(
    "a15_whole_row_duplicates",
    W("SELECT * EXCLUDE (__n) FROM (SELECT *, count(*) OVER (PARTITION BY "
      + ", ".join(O.RAW_COLUMNS) + ") AS __n FROM dup_in) WHERE __n > 1", DUP_CTE),
)(lambda spark, sf: PR.whole_row_duplicates(_dup_input(spark, sf)))

query(
    "a16_key_duplicates_listing_id",
    WT(f"SELECT * EXCLUDE (__rn) FROM (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY "
       f"{O.dedup_order_sql()}) AS __rn FROM typed_eda) WHERE __rn > 1"),
)(lambda spark, sf: PR.key_duplicates(typed(spark, sf), ("listing_id",)))
query(
    "a16_key_duplicates_listing_start",
    WT(f"SELECT * EXCLUDE (__rn) FROM (SELECT *, row_number() OVER (PARTITION BY listing_id, start_date ORDER BY "
       f"{O.dedup_order_sql(keys=('listing_id', 'start_date'))}) AS __rn FROM typed_eda) WHERE __rn > 1"),
)(lambda spark, sf: PR.key_duplicates(typed(spark, sf), ("listing_id", "start_date")))


# Rows without a key and exact copies, every key with more than two rows numbered by ranges.
KEYLESS_CTE = ("keyless AS (SELECT * REPLACE (CASE WHEN listing_id % 7 <> 0 THEN listing_id END AS listing_id) FROM typed_eda), "
               "keyless_in AS (SELECT * FROM keyless UNION ALL SELECT * FROM keyless WHERE listing_id IS NULL OR listing_id % 5 = 0)")


def _keyless_input(spark, sf):
    t = typed(spark, sf).withColumn("listing_id", F.when(F.col("listing_id") % 7 != 0, F.col("listing_id")))
    twice = F.col("listing_id").isNull() | (F.col("listing_id") % 5 == 0)
    copies = F.when(twice, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))  # the feed is joined once
    return t.withColumn("__copy", F.explode(copies)).drop("__copy")


query(
    "w2_occurrence_number_hot_keys",
    WT(f"SELECT *, CAST(row_number() OVER (PARTITION BY listing_id ORDER BY {O.dedup_order_sql()}) AS INTEGER) AS occurrence "
       "FROM keyless_in", KEYLESS_CTE),
)(lambda spark, sf: PR.occurrence_number(_keyless_input(spark, sf), ("listing_id",), hot_rows=2))
query(
    "a16_key_duplicates_hot_keys",
    WT(f"SELECT * EXCLUDE (__rn) FROM (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY "
       f"{O.dedup_order_sql()}) AS __rn FROM keyless_in) WHERE __rn > 1", KEYLESS_CTE),
)(lambda spark, sf: PR.key_duplicates(_keyless_input(spark, sf), ("listing_id",), hot_rows=2))
query(
    "w2_occurrence_number",
    WT(f"SELECT *, CAST(row_number() OVER (PARTITION BY listing_id ORDER BY {O.dedup_order_sql()}) AS INTEGER) AS occurrence "
       "FROM typed_eda"),
)(lambda spark, sf: PR.occurrence_number(typed(spark, sf), ("listing_id",)))

# Every 11th listing under a type that its subtype doesn't belong to.
MISTYPED_SQL = "CASE WHEN listing_id % 11 = 0 THEN 'ITEM_TYPE.OTHER' ELSE item_type END AS item_type"


def _mistyped(df: DataFrame) -> DataFrame:
    return df.withColumn("item_type", F.when(F.col("listing_id") % 11 == 0, "ITEM_TYPE.OTHER").otherwise(F.col("item_type")))


query(
    "a17_dependency_zipcode_city",
    W("SELECT zipcode, count(DISTINCT city) AS n_values FROM listing WHERE zipcode IS NOT NULL "
      "GROUP BY zipcode HAVING count(DISTINCT city) > 1"),
)(lambda spark, sf: PR.dependency_violations(listing(spark, sf), "zipcode", "city"))
query(
    "a17_dependency_subtype_type",
    W("SELECT item_subtype, count(DISTINCT item_type) AS n_values FROM mistyped WHERE item_subtype IS NOT NULL "
      "GROUP BY item_subtype HAVING count(DISTINCT item_type) > 1", f"mistyped AS (SELECT * REPLACE ({MISTYPED_SQL}) FROM cleaned)"),
)(lambda spark, sf: PR.dependency_violations(_mistyped(cleaned(spark, sf)), "item_subtype", "item_type"))


DEPENDENCY_COLUMNS = ("listing_id", "item_type", "item_subtype", "city", "zipcode", "build_year", "floor", "has_cellar")


def dependencies_sql(cols) -> str:
    """Every column against every set of one or two others; of two, those that no single one implies."""
    one = lambda s, c: (
        f"SELECT '{s[0]}' AS c1, '{s[-1]}' AS c2, '{','.join(s)}' AS determinant, '{c}' AS dependent, count(*) AS n_values FROM "
        f"(SELECT count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n FROM cleaned GROUP BY {', '.join(s)}) HAVING max(n) = 1"
    )
    singles = union_all(one((a,), c) for a in cols for c in cols if c != a)
    pairs = union_all(one((a, b), c) for i, a in enumerate(cols) for b in cols[i + 1:] for c in cols if c not in (a, b))
    return W(
        "SELECT determinant, dependent, n_values FROM singles UNION ALL SELECT determinant, dependent, n_values FROM pairs p WHERE NOT EXISTS "
        "(SELECT 1 FROM singles s WHERE (s.c1 IN (p.c1, p.c2) AND s.dependent IN (p.dependent, p.c1, p.c2)))",
        f"singles AS ({singles}),\npairs AS ({pairs})",
    )


query("a17_discovered_dependencies", dependencies_sql(DEPENDENCY_COLUMNS))(
    lambda spark, sf: discover_dependencies(cleaned(spark, sf), DEPENDENCY_COLUMNS)
)


def long_sql(src: str, cols, ids=()) -> str:
    sel = ", ".join([*ids, *[f"CAST({c} AS DOUBLE) AS {c}" for c in cols]])
    return f"(UNPIVOT (SELECT {sel} FROM {src}) ON {', '.join(cols)} INTO NAME {q('column')} VALUE value)"


IQR_SQL = W(
    f"SELECT s.{q('column')}, s.count, round(s.q1, 6) AS q1, round(s.median, 6) AS median, round(s.q3, 6) AS q3, "
    "round(s.q3 - s.q1, 6) AS iqr, round(s.q1 - 1.5 * (s.q3 - s.q1), 6) AS lower_fence, "
    "round(s.q3 + 1.5 * (s.q3 - s.q1), 6) AS upper_fence, round(s.mean, 6) AS mean, "
    "min(CASE WHEN l.value >= s.q1 - 1.5 * (s.q3 - s.q1) THEN l.value END) AS whisker_low, "
    "max(CASE WHEN l.value <= s.q3 + 1.5 * (s.q3 - s.q1) THEN l.value END) AS whisker_high, "
    "CAST(count_if(l.value < s.q1 - 1.5 * (s.q3 - s.q1) OR l.value > s.q3 + 1.5 * (s.q3 - s.q1)) AS BIGINT) AS n_fliers "
    f"FROM lng l JOIN st s ON l.{q('column')} = s.{q('column')} "
    f"GROUP BY s.{q('column')}, s.count, s.q1, s.median, s.q3, s.mean",
    f"lng AS (SELECT * FROM {long_sql('cleaned', INTEGER_COLUMNS)}),\n"
    f"st AS (SELECT {q('column')}, count(value) AS count, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, "
    f"quantile_cont(value, 0.75) AS q3, avg(value) AS mean FROM lng GROUP BY {q('column')})",
)
query("a18_iqr_stats", IQR_SQL)(lambda spark, sf: PR.iqr_stats(cleaned(spark, sf), INTEGER_COLUMNS))

Z_COLUMNS = INTEGER_COLUMNS + MEASURE_COLUMNS
def zscore_sql(src: str, cols) -> tuple[str, str]:
    body = (
        f"SELECT {q('column')}, listing_id, value, round(z, 6) AS z FROM (SELECT l.{q('column')}, l.listing_id, l.value, "
        f"(l.value - s.m) / nullif(s.sd, 0) AS z FROM lng l JOIN st s ON l.{q('column')} = s.{q('column')}) WHERE abs(z) >= 3"
    )
    extra = (
        f"lng AS (SELECT * FROM {long_sql(src, cols, ids=('listing_id',))}),\n"
        f"st AS (SELECT {q('column')}, avg(value) AS m, stddev_pop(value) AS sd FROM lng GROUP BY {q('column')})"
    )
    return body, extra


query("a19_zscore_outliers_raw", WT(*zscore_sql("typed_eda", Z_COLUMNS)))(
    lambda spark, sf: PR.zscore_outliers(typed(spark, sf), Z_COLUMNS)
)
query("a19_zscore_outliers_clean", W(*zscore_sql("cleaned", Z_COLUMNS)))(
    lambda spark, sf: PR.zscore_outliers(cleaned(spark, sf), Z_COLUMNS)
)


def complete_case_sql(cols, src: str = "cleaned") -> str:
    d = f"SELECT listing_id, {', '.join(cols)} FROM {src} WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in cols)
    stats = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}, stddev_pop(CAST({c} AS DOUBLE)) AS s_{c}" for c in cols)
    cond = " OR ".join(f"coalesce(abs((CAST({c} AS DOUBLE) - m_{c}) / nullif(s_{c}, 0)) >= 3, false)" for c in cols)
    extra = f"cc AS ({d}),\nccs AS (SELECT {stats} FROM cc)"
    body = f"SELECT listing_id, {', '.join(cols)} FROM cc, ccs WHERE {cond}"
    return WT(body, extra) if src == "typed_eda" else W(body, extra)


CC_FLOAT = ("price", "area", "site_area")
query("a20_zscore_complete_case_int", complete_case_sql(INTEGER_COLUMNS))(
    lambda spark, sf: PR.zscore_complete_case(cleaned(spark, sf), INTEGER_COLUMNS)
)
query("a20_zscore_complete_case_float", complete_case_sql(CC_FLOAT))(
    lambda spark, sf: PR.zscore_complete_case(cleaned(spark, sf), CC_FLOAT)
)
query("a20_zscore_complete_case_int_raw", complete_case_sql(INTEGER_COLUMNS, "typed_eda"))(
    lambda spark, sf: PR.zscore_complete_case(typed(spark, sf), INTEGER_COLUMNS)
)
query("a20_zscore_complete_case_float_raw", complete_case_sql(CC_FLOAT, "typed_eda"))(
    lambda spark, sf: PR.zscore_complete_case(typed(spark, sf), CC_FLOAT)
)
query(
    "a21_integer_distribution",
    W(f"SELECT v.{q('column')}, v.value, v.count, t.n_levels, t.n_levels < 100 AS few_levels FROM vc v JOIN (SELECT {q('column')}, count(*) AS n_levels "
      f"FROM vc GROUP BY {q('column')}) t ON v.{q('column')} = t.{q('column')}",
      f"vc AS ({vc_sql('cleaned', INTEGER_COLUMNS, 'BIGINT')})"),
)(lambda spark, sf: PR.integer_distribution(cleaned(spark, sf), INTEGER_COLUMNS))
query("a14_missing_share_footers", ORACLE["a14_missing_share"])(lambda spark, sf: FT.missing_share(_written_listing(spark, sf)))
query(
    "a6_column_info_footers",
    W(union_all(f"SELECT '{f.name}' AS {q('column')}, count({f.name}) AS non_null, '{f.dataType.simpleString()}' AS dtype FROM listing" for f in LISTING_SCHEMA)),
)(lambda spark, sf: FT.column_info(_written_listing(spark, sf)))
query(
    "a22_ranges_footers",
    W(union_all(f"SELECT '{c}' AS {q('column')}, count({c}) AS non_null, CAST(min({c}) AS DOUBLE) AS least, CAST(max({c}) AS DOUBLE) AS greatest FROM listing"
                for c in NUMERIC_COLUMNS)),
)(lambda spark, sf: FT.column_ranges(_written_listing(spark, sf), list(NUMERIC_COLUMNS)))
query("a22_date_range", W("SELECT min(start_date) AS min_start_date, max(start_date) AS max_start_date FROM listing"))(
    lambda spark, sf: PR.date_range(listing(spark, sf))
)

query(
    "f21_zipcode_length_rows",
    W("SELECT zipcode, city, CAST(length(zipcode) AS INTEGER) AS zipcode_length FROM raw WHERE length(zipcode) IN (2, 3, 4)"),
)(lambda spark, sf: PR.zipcode_length_rows(raw(spark, sf)))
query("f22_zipcode_lookup", W("SELECT zipcode, city FROM listing WHERE zipcode = '75000'"))(
    lambda spark, sf: PR.zipcode_rows(listing(spark, sf), "75000")
)
query(
    "f23_future_build_year",
    WT("SELECT * FROM typed_eda WHERE build_year > year(start_date)"),
)(lambda spark, sf: PR.future_build_year(typed(spark, sf)))
query(
    "f24_build_year_tails",
    WT("SELECT CASE WHEN build_year > 2020 THEN 'high' ELSE 'low' END AS tail, build_year, count(*) AS count "
       "FROM typed_eda WHERE build_year > 2020 OR build_year < 1700 GROUP BY 1, 2"),
)(lambda spark, sf: PR.build_year_tails(typed(spark, sf)))
query(
    "f25_date_inversions",
    WT("SELECT * FROM typed_eda WHERE start_date > change_date"),
)(lambda spark, sf: PR.date_inversions(typed(spark, sf)))
query(
    "f26_missing_flag_rows",
    WT("SELECT * FROM typed_eda WHERE is_furnished IS NULL"),
)(lambda spark, sf: PR.missing_rows(typed(spark, sf), "is_furnished"))
query(
    "f27_hierarchy_mismatch",
    W("SELECT listing_id, item_type, item_subtype FROM mistyped WHERE item_subtype IS NOT NULL AND "
      "item_type IS DISTINCT FROM array_to_string(string_split(item_subtype, '.')[1:-2], '.')",
      f"mistyped AS (SELECT * REPLACE ({MISTYPED_SQL}) FROM raw)"),
)(lambda spark, sf: PR.hierarchy_mismatch(_mistyped(raw(spark, sf))).select("listing_id", "item_type", "item_subtype"))
