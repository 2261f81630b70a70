"""Listing and category search.

A search is one lazy filtered DataFrame; the page and the total are two
actions over it (``search_listings`` returns both lazily, ``fetch_listings``
runs them as concurrent jobs). Every optional parameter only adds a
conjunct, so Catalyst pushes all of them into the parquet scan of the stored
table.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, fields

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.functions.columns import contains_ci, contains_literal
from hearth.operators.ordered import placed
from hearth.schema import CATEGORIES, FLAG_COLUMNS, LISTING_COLUMNS, SUBCATEGORIES, TRANSACTION_TYPES
from hearth.session import scratch_path

DEFAULT_LIMIT = 100
MAX_PAGE = 10_000


@dataclass(frozen=True)
class ListingSearch:
    """Parameters of a listing search; ``None`` (or '' for text) means no filter."""

    skip: int = 0
    limit: int = DEFAULT_LIMIT
    subcategory: str | None = None
    category: str | None = None
    transaction_type: str | None = None
    city: str | None = None
    zipcode: str | None = None
    min_price: float | None = None
    max_price: float | None = None
    min_area: float | None = None
    max_area: float | None = None
    min_build_year: int | None = None
    max_build_year: int | None = None
    has_build_year: bool | None = None
    has_garden: bool | None = None
    has_passenger_lift: bool | None = None
    is_new_construction: bool | None = None
    has_cellar: bool | None = None
    is_furnished: bool | None = None
    sort_by_change_date: str | None = None

    def __post_init__(self) -> None:
        check_enum("subcategory", self.subcategory, SUBCATEGORIES)
        check_enum("category", self.category, CATEGORIES)
        check_enum("transaction_type", self.transaction_type, TRANSACTION_TYPES)
        check_paging(self.skip, self.limit)

    @classmethod
    def of(cls, params: "ListingSearch | dict | None" = None, **kw) -> "ListingSearch":
        if isinstance(params, ListingSearch):
            return params if not kw else cls(**{**asdict(params), **kw})
        names = {f.name for f in fields(cls)}
        merged = {**(params or {}), **kw}
        unknown = sorted(set(merged) - names)
        if unknown:
            raise ValueError(f"unknown search parameters: {unknown}")
        return cls(**merged)


def check_enum(name: str, value: str | None, members: tuple[str, ...]) -> None:
    """an enum parameter must be an exact member (case matters)."""
    if value is not None and value not in members:
        raise ValueError(f"{name}={value!r} is not one of {members}")


def check_paging(skip: int, limit: int) -> None:
    if skip < 0 or limit < 0:
        raise ValueError(f"skip and limit must be >= 0 (got skip={skip}, limit={limit})")


# ------------------------------------------------------------------ predicates
def listing_predicate(p: ListingSearch) -> Column | None:
    """F6, F8–F15 as one conjunction (the category filter F7 is a join)."""
    conds: list[Column] = []
    if p.subcategory:
        conds.append(F.col("item_subcategory") == p.subcategory)
    if p.transaction_type:
        conds.append(F.col("transaction_type") == p.transaction_type)
    if p.city:
        conds.append(contains_ci("city", p.city))
    if p.zipcode:
        conds.append(contains_literal("zipcode", p.zipcode))
    for col, lo, hi in (
        ("price", p.min_price, p.max_price),
        ("area", p.min_area, p.max_area),
        ("build_year", p.min_build_year, p.max_build_year),
    ):
        if lo is not None:
            conds.append(F.col(col) >= F.lit(lo))
        if hi is not None:
            conds.append(F.col(col) <= F.lit(hi))
    if p.has_build_year is not None:
        conds.append(F.col("build_year").isNotNull() if p.has_build_year else F.col("build_year").isNull())
    for flag in FLAG_COLUMNS:
        v = getattr(p, flag)
        if v is not None:
            conds.append(F.col(flag) == F.lit(bool(v)))
    if not conds:
        return None
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def in_category(listing: DataFrame, item_category: DataFrame, category: str) -> DataFrame:
    """Listings whose subcategory belongs to ``category``.

    A left-semi join against the filtered category table: the result keeps
    only listing columns, and since ``subcategory`` is the category key it
    equals the inner join. The category side is a handful of rows; Spark's
    size check (static stats or AQE's runtime size) broadcasts it.
    """
    cats = item_category.filter(F.col("category") == category).select(
        F.col("subcategory").alias("__sub")
    )
    return listing.join(cats, listing["item_subcategory"] == cats["__sub"], "left_semi")


def search(listing: DataFrame, item_category: DataFrame | None = None, params=None, **kw) -> DataFrame:
    """F16: the filtered, unpaged listings of a search."""
    p = ListingSearch.of(params, **kw)
    out = listing
    pred = listing_predicate(p)
    if pred is not None:
        out = out.filter(pred)
    if p.category:
        if item_category is None:
            raise ValueError("a category filter needs the item_category table")
        out = in_category(out, item_category, p.category)
    return out


# ------------------------------------------------------------------ ordering
def change_date_order(sort_by_change_date: str | None) -> list[Column]:
    """L1: 'asc' / 'desc' (any case) on change_date, other text ignored.

    Nulls follow the row-store convention (last on asc, first on desc) and
    ``listing_id`` is always the final key, so pages are stable.
    """
    key = (sort_by_change_date or "").lower()
    if key == "asc":
        return [F.col("change_date").asc_nulls_last(), F.col("listing_id").asc()]
    if key == "desc":
        return [F.col("change_date").desc_nulls_first(), F.col("listing_id").asc()]
    return [F.col("listing_id").asc()]


def two_key_order(first: str = "listing_id", then: str = "change_date") -> list[Column]:
    """L4: ascending by key, newest first inside it."""
    return [F.col(first).asc(), F.col(then).desc()]


def preview(df: DataFrame, rows: int = 5, key: str = "listing_id") -> DataFrame:
    """The first rows by key."""
    return page(df, [F.col(key).asc()], 0, rows)


def page(df: DataFrame, order: list[Column], skip: int = 0, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """L2: ordered ``offset(skip).limit(limit)`` (a top-k, no global sort)."""
    check_paging(skip, limit)
    out = df.orderBy(*order)
    if skip:
        out = out.offset(skip)
    return out.limit(limit)


def after_cursor(sort_by_change_date: str | None, change_date, listing_id: int) -> Column:
    """The rows that ``change_date_order`` puts behind (change_date, listing_id), as a predicate for the scan."""
    key, day, number = (sort_by_change_date or "").lower(), F.col("change_date"), F.col("listing_id")
    later = number > F.lit(int(listing_id))
    if key not in ("asc", "desc"):
        return later
    if change_date is None:  # nulls are last when rising, first when falling
        return day.isNull() & later if key == "asc" else (day.isNull() & later) | day.isNotNull()
    at = F.lit(change_date).cast("timestamp_ntz")
    if key == "asc":
        return (day > at) | ((day == at) & later) | day.isNull()
    return (day < at) | ((day == at) & later)


def seek_page(df: DataFrame, sort_by_change_date: str | None = None, after: tuple | None = None, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """L2 by cursor: the ``limit`` rows behind ``after`` (a ``cursor`` of the page before; None: the first page).

    The cursor is a predicate that the scan prunes files and row groups by, so
    a page costs the same at any depth: a top-k of ``limit`` rows, where
    ``offset`` would sort and send all rows before it. Rows that are added or
    removed between pages shift no other row. ``limit`` is 1 to MAX_PAGE;
    ``listing_id`` must be unique and not null, as in the stored table.
    """
    rows = _behind(df, sort_by_change_date, after, limit)
    return rows.orderBy(*change_date_order(sort_by_change_date)).limit(limit)


def _behind(df: DataFrame, sort_by_change_date: str | None, after: tuple | None, limit: int) -> DataFrame:
    if not 1 <= limit <= MAX_PAGE:
        raise ValueError(f"limit must be 1 to {MAX_PAGE} (got {limit})")
    return df if after is None else df.where(after_cursor(sort_by_change_date, *after))


def seek_pages(df: DataFrame, sort_by_change_date: str | None = None, after: tuple | None = None, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Every page behind ``after`` at once: the rows with ``page`` (a long, from 0).

    Page n holds what ``seek_page`` gives from the cursor of page n - 1. A job a
    page would make as many jobs as the table has pages; here the rows are put
    in order once (``placed``), and a row's place gives its page. ``df`` is
    evaluated when this is called.
    """
    rows = _behind(df, sort_by_change_date, after, limit)
    found = placed(rows, change_date_order(sort_by_change_date), scratch_path(df.sparkSession, "pages"))
    sizes = found.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))  # one row a partition
    earlier = F.sum("__size").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("__part", F.coalesce(earlier, F.lit(0)).alias("__start"))
    page = F.floor((F.col("__start") + F.col("__at")) / limit).cast("long")
    return found.join(F.broadcast(starts), "__part").select(*df.columns, page.alias("page"))


def cursor(page: DataFrame) -> tuple | None:
    """(change_date, listing_id) of a page's last row, None for an empty page."""
    rows = page.select("change_date", "listing_id").tail(1)
    return (rows[0]["change_date"], rows[0]["listing_id"]) if rows else None


def total(df: DataFrame) -> DataFrame:
    """A1: one-row ``count`` of a filtered frame."""
    return df.agg(F.count(F.lit(1)).alias("count"))


def search_listings(listing: DataFrame, item_category: DataFrame | None = None, params=None, **kw):
    """L3: (page, total) of a listing search, both lazy over one filtered frame."""
    p = ListingSearch.of(params, **kw)
    matched = search(listing, item_category, p)
    return page(matched, change_date_order(p.sort_by_change_date), p.skip, p.limit), total(matched)


def fetch_listings(listing: DataFrame, item_category: DataFrame | None = None, params=None, **kw):
    """L3 executed: (page rows, total) of a listing search.

    The page (a top-k) and the count run as two concurrent jobs over the
    same lazy filtered frame; the count reads only the filter columns. (The
    total cannot ride on the page's scan: when Spark knows its input is
    already in page order, the top-k stops reading early.)
    """
    from concurrent.futures import ThreadPoolExecutor

    page_df, total_df = search_listings(listing, item_category, params, **kw)
    with ThreadPoolExecutor(max_workers=2) as pool:
        rows = pool.submit(page_df.collect)
        count = pool.submit(lambda: total_df.collect()[0]["count"])
        return rows.result(), count.result()


def public_listing(df: DataFrame) -> DataFrame:
    """The public response columns of a listing (all 21 stored columns)."""
    return df.select(*LISTING_COLUMNS)


def public_category(df: DataFrame) -> DataFrame:
    """The public response columns of a category."""
    return df.select("subcategory", "category")


def listing_by_id(listing: DataFrame, listing_id: int) -> DataFrame:
    """zero or one listing (``listing_id`` is the key)."""
    return listing.filter(F.col("listing_id") == F.lit(int(listing_id)))


# ------------------------------------------------------------------ categories
def category_by_subcategory(item_category: DataFrame, subcategory: str) -> DataFrame:
    """zero or one category row for an exact subcategory member."""
    check_enum("subcategory", subcategory, SUBCATEGORIES)
    return item_category.filter(F.col("subcategory") == subcategory)


def search_categories(item_category: DataFrame, category: str | None = None, skip: int = 0, limit: int = DEFAULT_LIMIT):
    """F19 + L3: (page ordered by subcategory, total) of the category table."""
    check_enum("category", category, CATEGORIES)
    matched = item_category.filter(F.col("category") == category) if category else item_category
    return page(matched, [F.col("subcategory").asc()], skip, limit), total(matched)
