"""DuckDB text of the registered queries (the correctness oracle).

Each function returns SQL over the driver's pre-registered tables. Shared
steps are common table expressions built from the same column lists as the
Spark side, so both engines see one definition of the data model.

Engine differences handled here: DuckDB rounds when casting a double to an
integer (Spark truncates), so such casts go through ``trunc``; ``split_part``
with index -1 is the last dotted segment; ``regexp_replace`` needs the ``g``
flag; quantiles are taken over DOUBLE input.
"""

from __future__ import annotations

from hearth.operators.clean import TIE_BREAK_FIRST
from hearth.schema import (
    CATEGORIES,
    FLOAT_COLUMNS,
    LISTING_COLUMNS,
    NON_NEGATIVE_COLUMNS,
    SUBCATEGORIES,
    TRANSACTION_TYPES,
)

RAW_COLUMNS = (
    "listing_id", "transaction_type", "item_type", "item_subtype", "start_date", "change_date",
    "price", "area", "site_area", "floor", "room_count", "balcony_count", "terrace_count",
    "has_garden", "city", "zipcode", "has_passenger_lift", "is_new_construction", "build_year",
    "terrace_area", "has_cellar", "is_furnished", "description_fr",
)
FRAME_COLUMNS = tuple(c for c in RAW_COLUMNS if c != "description_fr")


def raw_sql(where: str | None = None, start_shift_mod: int | None = None) -> str:
    """The raw listing feed projection (same rows as ``hearth.sources.fixture``)."""
    shift = "" if start_shift_mod is None else (
        f" + CASE WHEN l.l_orderkey % {start_shift_mod} = 0 THEN 86400000 ELSE 0 END"
    )
    cond = f" WHERE {where}" if where else ""
    return f"""SELECT l.l_orderkey AS listing_id,
 CASE WHEN l.l_orderkey % 3 = 0 THEN 'TRANSACTION_TYPE.RENT' ELSE 'TRANSACTION_TYPE.SELL' END AS transaction_type,
 CASE WHEN l.l_partkey % 6 <= 1 THEN 'ITEM_TYPE.HOUSE' WHEN l.l_partkey % 6 <= 3 THEN 'ITEM_TYPE.APARTMENT'
      WHEN l.l_partkey % 6 = 4 THEN 'ITEM_TYPE.PARKING' ELSE 'ITEM_TYPE.PLOT' END AS item_type,
 CASE WHEN l.l_suppkey % 29 = 0 THEN NULL WHEN l.l_partkey % 6 = 0 THEN 'ITEM_TYPE.HOUSE.VILLA' WHEN l.l_partkey % 6 = 1 THEN 'ITEM_TYPE.HOUSE.CHALET'
      WHEN l.l_partkey % 6 = 2 THEN 'ITEM_TYPE.APARTMENT.APARTMENT' WHEN l.l_partkey % 6 = 3 THEN 'ITEM_TYPE.APARTMENT.DUPLEX_OR_TRIPLEX'
      ELSE NULL END AS item_subtype,
 CAST(1300000000123 + (l.l_orderkey % 4000) * 86400000{shift} AS BIGINT) AS start_date,
 CASE WHEN l.l_suppkey % 23 = 0 THEN NULL ELSE
  CAST(1300000000123 + (l.l_orderkey % 4000) * 86400000 + (((l.l_partkey * 37 + l.l_linenumber * 1013) % 900) - 100) * 86400000 AS BIGINT) END AS change_date,
 CASE WHEN l.l_suppkey % 41 = 0 THEN -l.l_extendedprice ELSE l.l_extendedprice END AS price,
 CASE WHEN l.l_partkey % 13 = 0 THEN NULL ELSE l.l_quantity * 4 END AS area,
 CASE WHEN l.l_partkey % 5 = 0 THEN l.l_quantity * 40 ELSE NULL END AS site_area,
 CAST((l.l_linenumber % 9) - 2 AS DOUBLE) AS floor,
 CAST(l.l_linenumber % 6 AS DOUBLE) AS room_count,
 CASE WHEN l.l_partkey % 4 = 0 THEN NULL ELSE CAST(l.l_partkey % 3 AS DOUBLE) END AS balcony_count,
 CASE WHEN l.l_partkey % 7 = 0 THEN NULL ELSE CAST(l.l_partkey % 2 AS DOUBLE) END AS terrace_count,
 CASE WHEN l.l_partkey % 3 = 0 THEN NULL ELSE l.l_suppkey % 2 = 0 END AS has_garden,
 CONCAT('City ', n.n_name) AS city,
 CASE WHEN l.l_orderkey % 10 = 0 THEN '75' WHEN l.l_orderkey % 10 = 1 THEN 'n/a' WHEN l.l_orderkey % 10 = 2 THEN NULL
      WHEN l.l_orderkey % 10 = 3 THEN ' F-34230 ' WHEN l.l_orderkey % 10 = 4 THEN '1234567'
      ELSE CAST(10000 + (l.l_orderkey * 31) % 80000 AS VARCHAR(10)) END AS zipcode,
 CASE WHEN l.l_suppkey % 4 = 0 THEN NULL ELSE l.l_suppkey % 3 = 0 END AS has_passenger_lift,
 l.l_linenumber = 1 AS is_new_construction,
 CASE WHEN l.l_partkey % 11 = 0 THEN NULL WHEN l.l_partkey % 97 = 0 THEN CAST(19601970 AS DOUBLE) WHEN l.l_partkey % 89 = 0 THEN CAST(19320 AS DOUBLE)
      ELSE CAST(1850 + l.l_partkey % 185 AS DOUBLE) END AS build_year,
 CASE WHEN l.l_partkey % 2 = 0 THEN NULL ELSE l.l_quantity END AS terrace_area,
 l.l_suppkey % 5 = 0 AS has_cellar,
 CASE WHEN l.l_returnflag = 'N' THEN NULL ELSE l.l_returnflag = 'A' END AS is_furnished,
 CONCAT('ligne "', p.p_name, '"') AS description_fr
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN part p ON l.l_partkey = p.p_partkey{cond}"""


def ts_from_ms(c: str) -> str:
    return f"make_timestamp((({c}) - ({c}) % 1000) // 1000 * 1000000)"


def smallint(c: str) -> str:
    return f"CAST(trunc({c}) AS SMALLINT)"


def _sel(exprs: dict[str, str], cols=FRAME_COLUMNS) -> str:
    return ",\n ".join(f"{exprs[c]} AS {c}" if c in exprs else c for c in cols)


def typed_cte(src: str = "raw") -> str:
    """P1 -> P3 -> P2 -> P4 on ``src`` (no rows removed)."""
    last = {c: f"split_part({c}, '.', -1)" for c in ("transaction_type", "item_type")}
    last["item_subtype"] = "coalesce(split_part(item_subtype, '.', -1), split_part(item_type, '.', -1))"
    last["start_date"] = ts_from_ms("start_date")
    last["change_date"] = ts_from_ms("change_date")
    return f"SELECT {_sel(last, RAW_COLUMNS)} FROM {src}"


def non_negative_sql() -> str:
    return " AND ".join(f"({c} IS NULL OR {c} >= 0)" for c in NON_NEGATIVE_COLUMNS)


def digits_sql(c: str = "zipcode") -> str:
    return f"regexp_replace(trim({c}), '[^0-9]', '', 'g')"


def expand_zip_sql(c: str = "zipcode") -> str:
    return f"CASE WHEN length({c}) = 2 THEN {c} || '000' ELSE {c} END"


def dedup_order_sql(keys=("listing_id",)) -> str:
    """The keep-latest order over the frame columns (same rule as the Spark side)."""
    rest = [c for c in TIE_BREAK_FIRST if c not in keys]
    rest += [c for c in FRAME_COLUMNS if c not in rest and c not in keys and c != "change_date"]
    return "change_date DESC NULLS LAST, " + ", ".join(f"{c} ASC NULLS LAST" for c in rest)


def clean_ctes(
    raw: str | None = None,
    prefix: str = "",
    build_year_policy: str = "adjust",
    change_date_policy: str = "adjust",
    deduplicate: bool = True,
) -> str:
    """CTEs ``{prefix}raw .. {prefix}listing, {prefix}item_category`` of the clean pipeline."""
    p = prefix
    raw = raw or raw_sql()
    z = digits_sql()
    ctes = [
        f"{p}raw AS ({raw})",
        f"{p}typed AS ({typed_cte(p + 'raw')})",
        f"{p}nonneg AS (SELECT * FROM {p}typed WHERE {non_negative_sql()})",
        f"{p}zip1 AS (SELECT * REPLACE ({z} AS zipcode) FROM {p}nonneg)",
        f"{p}prepared AS (SELECT * REPLACE ({expand_zip_sql()} AS zipcode) FROM {p}zip1 "
        f"WHERE regexp_matches(zipcode, '^\\d+$'))",
    ]
    src = f"{p}prepared"
    if build_year_policy == "drop":
        ctes.append(
            f"{p}by_drop AS (SELECT * FROM {src} WHERE build_year IS NULL OR build_year <= year(start_date))"
        )
        src = f"{p}by_drop"
    if change_date_policy == "adjust":
        cd = "CASE WHEN change_date IS NULL OR change_date < start_date THEN start_date ELSE change_date END"
        ctes.append(f"{p}dated AS (SELECT * REPLACE ({cd} AS change_date) FROM {src})")
    else:
        ctes.append(f"{p}dated AS (SELECT * FROM {src} WHERE change_date IS NOT NULL AND change_date >= start_date)")
    fin = {c: smallint(c) for c in ("floor", "room_count", "balcony_count", "terrace_count")}
    fin.update({c: f"CAST({c} AS FLOAT)" for c in FLOAT_COLUMNS})
    ctes.append(f"{p}final AS (SELECT {_sel(fin)} FROM {p}dated)")
    if deduplicate:
        ctes.append(
            f"{p}latest AS (SELECT * EXCLUDE (__rn) FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY listing_id ORDER BY {dedup_order_sql()}) AS __rn FROM {p}final) WHERE __rn = 1)"
        )
    else:
        ctes.append(f"{p}latest AS (SELECT * FROM {p}final)")
    if build_year_policy == "adjust":
        by = "CAST(trunc(build_year) AS INTEGER)"
        m = f"(SELECT max(year(start_date)) FROM {p}prepared)"
        adj = f"CAST(CASE WHEN {by} > {m} THEN CAST(substring(CAST({by} AS VARCHAR), 1, 4) AS SMALLINT) ELSE {by} END AS SMALLINT)"
    else:
        adj = smallint("build_year")
    ctes.append(f"{p}cleaned AS (SELECT * REPLACE ({adj} AS build_year) FROM {p}latest)")
    lst = ", ".join("item_subtype AS item_subcategory" if c == "item_subcategory" else c for c in LISTING_COLUMNS)
    ctes.append(f"{p}listing AS (SELECT {lst} FROM {p}cleaned)")
    ctes.append(
        f"{p}item_category AS (SELECT item_subtype AS subcategory, min(item_type) AS category "
        f"FROM {p}cleaned WHERE item_subtype IS NOT NULL GROUP BY item_subtype)"
    )
    return ",\n".join(ctes)


def with_clean(body: str, **kw) -> str:
    return f"WITH {clean_ctes(**kw)}\n{body}"


def sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


ENUM_SQL = {
    "subcategories": sql_list(SUBCATEGORIES),
    "categories": sql_list(CATEGORIES),
    "transaction_types": sql_list(TRANSACTION_TYPES),
}
