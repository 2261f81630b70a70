"""Types, column lists and enum members of the listings data model.

Everything in this module is a fixed value of the data model: the raw
record layout, the stored ``listing`` / ``item_category`` layouts and the
enum members that the integrity checks test against.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Enum members of the stored tables (natural order).
# ---------------------------------------------------------------------------
SUBCATEGORIES = (
    "SINGLE_FAMILY_HOUSE",
    "APARTMENT",
    "EXCEPTIONAL_PROPERTY",
    "VILLA",
    "DUPLEX_OR_TRIPLEX",
    "TOWN_HOUSE",
    "FARMHOUSE",
    "MANOR",
    "CHALET",
    "SEMIDETACHED_HOUSE",
    "GITE",
    "STORAGE_PRODUCTION",
    "PLOT",
    "OFFICE",
    "PARKING",
    "TRADING",
    "MISCELLANEOUS",
)
CATEGORIES = (
    "HOUSE",
    "APARTMENT",
    "STORAGE_PRODUCTION",
    "PLOT",
    "OFFICE",
    "PARKING",
    "TRADING",
    "MISCELLANEOUS",
)
TRANSACTION_TYPES = ("SELL", "RENT")

# ---------------------------------------------------------------------------
# Raw record casts (column -> type), applied when present.
# ---------------------------------------------------------------------------
RAW_CASTS: dict[str, T.DataType] = {
    "listing_id": T.LongType(),
    "transaction_type": T.StringType(),
    "item_subtype": T.StringType(),
    "item_type": T.StringType(),
    "price": T.DoubleType(),
    "area": T.DoubleType(),
    "site_area": T.DoubleType(),
    "floor": T.DoubleType(),
    "room_count": T.DoubleType(),
    "balcony_count": T.DoubleType(),
    "terrace_count": T.DoubleType(),
    "has_garden": T.BooleanType(),
    "city": T.StringType(),
    "zipcode": T.StringType(),
    "has_passenger_lift": T.BooleanType(),
    "is_new_construction": T.BooleanType(),
    "build_year": T.DoubleType(),
    "terrace_area": T.DoubleType(),
    "has_cellar": T.BooleanType(),
    "is_furnished": T.BooleanType(),
}

# Raw record read schema for JSON / CSV sources (dates are epoch ms).
RAW_SCHEMA = T.StructType(
    [
        T.StructField("listing_id", T.LongType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("item_type", T.StringType()),
        T.StructField("item_subtype", T.StringType()),
        T.StructField("start_date", T.LongType()),
        T.StructField("change_date", T.LongType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("area", T.DoubleType()),
        T.StructField("site_area", T.DoubleType()),
        T.StructField("floor", T.DoubleType()),
        T.StructField("room_count", T.DoubleType()),
        T.StructField("balcony_count", T.DoubleType()),
        T.StructField("terrace_count", T.DoubleType()),
        T.StructField("has_garden", T.BooleanType()),
        T.StructField("city", T.StringType()),
        T.StructField("zipcode", T.StringType()),
        T.StructField("has_passenger_lift", T.BooleanType()),
        T.StructField("is_new_construction", T.BooleanType()),
        T.StructField("build_year", T.DoubleType()),
        T.StructField("terrace_area", T.DoubleType()),
        T.StructField("has_cellar", T.BooleanType()),
        T.StructField("is_furnished", T.BooleanType()),
        T.StructField("description_fr", T.StringType()),
    ]
)

# How JSON and CSV feeds are read: every value as text (cast by P1), and the
# lines that are no record.
CORRUPT_COLUMN = "_corrupt_record"
TEXT_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in [*RAW_SCHEMA.names, CORRUPT_COLUMN]])

# Enum-coded columns normalised to their last dotted segment.
ENUM_COLUMNS = ("transaction_type", "item_type", "item_subtype")

# Columns that must not be negative in the clean step.
NON_NEGATIVE_COLUMNS = (
    "price",
    "area",
    "site_area",
    "room_count",
    "balcony_count",
    "terrace_count",
    "build_year",
    "terrace_area",
)

# Final storage types.
SMALLINT_COLUMNS = ("floor", "room_count", "balcony_count", "terrace_count", "build_year")
FLOAT_COLUMNS = ("price", "area", "site_area", "terrace_area")

# The stored listing table, in column order.
LISTING_SCHEMA = T.StructType(
    [
        T.StructField("listing_id", T.LongType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("item_subcategory", T.StringType()),
        T.StructField("start_date", T.TimestampNTZType()),
        T.StructField("change_date", T.TimestampNTZType()),
        T.StructField("price", T.FloatType()),
        T.StructField("area", T.FloatType()),
        T.StructField("site_area", T.FloatType()),
        T.StructField("floor", T.ShortType()),
        T.StructField("room_count", T.ShortType()),
        T.StructField("balcony_count", T.ShortType()),
        T.StructField("terrace_count", T.ShortType()),
        T.StructField("has_garden", T.BooleanType()),
        T.StructField("city", T.StringType()),
        T.StructField("zipcode", T.StringType()),
        T.StructField("has_passenger_lift", T.BooleanType()),
        T.StructField("is_new_construction", T.BooleanType()),
        T.StructField("build_year", T.ShortType()),
        T.StructField("terrace_area", T.FloatType()),
        T.StructField("has_cellar", T.BooleanType()),
        T.StructField("is_furnished", T.BooleanType()),
    ]
)
LISTING_COLUMNS = tuple(f.name for f in LISTING_SCHEMA.fields)
LISTING_KEY = ("listing_id",)

ITEM_CATEGORY_SCHEMA = T.StructType(
    [
        T.StructField("subcategory", T.StringType()),
        T.StructField("category", T.StringType()),
    ]
)
ITEM_CATEGORY_KEY = ("subcategory",)

# Column groups used by the profile operators.
FLAG_COLUMNS = (
    "has_garden",
    "has_passenger_lift",
    "is_new_construction",
    "has_cellar",
    "is_furnished",
)
INTEGER_COLUMNS = ("floor", "room_count", "balcony_count", "terrace_count", "build_year")
MEASURE_COLUMNS = ("price", "area", "site_area", "terrace_area")
CATEGORICAL_COLUMNS = ("transaction_type", "item_type", "item_subtype", "city", "zipcode")

# Integrity limits of the stored listing table.
REQUIRED_LISTING_COLUMNS = (
    "listing_id",
    "transaction_type",
    "item_subcategory",
    "start_date",
    "change_date",
    "price",
    "city",
    "zipcode",
)
REQUIRED_CATEGORY_COLUMNS = ("subcategory", "category")
ZIPCODE_PATTERN = r"^\d+$"
ZIPCODE_MAX_LENGTH = 5
CITY_MAX_LENGTH = 255
