"""Raw feed readers and writers.

Readers take an explicit schema of texts by default: no inference job, no
value lost to a type it doesn't fit (P1 casts them, by the policy for bad
values), malformed JSON lines kept in ``_corrupt_record``, and the unused ``description_fr`` is pruned by Catalyst when
no query asks for it (JSON and CSV scans honour the required schema).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hearth.schema import TEXT_SCHEMA

# Default reader options of the shipped job configuration.
JSON_OPTIONS = {"multiline": "false"}
CSV_OPTIONS = {
    "header": "true",
    "delimiter": ",",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "nullValue": "",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
    "encoding": "UTF-8",
}
FORMATS = ("json", "csv")
# How feeds are written: compressed, and in files of so many records, since one task reads a compressed file whole (and
# any CSV file, whose values may hold line breaks).
FEED_OPTIONS = {"compression": "lz4", "maxRecordsPerFile": 100_000}


def read_json(spark: SparkSession, path: str, options: dict | None = None, schema: T.StructType | None = TEXT_SCHEMA) -> DataFrame:
    """JSON lines; every option is passed to the reader."""
    reader = spark.read.options(**{**JSON_OPTIONS, **(options or {})})
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_csv(spark: SparkSession, path: str, options: dict | None = None, schema: T.StructType | None = None) -> DataFrame:
    """CSV with header; without a schema every column is text and the
    clean pipeline's casts type it (strict by default)."""
    reader = spark.read.options(**{**CSV_OPTIONS, **(options or {})})
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_input(spark: SparkSession, path: str, fmt: str = "json", options: dict | None = None, schema: T.StructType = TEXT_SCHEMA) -> DataFrame:
    """S1/S2 by name; S3: any other format raises before a job starts."""
    if fmt == "json":
        return read_json(spark, path, options, schema)
    if fmt == "csv":
        return read_csv(spark, path, options, None if schema is TEXT_SCHEMA else schema)
    raise ValueError(f"Unsupported input format: {fmt!r} (expected one of {FORMATS})")


def read_untyped(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Load to inspect, with no typing (every value kept as text)."""
    if fmt == "json":
        return spark.read.option("primitivesAsString", "true").json(path)
    if fmt == "csv":
        return read_csv(spark, path)
    raise ValueError(f"Unsupported input format: {fmt!r}")


def read_typed(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Load with declared types and both dates parsed (epoch ms)."""
    from hearth.operators.clean import cast_known_columns, to_timestamps

    return to_timestamps(cast_known_columns(read_input(spark, path, fmt)))


def write_feed(df: DataFrame, path: str, fmt: str = "json", options: dict | None = None) -> str:
    """Write a raw feed (JSON lines or CSV with the reader's options), by ``FEED_OPTIONS`` where ``options`` don't say otherwise."""
    w = df.write.mode("errorifexists").options(**FEED_OPTIONS)
    if fmt == "json":
        w.options(**(options or {})).json(path)
    elif fmt == "csv":
        w.options(**{**CSV_OPTIONS, **(options or {})}).csv(path)
    else:
        raise ValueError(f"Unsupported output format: {fmt!r}")
    return path
