"""Counts of written tables from their files' footers.

Parquet footers hold the rows of each file, and the nulls and extremes of each
column. Spark's parquet source answers count, min and max from them
(aggregate pushdown), reading footers in its tasks and no data pages. The
figures are those of the committed files: a task that ran twice left one file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Types whose extremes Spark takes from footers.
ORDERED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType)


def _files(table: DataFrame) -> list[str]:
    files = table.inputFiles()
    if not files:
        raise ValueError("the frame reads no files")
    return files


def footer_frame(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """The files read by the source that pushes aggregates into footers. It has a session of its own, so that the
    settings stay there."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.schema(schema).parquet(*paths)


def footer_aggregate(table: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: ``rows``, and of each column its non-null values and, for numbers and dates, its extremes.

    ``table`` must read written parquet files whole (no filter, no computed
    columns): its columns are looked up in the files.
    """
    columns = list(columns if columns is not None else table.columns)
    files = footer_frame(table.sparkSession, _files(table), table.schema)
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        aggregates.append(F.count(files[c]).alias(f"n{i}"))
        if isinstance(table.schema[c].dataType, ORDERED):
            aggregates += [F.min(files[c]).alias(f"lo{i}"), F.max(files[c]).alias(f"hi{i}")]
    return files.agg(*aggregates)


def footer_counts(table: DataFrame, columns: list[str] | None = None) -> dict:
    """``rows``, and of each column (non-null values, least, greatest; None where footers don't tell)."""
    columns = list(columns if columns is not None else [])
    row = footer_aggregate(table, columns).first()
    get = row.asDict().get
    return {"rows": row["rows"]} | {c: (row[f"n{i}"], get(f"lo{i}"), get(f"hi{i}")) for i, c in enumerate(columns)}


def missing_share(table: DataFrame, digits: int = 6) -> DataFrame:
    """A14 of a written table: (variable, missing, share), from footers."""
    found = footer_counts(table, table.columns)
    rows = [(c, found["rows"] - found[c][0], found["rows"]) for c in table.columns]
    out = table.sparkSession.createDataFrame(rows, "variable string, missing long, n long")
    return out.select("variable", "missing", F.round(F.try_divide("missing", "n"), digits).alias("share"))


def column_info(table: DataFrame) -> DataFrame:
    """A6 of a written table: (column, non_null, dtype), from footers."""
    found = footer_counts(table, table.columns)
    rows = [(f.name, found[f.name][0], f.dataType.simpleString()) for f in table.schema]
    return table.sparkSession.createDataFrame(rows, "column string, non_null long, dtype string")


def column_ranges(table: DataFrame, columns: list[str]) -> DataFrame:
    """(column, non_null, least, greatest) of number columns, from footers; a column with NaN has no extremes there."""
    found = footer_counts(table, columns)
    rows = [(c, found[c][0], *(None if v is None else float(v) for v in found[c][1:])) for c in columns]
    return table.sparkSession.createDataFrame(rows, "column string, non_null long, least double, greatest double")
