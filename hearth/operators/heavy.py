"""The most frequent values of columns with very many values (A9, A11, A12), without counting every value.

A sketch of two rows of 2^bits counters a column (count-min: each value counts
in one bucket of each row) bounds every value's count from above; sketches of
parts add up, so tasks send 2^bits counters at most, whatever they read. The
values in the ``k`` fullest buckets are counted exactly, and their k-th largest
count is a floor: a value below it is none of the first ``k``, and neither is
one in a bucket below it. What is left is counted exactly.

A value's bucket holds, beside its own, about rows / 2^bits other rows, so
values that occur far more often than that are told apart from the rest. Where
no value does (a key), the floor is low, most values are counted, and the cost
is that of the full count; the result is exact either way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.operators.profile import _long
from hearth.session import scratch_path

BITS = 16
ROWS = (0, 1)


def _bucket(row: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(row), "value"), F.lit(1 << bits))


def sketch(values: DataFrame, bits: int = BITS) -> DataFrame:
    """(column, row, bucket, n) of (column, value): at most 2^bits counters a column and row."""
    places = F.array(*(F.struct(F.lit(r).alias("row"), _bucket(r, bits).alias("bucket")) for r in ROWS))
    return values.select("column", F.explode(places).alias("at")).groupBy("column", "at.row", "at.bucket").agg(F.count("*").alias("n"))


def _first(rows: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows of each column."""
    return rows.withColumn("__rank", F.row_number().over(Window.partitionBy("column").orderBy(*order))).where(F.col("__rank") <= k)


def _in_buckets(values: DataFrame, buckets: DataFrame, row: int, bits: int) -> DataFrame:
    """Values whose bucket of ``row`` is in ``buckets``, of which there are at most 2^bits a column."""
    kept = buckets.where(F.col("row") == row).select("column", F.col("bucket").alias("__b"))
    return values.withColumn("__b", _bucket(row, bits)).join(F.broadcast(kept), ["column", "__b"], "left_semi").drop("__b")


def top_values(df: DataFrame, columns: Sequence[str], k: int = 100, bits: int = BITS) -> DataFrame:
    """(column, rank, value, count) of the ``k`` most frequent values of each column, exactly; nulls are no values.

    Ranks go by count, then value; of a column with fewer values all are
    returned, of an empty table none. Values are texts. ``df`` is read three
    times: give a stored table.
    """
    if k < 1:
        raise ValueError(f"k must be positive (got {k})")
    spark = df.sparkSession
    path = scratch_path(spark, "heavy")
    values = _long(df, list(columns), "string").select("column", "value")
    counted = lambda rows: rows.groupBy("column", "value").agg(F.count("*").alias("count"))
    sketch(values, bits).write.parquet(f"{path}/sketch")
    counters = spark.read.parquet(f"{path}/sketch")
    full = _first(counters.where("row = 0"), k, F.desc("n"), F.asc("bucket"))
    some = _first(counted(_in_buckets(values, full, 0, bits)), k, F.desc("count"), F.asc("value"))
    floors = some.groupBy("column").agg(F.when(F.count("*") == k, F.min("count")).otherwise(1).alias("floor"))
    floors.write.parquet(f"{path}/floors")
    heavy = counters.join(F.broadcast(spark.read.parquet(f"{path}/floors")), "column").where("n >= floor")  # a row a column
    for row in ROWS:
        values = _in_buckets(values, heavy, row, bits)
    found = _first(counted(values), k, F.desc("count"), F.asc("value"))
    return found.select("column", F.col("__rank").alias("rank"), "value", "count")


def distinct_estimates(df: DataFrame, columns: Sequence[str], error: float = 0.02) -> DataFrame:
    """(column, n_distinct, error) by one HyperLogLog a column, in one aggregate; nulls are no values.

    ``error`` is the relative standard deviation: an estimate is off by more
    than three times as much in about 3 of 1,000 cases. State is bounded by
    it (about 1 / error^2 bytes a column and task).
    """
    found = df.agg(*(F.approx_count_distinct(c, error).alias(c) for c in columns))
    return found.unpivot([], list(columns), "column", "n_distinct").select("column", "n_distinct", F.lit(error).alias("error"))
