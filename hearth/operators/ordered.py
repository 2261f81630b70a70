"""Rows put in order once, in range partitions, each with its place.

Positions come from the written rows, so from one evaluation: a row's place is
that in its partition, and what lies before a partition is one number each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The place in the partition of a monotonically increasing id.
PLACE_BITS = 33


def placed(df: DataFrame, order: Sequence[Column], path: str, partitions: int = 0, within: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``df`` written to ``path`` in range partitions by ``order``, and read back with ``__part`` (earlier partitions hold
    earlier rows) and ``__at`` (the place in it, from 0).

    The partitions are ``partitions``, or Spark's number for shuffles if that
    is more. ``within`` adds columns to the sorted rows and must keep them in
    their order and partition.
    """
    spark = df.sparkSession
    parts = max(partitions, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    rows = within(rows) if within else rows
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    rows.withColumn("__part", F.spark_partition_id()).withColumn("__at", at).write.parquet(path)
    return spark.read.parquet(path)


def _repeats(column: pa.Array) -> np.ndarray:
    """Whether each value but the first equals the one before it, as Spark groups: nulls are equal, and NaN too."""
    if pa.types.is_nested(column.type):
        values = column.to_pylist()
        return np.array([a == b for a, b in zip(values, values[1:])], dtype=bool)
    a, b = column[:-1], column[1:]
    same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
    if pa.types.is_floating(column.type):
        same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
    return same.to_numpy(zero_copy_only=False)


def run_numbers(df: DataFrame, keys: Sequence[str], name: str = "__number") -> DataFrame:
    """``df`` with ``name`` = 1, 2, ... (long) along each run of rows with equal ``keys`` in a partition, as its rows come."""
    at = [df.columns.index(k) for k in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, count = None, 0  # the keys of the row before, and its number
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            columns = [batch.column(i) for i in at]
            begins = np.ones(n, dtype=bool)
            whole = columns if last is None else [pa.concat_arrays([x, c]) for x, c in zip(last, columns)]
            begins[0 if last is not None else 1 :] = ~np.logical_and.reduce([_repeats(c) for c in whole])
            place = np.arange(n)
            numbers = place - np.maximum.accumulate(np.where(begins, place, -count)) + 1
            last, count = [c[n - 1 : n] for c in columns], int(numbers[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], [*[f"_{i}" for i in range(len(batch.columns))], name])

    plain = [f"_{i}" for i in range(len(df.columns))]  # names may hold dots
    schema = T.StructType([T.StructField(p, f.dataType) for p, f in zip(plain, df.schema.fields)] + [T.StructField(name, T.LongType())])
    return df.toDF(*plain).mapInArrow(run, schema).toDF(*df.columns, name)
