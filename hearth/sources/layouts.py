"""A listing table laid out for search: blocks that searches prune.

The rows stand in ``blocks`` parquet partitions ``block=0, 1, ...``, in the
order of a space-filling curve over number columns (by default price, area and
build year), or of given columns (say city and zipcode). Beside them:

* ``zones``: for each block the least and greatest value of the range columns;
* ``values``: which distinct texts of the text columns occur in which block;
* ``grams``: for each one, two or three characters in a row the texts that hold
  them, sorted, so that a needle reads few row groups.

A search first finds its blocks. A range keeps the blocks whose zone meets it.
A needle is cut into grams; texts that hold all of them are its candidates,
those that hold the needle itself are verified, and their blocks remain. Then
the whole search runs over the remaining blocks, so results are those of a
scan. The driver sees block numbers only, whose number the layout bounds.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.operators.search import ListingSearch, search

BLOCK = "block"
RANGE_COLUMNS = ("price", "area", "build_year")
TEXT_COLUMNS = ("city", "zipcode")
FOLDED = ("city",)  # searched without regard to case
GRAM = 3
CURVE_BITS = 8
VALUES_SCHEMA = "column string, value string, block int"
GRAMS_SCHEMA = "column string, gram string, value string"


def folded(column: str, text: Column) -> Column:
    return F.lower(text) if column in FOLDED else text


def grams(text: Column) -> Column:
    """The distinct runs of one to GRAM characters of ``text``."""
    sizes = F.filter(F.array(*(F.lit(n) for n in range(1, GRAM + 1))), lambda n: n <= F.length(text))
    each = F.transform(sizes, lambda n: F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(text, i, n)))
    return F.array_distinct(F.flatten(each))


def needle_grams(needle: str) -> list[str]:
    """The longest grams of a needle; one that is shorter than GRAM is its own gram."""
    n = min(GRAM, len(needle))
    return sorted({needle[i : i + n] for i in range(len(needle) - n + 1)})


def curve_key(rows: DataFrame, columns: Sequence[str], bits: int = CURVE_BITS) -> Column:
    """The place of a row on a Z-order curve over ``columns``: the bits of its cells, interleaved.

    A column's cells are cut at approximate quantiles, so that they hold about
    as many rows each whatever the distribution (2^bits - 1 numbers a column,
    the only thing that is collected). Null stands in the first cell. The
    cell is found by halving.
    """
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    cuts = rows.agg(*(F.percentile_approx(F.col(c).cast("double"), shares, 10 << bits).alias(c) for c in columns)).collect()[0]
    steps = F.array(*(F.lit(1 << b) for b in reversed(range(bits))))
    key = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        bounds = F.lit(cuts[c] or []).cast("array<double>")
        value = F.col(c).cast("double")
        cell = F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(value > F.try_element_at(bounds, at + step), step).otherwise(0))  # noqa: B023
        bit = lambda at, b: F.shiftleft(F.shiftright(at, b).bitwiseAND(1).cast("long"), len(columns) * b + i)  # noqa: B023, E731
        key = key + F.transform(F.array(cell), lambda at: reduce(lambda x, y: x + y, [bit(at, b) for b in range(bits)]))[0]  # noqa: B023
    return key


class SearchLayout:
    """A written layout under ``root``; ``SearchLayout.build`` makes one."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    @classmethod
    def build(cls, rows: DataFrame, root: str, blocks: int, order: Sequence[str] = (), curve: Sequence[str] = RANGE_COLUMNS) -> SearchLayout:
        """Writes ``rows`` in ``blocks`` blocks under the fresh folder ``root``, by ``order`` if given, else by the curve.

        ``rows`` is evaluated for the cuts, the samples and the blocks: give a
        stored table. Rows equal in order or cell are parted by a hash of the
        whole row and a salt, so a city with a third of all rows fills several
        blocks. Null texts and numbers meet no filter on them and are kept
        with the rest. An empty table has no blocks.
        """
        if blocks < 1 or BLOCK in rows.columns:
            raise ValueError(f"needs a positive number of blocks and no column {BLOCK!r}")
        layout = cls(rows.sparkSession, root, rows.schema)
        place = [F.col(c).asc_nulls_first() for c in order] if order else [curve_key(rows, curve).asc()]
        place += [F.xxhash64(*rows.columns).asc(), F.rand(0).asc()]
        dealt = rows.repartitionByRange(blocks, *place).withColumn(BLOCK, F.spark_partition_id())
        inside = [F.col(c).asc_nulls_first() for c in (order or curve)]
        dealt.sortWithinPartitions(BLOCK, *inside).write.partitionBy(BLOCK).parquet(f"{layout.root}/rows")
        layout._index()
        return layout

    def _index(self) -> None:
        rows = self.rows()
        ranges = [c for c in RANGE_COLUMNS if c in self.schema.names]
        ends = [f(c).alias(f"{n}_{c}") for c in ranges for n, f in (("least", F.min), ("most", F.max))]
        rows.groupBy(BLOCK).agg(F.count("*").alias("rows"), *ends).coalesce(1).write.parquet(f"{self.root}/zones")
        texts = [F.struct(F.lit(c).alias("column"), folded(c, F.col(c)).alias("value")) for c in TEXT_COLUMNS if c in self.schema.names]
        values = rows.select(BLOCK, F.explode(F.array(*texts)).alias("x")).where("x.value IS NOT NULL").select("x.column", "x.value", BLOCK).distinct()
        values.repartition("column", "value").sortWithinPartitions("column", "value").write.parquet(f"{self.root}/values")
        held = self.values().select("column", "value").distinct().select("column", F.explode(grams(F.col("value"))).alias("gram"), "value")
        # sorted by gram; a frequent one fills several files
        held.repartitionByRange("column", "gram", F.xxhash64("value")).sortWithinPartitions("column", "gram", "value").write.parquet(f"{self.root}/grams")

    # -- reading -----------------------------------------------------------
    def rows(self) -> DataFrame:
        """All rows, with their block."""
        return self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(BLOCK, T.IntegerType())])).parquet(f"{self.root}/rows")

    def zones(self) -> DataFrame:
        """One row a block."""
        return self.spark.read.parquet(f"{self.root}/zones")

    def values(self) -> DataFrame:
        return self.spark.read.schema(VALUES_SCHEMA).parquet(f"{self.root}/values")

    def candidates(self, column: str, needle: str) -> DataFrame:
        """(value, verified) of the distinct texts (folded) that hold all grams of ``needle``; verified ones hold the needle."""
        needle = needle.lower() if column in FOLDED else needle
        asked = needle_grams(needle)
        found = self.spark.read.schema(GRAMS_SCHEMA).parquet(f"{self.root}/grams").where((F.col("column") == column) & F.col("gram").isin(asked))
        found = found.groupBy("value").agg(F.count("*").alias("n")).where(F.col("n") == len(asked))
        return found.select("value", F.col("value").contains(needle).alias("verified"))

    def blocks_of(self, params=None, **kw) -> list[int] | None:
        """The blocks that may hold a search's rows; None if its filters say nothing about blocks."""
        p = ListingSearch.of(params, **kw)
        parts = []
        for column in RANGE_COLUMNS:
            low, high = getattr(p, f"min_{column}"), getattr(p, f"max_{column}")
            parts += [F.col(f"most_{column}") >= low] if low is not None else []
            parts += [F.col(f"least_{column}") <= high] if high is not None else []
        found = [self.zones().where(reduce(lambda a, b: a & b, parts)).select(BLOCK)] if parts else []
        for column in TEXT_COLUMNS:
            if needle := getattr(p, column):
                texts = self.candidates(column, needle).where("verified").select("value")
                found.append(self.values().where(F.col("column") == column).join(texts, "value", "left_semi").select(BLOCK).distinct())
        if not found:
            return None
        return sorted(r[0] for r in reduce(lambda a, b: a.join(b, BLOCK, "left_semi"), found).collect())

    def search(self, item_category: DataFrame | None = None, params=None, **kw) -> DataFrame:
        """F16 over the blocks that can hold rows: the rows of ``search`` over the whole table."""
        blocks = self.blocks_of(params, **kw)
        rows = self.rows() if blocks is None else self.rows().where(F.col(BLOCK).isin(blocks))
        return search(rows.drop(BLOCK), item_category, params, **kw)
