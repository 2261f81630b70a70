"""Approximate nearest neighbours by a hash-prefix forest.

A tree gives every vector a long hash string (the sides of random
hyperplanes) and keeps the strings as a sorted array. A query descends in
every tree to its longest prefix that any string shares, and then all trees
ascend together, bit by bit, until the vectors below the common prefix length
are enough. Those are scored exactly.

Hyperplanes tell directions, but the measure is the inner product, which
favours long vectors. So for the strings every vector of a block gets one more
component that makes all lengths equal, and queries get zero there: nearest by
direction is then nearest by inner product.

Where lengths differ much that component would outweigh the directions, so
vectors are first parted by length, in bands of a quarter octave.

Each band is dealt into blocks of about ``block_rows`` vectors by their hash, and the
queries into batches of ``batch_rows``; a task takes one batch to one block's
forest, so that neither an index nor its queries and their candidates grow
beyond a task. Equal vectors are indexed once, with the few smallest of their
ids that a result can show.

How many candidates a recall takes depends on the vectors: near-orthogonal
ones (random directions) need a good part of all rows, which is what ``share``
says. Clustered embeddings do with far less.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.session import scratch_path

TREES, BITS = 24, 32


def hash_strings(vectors: np.ndarray, trees: int, bits: int, seed: int) -> np.ndarray:
    """(tree, row): the strings as whole numbers, first bit highest. Planes of a tree are orthogonal as far as they go."""
    rng = np.random.default_rng(seed)
    dim, out = vectors.shape[1], np.zeros((trees, len(vectors)), dtype=np.uint64)
    place = (np.uint64(1) << np.arange(bits - 1, -1, -1, dtype=np.uint64))[:, None]
    for t in range(trees):
        planes = np.concatenate([np.linalg.qr(rng.normal(size=(dim, dim)))[0] for _ in range(-(-bits // dim))], axis=1)[:, :bits]
        out[t] = ((vectors @ planes > 0).T * place).sum(axis=0, dtype=np.uint64)
    return out


def equal_lengths(vectors: np.ndarray) -> np.ndarray:
    """The vectors with one more component, by which all are as long as the longest."""
    squares = (vectors**2).sum(axis=1)
    return np.column_stack([vectors, np.sqrt(np.maximum(squares.max(initial=0.0) - squares, 0.0))])


class Forest:
    """The sorted arrays of one block."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = 0):
        self.vectors, self.bits, self.options = vectors, bits, (trees, bits, seed)
        strings = hash_strings(equal_lengths(vectors), *self.options)
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=1)

    def ranges(self, queries: np.ndarray, enough: int) -> tuple[np.ndarray, np.ndarray]:
        """(tree, query): where each query's candidates stand in the sorted arrays, after the ascent."""
        strings = hash_strings(np.column_stack([queries, np.zeros(len(queries))]), *self.options)
        low = np.zeros((self.bits + 1, *strings.shape), dtype=np.int64)
        high = low.copy()
        for level in range(self.bits + 1):
            shift = np.uint64(self.bits - level)
            first = (strings >> shift) << shift
            last = first | ((np.uint64(1) << shift) - np.uint64(1))
            for t, row in enumerate(self.sorted):
                low[level, t] = np.searchsorted(row, first[t], side="left")
                high[level, t] = np.searchsorted(row, last[t], side="right")
        found = (high - low).sum(axis=1)  # level, query
        level = np.where(found >= enough, np.arange(self.bits + 1)[:, None], 0).max(axis=0)
        at = np.arange(len(level))
        return low[level, :, at].T, high[level, :, at].T

    def search(self, queries: np.ndarray, k: int, enough: int):
        """Yields (rows, scores) of each query's k best candidates, and of those that tie with the last."""
        for start in range(0, len(queries), 256):
            part = queries[start : start + 256]
            low, high = self.ranges(part, enough)
            for i, q in enumerate(part):
                chosen = np.zeros(len(self.vectors), dtype=bool)
                for t in range(len(low)):
                    chosen[self.order[t, low[t, i] : high[t, i]]] = True
                rows = np.flatnonzero(chosen)
                rough = self.vectors[rows] @ q
                if len(rows) > k:
                    rows = rows[rough >= np.partition(rough, len(rough) - k)[len(rough) - k] - 1e-9 * (1 + np.abs(rough).max())]
                yield rows, (self.vectors[rows] * q).sum(axis=1)


def _usable(vector: Column) -> Column:
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & whole & F.exists(vector, lambda x: x != 0)


def nearest(vectors: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
            trees: int = TREES, bits: int = BITS, share: float = 0.9, least: int = 2048, block_rows: int = 4096, batch_rows: int = 8192, seed: int = 0) -> DataFrame:
    """(query_id, rank, id, score): the k nearest found by inner product for each row that the condition ``queries`` selects.

    ``queries`` is a condition on ``id_col``. Trees ascend until at least
    max(``least``, ``share`` x rows of the block) strings stand below the
    prefix, counted over all trees. Scores are exact, in double precision;
    ties go to the smaller id, ranks start from 1.

    Rows whose id or vector is null, whose vector is zero, or holds a null or a
    non-finite number take no part. Vectors are compared with those of their
    own length. Rows equal in id and vector are one; a row is no neighbour of
    its own id. Fewer rows than k give fewer neighbours, an empty table gives
    none; other columns are ignored.
    """
    spark = vectors.sparkSession
    path = scratch_path(spark, "forest")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(queries, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & _usable(F.col("v"))).distinct()
    # equal vectors: one entry with its k + 1 smallest ids
    few = rows.withColumn("no", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("no") <= k + 1)
    few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("entry", F.monotonically_increasing_id()).write.parquet(f"{path}/entries")
    entries = spark.read.parquet(f"{path}/entries").withColumn("dim", F.size("v"))
    rows.where("asks").select("id", "v").join(entries, "v").select(F.col("id").alias("query_id"), "entry").write.parquet(f"{path}/queries")
    asked = spark.read.parquet(f"{path}/queries")
    # bands of lengths (a few thousand at most), each with so many blocks of its own
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    band = F.floor(4 * F.log2(length)).alias("band")  # null where the sum of squares is no number above zero
    bands = entries.groupBy("dim", band).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    bands.write.parquet(f"{path}/bands")
    bands = F.broadcast(spark.read.parquet(f"{path}/bands").withColumnsRenamed({"dim": "dim_b", "band": "band_b"}))
    batches = max(1, -(-asked.select("entry").distinct().count() // batch_rows))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "v"), n).cast("int")
    index = entries.select("dim", band, numbers(batches).alias("batch"), "entry", "v")
    index = index.join(bands, (F.col("dim") == F.col("dim_b")) & F.col("band").eqNullSafe(F.col("band_b"))).withColumn("block", dealt(1, F.col("blocks")))
    again = spark.read.parquet(f"{path}/entries").withColumn("dim", F.size("v"))
    asking = again.join(asked.select("entry").distinct(), "entry", "left_semi")
    asking = asking.join(bands, F.col("dim") == F.col("dim_b"))
    asking = asking.select("dim", F.col("band_b").alias("band"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), dealt(2, F.lit(batches)).alias("batch"), "entry", "v")
    index, asking = (x.withColumn("band", F.coalesce("band", F.lit(-(1 << 40)))).select("dim", "band", "block", "batch", "entry", "v") for x in (index, asking))

    def matrix(table: pa.Table) -> np.ndarray:
        return np.array(table["v"].combine_chunks().flatten()).reshape(table.num_rows, -1)

    def search(here: pa.Table, who: pa.Table) -> pa.Table:
        if not here.num_rows or not who.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=["asker", "entry", "score"])
        forest = Forest(matrix(here), trees, bits, seed)
        names, enough = here["entry"].to_numpy(), max(least, int(np.ceil(share * here.num_rows)))
        found = list(forest.search(matrix(who), k + 1, enough))
        asker = np.repeat(who["entry"].to_numpy(), [len(r) for r, _ in found])
        return pa.table([asker, names[np.concatenate([r for r, _ in found])], np.concatenate([s for _, s in found])], names=["asker", "entry", "score"])

    found = index.groupBy("dim", "band", "block", "batch").cogroup(asking.groupBy("dim", "band", "block", "batch")).applyInArrow(search, "asker long, entry long, score double")
    # the best of all blocks: k + 1 entries with their ids hold k ids other than the query's own
    first = entries.select("entry", "ids", F.col("ids")[0].alias("least"))
    best = found.join(first, "entry").withColumn("no", F.row_number().over(Window.partitionBy("asker").orderBy(F.desc("score"), "least"))).where(F.col("no") <= k + 1)
    each = best.select("asker", "score", F.explode("ids").alias("id"))
    each = each.withColumn("no", F.row_number().over(Window.partitionBy("asker").orderBy(F.desc("score"), "id"))).where(F.col("no") <= k + 1)
    pairs = asked.withColumnRenamed("entry", "asker").join(each.drop("no"), "asker").where("id <> query_id")
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "asker").orderBy(F.desc("score"), "id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")
