"""Connected components of a link table, by alternating star contraction.

Each round sends every node the smallest name among itself and its
neighbours (large star: larger neighbours are linked to it; small star:
smaller neighbours are). Links stay a table of (a, b) pairs: nothing is
gathered per node beyond a minimum, which Spark aggregates before the
shuffle. Rounds grow with the logarithm of a component's size, and end once
every node is linked to a root and nothing else; links that are so from the
start take none. Each round is written to the shared folder, so a lost
executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.session import scratch_path


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links of each node's larger (or smaller and own) neighbours to the least name it sees."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    out = both.join(least, "a")
    if large:
        return out.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    # edges point from the larger a to the smaller b
    return out.select(F.col("b").alias("x"), "m").unionByName(out.select(F.col("a").alias("x"), "m")).where("x > m").select(F.col("x").alias("a"), F.col("m").alias("b"))


def _settled(edges: DataFrame) -> bool:
    """Whether each node has one link to a smaller one, or is such a smaller one only. ``edges``: distinct, a > b."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up")))
    links = ends.groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
    return links.where("up > 1 OR up = 1 AND least = 0").isEmpty()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: any orderable type).

    ``component`` is the least node name of the component. Repeated links are
    allowed; loops (a = b) and links with a null end say nothing and are left out. An empty
    table gives no rows. Raises if ``max_rounds`` do not suffice.
    """
    spark = links.sparkSession
    path = scratch_path(spark, "components")
    links = links.where("a IS NOT NULL AND b IS NOT NULL")
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges.write.parquet(f"{path}/0")
    edges = spark.read.parquet(f"{path}/0")
    for k in range(1, max_rounds + 2):
        if _settled(edges):
            break
        if k > max_rounds:
            raise RuntimeError(f"components not settled after {max_rounds} rounds")
        _star(_star(edges, True).distinct(), False).distinct().write.parquet(f"{path}/{k}")
        edges = spark.read.parquet(f"{path}/{k}")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
