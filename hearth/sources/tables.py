"""Versioned parquet tables.

A table is a folder of versions ``v=000001, v=000002, ...``; the current
version is the highest one that Spark's output committer finished (it holds
``_SUCCESS``). A write always creates a new version and never touches the
one being read, so a failed or interrupted job leaves the previous version
current: every table write is all-or-nothing, whatever the partition count.
The folder layout is read through Hadoop's FileSystem API, so any store
Spark can write to works.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

VERSION_PREFIX = "v="


class TableStore:
    """Named, versioned parquet tables under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- file system -------------------------------------------------------
    def _path(self, *parts: str):
        jvm = self.spark.sparkContext._jvm
        return jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self, path):
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _numbers(self, table: str) -> list[int]:
        """The numbers of all version folders, committed or not."""
        p = self._path(table)
        fs = self._fs(p)
        if not fs.exists(p):
            return []
        names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
        return sorted(int(n[len(VERSION_PREFIX):]) for n in names if n.startswith(VERSION_PREFIX))

    def versions(self, table: str) -> list[int]:
        """Committed versions of ``table``, oldest first."""
        done = [(n, self._path(table, f"{VERSION_PREFIX}{n:06d}", "_SUCCESS")) for n in self._numbers(table)]
        return [n for n, mark in done if self._fs(mark).exists(mark)]

    def current_path(self, table: str) -> str | None:
        v = self.versions(table)
        return None if not v else f"{self.root}/{table}/{VERSION_PREFIX}{v[-1]:06d}"

    # -- S9 ----------------------------------------------------------------
    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame | None:
        """The current version (``None``, or an empty frame when a schema
        is given, if the table has no version yet)."""
        path = self.current_path(table)
        if path is None:
            return None if schema is None else self.spark.createDataFrame([], schema)
        reader = self.spark.read
        if schema is not None:
            reader = reader.schema(schema)
        return reader.parquet(path)

    def register_views(self, tables=("listing", "item_category"), prefix: str = "") -> list[str]:
        """Register the current version of each table as a temporary view
        (``spark.sql`` over the stored tables); returns the view names."""
        names = []
        for t in tables:
            df = self.read(t)
            if df is not None:
                df.createOrReplaceTempView(prefix + t)
                names.append(prefix + t)
        return names

    # -- S6–S8 -------------------------------------------------------------
    def write_version(self, table: str, df: DataFrame, partitions: int | None = None, sort_within=None) -> str:
        """Write ``df`` as the next version of ``table`` and return its path.

        ``partitions`` (S8) repartitions before the write; by default the
        frame's own partitioning is kept (AQE already sized it). Rows can be
        sorted within files (e.g. by ``change_date``) so parquet min/max
        statistics prune row groups for range filters.
        """
        nxt = max(self._numbers(table), default=0) + 1  # past the leftovers of interrupted writes, too
        path = f"{self.root}/{table}/{VERSION_PREFIX}{nxt:06d}"
        out = df.repartition(partitions) if partitions else df
        if sort_within:
            out = out.sortWithinPartitions(*sort_within)
        out.write.mode("errorifexists").parquet(path)
        return path


def is_empty(df: DataFrame) -> bool:
    """Emptiness without an RDD conversion (stops at the first row)."""
    return df.isEmpty()
