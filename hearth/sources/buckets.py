"""Keyed tables in hash buckets: upserts that rewrite what changed, lookups that read one bucket.

A table is a folder of parquet partitions ``bucket=0, 1, ...``; a row's bucket
is a fixed hash of its key. Inside a bucket rows are sorted by key, and the
files carry bloom filters of the key columns, so a lookup opens one partition
and skips row groups and pages in it.

An upsert costs what the batch touches:

1. the batch's rows are digested per bucket (an order-independent digest of
   whole rows). Buckets whose digest is the stored one hold the same rows and
   are not even read;
2. of the others the stored rows are read and merged, and the result is staged
   beside the table. Buckets that come out with their old digest stay;
3. when all tables of a commit are staged, one mark makes the commit final.
   Then Spark's dynamic partition overwrite replaces the changed buckets.

A job that dies before the mark has changed nothing. One that dies after it is
finished, from the staged rows, by the next one that opens the store: several
tables become current together. There is one writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.operators.upsert import merge_upsert

BUCKET = "bucket"
DIGEST = T.StructType(
    [T.StructField("rows", T.LongType()), T.StructField("xored", T.LongType()), T.StructField("summed", T.DecimalType(38, 0)), T.StructField(BUCKET, T.IntegerType())]
)
ROW_GROUP_BYTES = 16 << 20


def row_digest(columns: Sequence[str]) -> list[Column]:
    """Aggregates that tell sets of rows apart, whatever their order: two independent 64-bit hashes of whole rows,
    one xored and one summed, and the number of rows. Nulls count by their place."""
    cols = [F.col(c) for c in columns]
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cols])
    wide = F.xxhash64(F.lit(1), nulls, *cols).cast("decimal(20,0)")
    return [F.count(F.lit(1)).alias("rows"), F.bit_xor(F.xxhash64(nulls, *cols)).alias("xored"), F.sum(wide).cast("decimal(38,0)").alias("summed")]


class BucketStore:
    """Keyed tables under ``root``; opening it finishes an interrupted commit."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.recover()

    # -- files -------------------------------------------------------------
    def _path(self, *parts: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _exists(self, *parts: str) -> bool:
        return self._fs().exists(self._path(*parts))

    def _names(self, *parts: str) -> list[str]:
        if not self._exists(*parts):
            return []
        return sorted(x.getPath().getName() for x in self._fs().listStatus(self._path(*parts)))

    def _put(self, content: str, *parts: str) -> None:
        """A small file that is there whole or not at all."""
        fs, path = self._fs(), self._path(*parts)
        draft = self._path(*parts[:-1], f"_draft-{parts[-1]}")
        out = fs.create(draft, True)
        out.write(bytearray(content.encode()))
        out.close()
        if not fs.rename(draft, path):
            raise OSError(f"{path} is there already")

    def _get(self, *parts: str) -> dict:
        stream = self._fs().open(self._path(*parts))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    # -- layout ------------------------------------------------------------
    def create(self, table: str, schema: T.StructType, keys: Sequence[str], buckets: int) -> None:
        """Declares a table (``schema``: its columns, without a column ``bucket``). The number of buckets is fixed from
        then on: about the rows the table will have / 1 million. Another layout for an existing table is a ValueError."""
        layout = {"keys": list(keys), "buckets": int(buckets), "schema": schema.jsonValue()}
        if buckets < 1 or BUCKET in schema.names or not set(keys) <= set(schema.names):
            raise ValueError(f"{table}: needs a positive number of buckets, its keys, and no column {BUCKET!r}")
        if not self._exists(table, "layout.json"):
            self._put(json.dumps(layout), table, "layout.json")
        elif self.layout(table) != layout:
            raise ValueError(f"{table} exists with another layout")

    def layout(self, table: str) -> dict:
        return self._get(table, "layout.json")

    def tables(self) -> list[str]:
        return [t for t in self._names() if self._exists(t, "layout.json")]

    @staticmethod
    def _bucket(layout: dict, values: Sequence[Column]) -> Column:
        return F.pmod(F.xxhash64(*values), F.lit(layout["buckets"])).cast("int")

    # -- reading -----------------------------------------------------------
    def _rows(self, table: str) -> DataFrame:
        """The current rows with their bucket."""
        schema = T.StructType.fromJson(self.layout(table)["schema"]).add(BUCKET, T.IntegerType())
        if not self._exists(table, "data"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{table}/data")

    def read(self, table: str) -> DataFrame:
        """The table's current rows (none before its first upsert)."""
        return self._rows(table).drop(BUCKET)

    def register_views(self, prefix: str = "") -> list[str]:
        """A temporary view of each table, for ``spark.sql``."""
        for t in self.tables():
            self.read(t).createOrReplaceTempView(prefix + t)
        return [prefix + t for t in self.tables()]

    def lookup(self, table: str, **key) -> DataFrame:
        """The rows of one key, read from its bucket only."""
        layout = self.layout(table)
        if set(key) != set(layout["keys"]):
            raise ValueError(f"{table} is looked up by {layout['keys']}")
        schema = T.StructType.fromJson(layout["schema"])
        values = {k: F.lit(v).cast(schema[k].dataType) for k, v in key.items()}
        rows = self._rows(table).where(F.col(BUCKET) == self._bucket(layout, [values[k] for k in layout["keys"]]))
        for k, v in values.items():
            rows = rows.where(F.col(k).eqNullSafe(v) if key[k] is None else F.col(k) == v)
        return rows.drop(BUCKET)

    def near(self, table: str, incoming: DataFrame) -> DataFrame:
        """The current rows of the buckets that hold the keys of ``incoming``; the list of buckets is bounded by the layout."""
        layout = self.layout(table)
        numbers = incoming.select(self._bucket(layout, [F.col(k) for k in layout["keys"]]).alias(BUCKET)).distinct().collect()
        return self._rows(table).where(F.col(BUCKET).isin([r[0] for r in numbers])).drop(BUCKET)

    def digests(self, table: str) -> dict[int, tuple]:
        """(rows, xored, summed) of each bucket: one row a bucket."""
        if not self._exists(table, "digests"):
            return {}
        return {r[BUCKET]: (r["rows"], r["xored"], r["summed"]) for r in self.spark.read.schema(DIGEST).parquet(f"{self.root}/{table}/digests").collect()}

    # -- writing -----------------------------------------------------------
    def upsert(self, batches: dict[str, DataFrame]) -> dict[str, dict]:
        """Merges unique-keyed batches into their tables, which become current together.

        Rows with a stored key replace it, new keys are added (a table of keys
        only keeps what it has). Columns are cast to the table's types. Returns for each table the buckets the batch
        touched, those read, and those written. Empty batches change nothing.
        """
        self.recover()
        number = max((int(n) for n in self._names("commits")), default=0) + 1
        commit = f"commits/{number:06d}"
        report = {t: self._stage(t, rows, f"{commit}/{t}") for t, rows in batches.items()}
        if any(r["written"] for r in report.values()):
            self._put(json.dumps({t: r["written"] for t, r in report.items()}), commit, "READY")
            self._publish(commit)
        return report

    def _stage(self, table: str, incoming: DataFrame, folder: str) -> dict:
        layout, spark = self.layout(table), self.spark
        schema = T.StructType.fromJson(layout["schema"])
        keys = [F.col(k) for k in layout["keys"]]
        path = f"{self.root}/{folder}"
        # evaluated once: the digests and the merge read it again
        incoming.select(*[F.col(f.name).cast(f.dataType) for f in schema]).withColumn(BUCKET, self._bucket(layout, keys)).write.parquet(f"{path}/incoming")
        batch = spark.read.parquet(f"{path}/incoming")
        stored = self.digests(table)
        came = self._digested(batch, schema.names)
        open_ = sorted(b for b, d in came.items() if stored.get(b) != d)
        report = {"touched": sorted(came), "read": [b for b in open_ if b in stored], "written": []}
        if open_:
            old = self._rows(table).where(F.col(BUCKET).isin(open_))
            merge_upsert(old, batch.where(F.col(BUCKET).isin(open_)), [BUCKET, *layout["keys"]]).write.parquet(f"{path}/rows")
            merged = self._digested(spark.read.parquet(f"{path}/rows"), schema.names)
            report["written"] = sorted(b for b, d in merged.items() if stored.get(b) != d)
        return report

    @staticmethod
    def _digested(rows: DataFrame, columns: list[str]) -> dict[int, tuple]:
        return {r[BUCKET]: (r["rows"], r["xored"], r["summed"]) for r in rows.groupBy(BUCKET).agg(*row_digest(columns)).collect()}

    def _publish(self, commit: str) -> None:
        """Replaces the changed buckets by the staged rows; may be repeated."""
        for table, buckets in self._get(commit, "READY").items():
            if not buckets:
                continue
            layout = self.layout(table)
            schema = T.StructType.fromJson(layout["schema"])
            rows = self.spark.read.schema(schema.add(BUCKET, T.IntegerType())).parquet(f"{self.root}/{commit}/{table}/rows")
            rows = rows.where(F.col(BUCKET).isin(buckets))
            out = rows.repartition(len(buckets), BUCKET).sortWithinPartitions(BUCKET, *layout["keys"]).write.option("parquet.block.size", ROW_GROUP_BYTES)
            for k in layout["keys"]:
                out = out.option(f"parquet.bloom.filter.enabled#{k}", "true")
            self._replace(out, f"{table}/data")
            columns = [c for c in schema.names if c != BUCKET]
            self._replace(rows.groupBy(BUCKET).agg(*row_digest(columns)).coalesce(1).write, f"{table}/digests")
        self._put("{}", commit, "DONE")

    def _replace(self, out, folder: str) -> None:
        out.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(f"{self.root}/{folder}")

    def recover(self) -> list[str]:
        """Finishes commits that were marked but not published; returns them."""
        names = [n for n in self._names("commits") if n.isdigit()]
        todo = [n for n in names if self._exists("commits", n, "READY") and not self._exists("commits", n, "DONE")]
        for n in todo:
            self._publish(f"commits/{n}")
        return todo

    def expire(self, keep: int = 1) -> int:
        """Deletes the staged rows of finished commits but the last ``keep`` (the tables don't need them)."""
        done = [n for n in self._names("commits") if self._exists("commits", n, "DONE")]
        old = done[: len(done) - keep] if keep else done
        for n in old:
            for t in self.tables():
                for part in ("incoming", "rows"):
                    self._fs().delete(self._path("commits", n, t, part), True)
        return len(old)
