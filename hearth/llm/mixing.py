"""Mixing sources to target weights by a low-discrepancy schedule of token blocks.

* Each source has a share of the total by its weight; no source is taken more
  than ``epochs`` times, and what a capped source can't give is shared out
  again by weight (``targets``).
* The mix is a row of slots of ``block`` tokens. Slot i falls on the point
  i * golden ratio mod 1, and the point lies in one source's part of [0, 1).
  After any number of slots, every source has had its part of them but for
  one or two.
* A source's documents stand in a shuffled order (by a seeded hash), repeated
  ``epochs`` times, and cut into blocks of as many tokens. The r-th slot of a
  source takes its r-th block.

Running totals (token positions of documents, ranks of slots) are summed in
two steps: per hash range or run of slots, then inside each, so that no source
has to pass through one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearth.llm.text import SPACE, quoted
from hearth.session import scratch_path

GOLDEN = round((5**0.5 - 1) / 2 * (1 << 40))  # in units of 2^-40
RUN = 1 << 12  # slots in a run
MOST_SOURCES = 1 << 16  # more raise ValueError: the table of sources is broadcast
PIECE_ROWS = 1 << 12  # documents in a hash range, about
COPIES = 1 << 12  # copies of a row that are made in one step


def numbered(rows: DataFrame, n: str, out: str) -> DataFrame:
    """Each row ``n`` times, as ``out`` = 0 .. n - 1, in two steps: no array of all copies is made."""
    last = F.col(n).cast("long") - 1
    rows = rows.withColumn("__first", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(COPIES).cast("long"))))
    return rows.withColumn(out, F.explode(F.sequence("__first", F.least(last, F.col("__first") + (COPIES - 1))))).drop("__first")


def n_words(text: Column) -> Column:
    """The number of words of a text (null: 0)."""
    return F.coalesce(F.size(F.filter(F.split(text, SPACE), lambda w: w != "")), F.lit(0)).cast("long")


def targets(sizes: list[tuple[str | None, int]], weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, epochs: int = 2) -> list[float]:
    """Tokens to take from each source of ``sizes`` [(source, size)], sorted by code point with null last:
    ``share`` of all sizes by ``weights`` (repeating), at most ``epochs`` times a source's size."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    most = [epochs * size for _, size in sizes]
    total = share * sum(size for _, size in sizes)
    out, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        left = total - sum(out[i] for i in range(len(sizes)) if i not in open_)
        each = left / sum(weight[i] for i in open_)
        over = {i for i in open_ if each * weight[i] > most[i]}
        for i in over or open_:
            out[i] = float(most[i]) if over else each * weight[i]
        open_ -= over or open_
    return out


def running(rows: DataFrame, key: list[str], piece: str, order: list[str], value: str, out: str) -> DataFrame:
    """``rows`` with ``out``: the sum of ``value`` over earlier rows of the same key.

    Rows are ordered by ``piece`` (a number that grows with ``order`` inside a
    key), then ``order``. One window runs over the sums per (key, piece), the
    other inside each piece.
    """
    sums = rows.groupBy(*key, piece).agg(F.sum(value).alias("__s"))
    before = Window.partitionBy(*key).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    base = sums.withColumn("__base", F.coalesce(F.sum("__s").over(before), F.lit(0))).drop("__s")
    inside = Window.partitionBy(*key, piece).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return rows.join(base, [*key, piece]).withColumn(out, F.col("__base") + F.col("__in")).drop("__base", "__in")


def golden(i: Column) -> Column:
    """i times the golden ratio, modulo 1, for i below 2^40: exact in whole numbers of 2^-40."""
    high, low = F.shiftright(i, 20), i.bitwiseAND((1 << 20) - 1)
    product = ((high * GOLDEN) % (1 << 40)) * (1 << 20) + low * GOLDEN
    return (product % (1 << 40)).cast("double") / float(1 << 40)


def schedule(spark: SparkSession, sources: DataFrame, slots: int) -> DataFrame:
    """(slot, sid, rank) of ``slots`` slots: ``sources`` has sid int, low double and high double, the parts of [0, 1).

    ``sources`` has one row a source; it is joined on 1/256ths of [0, 1), so
    that no slot is compared with all sources.
    """
    grid = 256
    cells = sources.where("high > low").select("sid", "low", "high", F.explode(F.sequence(F.floor(F.col("low") * grid).cast("int"), F.least(F.floor(F.col("high") * grid), F.lit(grid - 1)).cast("int"))).alias("cell"))
    points = spark.range(slots).select(F.col("id").alias("slot"), golden(F.col("id") + 1).alias("point"))
    points = points.withColumn("cell", F.floor(F.col("point") * grid).cast("int"))
    found = points.join(cells, (points.cell == cells.cell) & (F.col("point") >= F.col("low")) & (F.col("point") < F.col("high")))
    taken = found.select("slot", "sid", F.floor(F.col("slot") / RUN).alias("run"), F.lit(1).cast("long").alias("one"))
    return running(taken, ["sid"], "run", ["slot"], "one", "rank").select("slot", "sid", "rank")


class Mix:
    """The mix of ``docs``: ``slots`` (slot, source, rank), ``segments`` (slot, document, first and last token), ``taken`` per row.

    ``docs`` may hold nulls in any column: a null source is a source of its
    own, after the others; a null or empty text has no tokens and is never
    taken. Repeated rows and ids are documents of their own. Very long texts
    run over several blocks. Rows equal in id, source and text are
    interchangeable and are numbered; ties in the shuffled order are broken by
    id, size, text hash and that number. An empty table gives an empty mix.
    Extra columns are ignored. More than ``MOST_SOURCES`` sources raise an
    error.
    """

    def __init__(self, docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", weights=(5, 2, 1), share=1.5, epochs=2, block=64, seed=0):
        self.spark, self.block, self.epochs = docs.sparkSession, block, epochs
        path = scratch_path(self.spark, "mix")
        rows = docs.select(
            F.col(quoted(id_col)).alias("id"),
            F.col(quoted(source_col)).alias("source"),
            n_words(F.col(quoted(text_col))).alias("size"),
            F.xxhash64(quoted(text_col)).alias("text_hash"),
        )
        rows.groupBy("id", "source", "size", "text_hash").agg(F.count("*").alias("n")).write.parquet(f"{path}/rows")
        rows = self.spark.read.parquet(f"{path}/rows")
        found = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n"))
        found = found.limit(MOST_SOURCES + 1).collect()
        if len(found) > MOST_SOURCES:
            raise ValueError(f"more than {MOST_SOURCES} sources")
        found = sorted(found, key=lambda r: (r.source is None, r.source if r.source is None else r.source.encode("utf-8", "surrogatepass")))
        wanted = targets([(r.source, r.source_size) for r in found], weights, share, epochs)
        total = sum(wanted)
        self.n_slots = -(-int(total) // block) if total else 0
        parts, low = [], 0.0
        for sid, (r, target) in enumerate(zip(found, wanted, strict=True)):
            high = low + (target / total if total else 0.0)
            parts.append((sid, r.source, r.source_size, target, low, high))
            low = high
        if parts:
            parts[-1] = (*parts[-1][:-1], max(1.0, low))
        kind = rows.schema["source"].dataType.simpleString()
        sources = self.spark.createDataFrame(parts, f"sid int, source {kind}, source_size long, target double, low double, high double")
        pieces = max(1, -(-sum(r.n for r in found) // PIECE_ROWS))
        rows = rows.join(F.broadcast(sources.select("sid", "source", "source_size", "target")), rows.source.eqNullSafe(sources.source)).drop(sources.source)
        rows = numbered(rows, "n", "copy").drop("n").withColumn("shuffled", F.xxhash64(F.lit(seed), "id", "text_hash", "copy"))
        # pieces: equal ranges of the hash, in its order
        rows = rows.withColumn("piece", F.floor((F.shiftright("shuffled", 1) + (1 << 62)) / float((1 << 63) / pieces)).cast("long"))
        running(rows, ["sid"], "piece", ["shuffled", "id", "size", "text_hash", "copy"], "size", "start").write.parquet(f"{path}/documents")
        self.documents = self.spark.read.parquet(f"{path}/documents")
        schedule(self.spark, sources, self.n_slots).write.parquet(f"{path}/slots")
        self.slots = self.spark.read.parquet(f"{path}/slots")

    def segments(self) -> DataFrame:
        """(slot, sid, start, epoch, begin, stop): words begin..stop-1 of the document at ``start`` of a source, for each slot that takes some."""
        d = self.documents.where("size > 0").select("sid", "start", "size", "source_size", F.explode(F.sequence(F.lit(0), F.lit(self.epochs - 1))).alias("epoch"))
        d = d.withColumn("at", F.col("start") + F.col("epoch") * F.col("source_size"))
        of = lambda c: F.floor(c / self.block)
        d = d.withColumn("rank", F.explode(F.sequence(of(F.col("at")), of(F.col("at") + F.col("size") - 1))))
        begin = F.greatest(F.col("rank") * self.block - F.col("at"), F.lit(0))
        stop = F.least((F.col("rank") + 1) * self.block - F.col("at"), F.col("size"))
        return d.join(self.slots, ["sid", "rank"]).select("slot", "sid", "start", "epoch", begin.alias("begin"), stop.alias("stop"))

    def taken(self) -> DataFrame:
        """The rows (id, source, text_hash, size, source_size, target) with ``taken``: the words that the mix takes, repeats counted."""
        sums = self.segments().groupBy("sid", "start").agg(F.sum(F.col("stop") - F.col("begin")).alias("taken"))
        filled, empty = self.documents.where("size > 0"), self.documents.where("size = 0")
        keep = ["id", "source", "text_hash", "size", "source_size", "target"]
        out = filled.join(sums, ["sid", "start"], "left").select(*keep, F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
        return out.unionByName(empty.select(*keep, F.lit(0).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them: round(taken / size) times (a document that the last block of
    a source cuts counts if at least half of it is taken). Documents without words are not taken."""
    taken = Mix(docs, id_col, text_col, **options).taken().where("size > 0")
    # rows equal in id and text share their copies evenly: they are interchangeable
    times = taken.groupBy("id", "text_hash").agg(F.sum(F.round(F.col("taken") / F.col("size")).cast("long")).alias("times"), F.count("*").alias("n")).where("times > 0")
    path = scratch_path(docs.sparkSession, "mix-times")
    times.write.parquet(path)
    times = docs.sparkSession.read.parquet(path)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    place = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows = plain.select(F.struct(*plain.columns).alias("row"), F.col(place[id_col]).alias("doc"), F.xxhash64(place[text_col]).alias("h"))

    def of(chosen: DataFrame) -> DataFrame:
        return rows.join(chosen, rows["doc"].eqNullSafe(chosen["id"]) & (rows["h"] == chosen["text_hash"]))

    out = of(times.where("n = 1")).select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    # repeated rows, equal ones counted: the first times mod n of them, by the hash of the row, are taken once more than the others
    again = of(times.where("n > 1")).groupBy("doc", "h", "times", "n", "row").agg(F.count("*").alias("m")).withColumn("order", F.xxhash64("row"))
    again = again.withColumn("piece", F.shiftright("order", 52))
    before = running(again.withColumn("doc", F.struct("doc", "h")), ["doc"], "piece", ["order"], "m", "before")
    more = F.greatest(F.lit(0), F.least(F.col("m"), F.col("times") % F.col("n") - F.col("before")))
    again = before.withColumn("all", (F.floor(F.col("times") / F.col("n")) * F.col("m") + more).cast("long")).where("all > 0")
    both = out.select("row.*").unionByName(numbered(again.select("row", "all"), "all", "copy").select("row.*"))
    return both.toDF(*docs.columns)
