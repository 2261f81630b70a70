"""Repeated passages: Rabin-Karp hashes of every window of words, counted over the corpus.

1. Documents are dealt into groups by a hash of id and text. Each group hashes
   every window of its texts, drops what it holds twice, and sends the sorted
   hashes, packed, to buckets chosen by a second, independent hash.
2. Each bucket counts: a hash that came from two groups or more is repeated,
   and goes back to the groups that sent it.
3. Each group marks the windows that were repeated there or elsewhere, merges
   them into maximal intervals of words, and cuts those out.

A window is packed into 8 bytes, and a passage that occurs in very many
documents arrives in a bucket at most once from each group. Two different
windows count as one only if 64 bits and the bucket agree by chance; words and
windows are hashed modulo a prime. Groups and buckets hold about
``GROUP_BYTES`` of text each, whatever the input.

Rows equal in id and text would all fall into one group. They are found first,
by their hashes: one of each goes into the groups, for others' windows, and the
rows themselves are cut without one, as a copy repeats every window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.text import SPACE, Rolling, Words, chunks, quoted, splitmix
from hearth.session import scratch_path

GROUP_BYTES = 16 << 20
_FIRST, _SECOND = Rolling(0xA0761D6478BD642F), Rolling(0xE7037ED1A0B428DB)


def window_starts(w: Words, window: int) -> np.ndarray:
    """The words at which a whole window of one text starts."""
    starts = np.arange(max(0, len(w) - window + 1))
    text = w.text_of()
    return starts[text[starts] == text[starts + window - 1]]


def _hashes(words: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    return splitmix(_FIRST.slices(words, starts, starts + window))


def _distinct(texts: pa.Array, window: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, hash) of the distinct windows of a group, sorted."""
    hashes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
    for _, _, data, offsets in chunks(texts):
        w = Words(data, offsets)
        starts, words = window_starts(w, window), w.hashes()
        hashes.append(_hashes(words, starts, window))
        places.append((splitmix(_SECOND.slices(words, starts, starts + window)) % np.uint64(buckets)).astype(np.int32))
    h, b = np.concatenate(hashes), np.concatenate(places)
    order = np.lexsort((h, b))
    h, b = h[order], b[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (b[1:] != b[:-1])
    return b[new], h[new]


def _binaries(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Slices of an array of 8-byte values as one binary each."""
    data = pa.py_buffer(np.ascontiguousarray(values).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer((edges * 8).astype(np.int32).tobytes()), data])


def _values(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype=np.uint64) for x in column.to_pylist()]


def repeated_words(w: Words, repeated: np.ndarray, window: int) -> np.ndarray:
    """For each word whether a window of the sorted hashes ``repeated`` covers it."""
    edge = np.zeros(len(w) + 1, dtype=np.int64)
    starts = window_starts(w, window)
    if len(starts) and len(repeated):
        h = _hashes(w.hashes(), starts, window)
        at = np.minimum(np.searchsorted(repeated, h), len(repeated) - 1)
        starts = starts[repeated[at] == h]
        edge[starts] += 1
        edge[starts + window] -= 1
    return np.cumsum(edge[:-1]) > 0


def _own_repeats(texts: pa.Array, window: int) -> np.ndarray:
    """The hashes that a group of texts holds twice or more."""
    found = [np.zeros(0, np.uint64)]
    for _, _, data, offsets in chunks(texts):
        w = Words(data, offsets)
        found.append(_hashes(w.hashes(), window_starts(w, window), window))
    h = np.sort(np.concatenate(found))
    return np.unique(h[1:][h[1:] == h[:-1]])


def _intervals(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of true."""
    change = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def _cut(texts: pa.Array, repeated: np.ndarray, window: int) -> list[tuple[int, int, list, str]]:
    """(words, removed words, intervals, kept text) of each text."""
    out = []
    for _, _, data, offsets in chunks(texts):
        w = Words(data, offsets)
        flags, raw = repeated_words(w, repeated, window), data.tobytes()
        for d in range(len(offsets) - 1):
            a, b = int(w.first[d]), int(w.first[d + 1])
            begins, ends = _intervals(flags[a:b])
            kept, at = [], 0
            for x, y in [*zip(begins.tolist(), ends.tolist(), strict=True), (b - a, b - a)]:
                if at < x:
                    kept += raw[w.starts[a + at] : w.ends[a + x - 1]].split()
                at = y
            spans = [{"begin": x, "stop": y} for x, y in zip(begins.tolist(), ends.tolist(), strict=True)]
            out.append((b - a, int((ends - begins).sum()), spans, b" ".join(kept).decode()))
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35) -> DataFrame:
    """(id, text_hash, n_words, n_removed, removed array<struct<begin, stop>>, kept) of each row.

    A word goes if it stands in a window of ``window`` words that occurs
    anywhere else, in the same text too; ``removed`` are the maximal intervals
    of such words, and ``kept`` the other words, joined by one space. Windows
    are judged on the texts as they come in. Null texts are empty; texts
    shorter than a window stay whole; null ids are rows like others; repeated
    rows repeat each other's windows; other columns are ignored; an empty
    table gives no rows. Texts of any length are cut whole, in one task each.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(size) // GROUP_BYTES))
    groups = 2 * buckets
    path = scratch_path(spark, "equal-rows")
    twice = rows.groupBy("id", "text_hash").agg(F.count("*").alias("n")).where("n > 1")
    twice.select(F.col("id").alias("id_b"), F.col("text_hash").alias("hash_b")).write.parquet(path)
    equal = spark.read.parquet(path)
    same = F.col("id").eqNullSafe(F.col("id_b")) & (F.col("text_hash") == F.col("hash_b"))
    copies = rows.join(equal, same, "left_semi")
    one = copies.groupBy("id", "text_hash").agg(F.max("text").alias("text")).select("id", "text", "text_hash", F.lit(False).alias("single"))
    laid = rows.join(equal, same, "left_anti").withColumn("single", F.lit(True)).unionByName(one)
    laid = laid.withColumn("part", F.pmod(F.xxhash64("id", "text_hash"), F.lit(groups)).cast("int")).repartition(buckets, "part")

    def send(table: pa.Table) -> pa.Table:
        bucket, h = _distinct(table["text"].combine_chunks(), window, buckets)
        there, first = np.unique(bucket, return_index=True)
        part = pa.array(np.full(len(there), table["part"][0].as_py(), dtype=np.int32))
        return pa.table([pa.array(there.astype(np.int32)), part, _binaries(h, np.append(first, len(h)))], names=["bucket", "part", "hashes"])

    def count(table: pa.Table) -> pa.Table:
        packed = _values(table["hashes"])
        edges = np.cumsum([0, *map(len, packed)])
        h = np.concatenate(packed)
        order = np.argsort(h)
        same = h[order][1:] == h[order][:-1]
        twice = np.zeros(len(h), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        total = np.concatenate([[0], np.cumsum(twice)])[edges]
        out = pa.table([table["part"].combine_chunks(), _binaries(h[twice], total)], names=["part", "hashes"])
        return out.filter(pa.array(np.diff(total) > 0))

    kind = docs.schema[id_col].dataType.simpleString()
    result = f"id {kind}, text_hash long, n_words long, n_removed long, removed array<struct<begin:int,stop:int>>, kept string"
    arrow = pa.list_(pa.struct([("begin", pa.int32()), ("stop", pa.int32())]))

    def cut(table: pa.Table, found: pa.Table) -> pa.Table:
        single, texts = table["single"], table["text"].combine_chunks()
        there = np.unique(np.concatenate([_own_repeats(texts, window), *_values(found["hashes"])]))
        table = table.filter(single)
        done = _cut(table["text"].combine_chunks(), there, window)
        columns = [
            table["id"].combine_chunks(),
            table["text_hash"].combine_chunks(),
            pa.array([x[0] for x in done], pa.int64()),
            pa.array([x[1] for x in done], pa.int64()),
            pa.array([x[2] for x in done], arrow),
            pa.array([x[3] for x in done], pa.string()),
        ]
        return pa.table(columns, names=["id", "text_hash", "n_words", "n_removed", "removed", "kept"])

    sent = laid.groupBy("part").applyInArrow(send, "bucket int, part int, hashes binary")
    found = sent.groupBy("bucket").applyInArrow(count, "part int, hashes binary")
    out = laid.groupBy("part").cogroup(found.groupBy("part")).applyInArrow(cut, result)
    words = F.filter(F.split("text", SPACE), lambda w: w != "")
    copies = copies.select("id", "text_hash", F.coalesce(words, F.array().cast("array<string>")).alias("words"))
    n, whole = F.size("words"), F.size("words") >= window
    span = F.struct(F.lit(0).alias("begin"), n.alias("stop"))
    none = F.array().cast("array<struct<begin:int,stop:int>>")
    cut_whole = [F.when(whole, n).otherwise(0).cast("long").alias("n_removed"), F.when(whole, F.array(span)).otherwise(none).alias("removed")]
    kept = F.when(whole, "").otherwise(F.array_join("words", " ")).alias("kept")
    return out.unionByName(copies.select("id", "text_hash", n.cast("long").alias("n_words"), *cut_whole, kept))
