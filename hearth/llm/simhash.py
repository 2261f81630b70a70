"""SimHash near-duplicates by anchor points of a covering code.

A fingerprint is cut into bits 0-22, 23-45 and 46-63. The first two parts use
the binary Golay code of length 23, a perfect code: every 23-bit word lies
within distance 3 (the covering radius) of exactly one code word, its anchor.
Every fingerprint x stands at the pair of its two anchors. If y differs from x
in at most t bits, i of them in the first part and j in the second, then y is
within 3 + i and 3 + j of x's anchors; so y is copied to every pair of code
words within 3 + i and 3 + j for some i + j <= t. Fingerprints are compared
per anchor pair, those that stand there against the copies, on all 64 bits.
There are 2^24 anchor pairs, and about 61 copies of a fingerprint for t = 2.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.components import components
from hearth.llm.text import Words, chunks, small_batches
from hearth.session import scratch_path

# Generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 of the Golay code (fixed value).
GOLAY = 0b101011100011
LENGTH, RADIUS = 23, 3


def _remainders(length: int = LENGTH) -> np.ndarray:
    """x^i modulo the generator, for each bit i."""
    out, r = [], 1
    for _ in range(length):
        out.append(r)
        r <<= 1
        if r >> 11:
            r ^= GOLAY
    return np.array(out, dtype=np.int64)


def _byte_tables() -> list[np.ndarray]:
    """Syndromes of the low, middle and high byte of a word."""
    rem = _remainders()
    tables = []
    for low in (0, 8, 16):
        t = np.zeros(256, dtype=np.int64)
        for bit in range(low, min(low + 8, LENGTH)):
            t[(np.arange(256) >> (bit - low)) & 1 == 1] ^= rem[bit]
        tables.append(t)
    return tables


def cosets(max_weight: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The error patterns up to ``max_weight`` of each syndrome s, lightest first:
    ``patterns[first[s] : first[s + 1]]``, with their weights."""
    rem = _remainders()
    syndromes, patterns, weights = [], [], []
    for w in range(max_weight + 1):
        flipped = list(combinations(range(LENGTH), w))
        picked = np.array(flipped, dtype=np.int64).reshape(len(flipped), w)
        patterns.append((1 << picked).sum(axis=1))
        syndromes.append(np.bitwise_xor.reduce(rem[picked], axis=1))
        weights.append(np.full(len(picked), w))
    s, p, w = map(np.concatenate, (syndromes, patterns, weights))
    order = np.lexsort((w, s))
    return p[order], w[order], np.searchsorted(s[order], np.arange(2049))


class Anchors:
    """Anchor pairs of fingerprints for at most ``max_bits`` differing bits."""

    def __init__(self, max_bits: int):
        self.max_bits = max_bits
        self.tables = _byte_tables()
        self.patterns, self.weights, self.first = cosets(RADIUS + max_bits)

    def syndrome(self, word: np.ndarray) -> np.ndarray:
        a, b, c = self.tables
        return a[word & 255] ^ b[(word >> 8) & 255] ^ c[word >> 16]

    def parts(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mask = (1 << LENGTH) - 1
        return fp & mask, (fp >> LENGTH) & mask

    def home(self, fp: np.ndarray) -> np.ndarray:
        """The anchor pair at which each fingerprint stands."""
        a, b = self.parts(fp)
        a ^= self.patterns[self.first[self.syndrome(a)]]
        b ^= self.patterns[self.first[self.syndrome(b)]]
        return (a << LENGTH) | b

    def near(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the fingerprint, anchor pair) for all its copies."""
        a, b = self.parts(fp)
        sa, sb = self.syndrome(a), self.syndrome(b)
        na, nb = self.first[sa + 1] - self.first[sa], self.first[sb + 1] - self.first[sb]
        # every code word near a, then beside each every code word near b
        ia = np.repeat(np.arange(len(fp)), na)
        ka = np.arange(len(ia)) - np.repeat(np.cumsum(na) - na, na) + self.first[sa][ia]
        ib = np.repeat(np.arange(len(ia)), nb[ia])
        kb = np.arange(len(ib)) - np.repeat(np.cumsum(nb[ia]) - nb[ia], nb[ia]) + self.first[sb][ia][ib]
        over = lambda k: np.maximum(self.weights[k] - RADIUS, 0)
        keep = over(ka)[ib] + over(kb) <= self.max_bits
        ib, kb = ib[keep], kb[keep]
        i = ia[ib]
        return i, ((a[i] ^ self.patterns[ka[ib]]) << LENGTH) | (b[i] ^ self.patterns[kb])


_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint_texts(column: pa.Array, shingle: int) -> np.ndarray:
    """SimHash of each text: a bit is 1 if it is set in over half the XXH64 (seed 42) of the shingles."""
    out = np.zeros(len(column), dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    for row, last, data, offsets in chunks(column):
        w = Words(data, offsets)
        lowered = data.tobytes().translate(_LOWER)
        for d in range(last - row):
            a, b = int(w.first[d]), int(w.first[d + 1])
            if a == b:
                continue
            starts, ends = w.starts[a:b], w.ends[a:b]
            # one space between words
            text = b" ".join([lowered[x:y] for x, y in zip(starts.tolist(), ends.tolist(), strict=True)])
            stops = np.cumsum(ends - starts) + np.arange(b - a)
            begins = stops - (ends - starts)
            k = min(shingle, b - a)
            h = np.array(
                [digest(text[x:y], 42) for x, y in zip(begins[: b - a - k + 1].tolist(), stops[k - 1 :].tolist(), strict=True)],
                dtype=np.uint64,
            )
            out[row + d] = majority(h)
    return out


def majority(h: np.ndarray) -> np.uint64:
    """The bits that over half the values have."""
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), 1 << 14):
        bits = np.unpackbits(h[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, text_hash long, fp long) of each row."""
    small_batches(docs.sparkSession)
    kind = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))

    def of(batches):
        for batch in batches:
            fp = fingerprint_texts(batch.column(2), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp)], ["id", "text_hash", "fp"])

    return kind.mapInArrow(of, f"id {docs.schema[id_col].dataType.simpleString()}, text_hash long, fp long")


def links(distinct: DataFrame, max_bits: int = 2) -> DataFrame:
    """Pairs a < b of the distinct fingerprints ``fp`` at 1..max_bits differing bits."""
    code = Anchors(max_bits)

    def home(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(code.home(fp)), batch.column(0)], ["anchor", "a"])

    def near(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                fp = batch.column(0).slice(i, 2048).to_numpy()
                k, anchor = code.near(fp)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(fp[k])], ["anchor", "b"])

    fp = distinct.select("fp")
    here = fp.mapInArrow(home, "anchor long, a long")
    copies = fp.mapInArrow(near, "anchor long, b long")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return here.hint("merge").join(copies, (here.anchor == copies.anchor) & (F.col("a") < F.col("b")) & close).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """Fingerprint and component of each row: (id, text_hash, fp long, component, group long).

    ``component`` is the smallest id reachable over fingerprints that differ in
    at most ``max_bits`` bits; ``group`` is the smallest such fingerprint. One row
    per input row; other columns are ignored.
    Texts that are null, empty or have no word get fingerprint zero, which is
    linked like any other. Null ids are rows like others, but no component is
    named by a null unless it has no other id. Equal texts (and repeated rows)
    share a fingerprint, and are compared once. An empty table gives no rows.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "simhash")
    fingerprints(docs, id_col, text_col, shingle).write.parquet(f"{path}/fps")
    fps = spark.read.parquet(f"{path}/fps")
    fps.groupBy("fp").agg(F.min("id").alias("least")).write.parquet(f"{path}/distinct")
    distinct = spark.read.parquet(f"{path}/distinct")
    links(distinct, max_bits).write.parquet(f"{path}/links")
    members = components(spark.read.parquet(f"{path}/links"))
    # the smallest id of each component, for every fingerprint
    named = distinct.join(members, distinct.fp == members.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("group"))
    least = named.groupBy("group").agg(F.min("least").alias("component"))
    named = named.join(least, "group").select("fp", "component", "group")
    return fps.join(named, "fp").select("id", "text_hash", "fp", "component", "group")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``docs`` with one of each component: that with the smallest id (null last), then the
    smallest hash of its text. Of rows equal in id and text any one stays."""
    found = near_duplicates(docs, id_col, text_col, shingle, max_bits)
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "simhash-keep")
    order = F.struct(F.col("id").isNull().alias("last"), "id", "text_hash", "n")
    found.groupBy("group", "id", "text_hash").agg(F.count("*").alias("n")).groupBy("group").agg(F.min(order).alias("best")).select("best.*").write.parquet(path)
    best = spark.read.parquet(path)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("h"))

    def of(chosen: DataFrame) -> DataFrame:
        return rows.join(chosen, rows["doc"].eqNullSafe(chosen["id"]) & (rows["h"] == chosen["text_hash"])).select("row", "doc", "h")

    again = of(best.where("n > 1")).dropDuplicates(["doc", "h"])
    return of(best.where("n = 1")).unionByName(again).select("row.*")
