"""Phrase collocations by a sample's proposal, exact counts and expansion passes.

A phrase of k words can be frequent only if the two phrases of k-1 words in it
are. A sample of the rows proposes frequent words and word pairs. One pass
over all texts then counts exactly every phrase that the proposal lets
through: all words, the pairs of two proposed words, the triples of two
proposed pairs. These are the proposed phrases and their negative border. Where
the border turns out to hold a frequent phrase, the proposal was too small:
what the exact counts found joins it, a further pass counts the phrases that
are let through only now, and so on until no count adds anything.

Proposals travel as bit tables of fixed size, indexed by a hash of the phrase.
Two phrases under one bit can only cause a phrase to be counted that needs no
count: phrases themselves are the keys of all counts, so results are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.text import IS_SPACE, quoted, small_batches, splitmix
from hearth.session import scratch_path

# Bits of a proposal's table (8 MB), and bits of one bitmap of Spark's bitmap functions.
TABLE_BITS, BITMAP_BITS = 26, 15
BLOCK_BYTES, ROWS_OUT = 8 << 20, 1 << 16
UPPER, ENDS = bytes(range(65, 91)), b".,;:!?\n\x0b\x0c\r"
# A-Z to a-z, ends of pieces to line feeds, tabs to spaces: single bytes in UTF-8, never part of another character.
_PLAIN = bytes.maketrans(UPPER + ENDS + b"\t", UPPER.lower() + b"\n" * len(ENDS) + b" ")
COUNTS = "lang string, size int, phrase string, n long"


class Table:
    """A set of phrase hashes, held as bits."""

    def __init__(self, bits: np.ndarray | None = None):
        self.bits = np.zeros(1 << TABLE_BITS >> 3, np.uint8) if bits is None else bits

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes >> np.uint64(64 - TABLE_BITS)
        return (self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0

    def __or__(self, other: Table) -> Table:
        return Table(self.bits | other.bits)


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode(), 42)
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return splitmix(first * np.uint64(0x9E3779B97F4A7C15) + second)


class Block:
    """The words of some texts of one language: ``codes`` into ``words``; ``joined[i]``: word i+1 is in i's piece."""

    def __init__(self, lang: str, texts: list[str]):
        raw = np.frombuffer("\n".join(texts).encode().translate(_PLAIN), np.uint8)
        word = np.concatenate([[False], ~IS_SPACE[raw], [False]])
        begins, ends = np.flatnonzero(word[1:] & ~word[:-1]), np.flatnonzero(word[:-1] & ~word[1:])
        offsets = np.concatenate([[0], np.cumsum(ends - begins)])
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(raw[word[1:-1]])])
        coded = words.dictionary_encode()
        self.lang, self.words = lang, coded.dictionary
        self.codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        piece = np.cumsum(raw == 10, dtype=np.int32)[begins]
        self.joined = piece[1:] == piece[:-1]

    def let_through(self, proposal: tuple[Table, Table] | None, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flags of the pairs and triples (by their first word) that are to be counted."""
        first, second = self.codes[:-1], self.codes[1:]
        if proposal is None:
            return self.joined, self.joined[:-1] & self.joined[1:]
        known = proposal[0].holds(hashes)
        pairs = self.joined & known[first] & known[second]
        known = self.joined.copy()
        at = np.flatnonzero(known)
        known[at] = proposal[1].holds(pair_hashes(hashes[first[at]], hashes[second[at]]))
        return pairs, known[:-1] & known[1:]

    def counts(self, proposal: tuple[Table, Table] | None, counted: tuple[Table, Table] | None) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
        """(size, phrases, counts) of what ``proposal`` lets through (None: all) and ``counted`` did not."""
        n = len(self.words)
        if counted is None:
            yield 0, pa.array([b""], pa.large_binary()), np.array([len(self.codes)])
            yield 1, self.words, np.bincount(self.codes, minlength=n)
        if len(self.codes) < 2:
            return
        hashes = np.zeros(n, np.uint64) if proposal is None else word_hashes(self.lang, self.words.to_pylist())
        pairs, triples = self.let_through(proposal, hashes)
        if counted is not None:
            before = self.let_through(counted, hashes)
            pairs, triples = pairs & ~before[0], triples & ~before[1]
        at = np.flatnonzero(pairs)
        keys, found = np.unique(self.codes[at] * n + self.codes[at + 1], return_counts=True)
        yield 2, self._phrases(keys // n, keys % n), found
        at = np.flatnonzero(triples)
        pair, number = np.unique(self.codes[at] * n + self.codes[at + 1], return_inverse=True)
        keys, found = np.unique(number * n + self.codes[at + 2], return_counts=True)
        pair = pair[keys // n]
        yield 3, self._phrases(pair // n, pair % n, keys % n), found

    def _phrases(self, *codes: np.ndarray) -> pa.Array:
        return pc.binary_join_element_wise(*[self.words.take(pa.array(c)) for c in codes], pa.scalar(b" ", pa.large_binary()))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str]]]:
    """(language, texts) of about BLOCK_BYTES, or one longer text."""
    held: dict[str, list[str]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if text:
                held.setdefault(lang, []).append(text)
                size += len(text)
        if size >= BLOCK_BYTES:
            yield from held.items()
            held, size = {}, 0
    yield from held.items()


def _counted(rows: DataFrame, proposal=None, counted=None) -> DataFrame:
    """COUNTS of (lang, text) rows: partial counts of each block, summed."""
    sc = rows.sparkSession.sparkContext
    sent = sc.broadcast((proposal, counted))

    def run(batches):
        names = ["lang", "size", "phrase", "n"]
        for lang, texts in _blocks(batches):
            for size, phrases, n in Block(lang, texts).counts(*sent.value):
                text = phrases.cast(pa.string())
                for i in range(0, len(n), ROWS_OUT):
                    part = text[i : i + ROWS_OUT]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part)), pa.array(np.full(len(part), size, np.int32)), part, pa.array(n[i : i + ROWS_OUT])], names)

    return rows.mapInArrow(run, COUNTS).groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))


def _tables(frequent: DataFrame) -> tuple[Table, Table]:
    """The bit tables of the words and pairs of (lang, size, phrase): at most 8 MB each come to the driver."""

    def hashed(batches):
        for batch in batches:
            lang, size, phrase = (batch.column(i).to_pylist() for i in range(3))
            place = []
            for a, k, p in zip(lang, size, phrase, strict=True):
                h = word_hashes(a, p.encode().split(b" "))
                place.append(int(h[0] if k == 1 else pair_hashes(h[:1], h[1:])[0]) >> (64 - TABLE_BITS))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([x >> BITMAP_BITS for x in place], pa.int32()), pa.array([x & ((1 << BITMAP_BITS) - 1) for x in place], pa.int64())], ["size", "bitmap", "place"])

    rows = frequent.where("size in (1, 2)").select("lang", "size", "phrase").mapInArrow(hashed, "size int, bitmap int, place long")
    out = Table(), Table()
    for r in rows.groupBy("size", "bitmap").agg(F.bitmap_construct_agg("place").alias("bits")).collect():
        width = 1 << BITMAP_BITS >> 3
        out[r["size"] - 1].bits[r["bitmap"] * width : (r["bitmap"] + 1) * width] = np.frombuffer(r["bits"], np.uint8)
    return out


def _failed(frequent: DataFrame, proposal: tuple[Table, Table], found: tuple[Table, Table]) -> bool:
    """Whether the exact counts found a frequent word or pair outside the proposal."""
    return any(bool((f.bits & ~p.bits).any()) for f, p in zip(found, proposal, strict=True))


def count_phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 10, share: float = 0.1, sample_least: int = 2) -> tuple[DataFrame, int]:
    """((lang, size, phrase, n) of all phrases of one to three words found at least ``least`` times, passes over all rows).

    Size 0 is the number of all words of a language. ``share`` of the rows
    make the proposal, from phrases found ``sample_least`` times in them: both
    change the number of passes and counted phrases, never the result. Null
    languages are ``und``, null and empty texts have no words, copies and
    repeated rows count each; an empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.coalesce(F.col(quoted(lang_col)), F.lit("und")).alias("lang"), F.col(quoted(text_col)).alias("text"))
    path = scratch_path(spark, "phrases")
    sampled = _counted(rows.sample(share, 7)).where(F.col("size").between(1, 2) & (F.col("n") >= sample_least))
    proposal, counted, passes = _tables(sampled), None, 0
    while True:
        kept = _counted(rows, proposal, counted).where((F.col("n") >= least) | (F.col("size") == 0))
        kept.write.parquet(f"{path}/pass={passes}")
        passes += 1
        frequent = spark.read.schema(COUNTS).parquet(*[f"{path}/pass={i}" for i in range(passes)])
        found = _tables(frequent)
        if not _failed(frequent, proposal, found):
            return frequent, passes
        counted = proposal
        proposal = proposal[0] | found[0], proposal[1] | found[1]


def _cuts() -> Column:
    """Each way to cut ``words``: (k, first, rest)."""
    return F.transform(
        F.sequence(F.lit(1), F.size("words") - 1),
        lambda k: F.struct(
            k.alias("k"),
            F.array_join(F.slice("words", F.lit(1), k), " ").alias("first"),
            F.array_join(F.slice("words", k + 1, F.size("words")), " ").alias("rest"),
        ),
    )


def mine(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 10, top: int = 2000, inside: int = 50, **sampling) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's ``top`` collocations.

    A candidate is a phrase of two or three words found ``a`` >= ``least``
    times within pieces; the lowest score of its cuts counts (ties: fewest
    first words). Candidates of which ``inside`` % or more occurrences' worth
    lie in a longer candidate go. Order: score and a descending, then phrase
    by its bytes. Nulls and empty tables are as in ``count_phrases``; other
    columns are ignored.
    """
    frequent, _ = count_phrases(docs, lang_col, text_col, least, **sampling)
    counts = frequent.where("size > 0")
    candidates = counts.where("size > 1").select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))
    cut = candidates.select("lang", "phrase", "a", F.explode(_cuts()).alias("cut")).select("lang", "phrase", "a", "cut.*")
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    scored = (
        cut.join(left, ["lang", "first"])
        .join(right, ["lang", "rest"])
        .withColumn("over", F.lit(1_000_000).cast("decimal(7,0)") * (wide("a") * wide("a")).cast("decimal(31,0)"))
        .withColumn("under", (wide("l") * wide("r")).cast("decimal(38,0)"))
        .withColumn("score", F.expr("over div under"))
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
        .select("lang", "phrase", "a", "best.score", "best.l", "best.r")
    )
    longer = (
        candidates.where(F.size("words") == 3)
        .select("lang", F.col("a").alias("of"), F.explode(F.array(F.array_join(F.slice("words", 1, 2), " "), F.array_join(F.slice("words", 2, 2), " "))).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("of").alias("of"))
    )
    kept = scored.join(longer, ["lang", "phrase"], "left").where(F.col("of").isNull() | (100 * F.col("of") < inside * F.col("a")))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # each part of a language sends its own best, so that no task reads all candidates of a language
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    best = kept.withColumn("place", F.row_number().over(part)).where(F.col("place") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    words = frequent.where("size = 0").select("lang", F.col("n"))
    return best.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
