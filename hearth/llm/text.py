"""Word helpers shared by the operators: bytes of many texts at once, in numpy.

A word is a maximal run of characters other than space and U+0009..U+000D.
Those six are single bytes in UTF-8 and never part of another character, so
words are found on bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words for Spark's split(): the separators of the rule above.
SPACE = r"[\x20\x09-\x0D]+"
BATCH_ROWS = 1000


def once(value: Column) -> Column:
    """``value``, computed once a row: later filters and columns can't copy the expression."""
    return F.explode_outer(F.array(value))


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Texts go to Python in batches of at most ``rows`` from now on: Spark's 10,000 would be a hundred times its usual
    size where texts are long, in the JVM and in Python. A smaller setting of the session stays."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def quoted(name: str) -> str:
    """A column's name for select() and col(), dots and backquotes included."""
    return "`" + name.replace("`", "``") + "`"


def map_batches(rows: DataFrame, run, schema: T.StructType) -> DataFrame:
    """mapInArrow for frames whose column names may hold dots."""
    return rows.toDF(*[f"_{i}" for i in range(len(rows.columns))]).mapInArrow(run, schema)


IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def splitmix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer: spreads every input bit over the result."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


PRIME = (1 << 61) - 1
_P, _LOW = np.uint64(PRIME), np.uint64((1 << 32) - 1)


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo 2^61 - 1."""
    x = (x >> np.uint64(61)) + (x & _P)
    return np.where(x >= _P, x - _P, x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo 2^61 - 1, of numbers below it, in halves that don't pass 64 bits."""
    half, rest = np.uint64(31), np.uint64((1 << 31) - 1)
    a1, a0, b1, b0 = a >> half, a & rest, b >> half, b & rest
    middle = a0 * b1 + a1 * b0
    carried = ((middle & np.uint64((1 << 30) - 1)) << half) + (middle >> np.uint64(30))
    return _reduced(np.uint64(2) * (a1 * b1) + carried + a0 * b0)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(max(n, 1), dtype=np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = _times(out[:more], np.uint64(pow(base, done, PRIME)))
        done += more
    return out


class Rolling:
    """Polynomial hashes modulo the prime 2^61 - 1 of any slice of a sequence, from its prefix sums.

    ``slices(values, starts, ends)`` is sum(values[i] * base^(i - start)). A
    power of two as the modulus would let unlike long slices (Thue-Morse words)
    collide under every base. Terms are summed in two halves of at most 40
    bits, so that slices of up to 2^24 values are exact.
    """

    def __init__(self, base: int):
        self.base = base % PRIME
        self.inverse = pow(self.base, -1, PRIME)
        self.up = self.down = np.ones(0, dtype=np.uint64)

    def slices(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(values)
        if n > len(self.up):
            self.up, self.down = _powers(self.base, n), _powers(self.inverse, n)
        up = self.up[:n]
        if values.dtype == np.uint8:  # bytes, as 1 to 256: the halves of the power are multiplied
            values = values.astype(np.uint64) + np.uint64(1)
            low, high = (up & _LOW) * values, (up >> np.uint64(32)) * values
        else:
            terms = _times(_reduced(values), up)
            low, high = terms & _LOW, terms >> np.uint64(32)
        sums = []
        for half in (low, high):
            total = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(half, out=total[1:])
            sums.append(_reduced(total[ends] - total[starts]))
        # 2^32 times a number of 61 bits turns it by 32 places
        turned = ((sums[1] << np.uint64(32)) | (sums[1] >> np.uint64(29))) & _P
        return _times(_reduced(sums[0] + turned), self.down[starts])


_BYTES = Rolling(0xD1342543DE82EF95)
LONG_WORD = 1 << 20  # bytes; longer words are hashed one by one


class Words:
    """The words of consecutive texts: ``data`` bytes, ``starts``/``ends`` in it,
    ``first[d] .. first[d+1]`` are the words of text d."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        n = len(data)
        word = ~IS_SPACE[data]
        begins, stops = word.copy(), np.zeros(n + 1, dtype=bool)
        begins[1:] &= ~word[:-1]
        stops[1:n] = word[:-1] & ~word[1:]
        if n:
            stops[n] = word[-1]
        edges = np.unique(offsets[(offsets > 0) & (offsets < n)])
        begins[edges] |= word[edges]
        stops[edges] |= word[edges - 1]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(stops)
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        size = self.ends - self.starts
        h = splitmix(_BYTES.slices(self.data, self.starts, self.ends) + size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        for i in np.flatnonzero(size > LONG_WORD).tolist():
            digest = blake2b(self.data[self.starts[i] : self.ends[i]].tobytes(), digest_size=8).digest()
            h[i] = int.from_bytes(digest, "little")
        return h

    def text_of(self) -> np.ndarray:
        """The number of each word's text."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.first))


def chunks(column: pa.Array, limit: int = 1 << 19) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Pieces (first row, last row, bytes, offsets) of a string column, of whole
    texts and about ``limit`` bytes each; null texts are empty."""
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield row, last, data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All characters one after the other, and where texts begin and end."""
    chars = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    return chars, np.cumsum([0, *map(len, texts)])


def utf8_lengths(chars: np.ndarray) -> np.ndarray:
    """The bytes of each character."""
    return 1 + (chars > 0x7F).astype(np.int8) + (chars > 0x7FF) + (chars > 0xFFFF)


def ranges(begins: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin .. begin + size - 1 for each entry, one after the other."""
    ends = np.cumsum(size)
    return np.repeat(begins - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def blocks(batches: Iterator[pa.RecordBatch], at: int, limit: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches in groups of about ``limit`` bytes of text."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(at).nbytes
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held
