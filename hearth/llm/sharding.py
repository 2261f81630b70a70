"""Sharding by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a table of prime
size: from an offset on, in steps of a skip, both hashed from its name. The
shards take turns, and each claims the first slot of its order that is still
free, until the table is full. A key belongs to the shard of slot hash(key)
mod size. Shards hold nearly equal parts of the table, and adding or removing
a shard moves few other keys.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TABLE_SIZE = 65537


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill(shards: list[str], size: int = TABLE_SIZE) -> np.ndarray:
    """The shard number of each slot. ``size`` is a prime of at least the number of shards."""
    if not _is_prime(size) or not 0 < len(shards) <= size or len(set(shards)) < len(shards):
        raise ValueError("the table size must be a prime, with at least a slot for each of the distinct shards")
    offset = [xxhash.xxh64_intdigest(s, 1) % size for s in shards]
    skip = [xxhash.xxh64_intdigest(s, 2) % (size - 1) + 1 for s in shards]
    table, at, free = np.full(size, -1, dtype=np.int32), list(offset), size
    while True:
        for i in range(len(shards)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % size
            table[at[i]] = i
            free -= 1
            if not free:
                return table


def place(rows: DataFrame, key_cols: list[str], shards: list[str], size: int = TABLE_SIZE, out_col: str = "shard") -> DataFrame:
    """``rows`` with ``out_col``: the name of the shard of each row's key.

    The table has ``size`` rows whatever the input, and is broadcast: one
    lookup a row, and no shuffle. Null keys hash like other values; equal keys
    and repeated rows meet in one shard; an existing ``out_col`` is replaced;
    other columns stay; an empty table gives no rows.
    """
    table = rows.sparkSession.createDataFrame([(slot, shards[i]) for slot, i in enumerate(fill(shards, size).tolist())], "slot long, shard string")
    kept = [c for c in rows.columns if c != out_col]
    keyed = rows.select(F.struct(*kept).alias("row"), F.pmod(F.xxhash64(*key_cols), F.lit(size).cast("long")).alias("slot"))
    return keyed.join(F.broadcast(table), "slot").select("row.*", F.col("shard").alias(out_col))
