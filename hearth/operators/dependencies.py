"""Which columns determine which others, found rather than asked for.

A set of columns determines another column if rows that agree on the set agree
on that column too; nulls agree with nulls. Sets are tried level by level, one
column, then two, and only minimal dependencies are looked for: a set is left
out if a part of it already determines the column, or the rest of the set.

Each level has two passes over the rows, for all sets of columns at once:

1. A share of the *values* of every set (by hash) is grouped with all of its
   rows. Two rows that agree on the set and differ in a column rule the
   dependency out for certain, and few false ones get past this.
2. What is left is decided over all rows.

A pass counts, for each value of a set, the least and greatest hash of every
other column, so that partial aggregation collapses equal values before the
shuffle and a hot value is one row a task. Values are compared by hash, those of
a set by 128 bits, those of a column by 64.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.session import scratch_path

SAMPLE = 64  # one value of a set in so many is tried first


def _hash(columns: Sequence[str], seed: int) -> Column:
    """A hash that tells a null from every value, and from a null in another place."""
    parts = [x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(F.lit(seed), *parts)


def _determined(df: DataFrame, wanted: dict[tuple[str, ...], list[str]], one_in: int) -> dict[tuple[str, ...], tuple[int, list[str]]]:
    """For each set of ``wanted`` {set: columns}: its number of values, and the columns that no value contradicts.

    With ``one_in`` above 1 only as large a part of each set's values is looked at.
    """
    sets = list(wanted)
    dependents = sorted({c for cs in wanted.values() for c in cs})
    keys = [F.struct(F.lit(i).alias("i"), _hash(s, 1).alias("k1"), _hash(s, 2).alias("k2")) for i, s in enumerate(sets)]
    rows = df.select(F.array(*keys).alias("keys"), *[_hash([c], 3).alias(f"h{j}") for j, c in enumerate(dependents)])
    if one_in > 1:
        rows = rows.withColumn("keys", F.filter("keys", lambda k: F.pmod(k["k1"], F.lit(one_in)) == 0))
    rows = rows.select(F.explode("keys").alias("key"), *[f"h{j}" for j in range(len(dependents))])
    ends = [f(f"h{j}").alias(f"{name}{j}") for j in range(len(dependents)) for f, name in ((F.min, "low"), (F.max, "high"))]
    values = rows.groupBy("key.i", "key.k1", "key.k2").agg(*ends)
    held = [F.min(F.col(f"low{j}") == F.col(f"high{j}")).alias(f"held{j}") for j in range(len(dependents))]
    found = values.groupBy("i").agg(F.count("*").alias("n"), *held).collect()  # one row a set of columns
    place = {c: j for j, c in enumerate(dependents)}
    out = {s: (0, list(cs)) for s, cs in wanted.items()}
    for r in found:
        s = sets[r["i"]]
        out[s] = (r["n"], [c for c in wanted[s] if r[f"held{place[c]}"]])
    return out


def discover_dependencies(df: DataFrame, columns: Sequence[str], most: int = 2, one_in: int = SAMPLE) -> DataFrame:
    """(determinant, dependent, n_values) of the minimal dependencies with up to ``most`` determining columns.

    ``determinant`` names its columns in the order of ``columns``, joined by
    commas; ``n_values`` counts its distinct values. Nulls are values. A
    constant column depends on every other; a column without repeated values
    determines all others. Repeated rows change nothing, an empty table gives
    no rows, and other columns are ignored. Floating-point columns are compared
    bit by bit.
    """
    columns, spark = list(columns), df.sparkSession
    path = scratch_path(spark, "dependencies")
    df.select(*[F.col(f"`{c}`") for c in columns]).write.parquet(path)  # every pass reads these columns, and nothing before them again
    df = spark.read.parquet(path)
    holds: dict[tuple[str, ...], dict[str, int]] = {}

    def implied(s: tuple[str, ...], c: str) -> bool:
        """Whether a proper part of ``s`` determines ``c``."""
        return any(c in holds.get(part, ()) for k in range(1, len(s)) for part in combinations(s, k))

    for level in range(1, most + 1):
        wanted = {}
        for s in combinations(columns, level):
            if any(implied(tuple(x for x in s if x != c), c) or c in holds.get(tuple(x for x in s if x != c), ()) for c in s):
                continue
            rest = [c for c in columns if c not in s and not implied(s, c)]
            if rest:
                wanted[s] = rest
        for step in (one_in, 1):
            if wanted:
                found = _determined(df, wanted, step)
                wanted = {s: cs for s, (_, cs) in found.items() if cs}
        holds |= {s: {c: found[s][0] for c in cs if found[s][0]} for s, cs in wanted.items()}
    rows = [(",".join(s), c, n) for s, cs in holds.items() for c, n in cs.items()]
    return spark.createDataFrame(rows, "determinant string, dependent string, n_values long")
