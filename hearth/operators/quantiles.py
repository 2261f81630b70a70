"""Exact quantiles: bracketed by sketches, or selected from a value histogram.

``bracketed`` needs no histogram of the data and no shuffle of its rows. One
aggregate builds a mergeable quantile sketch of each column; its error bound
gives two values between which each wanted rank must lie. A second aggregate
counts the rows below, at the ends of and inside each bracket exactly, which
proves that the rank is there, and only the values between its ends are counted
one by one. A bracket
that still holds too many values is sketched again, a few thousand times
narrower each time.

The other functions work on a (group, value) histogram that profiles share.

Spark's exact ``percentile`` keeps every distinct value of a group in one
task's map. That is fine for small-domain columns and wrong for a measure
with billions of distinct values. Here the work is:

1. one aggregation ``(group, value) -> n`` (partial aggregation map-side, so
   a hot value is one row after the shuffle), persisted;
2. per group the total and range (one row per group);
3. for every wanted rank, repeated narrowing: count the histogram inside the
   current interval per equal-width bucket (one aggregation over the
   histogram for all groups and ranks at once; the driver receives at most
   ``buckets`` rows per rank), keep the bucket that holds the rank;
4. once an interval holds at most ``final_values`` (10k) distinct values,
   those (value, n) rows are read and the rank is resolved exactly.

Groups with at most 10k distinct values skip the rounds: Spark's own
``percentile`` with the histogram counts as frequencies resolves them on an
executor with a map of bounded size.

The interpolation is Spark's own: position ``(N - 1) * p`` between the values
at ranks ``floor`` and ``ceil``. Everything the driver sees is bounded by
``buckets`` and ``final_values`` per rank, whatever the data size.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ROUNDS = 64
# Rank error of a sketch: 1 / ACCURACY of the rows.
ACCURACY = 10_000
# Ends of brackets counted by one aggregate.
ENDS_A_PASS = 20
# Distinct values up to which Spark's percentile map (one task per group, on
# an executor) is used directly.
PERCENTILE_MAX_DISTINCT = 10_000
# Distinct values of a narrowed interval the driver reads to finish a rank.
DRIVER_MAX_VALUES = 10_000


@dataclass
class Summary:
    """A column's non-null values (NaN is the greatest, as Spark sorts); ``std`` None below two values."""

    count: int
    mean: float
    std: float | None
    least: float
    greatest: float
    quantiles: list


@dataclass
class _Bracket:
    """The finite values ``lo`` .. ``hi`` hold the ranks ``first`` and ``second`` of the finite values."""

    column: str
    first: int
    second: int
    lo: float
    hi: float
    counts: dict | None = None  # value -> rows, once counted
    below: int = 0

    def value(self, rank: int) -> float:
        at = self.below
        for v in sorted(self.counts):
            at += self.counts[v]
            if rank < at:
                return v
        raise ValueError(f"rank {rank} is outside the bracket of {self.column!r}")


def bracketed(df: DataFrame, columns: dict[str, Column], probs=(), accuracy: int = ACCURACY, final_values: int = DRIVER_MAX_VALUES,
              cache: bool = True) -> dict[str, Summary]:
    """{name: Summary} of numeric expressions over ``df``, exact; columns without a value are left out.

    The expressions are computed once and kept (memory, then disk) for the
    passes; ``cache=False`` where ``df`` is a written table, to reread it.
    They are read once for the sketches, once for each ``ENDS_A_PASS`` ends of
    brackets, and, where values lie between the ends, once for those (each narrowing of a bracket that holds
    more than ``final_values`` between its ends reads it once more). The
    driver gets one row a pass and at most ``final_values`` values a bracket.
    """
    if accuracy < 20 or final_values < 4:
        raise ValueError("an accuracy below 20 or fewer than 4 final values would narrow no bracket")
    names = list(columns)
    rows = df.select(*[columns[c].cast("double").alias(f"v{i}") for i, c in enumerate(names)])
    real = {c: F.when(~F.isnan(f"v{i}") & (F.abs(F.col(f"v{i}")) < F.lit(float("inf"))), F.col(f"v{i}")) for i, c in enumerate(names)}
    if cache:
        rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _bracketed(rows, names, real, probs, accuracy, final_values)
    finally:
        if cache:
            rows.unpersist()


def _bracketed(rows: DataFrame, names: list[str], real: dict, probs, accuracy: int, final_values: int) -> dict[str, Summary]:
    margin = 2 / accuracy
    around = [x for p in probs for x in (max(0.0, p - margin), min(1.0, p + margin))]
    aggregates = []
    for i, c in enumerate(names):
        v = F.col(f"v{i}")
        aggregates += [
            F.count(v).alias(f"n{i}"), F.avg(v).alias(f"mean{i}"), F.stddev_samp(v).alias(f"std{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"),
            F.count_if(F.isnan(v)).alias(f"nan{i}"), F.count_if(v == float("-inf")).alias(f"below{i}"), F.count_if(v == float("inf")).alias(f"above{i}"),
            F.min(real[c]).alias(f"least{i}"), F.max(real[c]).alias(f"greatest{i}"),
        ]
        if around:
            aggregates.append(F.percentile_approx(real[c], around, accuracy).alias(f"q{i}"))
    found = rows.agg(*aggregates).first()
    brackets: dict[tuple[str, float], _Bracket] = {}
    edges, out = {}, {}
    for i, c in enumerate(names):
        n = found[f"n{i}"]
        if not n:
            continue
        out[c] = Summary(n, found[f"mean{i}"], found[f"std{i}"], found[f"lo{i}"], found[f"hi{i}"], [])
        edges[c] = (found[f"below{i}"], n - found[f"nan{i}"] - found[f"above{i}"], n - found[f"nan{i}"])
        for k, p in enumerate(probs):
            pos = (n - 1) * float(p)
            ranks = [min(max(r, edges[c][0]), edges[c][1] - 1) - edges[c][0] for r in (math.floor(pos), math.ceil(pos))]
            if edges[c][0] < edges[c][1]:
                brackets[c, p] = _Bracket(c, *ranks, *found[f"q{i}"][2 * k : 2 * k + 2])
    whole = {c: (found[f"least{i}"], found[f"greatest{i}"]) for i, c in enumerate(names)}
    _count_brackets(rows, real, list(brackets.values()), whole, accuracy, final_values)
    for c, s in out.items():
        first, end, nan = edges[c]

        def at(rank, p):
            if first <= rank < end:
                return brackets[c, p].value(rank - first)
            return float("-inf") if rank < first else float("inf") if rank < nan else float("nan")

        for p in probs:
            pos = (s.count - 1) * float(p)
            a, b = math.floor(pos), math.ceil(pos)
            s.quantiles.append(_spark_interpolate(pos, a, b, at(a, p), at(b, p)))
    return out


def _edge_counts(rows: DataFrame, real: dict, todo: list[_Bracket]) -> tuple[dict, dict]:
    """The rows below, and at, each end (column, value) of the brackets; some ends a pass, since the JVM compiles no method of very many aggregates."""
    ends = list(dict.fromkeys((b.column, x) for b in todo for x in (b.lo, b.hi)))
    less, equal = {}, {}
    for at in range(0, len(ends), ENDS_A_PASS):
        some = ends[at : at + ENDS_A_PASS]
        found = rows.agg(*[F.count_if(x).alias(f"{n}{i}") for i, (c, end) in enumerate(some) for n, x in (("less", real[c] < end), ("equal", real[c] == end))]).first()
        less |= {e: found[f"less{i}"] for i, e in enumerate(some)}
        equal |= {e: found[f"equal{i}"] for i, e in enumerate(some)}
    return less, equal


def _count_brackets(rows: DataFrame, real: dict, todo: list[_Bracket], whole: dict, accuracy: int, final_values: int) -> None:
    """Fills ``below`` and ``counts`` of every bracket."""
    for _ in range(MAX_ROUNDS):
        if not todo:
            return
        less, equal = _edge_counts(rows, real, todo)
        ready, narrow = [], []
        for b in todo:
            lo, hi = (b.column, b.lo), (b.column, b.hi)
            b.below = less[lo]
            inside = less[hi] + equal[hi] - less[lo]
            between = max(0, less[hi] - less[lo] - equal[lo])  # 0 where the ends are one value
            if not b.below <= b.first <= b.second < b.below + inside:
                b.lo, b.hi = whole[b.column]  # infinities shifted the ranks: start from the whole range
                narrow.append((b, 0, None))
            elif between <= final_values:
                # the ends are counted already: they may be hot, and the values between are few rows
                b.counts = {b.lo: equal[lo], b.hi: equal[hi]}
                if between:
                    ready.append(b)
            else:
                narrow.append((b, b.below, inside))
        if ready:
            within = [(real[b.column] > b.lo) & (real[b.column] < b.hi) for b in ready]
            each = F.array(*[F.when(x, F.struct(F.lit(i).alias("i"), real[b.column].alias("v"))) for i, (b, x) in enumerate(zip(ready, within, strict=True))])
            some = rows.where(reduce(lambda x, y: x | y, within))
            values = some.select(F.explode(F.array_compact(each)).alias("e")).groupBy("e.i", "e.v").agg(F.count(F.lit(1)).alias("n")).collect()
            for r in values:
                ready[r["i"]].counts[r["v"]] = r["n"]
        if narrow:
            sketches = []
            for i, (b, below, inside) in enumerate(narrow):
                n = inside if inside is not None else None
                v = real[b.column]
                share = [0.0, 1.0] if n is None else [max(0.0, (b.first - below) / n - 2 / accuracy), min(1.0, (b.second - below + 1) / n + 2 / accuracy)]
                sketches.append(F.percentile_approx(F.when((v >= b.lo) & (v <= b.hi), v), share, accuracy).alias(f"q{i}"))
            found = rows.agg(*sketches).first()
            for i, (b, _, _) in enumerate(narrow):
                b.lo, b.hi = found[f"q{i}"]
        todo = [b for b, _, _ in narrow]
    raise RuntimeError("quantile brackets did not converge")


def histogram(long: DataFrame, group: str = "column", value: str = "value") -> DataFrame:
    """(group, value, n) over non-null values."""
    return long.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))


def _spark_interpolate(pos: float, lo_rank: int, hi_rank: int, v_lo: float, v_hi: float) -> float:
    if hi_rank == lo_rank or v_lo == v_hi:
        return float(v_lo)
    return (hi_rank - pos) * float(v_lo) + (pos - lo_rank) * float(v_hi)


def select_ranks(hist: DataFrame, targets: dict, group: str = "column", value: str = "value",
                 buckets: int = 1024, final_values: int = DRIVER_MAX_VALUES) -> dict:
    """Values at 0-based ranks: ``targets`` maps (group, rank) -> (lo, hi) start interval."""
    spark = hist.sparkSession
    state = {k: dict(lo=lo, hi=hi, base=0) for k, (lo, hi) in targets.items()}
    done: dict = {}
    for _ in range(MAX_ROUNDS):
        todo = {k: s for k, s in state.items() if k not in done}
        if not todo:
            break
        keys = list(todo)
        t = spark.createDataFrame(
            [(i, k[0], float(s["lo"]), float(s["hi"])) for i, (k, s) in enumerate(zip(keys, todo.values()))],
            f"__t int, __g string, __lo double, __hi double",
        )
        v = F.col(value).cast("double")
        joined = hist.join(
            F.broadcast(t), (F.col(group) == F.col("__g")) & (v >= F.col("__lo")) & (v <= F.col("__hi"))
        )
        width = F.col("__hi") - F.col("__lo")
        bucket = F.when(width <= 0, F.lit(0)).otherwise(
            F.least(F.floor((v - F.col("__lo")) / width * buckets), F.lit(buckets - 1))
        )
        per_bucket = (
            joined.groupBy("__t", bucket.alias("__b"))
            .agg(F.sum("n").alias("cnt"), F.count(F.lit(1)).alias("distinct"), F.min(v).alias("vmin"), F.max(v).alias("vmax"))
            .collect()
        )
        by_t: dict = {}
        for r in per_bucket:
            by_t.setdefault(r["__t"], []).append(r)
        small = []
        for i, k in enumerate(keys):
            s = state[k]
            rank = k[1]
            acc = s["base"]
            for r in sorted(by_t.get(i, []), key=lambda r: r["__b"]):
                if acc + r["cnt"] > rank:
                    s.update(lo=r["vmin"], hi=r["vmax"], base=acc)
                    if r["vmin"] == r["vmax"]:
                        done[k] = r["vmin"]
                    elif r["distinct"] <= final_values:
                        small.append((i, k))
                    break
                acc += r["cnt"]
            else:
                raise ValueError(f"rank {rank} is outside the data of group {k[0]!r}")
        if small:
            t_small = spark.createDataFrame(
                [(i, k[0], float(state[k]["lo"]), float(state[k]["hi"])) for i, k in small],
                "__t int, __g string, __lo double, __hi double",
            )
            rows = (
                hist.join(F.broadcast(t_small), (F.col(group) == F.col("__g")) & (v >= F.col("__lo")) & (v <= F.col("__hi")))
                .select("__t", v.alias("v"), "n")
                .collect()
            )
            vals: dict = {}
            for r in rows:
                vals.setdefault(r["__t"], []).append((r["v"], r["n"]))
            for i, k in small:
                acc = state[k]["base"]
                for val, n in sorted(vals.get(i, [])):
                    if acc + n > k[1]:
                        done[k] = val
                        break
                    acc += n
    missing = [k for k in state if k not in done]
    if missing:
        raise RuntimeError(f"quantile selection did not converge for {missing[:5]}")
    return done


def column_totals(hist: DataFrame, group: str = "column", value: str = "value") -> list:
    """Per group: N (values), D (distinct values), nan, below and above (NaN,
    -Infinity and +Infinity values), and the range lo..hi of the finite values."""
    v = F.col(value).cast("double")
    inf = F.lit(float("inf"))
    real = F.when(~F.isnan(v) & (F.abs(v) < inf), v)
    times = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    return hist.groupBy(group).agg(
        F.sum("n").alias("N"), F.count(F.lit(1)).alias("D"),
        times(F.isnan(v)).alias("nan"), times(v == -inf).alias("below"), times(v == inf).alias("above"),
        F.min(real).alias("lo"), F.max(real).alias("hi"),
    ).collect()


def exact_quantiles(long: DataFrame | None, probs, group: str = "column", value: str = "value",
                    hist: DataFrame | None = None, buckets: int = 1024, final_values: int = DRIVER_MAX_VALUES,
                    totals: list | None = None, percentile_max_distinct: int = PERCENTILE_MAX_DISTINCT) -> dict:
    """{group: [quantile per p]} with Spark's linear interpolation (exact).

    Groups with at most ``percentile_max_distinct`` distinct values use
    Spark's ``percentile`` with the histogram counts as frequencies (its map,
    on an executor, is bounded by that check); larger groups go through the
    selection rounds, which hand the driver at most ``buckets`` bucket counts
    and finally at most ``final_values`` values per rank.
    """
    own = hist is None
    if own:
        hist = histogram(long, group, value).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        tot = totals if totals is not None else column_totals(hist, group, value)
        small = [r[group] for r in tot if r["D"] <= percentile_max_distinct]
        out: dict = {}
        if small:
            pct = F.percentile(F.col(value).cast("double"), F.array(*[F.lit(float(p)) for p in probs]), F.col("n"))
            for r in hist.filter(F.col(group).isin(small)).groupBy(group).agg(pct.alias("q")).collect():
                out[r[group]] = list(r["q"])
        big = [r[group] for r in tot if r[group] not in out]
        if big:
            # -Infinity, finite values, +Infinity, NaN (as Spark sorts them):
            # the first and last have counted ranks, the others are selected.
            v = F.col(value).cast("double")
            real_hist = hist.filter(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
            targets, plan, edges = {}, {}, {}
            for r in column_totals(hist.filter(F.col(group).isin(big)), group, value):
                g, n = r[group], r["N"]
                edges[g] = (r["below"], n - r["nan"] - r["above"], n - r["nan"])
                for p in probs:
                    pos = (n - 1) * float(p)
                    lo_rank, hi_rank = math.floor(pos), math.ceil(pos)
                    plan[(g, p)] = (pos, lo_rank, hi_rank)
                    for rank in (lo_rank, hi_rank):
                        if edges[g][0] <= rank < edges[g][1]:
                            targets[(g, rank - edges[g][0])] = (r["lo"], r["hi"])
            picked = select_ranks(real_hist, targets, group, value, buckets, final_values) if targets else {}

            def at(g, rank):
                first, end, nan = edges[g]
                if first <= rank < end:
                    return picked[(g, rank - first)]
                return float("-inf") if rank < first else float("inf") if rank < nan else float("nan")

            for g in edges:
                out[g] = [
                    _spark_interpolate(plan[(g, p)][0], plan[(g, p)][1], plan[(g, p)][2],
                                       at(g, plan[(g, p)][1]), at(g, plan[(g, p)][2]))
                    for p in probs
                ]
        return out
    finally:
        if own:
            hist.unpersist()
