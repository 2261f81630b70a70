"""Data-quality profile of a listing frame.

Every profile takes any DataFrame and column names. Wide profiles are one
aggregate or one ``unpivot`` + one ``groupBy`` over all requested columns,
never a job per column. Per-column statistics that must be joined back to the
rows (fences, mean and std) are one row per column, so the broadcast side is
bounded by the number of columns, not by the data.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearth.functions.columns import parent_path
from hearth.operators import quantiles as Q
from hearth.operators.clean import latest_order
from hearth.operators.ordered import placed, run_numbers
from hearth.session import scratch_path
from hearth.sources.footers import footer_counts

QUARTILES = (0.25, 0.5, 0.75)


def _long(df: DataFrame, cols, value_type: str = "double", ids=()) -> DataFrame:
    """``(ids..., column, value)`` with one row per (row, column), nulls dropped."""
    ids = list(ids)
    return (
        df.select(*ids, *[F.col(c).cast(value_type).alias(c) for c in cols])
        .unpivot(ids, list(cols), "column", "value")
        .filter(F.col("value").isNotNull())
    )


def _r(c: Column, digits: int) -> Column:
    return F.round(c, digits) if digits is not None else c


def column_histogram(df: DataFrame, numeric=(), text=(), derived: dict[str, Column] | None = None) -> DataFrame:
    """(column, num, txt, n): every value of the given columns with its count,
    nulls included (``num`` and ``txt`` both null), in one pass.

    Numeric columns keep their values as doubles (exact for float and whole
    columns), text columns as strings; ``derived`` adds computed numeric
    columns (e.g. a length). Partial aggregation collapses repeated values
    map-side, so a hot value is one row after the shuffle. Several profiles
    can share one (persisted) histogram instead of each reading the data.
    """
    derived = derived or {}
    none_d, none_s = F.lit(None).cast("double"), F.lit(None).cast("string")
    exprs = {c: F.struct(F.col(c).cast("double").alias("num"), none_s.alias("txt")) for c in numeric}
    exprs.update({c: F.struct(e.cast("double").alias("num"), none_s.alias("txt")) for c, e in derived.items()})
    exprs.update({c: F.struct(none_d.alias("num"), F.col(c).cast("string").alias("txt")) for c in text})
    names = list(exprs)
    long = df.select(*[e.alias(c) for c, e in exprs.items()]).unpivot([], names, "column", "v")
    return long.groupBy("column", F.col("v.num").alias("num"), F.col("v.txt").alias("txt")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _num_hist(hist: DataFrame, cols) -> DataFrame:
    """(column, value, n) of the non-null numeric values of ``cols``."""
    return hist.filter(F.col("column").isin(*cols) & F.col("num").isNotNull()).select(
        "column", F.col("num").alias("value"), "n"
    )


def _txt_hist(hist: DataFrame, cols) -> DataFrame:
    """(column, value, n) of the non-null text values of ``cols``."""
    return hist.filter(F.col("column").isin(*cols) & F.col("txt").isNotNull()).select(
        "column", F.col("txt").alias("value"), "n"
    )


# ------------------------------------------------------------------ A5 / A13
SUMMARY_SCHEMA = (
    "column string, count bigint, mean double, std double, min double, "
    "q25 double, q50 double, q75 double, max double"
)


def _hist_moments(hist: DataFrame) -> DataFrame:
    """Per column: N, mean, M2 (sum of squared deviations), min, max from a
    (column, value, n) histogram; two passes over the histogram, the second
    against the per-column means (one row per column, broadcast)."""
    v = F.col("value").cast("double")
    base = hist.groupBy("column").agg(
        F.sum("n").alias("N"), (F.sum(v * F.col("n")) / F.sum("n")).alias("mean"),
        F.min(v).alias("min"), F.max(v).alias("max"), F.count(F.lit(1)).alias("D"),
    )
    m2 = hist.join(F.broadcast(base.select("column", F.col("mean").alias("__m"))), "column").groupBy("column").agg(
        F.sum(F.col("n") * (v - F.col("__m")) * (v - F.col("__m"))).alias("M2")
    )
    return base.join(m2, "column")


def numeric_summary(
    df: DataFrame, cols, approx: bool = False, digits: int | None = 6, hist: DataFrame | None = None,
    quantiles: dict | None = None, cache: bool = True,
) -> DataFrame:
    """A5: count, mean, sample std, min, quartiles, max per column (long form).

    Exact (default): quartiles from sketch brackets (``quantiles.bracketed``),
    which shuffles no rows. The small result is computed eagerly.
    ``approx=True`` is a single lazy aggregate with ``percentile_approx``.
    ``hist`` may be a shared ``column_histogram`` that holds ``cols`` as
    numeric columns, to be used instead.
    """
    if approx:
        long = _long(df, cols)
        v = F.col("value")
        return long.groupBy("column").agg(
            F.count(v).alias("count"),
            _r(F.avg(v), digits).alias("mean"),
            _r(F.stddev_samp(v), digits).alias("std"),
            F.min(v).alias("min"),
            F.percentile_approx(v, list(QUARTILES), 100000).alias("q"),
            F.max(v).alias("max"),
        ).select("column", "count", "mean", "std", "min", *[_r(F.col("q")[i], digits).alias(n) for i, n in
                                                             enumerate(("q25", "q50", "q75"))], "max")
    if hist is None:
        return summary_frame(df.sparkSession, Q.bracketed(df, {c: F.col(c) for c in cols}, QUARTILES, cache=cache), digits)
    hist = _num_hist(hist, cols)
    moments = _hist_moments(hist).collect()
    totals = [dict(column=r["column"], N=r["N"], D=r["D"], lo=r["min"], hi=r["max"]) for r in moments]
    qs = quantiles if quantiles is not None else Q.exact_quantiles(None, QUARTILES, hist=hist, totals=totals)
    found = {}
    for r in moments:
        n = r["N"]
        std = math.sqrt(r["M2"] / (n - 1)) if n > 1 else None
        found[r["column"]] = Q.Summary(n, r["mean"], std, r["min"], r["max"], qs[r["column"]])
    return summary_frame(df.sparkSession, found, digits)


def summary_frame(spark: SparkSession, found: dict[str, Q.Summary], digits: int | None = 6) -> DataFrame:
    """The rows of A5 from each column's figures."""
    rows = [(c, x.count, x.mean, x.std, x.least, *x.quantiles, x.greatest) for c, x in found.items()]
    out = spark.createDataFrame(rows, SUMMARY_SCHEMA)
    return out.select(
        "column", "count", *[_r(F.col(c), digits).alias(c) for c in ("mean", "std")], "min",
        *[_r(F.col(c), digits).alias(c) for c in ("q25", "q50", "q75")], "max",
    )


def length_summary(df: DataFrame, col: str = "zipcode", digits: int | None = 6) -> DataFrame:
    """A5 over ``length(col)``."""
    return numeric_summary(df.select(F.length(col).alias(f"{col}_length")), [f"{col}_length"], digits=digits)


# ------------------------------------------------------------------ A6 A7 A8
def column_info(df: DataFrame) -> DataFrame:
    """(column, non_null, dtype) for every column, one aggregate."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    long = counts.unpivot([], df.columns, "column", "non_null")
    types = df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in df.schema.fields], "column string, dtype string"
    )
    return long.join(F.broadcast(types), "column")


def integer_safe(df: DataFrame, cols) -> DataFrame:
    """(column, integer_safe): every non-null value is whole (true where there is none)."""
    aggs = [F.coalesce(F.bool_and((F.col(c) % 1) == 0), F.lit(True)).alias(c) for c in cols]
    return df.agg(*aggs).unpivot([], list(cols), "column", "integer_safe")


def boolean_safe(df: DataFrame, cols, hist: DataFrame | None = None) -> DataFrame:
    """(column, n_distinct, boolean_safe): at most two non-null values."""
    if hist is not None:
        per = hist.filter(F.col("column").isin(*cols) & (F.col("num").isNotNull() | F.col("txt").isNotNull()))
    else:
        per = _long(df, cols, "string").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    n = per.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return (
        names.join(n, "column", "left")
        .select("column", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"))
        .withColumn("boolean_safe", F.col("n_distinct") <= 2)
    )


# ------------------------------------------------------------------ A9 A10 A11 A12
def value_counts(df: DataFrame, cols, hist: DataFrame | None = None) -> DataFrame:
    """(column, value, count), nulls excluded; partial aggregation on the
    map side collapses hot values before the shuffle."""
    if hist is not None:
        vc = _txt_hist(hist, cols).select("column", "value", F.col("n").alias("count"))
    else:
        vc = _long(df, cols, "string").groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    return vc.orderBy("column", F.desc("count"), "value")


def pair_counts(df: DataFrame, a: str, b: str, where: Column | None = None) -> DataFrame:
    """A10: counts of (a, b) pairs (optionally on filtered rows)."""
    d = df if where is None else df.filter(where)
    return d.groupBy(a, b).agg(F.count(F.lit(1)).alias("count"))


def level_shares(
    df: DataFrame, cols, max_levels: int = 20, digits: int = 6, hist: DataFrame | None = None
) -> DataFrame:
    """Per column the number of levels and, per level, count and share.

    ``show_share`` marks columns with fewer than ``max_levels`` levels (those
    whose share breakdown is meant to be read). Column totals are one row per
    column and are broadcast back.
    """
    if hist is not None:
        vc = _txt_hist(hist, cols).select("column", "value", F.col("n").alias("count"))
    else:
        vc = _long(df, cols, "string").groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    tot = vc.groupBy("column").agg(F.sum("count").alias("__total"), F.count(F.lit(1)).alias("n_levels"))
    return vc.join(F.broadcast(tot), "column").select(
        "column",
        "value",
        "count",
        F.round(F.col("count") / F.col("__total"), digits).alias("share"),
        "n_levels",
        (F.col("n_levels") < max_levels).alias("show_share"),
    )


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """The distinct values of a column, null included."""
    return df.select(col).distinct()


# ------------------------------------------------------------------ A14
def missing_share(df: DataFrame, cols=None, digits: int = 6) -> DataFrame:
    """(variable, missing, share) per column, one aggregate."""
    cols = list(cols or df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return agg.unpivot(["__n"], cols, "variable", "missing").select(
        "variable", "missing", F.round(F.col("missing") / F.col("__n"), digits).alias("share")
    )


# ------------------------------------------------------------------ A15 A16 W2
EXPAND_CHUNK = 1 << 16
HOT_KEY_ROWS = 1 << 20


def expand_counts(df: DataFrame, count_col: str, chunk: int = EXPAND_CHUNK) -> DataFrame:
    """Each row repeated ``count_col`` times (the count column is dropped).

    Rows with at most ``chunk`` copies are exploded in place. A row with
    more copies is first cut into chunks of ``chunk`` copies, the chunks are
    spread over tasks by a shuffle of those few rows, and each chunk is
    exploded where it lands: no array larger than ``chunk`` is built and no
    single task emits all copies of a hot row.
    """
    n = F.col(count_col).cast("bigint")
    cols = [c for c in df.columns if c != count_col]
    one = F.lit(1).cast("bigint")
    small = df.filter((n > 0) & (n <= chunk)).select(*cols, F.explode(F.sequence(one, n)).alias("__i")).drop("__i")
    big = (
        df.filter(n > chunk)
        .select(*cols, n.alias("__n"), F.explode(F.sequence(F.lit(0).cast("bigint"), ((n - 1) / chunk).cast("bigint"))).alias("__c"))
        .repartition("__c", *cols)
    )
    last = F.least(F.lit(chunk).cast("bigint"), F.col("__n") - F.col("__c") * chunk)
    big = big.select(*cols, F.explode(F.sequence(one, last)).alias("__i")).drop("__i")
    return small.unionByName(big)


def whole_row_duplicates(df: DataFrame, prefilter: bool = True) -> DataFrame:
    """Every member of a group of identical rows (nulls compare equal).

    With ``prefilter`` a first pass shuffles only a 64-bit hash of each row
    and keeps the hashes seen more than once; only rows carrying such a hash
    go on to the exact ``groupBy`` over all columns. When duplicates are rare
    the wide shuffle shrinks to the candidates; a hash collision only adds a
    candidate, never a result. Partial aggregation collapses copies
    map-side in both passes. The counted rows are written to the shared folder
    once, and each is expanded back to its count in bounded chunks, so that
    ``df`` is evaluated once per pass.
    """
    cols = df.columns
    rows = df
    if prefilter:
        h = F.xxhash64(*[F.col(c) for c in cols])
        seen = df.select(h.alias("__h")).groupBy("__h").agg(F.count(F.lit(1)).alias("__c")).filter(F.col("__c") > 1)
        rows = df.withColumn("__h", h).join(seen.select("__h"), "__h", "left_semi").drop("__h")
    counts = rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 1)
    path = scratch_path(df.sparkSession, "row-counts")
    counts.write.parquet(path)
    return expand_counts(df.sparkSession.read.parquet(path), "__n").select(*cols)


def top1(df: DataFrame, keys, order: list[Column]) -> DataFrame:
    """First row of each key in ``order`` (planned as a partial + final WindowGroupLimit)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def key_duplicates(
    df: DataFrame, keys=("listing_id",), order: list[Column] | None = None, hot_rows: int = HOT_KEY_ROWS
) -> DataFrame:
    """Second and later rows of each key (the rows keep-latest drops).

    The rows whose occurrence number (W2, in the keep-latest order) is above
    one: by one window shuffle if no key has over ``hot_rows`` rows, else by
    range partitions, so no hot key's rows are ever gathered in one task.
    """
    return occurrence_number(df, keys, order, hot_rows, "__occ").filter(F.col("__occ") > 1).drop("__occ")


def key_duplicates_by_count(df: DataFrame, keys=("listing_id",), order: list[Column] | None = None) -> DataFrame:
    """A16 as a multiset difference: all rows minus each key's first row.

    Every row weighs +1, each key's first row (a top-1) weighs -1, weights are
    summed per distinct row (copies collapse map-side) and the remainder is
    expanded in bounded chunks. Equal to ``key_duplicates``; kept as the
    cross-check of the numbering path.
    """
    cols = df.columns
    order = order or latest_order(df, tuple(keys))
    plus = df.select(*cols, F.lit(1).alias("__w"))
    minus = top1(df, list(keys), order).select(*cols, F.lit(-1).alias("__w"))
    rest = plus.unionByName(minus).groupBy(*cols).agg(F.sum("__w").alias("__n")).filter(F.col("__n") > 0)
    return expand_counts(rest, "__n").select(*cols)


def occurrence_number(
    df: DataFrame, keys, order: list[Column] | None = None, hot_rows: int = HOT_KEY_ROWS, name: str = "occurrence"
) -> DataFrame:
    """``occurrence`` = 1, 2, ... inside each key, in a declared order
    (default: the keep-latest order, so occurrence 1 is the survivor).

    If every key (null ones too) has at most ``hot_rows`` rows, a window
    numbers them. Otherwise the rows are range-partitioned on (key, order) and
    a salt, and numbered inside each partition as they come: one shuffle of
    the rows, and a hot key, and copies of one row, are spread over many
    tasks. Only the key that a partition begins with may have rows in earlier
    ones; its numbers are shifted by their count, from a table of a row or two
    a partition. ``df`` is evaluated once, when this is called, and written to
    the shared folder; counts and numbers are taken from there. (An ``order``
    of columns bound to ``df`` is only known to ``df``, which is then evaluated
    again; the numbers still come from one evaluation.)
    """
    keys = list(keys)
    order = order or latest_order(df, tuple(keys))
    spark = df.sparkSession
    path = scratch_path(spark, "occurrences")
    try:
        spark.createDataFrame([], df.schema).orderBy(*order)
        df.write.parquet(f"{path}/rows")
        rows = spark.read.schema(df.schema).parquet(f"{path}/rows")
        partitions = -(-footer_counts(rows)["rows"] // HOT_KEY_ROWS)
    except AnalysisException:
        rows, partitions = df, 0
    if rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__cnt")).filter(F.col("__cnt") > hot_rows).isEmpty():
        return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))

    # The salt parts copies of one row, which are interchangeable.
    salted = rows.withColumn("__salt", F.rand(0))
    spread = [*[F.col(k).asc_nulls_first() for k in keys], *order, F.col("__salt").asc()]
    ranged = placed(salted, spread, f"{path}/ranged", partitions, lambda x: run_numbers(x.drop("__salt"), keys))
    named = lambda x, p: x.select(*[F.col(k).alias(f"{p}{k}") for k in keys], *[c for c in x.columns if c not in keys])
    match = lambda x, p: [ranged[k].eqNullSafe(x[f"{p}{k}"]) for k in keys]
    begun = named(ranged.filter(F.col("__at") == 0).select(*keys).distinct(), "__b_")
    sizes = ranged.join(F.broadcast(begun), match(begun, "__b_"), "left_semi").groupBy(*keys, "__part").agg(F.max("__number").alias("__size"))
    before = F.sum("__size").over(Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = named(sizes.select(*keys, F.col("__part").alias("__opart"), before.alias("__offset")), "__o_")
    numbered = ranged.join(F.broadcast(offsets), match(offsets, "__o_") + [ranged["__part"] == offsets["__opart"]], "left")
    return numbered.select(*[ranged[c] for c in df.columns], (F.col("__number") + F.coalesce("__offset", F.lit(0))).cast("int").alias(name))


# ------------------------------------------------------------------ A17
def dependency_violations(df: DataFrame, lhs: str, rhs: str) -> DataFrame:
    """Values of ``lhs`` mapped to more than one non-null ``rhs``.

    An empty result means the functional dependency lhs -> rhs holds.
    """
    return (
        df.filter(F.col(lhs).isNotNull())
        .groupBy(lhs)
        .agg(F.count_distinct(rhs).alias("n_values"))
        .filter(F.col("n_values") > 1)
    )


# ------------------------------------------------------------------ A18
def iqr_stats(
    df: DataFrame, cols, k: float = 1.5, digits: int = 6, hist: DataFrame | None = None, quantiles: dict | None = None
) -> DataFrame:
    """Quartiles (linear interpolation), IQR fences and box statistics.

    Quartiles come from sketch brackets, whiskers (most extreme values inside
    the fences) and fliers (values outside) from one more aggregate with the
    fences as literals; no rows are shuffled. ``quantiles`` ({column:
    quartiles}) saves the first part. With a shared ``hist`` both come from
    the histogram.
    """
    if hist is not None:
        hist = _num_hist(hist, cols)
        qs = quantiles if quantiles is not None else Q.exact_quantiles(None, QUARTILES, hist=hist)
    else:
        qs = quantiles if quantiles is not None else {c: x.quantiles for c, x in Q.bracketed(df, {c: F.col(c) for c in cols}, QUARTILES).items()}
    fences = [(c, q1, q2, q3, q3 - q1, q1 - k * (q3 - q1), q3 + k * (q3 - q1)) for c, (q1, q2, q3) in qs.items() if c in cols]
    if hist is not None:
        f = df.sparkSession.createDataFrame(
            fences, "column string, q1 double, median double, q3 double, iqr double, lower_fence double, upper_fence double"
        )
        v, n = F.col("value").cast("double"), F.col("n")
        box = hist.join(F.broadcast(f), "column").groupBy("column").agg(
            F.sum(n).alias("count"),
            (F.sum(v * n) / F.sum(n)).alias("mean"),
            F.min(F.when(v >= F.col("lower_fence"), v)).alias("whisker_low"),
            F.max(F.when(v <= F.col("upper_fence"), v)).alias("whisker_high"),
            F.sum(F.when((v < F.col("lower_fence")) | (v > F.col("upper_fence")), n).otherwise(0)).alias("n_fliers"),
        )
        rows = box.join(f, "column").collect()
    else:
        aggregates = []
        for i, (c, *_, low, high) in enumerate(fences):
            v = F.col(c).cast("double")
            aggregates += [
                F.count(v).alias(f"count{i}"), F.avg(v).alias(f"mean{i}"),
                F.min(F.when(v >= low, v)).alias(f"whisker_low{i}"), F.max(F.when(v <= high, v)).alias(f"whisker_high{i}"),
                F.count_if((v < low) | (v > high)).alias(f"n_fliers{i}"),
            ]
        one = df.agg(*aggregates).first() if aggregates else None
        rows = [
            dict(zip(("column", "q1", "median", "q3", "iqr", "lower_fence", "upper_fence"), f, strict=True))
            | {x: one[f"{x}{i}"] for x in ("count", "mean", "whisker_low", "whisker_high", "n_fliers")}
            for i, f in enumerate(fences)
        ]
    names = ("column", "count", "q1", "median", "q3", "iqr", "lower_fence", "upper_fence", "mean",
             "whisker_low", "whisker_high", "n_fliers")
    out = df.sparkSession.createDataFrame(
        [tuple(r[c] for c in names) for r in rows],
        "column string, count bigint, q1 double, median double, q3 double, iqr double, lower_fence double, "
        "upper_fence double, mean double, whisker_low double, whisker_high double, n_fliers bigint",
    )
    return out.select(
        "column", "count",
        *[_r(F.col(c), digits).alias(c) for c in ("q1", "median", "q3", "iqr", "lower_fence", "upper_fence", "mean")],
        "whisker_low", "whisker_high", "n_fliers",
    )


# ------------------------------------------------------------------ A19 A20
def zscore_outliers(
    df: DataFrame, cols, key: str = "listing_id", threshold: float = 3.0, digits: int = 6
) -> DataFrame:
    """Per column, rows with |z| >= threshold, z over that column's
    non-null values with the population std (a constant column has none)."""
    long = _long(df, cols, ids=[key])
    v = F.col("value")
    st = long.groupBy("column").agg(F.avg(v).alias("__mean"), F.stddev_pop(v).alias("__std"))
    z = (v - F.col("__mean")) / F.nullif(F.col("__std"), F.lit(0.0))
    return (
        long.join(F.broadcast(st), "column")
        .withColumn("z", z)
        .filter(F.abs(F.col("z")) >= threshold)
        .select("column", key, "value", _r(F.col("z"), digits).alias("z"))
    )


def zscore_complete_case(
    df: DataFrame, cols, key: str = "listing_id", threshold: float = 3.0
) -> DataFrame:
    """Drop rows with a null in any column first, then keep rows where
    any column has |z| >= threshold (mean and population std of the complete
    cases). The statistics are one row, cross-joined by broadcast."""
    cols = list(cols)
    d = df.select(key, *cols).dropna(subset=cols)
    st = d.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"__m_{c}") for c in cols],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"__s_{c}") for c in cols],
    )
    zs = [F.abs((F.col(c).cast("double") - F.col(f"__m_{c}")) / F.nullif(F.col(f"__s_{c}"), F.lit(0.0))) for c in cols]
    any_out = F.lit(False)
    for zc in zs:
        any_out = any_out | F.coalesce(zc >= threshold, F.lit(False))
    return d.crossJoin(F.broadcast(st)).filter(any_out).select(key, *cols)


# ------------------------------------------------------------------ A21 A22
def integer_distribution(df: DataFrame, cols, max_levels: int = 100, hist: DataFrame | None = None) -> DataFrame:
    """(column, value, count, n_levels, few_levels) ordered by value.

    Every column is listed; ``few_levels`` marks those with fewer than
    ``max_levels`` distinct values (the ones worth a bar chart).
    """
    if hist is not None:
        vc = _num_hist(hist, cols).select("column", F.col("value").cast("bigint").alias("value"), F.col("n").alias("count"))
    else:
        vc = _long(df, cols, "bigint").groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    lv = vc.groupBy("column").agg(F.count(F.lit(1)).alias("n_levels"))
    # one row per column of the frame
    return vc.join(F.broadcast(lv), "column").withColumn("few_levels", F.col("n_levels") < max_levels).orderBy("column", "value")


def date_range(df: DataFrame, col: str = "start_date") -> DataFrame:
    """Min and max of a date column."""
    return df.agg(F.min(col).alias(f"min_{col}"), F.max(col).alias(f"max_{col}"))


# ------------------------------------------------------------------ F21–F27
def zipcode_length_rows(df: DataFrame, lengths=(2, 3, 4)) -> DataFrame:
    """(zipcode, city, length) for zipcodes of the given lengths."""
    n = F.length("zipcode")
    return df.filter(n.isin(*lengths)).select("zipcode", "city", n.alias("zipcode_length"))


def zipcode_rows(df: DataFrame, zipcode: str) -> DataFrame:
    """(zipcode, city) rows of one zipcode."""
    return df.filter(F.col("zipcode") == zipcode).select("zipcode", "city")


def future_build_year(df: DataFrame) -> DataFrame:
    """rows built after their own start year."""
    return df.filter(F.col("build_year") > F.year("start_date"))


def build_year_tails(df: DataFrame, high: int = 2020, low: int = 1700, hist: DataFrame | None = None) -> DataFrame:
    """value counts of build years above ``high`` or below ``low``."""
    if hist is not None:
        v = F.col("value")
        return _num_hist(hist, ["build_year"]).filter((v > high) | (v < low)).select(
            F.when(v > high, "high").otherwise("low").alias("tail"),
            v.cast(df.schema["build_year"].dataType).alias("build_year"),
            F.col("n").alias("count"),
        )
    by = F.col("build_year")
    return (
        df.filter((by > high) | (by < low))
        .groupBy(F.when(by > high, "high").otherwise("low").alias("tail"), by.alias("build_year"))
        .agg(F.count(F.lit(1)).alias("count"))
    )


def date_inversions(df: DataFrame) -> DataFrame:
    """rows whose start_date is after their change_date."""
    return df.filter(F.col("start_date") > F.col("change_date"))


def missing_rows(df: DataFrame, col: str = "is_furnished") -> DataFrame:
    """rows where ``col`` is null."""
    return df.filter(F.col(col).isNull())


def hierarchy_mismatch(df: DataFrame, parent: str = "item_type", child: str = "item_subtype") -> DataFrame:
    """rows whose ``parent`` is not the dotted parent path of ``child``
    (child not null; a null parent counts as a mismatch)."""
    return df.filter(F.col(child).isNotNull() & ~F.col(parent).eqNullSafe(parent_path(child)))
