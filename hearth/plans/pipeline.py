"""K1: the clean pipeline, raw feed -> (item_category, listing).

Step order follows the ingest job: cast, normalise codes, fill subtype,
dates, non-negative filter, zipcode, build year, change date, final types,
keep latest, then the category mapping and the listing projection.

Two placements differ from a literal step-by-step reading, with identical
results:

* the build-year adjustment (P7) needs the maximum start year over the rows
  that survive the zipcode step. That maximum is taken at exactly that point
  (a scalar subquery, or a value passed in), but the per-row rewrite is
  applied after keep-latest, whose tie-break reads the unadjusted year. P7
  touches no other column, so it commutes with the filters and the dedup;
  running it later lets a job compute the maximum as a side metric of its
  single pass (see ``hearth.plans.ingest``).
* columns that are not stored (``description_fr`` and unknown raw fields)
  are dropped before the dedup shuffle instead of at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.operators import clean as C
from hearth.plans.policies import TransformPolicy
from hearth.schema import LISTING_COLUMNS, SMALLINT_COLUMNS
from hearth.session import scratch_path

KEEP_COLUMNS = tuple(LISTING_COLUMNS) + ("item_type", "item_subtype")


def prepare(raw: DataFrame, policy: TransformPolicy = TransformPolicy()) -> DataFrame:
    """Steps P1 -> P3 -> P2 -> P4 -> F1 -> P5/F2/P6 (the frame the maximum
    start year is taken over)."""
    df = C.cast_known_columns(raw, policy.on_bad_cast)
    if policy.normalize_enum:
        df = C.normalize_enum(df)
    df = C.fill_subtype(df)
    dates = C.to_timestamps if policy.date_as_unixtime else C.parse_timestamps
    df = dates(df, on_bad_cast=policy.on_bad_cast)
    if policy.enforce_non_negative:
        df = C.enforce_non_negative(df)
    return C.clean_zipcode(
        df,
        policy.zipcode_regex,
        policy.drop_invalid_zipcode,
        policy.normalize_two_digits_zc,
    )


def dedup_stage(pre: DataFrame, policy: TransformPolicy = TransformPolicy(), each_null_key: bool = False) -> DataFrame:
    """F3 or (nothing) -> P8/F4 -> P9 (all but build_year) -> keep latest.

    The build year is still unadjusted here; keep-latest reads it as a
    tie-break only. ``each_null_key`` keeps every row without a key, so that
    each is reported as a violation.
    """
    df = pre
    if policy.adjust_build_year_policy == "drop":
        df = C.adjust_build_year(df, "drop")
    df = C.adjust_change_date(df, policy.adjust_change_date_policy)
    df = C.finalize_types(df, smallint_cols=[c for c in SMALLINT_COLUMNS if c != "build_year"])
    df = df.select(*[c for c in df.columns if c in KEEP_COLUMNS])
    return C.keep_latest(df, each_null_key=each_null_key) if policy.deduplicate else df


def finish_stage(df: DataFrame, policy: TransformPolicy = TransformPolicy(), max_year: Column | int | None = None) -> DataFrame:
    """P7 'adjust' with the given maximum start year, then build_year -> smallint."""
    if policy.adjust_build_year_policy == "adjust" and {"build_year", "start_date"} <= set(df.columns):
        if max_year is None:
            raise ValueError("finish_stage needs the maximum start year of the prepared frame")
        df = C.adjust_build_year(df, "adjust", max_year=max_year)
    return C.finalize_types(df, smallint_cols=("build_year",), float_cols=())


def clean_frame(
    raw: DataFrame,
    policy: TransformPolicy = TransformPolicy(),
    max_year: Column | int | None = None,
) -> DataFrame:
    """The cleaned (and, by policy, deduplicated) frame before the split.

    Without ``max_year`` the maximum start year is a scalar subquery over the
    prepared frame.
    """
    pre = prepare(raw, policy)
    if max_year is None and policy.adjust_build_year_policy == "adjust" and "start_date" in pre.columns:
        max_year = C.max_start_year(pre)
    return finish_stage(dedup_stage(pre, policy), policy, max_year)


def staged_table(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back: later reads prune columns, and lost executors cost no rerun."""
    path = scratch_path(df.sparkSession, "staged")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def materialized_frame(raw: DataFrame, policy: TransformPolicy = TransformPolicy()) -> tuple[DataFrame, dict]:
    """The cleaned frame computed in one pass over ``raw`` and written as parquet.

    An ``Observation`` on the prepared frame collects the row count and the
    maximum start year while the dedup stage is written (to a fresh table
    under ``spark.checkpoint.dir``); the build-year rewrite then uses that value
    as a literal. Returns the frame and the observed metrics.
    """
    from pyspark.sql import Observation

    obs = Observation("prepared")
    pre = prepare(raw, policy)
    year = F.max(F.year("start_date")) if "start_date" in pre.columns else F.lit(None).cast("int")
    pre = pre.observe(obs, F.count(F.lit(1)).alias("prepared_rows"), year.alias("max_start_year"))
    staged = staged_table(dedup_stage(pre, policy))
    metrics = dict(obs.get)
    return finish_stage(staged, policy, F.lit(metrics.get("max_start_year")).cast("int")), metrics


def clean_listings(
    raw: DataFrame,
    policy: TransformPolicy = TransformPolicy(),
    max_year: Column | int | None = None,
    materialize: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """K1: (item_category, listing) from a raw feed.

    Lazy by default (the maximum start year is a scalar subquery, so the
    feed is read twice, the second time for a few columns only). With
    ``materialize=True`` the feed is read once: the cleaned frame is
    written to the shared folder and both outputs read it there.
    """
    if materialize:
        df, _ = materialized_frame(raw, policy)
    else:
        df = clean_frame(raw, policy, max_year)
    return C.item_categories(df), C.listing_projection(df)
