"""The full data-quality profile (A5–A22, F21–F27) as one composite.

The exploration reads the raw feed once: the typed load and the cleaned
table are written as parquet tables in the shared folder named by
``spark.checkpoint.dir`` and every profile reads those instead of re-parsing
or re-joining the feed. Parquet (rather than a row-oriented checkpoint) lets
each profile read only its own columns.

Results are returned as a dict name -> DataFrame (the quantile-based ones
are already computed; the others are lazy over the materialized inputs).
The two shared histograms stay cached while those frames are in use;
``spark.catalog.clearCache()`` releases them afterwards.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.operators import profile as PR
from hearth.operators import quantiles as Q
from hearth.schema import CATEGORICAL_COLUMNS, FLAG_COLUMNS, INTEGER_COLUMNS, MEASURE_COLUMNS
from hearth.session import scratch_path

NUMERIC = MEASURE_COLUMNS + INTEGER_COLUMNS


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back
    (cuts the lineage; later reads prune columns)."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def profile_report(typed: DataFrame, cleaned: DataFrame, checkpoint: bool = True) -> dict[str, DataFrame]:
    """All profiles: ``typed`` is the raw load (dates parsed, codes as given),
    ``cleaned`` the deduplicated frame (with ``item_type`` / ``item_subtype``
    or the stored listing table).

    Each input feeds one shared ``column_histogram`` of its columns with few
    values (one shuffle pass, persisted) from which value counts, shares,
    distributions and tails are derived. Summaries and quartiles come from
    sketch brackets, row-level profiles (duplicates, outliers, filtered rows)
    from the written inputs.
    """
    if checkpoint:
        typed = materialize(typed, "profile-typed")
        cleaned = materialize(cleaned, "profile-cleaned")
    cats = [c for c in CATEGORICAL_COLUMNS + ("item_subcategory",) if c in cleaned.columns]
    key = "listing_id"
    # Histograms of columns with few values only; measures are summed up by sketch brackets, which shuffle no rows.
    h_typed = PR.column_histogram(typed, numeric=("build_year",), text=FLAG_COLUMNS).persist(StorageLevel.MEMORY_AND_DISK)
    h_clean = PR.column_histogram(cleaned, numeric=INTEGER_COLUMNS, text=tuple(cats) + FLAG_COLUMNS).persist(
        StorageLevel.MEMORY_AND_DISK
    )
    # The eager parts are independent small jobs; a few driver threads let
    # Spark run them side by side.
    lengths = typed.withColumn("zipcode_length", F.length("zipcode"))
    with ThreadPoolExecutor(max_workers=4) as pool:
        typed_job = pool.submit(PR.numeric_summary, lengths, NUMERIC + ("zipcode_length",), cache=not checkpoint)
        clean_job = pool.submit(Q.bracketed, cleaned, {c: F.col(c) for c in NUMERIC}, PR.QUARTILES, cache=not checkpoint)
        list(pool.map(lambda h: h.count(), (h_typed, h_clean)))
        found = clean_job.result()
        iqr_job = pool.submit(PR.iqr_stats, cleaned, INTEGER_COLUMNS, quantiles={c: found[c].quantiles for c in INTEGER_COLUMNS if c in found})
        summary_typed, iqr = typed_job.result(), iqr_job.result()
    out = {
        # before dedup
        "numeric_summary_raw": summary_typed.filter(F.col("column") != "zipcode_length"),
        "zipcode_length_summary": summary_typed.filter(F.col("column") == "zipcode_length"),
        "column_info": PR.column_info(typed),
        "integer_safe": PR.integer_safe(typed, INTEGER_COLUMNS),
        "boolean_safe": PR.boolean_safe(typed, FLAG_COLUMNS, hist=h_typed),
        "build_year_tails": PR.build_year_tails(typed, hist=h_typed),
        "zipcode_length_rows": PR.zipcode_length_rows(typed),
        "whole_row_duplicates": PR.whole_row_duplicates(typed),
        "key_duplicates": PR.key_duplicates(typed, (key,)),
        "key_start_duplicates": PR.key_duplicates(typed, (key, "start_date")),
        "future_build_year": PR.future_build_year(typed),
        "date_inversions": PR.date_inversions(typed),
        "missing_flag_rows": PR.missing_rows(typed, "is_furnished"),
        "two_digit_zip_city_pairs": PR.pair_counts(typed, "zipcode", "city", F.length("zipcode") == 2),
        "distinct_build_years": PR.distinct_values(typed, "build_year"),
        # after dedup
        "numeric_summary_clean": PR.summary_frame(cleaned.sparkSession, found),
        "iqr_stats": iqr,
        "value_counts": PR.value_counts(cleaned, cats, hist=h_clean),
        "level_shares": PR.level_shares(cleaned, tuple(cats) + FLAG_COLUMNS, hist=h_clean),
        "integer_distribution": PR.integer_distribution(cleaned, INTEGER_COLUMNS, hist=h_clean),
        "missing_share": PR.missing_share(cleaned),
        "zipcode_city_dependency": PR.dependency_violations(cleaned, "zipcode", "city"),
        "zscore_outliers": PR.zscore_outliers(cleaned, NUMERIC),
        "zscore_complete_case_int": PR.zscore_complete_case(cleaned, INTEGER_COLUMNS),
        "zscore_complete_case_float": PR.zscore_complete_case(cleaned, ("price", "area", "site_area")),
        "date_range": PR.date_range(cleaned),
    }
    if "item_subtype" in typed.columns and "item_type" in typed.columns:
        out["hierarchy_mismatch"] = PR.hierarchy_mismatch(typed)
    if "item_subtype" in cleaned.columns and "item_type" in cleaned.columns:
        out["subtype_type_dependency"] = PR.dependency_violations(cleaned, "item_subtype", "item_type")
    return out


def write_report(report: dict[str, DataFrame], root: str, workers: int = 4) -> dict[str, str]:
    """Write every profile result as parquet under ``root`` (one folder per
    result) and return the paths.

    Results stay on shared storage, never on the driver: some are row-level
    (duplicates, outliers) and grow with the data. The writes are
    independent jobs, submitted from a few driver threads so Spark can run
    them side by side.
    """
    root = root.rstrip("/")

    def write(item):
        name, df = item
        path = f"{root}/{name}"
        df.write.mode("errorifexists").parquet(path)
        return name, path

    with ThreadPoolExecutor(max_workers=workers) as pool:
        return dict(pool.map(write, report.items()))
