"""K2: the ingest job, raw feed -> validated upsert of both tables.

One pass over the raw input:

1. read the feed with an explicit schema (S1/S2);
2. prepare + dedup in one plan; ``Observation``s collect the raw, prepared
   and deduplicated row counts and the maximum start year (A2, A3) as side
   metrics of that same pass;
3. the deduplicated frame is written as parquet (into the shared folder
   named by ``spark.checkpoint.dir``), which cuts the lineage: validation
   and the two table writes reread it instead of the raw feed, and a lost
   executor rereads the staged table, not the feed;
4. the build-year rewrite uses the observed maximum as a literal;
5. rules R1–R9 are checked before anything is written ('fail' raises,
   'reject' writes the violations once and keeps only clean keys). Spark's
   own size checks decide how the batch's keys meet the stored table;
6. the tables are written in one of two forms. As versions: item_category
   first, then listing (FK order), each a new version (all-or-nothing per
   table), the listing sorted by ``change_date`` within files. In buckets
   (``buckets``): only the buckets that the batch changes are read and
   written, both tables become current together, and a batch that is stored
   already writes nothing (``hearth.sources.buckets``).

Row counts of staged and written tables come from their files' footers.
``Observation`` counts those that are never written (raw and prepared rows);
Spark may count a task's rows twice there if the task is run again.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hearth.operators import integrity as R
from hearth.operators.clean import item_categories, listing_projection
from hearth.operators.upsert import merge_upsert
from hearth.plans.pipeline import dedup_stage, finish_stage, prepare, staged_table
from hearth.plans.policies import TransformPolicy
from hearth.schema import CORRUPT_COLUMN, ITEM_CATEGORY_KEY, ITEM_CATEGORY_SCHEMA, LISTING_KEY, LISTING_SCHEMA
from hearth.sources.buckets import BucketStore
from hearth.sources.files import read_input
from hearth.sources.footers import footer_counts
from hearth.sources.tables import TableStore

log = logging.getLogger(__name__)

ENFORCE_POLICIES = ("fail", "reject")


class IntegrityError(ValueError):
    """A batch breaks an integrity rule under the 'fail' policy."""


@dataclass
class IngestReport:
    metrics: dict = field(default_factory=dict)
    written: dict = field(default_factory=dict)


def ingest(
    spark: SparkSession,
    input_path: str,
    store_root: str,
    fmt: str = "json",
    options: dict | None = None,
    policy: TransformPolicy = TransformPolicy(),
    enforce: str = "fail",
    partitions: dict | None = None,
    buckets: dict | None = None,
) -> IngestReport:
    """K2 over a file feed (S1/S2 -> clean -> validate -> upsert both tables)."""
    return ingest_frame(read_input(spark, input_path, fmt, options), store_root, policy, enforce, partitions, buckets)


def keyed_tables(spark: SparkSession, store_root: str) -> BucketStore:
    """The tables that an ingest with ``buckets`` writes."""
    return BucketStore(spark, f"{store_root.rstrip('/')}/keyed")


def ingest_frame(
    raw: DataFrame,
    store_root: str,
    policy: TransformPolicy = TransformPolicy(),
    enforce: str = "fail",
    partitions: dict | None = None,
    buckets: dict | None = None,
) -> IngestReport:
    """K2 over any raw DataFrame (a file feed or a streaming micro-batch).

    ``buckets`` (table -> number of buckets, fixed by the first ingest; one
    where not given) keeps the tables in key buckets; without it each ingest
    writes new versions. One store keeps to one form.
    """
    if enforce not in ENFORCE_POLICIES:
        raise ValueError(f"unknown enforce policy {enforce!r} (expected one of {ENFORCE_POLICIES})")
    spark = raw.sparkSession
    partitions = partitions or {}
    report = IngestReport()

    obs_raw, obs_pre = Observation("raw"), Observation("prepared")
    feed = raw
    corrupt = F.col(CORRUPT_COLUMN).isNotNull() if CORRUPT_COLUMN in raw.columns else F.lit(False)
    raw = raw.observe(obs_raw, F.count(F.lit(1)).alias("raw_rows"), F.count_if(corrupt).alias("corrupt_lines"))
    pre = prepare(raw, policy)
    has_start = "start_date" in pre.columns
    pre = pre.observe(
        obs_pre,
        F.count(F.lit(1)).alias("prepared_rows"),
        (F.count_if(F.col("listing_id").isNull()) if "listing_id" in pre.columns else F.count(F.lit(1))).alias("null_key_rows"),
        (F.max(F.year("start_date")) if has_start else F.lit(None).cast("int")).alias("max_start_year"),
    )
    staged = staged_table(dedup_stage(pre, policy, each_null_key=True))
    for obs in (obs_raw, obs_pre):
        report.metrics.update(obs.get)
    report.metrics["batch_listings"] = footer_counts(staged)["rows"]
    store = TableStore(spark, store_root)
    if report.metrics["corrupt_lines"]:
        # Spark asks for a second column beside the corrupt one
        lines = feed.filter(corrupt).select(CORRUPT_COLUMN, "listing_id")
        report.written["corrupt_lines"] = store.write_version("corrupt_lines", lines)
        if enforce == "fail":
            raise IntegrityError(f"{report.metrics['corrupt_lines']} lines are no records; they are in {report.written['corrupt_lines']}")
    max_year = report.metrics.get("max_start_year")
    final = finish_stage(staged, policy, F.lit(max_year).cast("int"))

    cats, listing = item_categories(final), listing_projection(final)
    if buckets is None:
        old_cats = store.read("item_category", ITEM_CATEGORY_SCHEMA)
        old_listing = store.read("listing", LISTING_SCHEMA)
    else:
        keyed = keyed_tables(spark, store_root)
        keyed.create("item_category", ITEM_CATEGORY_SCHEMA, ITEM_CATEGORY_KEY, buckets.get("item_category", 1))
        keyed.create("listing", LISTING_SCHEMA, LISTING_KEY, buckets.get("listing", 1))
        old_cats = keyed.read("item_category")
        old_listing = keyed.near("listing", listing)

    cat_bad = R.category_row_violations(cats)  # one row per subcategory by construction
    if enforce == "reject":
        cats = R.reject(cats, cat_bad, "subcategory")
    merged_cats = merge_upsert(old_cats, cats, ITEM_CATEGORY_KEY)
    lst_bad = (
        R.listing_row_violations(listing)
        .unionByName(R.foreign_key_violations(listing, merged_cats))
        .unionByName(R.update_violations(old_listing, listing))
    )
    if not policy.deduplicate:  # keep-latest leaves one row per key
        lst_bad = lst_bad.unionByName(R.key_violations(listing, "listing_id"))
    violations = cat_bad.withColumn("table", F.lit("item_category")).unionByName(
        lst_bad.withColumn("table", F.lit("listing"))
    )
    # Written once, then reread: nothing below evaluates a rule again.
    report.written["rejects"] = store.write_version("rejects", violations)
    stored = spark.read.parquet(report.written["rejects"])
    if enforce == "fail":
        broken = {r["rule"]: r["count"] for r in stored.groupBy("rule").count().collect()}
        if broken:
            raise IntegrityError(f"batch breaks integrity rules {broken}; all violations are in {report.written['rejects']}")
    else:
        bad_listings = stored.filter(F.col("table") == "listing")
        report.metrics["rejected_listings"] = bad_listings.select("key").distinct().count()
        listing = R.reject(listing, bad_listings, "listing_id")

    report.metrics["category_rows"] = cats.count()  # one row per subcategory
    if buckets is not None:
        report.written.update(keyed.upsert({"item_category": cats, "listing": listing}))
        return report
    if report.metrics["category_rows"] == 0:
        log.info("no category rows to write")
    else:
        report.written["item_category"] = store.write_version(
            "item_category", merged_cats, partitions.get("item_category")
        )
    report.written["listing"] = store.write_version(
        "listing",
        merge_upsert(old_listing, listing, LISTING_KEY),
        partitions.get("listing"),
        ["change_date"],
    )
    return report


def main(argv=None) -> None:
    """Command line: ``spark-submit -m hearth.plans.ingest --input ... --store ...``
    (or ``python -m hearth.plans.ingest``); the session comes from the
    launcher's configuration."""
    import argparse
    import json

    ap = argparse.ArgumentParser(description="Clean, validate and upsert a listings feed into versioned tables.")
    ap.add_argument("--input", required=True, help="feed path (file, folder or glob)")
    ap.add_argument("--store", required=True, help="root folder of the versioned tables")
    ap.add_argument("--format", default="json", choices=("json", "csv"))
    ap.add_argument("--enforce", default="fail", choices=ENFORCE_POLICIES)
    ap.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="reader option (repeatable)")
    ap.add_argument("--no-dedup", action="store_true")
    ap.add_argument("--no-normalize-enum", action="store_true")
    ap.add_argument("--no-unixtime", action="store_true", help="dates are text, not epoch milliseconds")
    ap.add_argument("--keep-negative", action="store_true")
    ap.add_argument("--keep-invalid-zipcode", action="store_true")
    ap.add_argument("--no-two-digit-zipcode", action="store_true")
    ap.add_argument("--zipcode-regex", default=TransformPolicy.zipcode_regex)
    ap.add_argument("--build-year-policy", default="adjust", choices=("adjust", "drop"))
    ap.add_argument("--change-date-policy", default="adjust", choices=("adjust", "drop"))
    ap.add_argument("--listing-partitions", type=int)
    ap.add_argument("--category-partitions", type=int)
    ap.add_argument("--listing-buckets", type=int, help="keep the tables in key buckets, the listing in so many")
    a = ap.parse_args(argv)
    policy = TransformPolicy(
        date_as_unixtime=not a.no_unixtime,
        normalize_enum=not a.no_normalize_enum,
        enforce_non_negative=not a.keep_negative,
        drop_invalid_zipcode=not a.keep_invalid_zipcode,
        normalize_two_digits_zc=not a.no_two_digit_zipcode,
        zipcode_regex=a.zipcode_regex,
        adjust_build_year_policy=a.build_year_policy,
        adjust_change_date_policy=a.change_date_policy,
        deduplicate=not a.no_dedup,
    )
    options = dict(o.split("=", 1) for o in a.option)
    spark = SparkSession.builder.appName("hearth-ingest").getOrCreate()
    report = ingest(
        spark, a.input, a.store, a.format, options, policy, a.enforce,
        {"listing": a.listing_partitions, "item_category": a.category_partitions},
        {"listing": a.listing_buckets} if a.listing_buckets else None,
    )
    print(json.dumps({"metrics": report.metrics, "written": report.written}, default=str))


if __name__ == "__main__":
    main()
