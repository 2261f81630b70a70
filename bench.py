"""Headline timings at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Workloads (what a user of the listings engine runs):

* ``clean_pipeline``  K1 over the driver tables (listing + item_category),
                      materialized once (one pass over the feed);
* ``ingest_job``      K2: JSON feed -> clean -> validate -> upsert into a store;
* ``search``          four listing searches (page + total each, as concurrent
                      jobs) and a category page over the stored tables;
* ``upsert``          an incoming batch (cleaned in one pass) merged into the
                      stored table;
* ``profile``         the full data-quality profile (A5–A22, F21–F27) over the
                      raw feed and the stored listing table, each read once,
                      with every result written as parquet.

Setup (writing the JSON feed, the first ingest) is not timed. Every query
runs to completion (``noop`` sink or a small collect) once as warm-up and
``BENCH_REPEAT`` times; the median is reported and ``value`` is their sum.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from hearth.operators import search as S  # noqa: E402
from hearth.operators.clean import cast_known_columns, to_timestamps  # noqa: E402
from hearth.operators.upsert import merge_upsert  # noqa: E402
from hearth.plans.ingest import ingest  # noqa: E402
from hearth.plans.pipeline import clean_listings  # noqa: E402
from hearth.plans.profile_report import profile_report, write_report  # noqa: E402
from hearth.registry import ENTRY_PARAMS, SEARCHES, SHIFT_MOD  # noqa: E402
from hearth.session import local_session, scratch_path  # noqa: E402
from hearth.sources.files import read_input, write_feed  # noqa: E402
from hearth.sources.fixture import raw_listings  # noqa: E402
from hearth.sources.tables import TableStore  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


class Bench:
    def __init__(self, spark):
        self.spark = spark
        self.feed = write_feed(raw_listings(spark, SF_DIR), scratch_path(spark, "bench-feed"), "json")
        self.store_root = scratch_path(spark, "bench-store")
        ingest(spark, self.feed, self.store_root, "json", enforce="reject")
        store = TableStore(spark, self.store_root)
        self.listing_path = store.current_path("listing")
        self.category_path = store.current_path("item_category")

    def tables(self):
        return self.spark.read.parquet(self.category_path), self.spark.read.parquet(self.listing_path)

    def clean_pipeline(self):
        cats, lst = clean_listings(raw_listings(self.spark, SF_DIR), materialize=True)
        run(lst)
        run(cats)

    def ingest_job(self):
        ingest(self.spark, self.feed, scratch_path(self.spark, "bench-run"), "json", enforce="reject")

    def search(self):
        cats, lst = self.tables()
        for params in (ENTRY_PARAMS, SEARCHES["f16_composed_search"][0], SEARCHES["f9_city_contains_ci"][0],
                       {"zipcode": "75", "sort_by_change_date": "asc", "skip": 100, "limit": 50}):
            S.fetch_listings(lst, cats, params)
        page, total = S.search_categories(cats, "HOUSE")
        page.collect()
        total.collect()

    def upsert(self):
        _, lst = self.tables()
        incoming = self.upsert_incoming()
        run(merge_upsert(lst, incoming, ("listing_id",)))

    def profile(self):
        typed = to_timestamps(cast_known_columns(read_input(self.spark, self.feed, "json"))).drop("description_fr")
        _, lst = self.tables()
        write_report(profile_report(typed, lst), scratch_path(self.spark, "bench-profile"))

    def upsert_incoming(self):
        return clean_listings(
            raw_listings(self.spark, SF_DIR, lineitem_filter=F.col("l_linenumber") > 3, start_shift_mod=SHIFT_MOD),
            materialize=True,
        )[1]


HEADLINE = ("clean_pipeline", "ingest_job", "search", "upsert", "profile")


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    b = Bench(spark)
    times, errors = {}, {}
    for name in HEADLINE:
        fn = getattr(b, name)
        try:
            fn()  # warm-up
            runs = []
            for _ in range(REPEAT):
                t0 = time.perf_counter()
                fn()
                runs.append(time.perf_counter() - t0)
            times[name] = round(statistics.median(runs), 3)
        except Exception as e:  # report the failure in the one JSON line
            times[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:300]}"
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum of median seconds over headline workloads",
        "value": round(sum(t for t in times.values() if t is not None), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(CPUS),
        "repeat": REPEAT,
        **({"errors": errors} if errors else {}),
    }), flush=True)


if __name__ == "__main__":
    main()
