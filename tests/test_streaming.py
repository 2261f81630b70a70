"""Incremental ingest over a landing folder equals the batch ingest."""

from pyspark.sql import functions as F

from hearth.plans.ingest import ingest
from hearth.session import scratch_path
from hearth.sources.files import write_feed
from hearth.sources.fixture import raw_listings
from hearth.sources.tables import TableStore
from hearth.streaming import start_incremental_ingest


def test_stream_of_two_files_equals_batch(spark):
    raw = raw_listings(spark, "/root/testdata/sf0.001")
    landing = scratch_path(spark, "landing")
    write_feed(raw.filter(F.col("listing_id") % 2 == 0), landing + "/a", "json")
    write_feed(raw.filter(F.col("listing_id") % 2 == 1), landing + "/b", "json")
    store = scratch_path(spark, "stream-store")
    q = start_incremental_ingest(spark, landing + "/*", store, scratch_path(spark, "stream-ckpt"), available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None
    batch_store = scratch_path(spark, "batch-store")
    ingest(spark, landing + "/*", batch_store, "json", enforce="reject")
    a = sorted(tuple(r) for r in TableStore(spark, store).read("listing").collect())
    b = sorted(tuple(r) for r in TableStore(spark, batch_store).read("listing").collect())
    assert a == b and len(a) > 0
