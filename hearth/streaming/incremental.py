"""The ingest job (K2) as a Structured Streaming query over a landing folder.

New JSON-lines (or CSV) files in ``landing_dir`` are read as text, like a
batch; each micro-batch runs the same clean -> validate -> upsert job as the
batch ingest (``foreachBatch``), producing new table versions. The stream's
checkpoint (``checkpoint_location``, a shared folder) records which files
were processed, so a restarted query neither skips nor repeats a file, and
re-running an interrupted batch is harmless because the upsert of a batch
is idempotent.

No event-time state is involved: the job keeps no state between batches
other than the tables themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from hearth.plans.ingest import ingest_frame
from hearth.plans.policies import TransformPolicy
from hearth.schema import TEXT_SCHEMA
from hearth.sources.files import CSV_OPTIONS, JSON_OPTIONS


def start_incremental_ingest(
    spark: SparkSession,
    landing_dir: str,
    store_root: str,
    checkpoint_location: str,
    fmt: str = "json",
    policy: TransformPolicy = TransformPolicy(),
    enforce: str = "reject",
    max_files_per_trigger: int | None = None,
    available_now: bool = False,
    processing_time: str | None = None,
    buckets: dict | None = None,
) -> StreamingQuery:
    reader = spark.readStream.schema(TEXT_SCHEMA)
    if fmt == "json":
        reader = reader.options(**JSON_OPTIONS)
        stream = reader.option("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger else reader
        df = stream.json(landing_dir)
    elif fmt == "csv":
        reader = reader.options(**CSV_OPTIONS)
        stream = reader.option("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger else reader
        df = stream.csv(landing_dir)
    else:
        raise ValueError(f"Unsupported input format: {fmt!r}")

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            ingest_frame(batch, store_root, policy, enforce, buckets=buckets)

    w = df.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint_location)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
