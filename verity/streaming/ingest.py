"""foreachBatch ingestion: each micro-batch of new raw files is one run."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from verity import schemas
from verity.plans.job import BatchPaths, run_batch
from verity.plans.pipeline import CurationConfig


def start_ingest(spark: SparkSession, paths: BatchPaths, checkpoint_location: str,
                 config: CurationConfig | None = None, run_prefix: str = "stream",
                 available_now: bool = True, max_files_per_trigger: int | None = None,
                 merge_scope: str = "days", **batch_options) -> StreamingQuery:
    """Start the stream; returns the query (``awaitTermination()`` to wait).
    ``batch_options`` go to every ``run_batch``.

    A streaming file source maps columns by position, so landed files must
    carry the declared raw column order (the batch reader also matches
    standardised header names).

    The run id of a micro-batch is ``<run_prefix>-<batch id>``. A replayed
    batch (after a failure) gets the same id, and every write is a dynamic
    partition overwrite keyed by it, so replays replace instead of adding.
    """
    reader = spark.readStream.schema(schemas.RAW_TRANSACTIONS).option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(paths.raw_transactions)

    def process(batch: DataFrame, batch_id: int) -> None:
        run_batch(batch.sparkSession, paths, f"{run_prefix}-{batch_id}", config,
                  merge=True, merge_scope=merge_scope, transactions=batch, **batch_options)

    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation",
                                                             checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
