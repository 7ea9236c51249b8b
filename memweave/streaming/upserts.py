"""Incremental upserts fed as a stream of batches.

New batch files land in a folder; a Structured Streaming file source picks
them up and ``foreachBatch`` applies the classified upsert (U3) to the touched
partitions of the persisted store. A re-run micro-batch (after a failure) is
harmless: the upsert is idempotent and its report is written per epoch with
overwrite.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memweave.sources import store


def run_upsert_stream(spark: SparkSession, *, source_dir: str, schema, state_path: str, checkpoint_path: str,
                      report_path: str, metadata_cols: list[str], files_per_batch: int | None = 1,
                      available_now: bool = True, timeout_s: int | None = None):
    """Start the stream; with ``available_now`` it processes what is there and stops.

    ``files_per_batch=None`` takes all new files as one batch, for batches of many part files: run the stream
    after each arrival. ``timeout_s`` (off by default) stops and fails a query that takes longer.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(source_dir)

    def apply(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.persist()
        report = store.apply_classified_upsert(spark, state_path, batch, metadata_cols=metadata_cols)
        (report.withColumn("epoch", F.lit(epoch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(report_path))
        batch.unpersist()

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint_path)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    query = writer.start()
    if available_now:
        finish(query, timeout_s)
    return query


def finish(query, timeout_s: int | None) -> None:
    """Wait for an available-now query; stop it and fail if it does not finish in time."""
    done = query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination()
    if done is False:
        query.stop()
        raise TimeoutError(f"streaming query {query.name or query.id} did not finish in {timeout_s} s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
