"""P5: running token-usage counters over a stream of chat messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memweave.operators.tokens import count_tokens
from memweave.streaming.upserts import finish


def usage_counters(messages: DataFrame, *, count_mode: str = "whitespace") -> DataFrame:
    """Streaming aggregate: messages and tokens per role (complete output mode)."""
    tok = messages.withColumn("_tokens", count_tokens(F.col("text"), count_mode).cast("bigint"))
    return tok.groupBy("role").agg(F.count(F.lit(1)).alias("n_messages"), F.sum("_tokens").alias("tokens"))


def run_usage_stream(spark: SparkSession, *, source: str, schema, out_path: str, checkpoint_path: str,
                     glob: str | None = None, files_per_batch: int = 1, timeout_s: int | None = None):
    """Each trigger rewrites the counter snapshot at ``out_path``; ``source`` is a folder."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    msgs = reader.parquet(source)

    def publish(snapshot: DataFrame, epoch_id: int) -> None:
        snapshot.write.mode("overwrite").parquet(out_path)

    query = (usage_counters(msgs).writeStream.outputMode("complete").foreachBatch(publish)
             .option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start())
    finish(query, timeout_s)
    return query
