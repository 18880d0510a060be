"""Incremental ingest: a file stream, deduplicated under a watermark, merged into per-key state by each micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partsieve.operators.merge import merge


def latest_per_user(events: DataFrame) -> DataFrame:
    """Last event of each user, by time and id: user_id, event_id, ts, event_type, value."""
    return merge(events, ["user_id"], ["ts", "event_id"], {c: "last" for c in ("event_id", "ts", "event_type", "value")})


def ingest(spark: SparkSession, folder: str, pattern: str, target: str, checkpoint: str, late: str = "60 days") -> None:
    """Runs the files of a folder that match once through the stream: every batch becomes one folder of target, named by its id.

    A batch that runs again after a failure overwrites its own folder, so each event counts once.
    """
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])

    def write(batch: DataFrame, number: int) -> None:
        latest_per_user(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def ingested(spark: SparkSession, target: str) -> DataFrame:
    """State after all batches: the last event of each user over all of them."""
    return latest_per_user(spark.read.parquet(target).drop("batch")).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def windowed_counts(events: DataFrame, every: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Events by type and window of event time; works on streams (under a watermark) and on tables."""
    seen = events.withWatermark("ts", late) if events.isStreaming else events
    return seen.groupBy(F.window("ts", every).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")
