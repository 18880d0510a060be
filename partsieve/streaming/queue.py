"""A work queue as a stream: what was done to each item, with which version, and which items are to be done again.

Results arrive as rows; each item keeps its last one, by time. An empty result is taken back after a delay, by a timer in
event time, unless another result comes first. Items are dealt by hash into a fixed number of buckets, and a bucket has one
row of state and one timer for all its items: a call of the state function costs milliseconds in Spark's Python worker,
whatever it does, so one call an item would be nearly all of the work. Every micro-batch writes the items that changed into a
folder named by its number, so a batch that runs again after a failure replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

BUCKETS = 1024  # a checkpoint is kept by it
COLUMNS = ["item", "at", "number", "processed", "component_count", "version"]
UPDATES = "item string, at long, number long, processed int, component_count string, version string"
STATE = "item array<string>, at array<long>, number array<long>, processed array<int>, component_count array<string>, version array<string>"


def _updates(delay: int):
    def update(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        items, *kept = state.get if state.exists else [[] for _ in COLUMNS]
        last = dict(zip(items, zip(*kept, strict=True), strict=True))
        changed = set()
        for part in [] if state.hasTimedOut else parts:
            rows = zip(*(part[c].tolist() for c in COLUMNS if c != "processed"), strict=True)
            for item, at, number, count, version in rows:
                old = last.get(item)
                if old is None or (at, number) > old[:2]:
                    last[item] = (at, number, 1, count, version)
                    changed.add(item)
        watermark, timers = state.getCurrentWatermarkMs(), []
        for item, (at, number, processed, count, version) in last.items():
            if processed == 1 and count == "0":
                due = at // 1000 + delay
                if due < watermark:
                    last[item] = (at, number, 0, count, version)
                    changed.add(item)
                else:
                    timers.append(due)
        state.update(tuple(map(list, zip(*((item, *row) for item, row in last.items()), strict=True))))
        if timers:
            state.setTimeoutTimestamp(min(timers))
        if changed:
            yield pd.DataFrame([(item, *last[item]) for item in changed], columns=COLUMNS)

    return update


def queue_updates(results: DataFrame, delay: int, late: str) -> DataFrame:
    """results: a stream of item, ts, number, component_count, version. Changed items with their state; delay in milliseconds.

    Of results with the same time the one with the greatest number is the last; a result without a time is later than all others
    and never due. Rows later than late are dropped. Items and counts go to pandas as text, since nulls would turn whole numbers
    into floats: items are numbers, dates or text. at is in microseconds.
    """
    item = results.schema["item"].dataType
    at = F.coalesce(F.unix_micros("ts"), F.lit(2**63 - 1)).alias("at")
    bucket = F.pmod(F.xxhash64("item"), F.lit(BUCKETS)).alias("bucket")
    count = F.col("component_count").cast("long").cast("string").alias("component_count")
    rows = results.withWatermark("ts", late).select(bucket, "ts", F.col("item").cast("string").alias("item"), at, "number", count, F.col("version").cast("string").alias("version"))
    found = rows.groupBy("bucket").applyInPandasWithState(_updates(delay), UPDATES, STATE, "update", GroupStateTimeout.EventTimeTimeout)
    return found.withColumns({"item": F.col("item").cast(item), "component_count": F.col("component_count").cast("long")})


def run_queue(spark: SparkSession, folder: str, target: str, checkpoint: str, result: dict[str, Column], delay: int, late: str) -> None:
    """Runs what is new in a folder of Parquet files through the queue; the state of earlier runs is in checkpoint."""
    stream = spark.readStream.schema(spark.read.parquet(folder).schema).parquet(folder).select(*[c.alias(n) for n, c in result.items()])

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    updates = queue_updates(stream, delay, late)
    updates.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def queue_state(spark: SparkSession, target: str) -> DataFrame:
    """item, processed, component_count, version after all batches."""
    rows = spark.read.parquet(target)
    last = rows.groupBy("item").agg(F.max_by(F.struct("processed", "component_count", "version"), "batch").alias("last"))
    return last.select("item", "last.*")


def to_do(state: DataFrame, version: str) -> Column:
    """Whether an item of queue_state is to be done: taken back, or last done with another version."""
    return (state["processed"] == 0) | ~state["version"].eqNullSafe(F.lit(version))
