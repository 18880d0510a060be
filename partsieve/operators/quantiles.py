"""Exact quantiles of groups of any size by distributed selection.

A quantile is a value, or lies between two neighbours, of a known rank. Each round counts the values of a range in
buckets, first in each task, and goes on in the bucket that holds the rank, so what is shuffled is histograms. Ranges
with few values, which small groups are from the start, are settled by sorting them; no task ever holds a large group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partsieve.staging import Stages

#: Buckets of a range, and values of a range that are sorted instead.
BUCKETS, FEW = 4096, 10_000


def _in_ranges(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows with each range of their group that holds their value; Spark broadcasts the ranges where it measures few."""
    return rows.join(ranges.select("key", "low", "high").distinct(), "key").where("value BETWEEN low AND high")


def _settled(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """key, rank, value of targets whose ranges have few values or one."""
    one = targets.where("low = high").select("key", "rank", F.col("low").alias("value"))
    few = targets.where("low < high")
    upto = Window.partitionBy("key", "low", "high").orderBy("value")
    counts = _in_ranges(rows, few).groupBy("key", "low", "high", "value").agg(F.count("*").alias("n")).withColumn("upto", F.sum("n").over(upto))
    met = few.join(counts.drop("n").withColumnRenamed("upto", "to").withColumn("from", F.lag("to", 1, 0).over(upto)), ["key", "low", "high"])
    return one.unionByName(met.where("rank - below >= from AND rank - below < to").select("key", "rank", "value"))


def exact_quantiles(rows: DataFrame, keys: Sequence[str], value: str, at: Sequence[float]) -> DataFrame:
    """keys, n, quantiles: for each group the number of its values and the array of its quantiles, interpolated between the
    two nearest ranks.

    Null values do not count, a group without others has none and is left out; null keys are a group. Values are finite:
    others raise an error. rows are read once a round, as many rounds as it takes 4096 buckets to narrow a group to a few
    values: one or two for most, more where values span very many orders of magnitude. An empty table gives no rows.
    """
    stages = Stages(rows.sparkSession, "quantiles")
    number = F.col(value).cast("double")
    odd = F.isnan(number) | (F.abs(number) == float("inf"))
    fine = F.when(odd, F.raise_error(F.lit("quantiles: a value is not finite")).cast("double")).otherwise(number)
    plain = rows.where(number.isNotNull()).select(F.struct(*keys).alias("key") if keys else F.struct(F.lit(0).alias("all")).alias("key"), (fine + 0.0).alias("value"))
    groups = stages.write(plain.groupBy("key").agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")), "groups")

    place = lambda q: (F.col("n") - 1) * F.lit(float(q))
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(place(q)).cast("long"), F.ceil(place(q)).cast("long")) for q in at])))
    targets = groups.select("key", F.explode(ranks).alias("rank"), "low", "high", F.lit(0).cast("long").alias("below"), "n")
    few = (F.col("n") <= FEW) | (F.col("low") == F.col("high"))
    settled = [targets.where(few)]
    targets = stages.write(targets.where(~few), "targets")
    while not targets.isEmpty():
        bucket = F.least(F.floor((F.col("value") / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2) * BUCKETS), F.lit(BUCKETS - 1)).cast("int")
        counts = _in_ranges(plain, targets).groupBy("key", "low", "high", bucket.alias("bucket")).agg(F.count("*").alias("in_bucket"), F.min("value").alias("least"), F.max("value").alias("most"))
        before = F.sum("in_bucket").over(Window.partitionBy("key", "low", "high").orderBy("bucket")) - F.col("in_bucket")
        met = targets.join(counts.withColumn("before", before), ["key", "low", "high"])
        found = met.where((F.col("rank") >= F.col("below") + F.col("before")) & (F.col("rank") < F.col("below") + F.col("before") + F.col("in_bucket")))
        narrowed = stages.write(found.select("key", "rank", F.col("least").alias("low"), F.col("most").alias("high"), (F.col("below") + F.col("before")).alias("below"), F.col("in_bucket").alias("n")), "targets")
        settled.append(narrowed.where(few))
        stages.drop(targets)
        targets = stages.write(narrowed.where(~few), "targets")

    done = settled[0]
    for more in settled[1:]:
        done = done.unionByName(more)
    values = _settled(plain, stages.write(done, "settled"))
    known = values.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("known"))  # two a quantile

    def quantile(q: float) -> Column:
        low, high = (F.element_at("known", f(place(q)).cast("long")) for f in (F.floor, F.ceil))
        return low + (high - low) * (place(q) - F.floor(place(q)))

    out = groups.join(known, "key")
    return out.select(*[F.col("key")[k].alias(k) for k in keys], "n", F.array(*[quantile(q) for q in at]).alias("quantiles"))
