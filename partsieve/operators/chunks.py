"""Records packed in order into chunks under a budget, in parallel however long the order is.

The sum starts over with each chunk, which no window can express. But where a chunk ends depends on nothing but where it
begins: it ends before the first record whose running sum exceeds the sum before its beginning by more than the budget.
So every record gets a successor, by one merge of running sums sorted by value. Each range-sorted partition then tells,
for every record, where the chain of successors leaves the partition; the records at which a chain can enter one are few,
and the chain over these, from the first record of each group, is walked, or found by pointer doubling where they are many.
Running sums are windows over partitions plus the sums of the partitions before, one row a partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partsieve.staging import Stages

#: Entries of partitions that are walked on the driver, two numbers each; more are found by pointer doubling.
WALK = 1 << 17


def _parts():
    """A window over the sums of parts: one row a partition."""
    return Window.partitionBy(F.lit(0)).orderBy("part")


def _places():
    return Window.partitionBy("part").orderBy("place")


def in_order(stages: Stages, rows: DataFrame, order: Sequence[str], what: str) -> DataFrame:
    """rows written in order, with part (of a range-sorted table) and place in it; order has to tell all rows apart that are
    many, since equal rows share a part."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return stages.write(rows.orderBy(*order).withColumns({"part": F.spark_partition_id(), "place": place}), what)


def running(rows: DataFrame, sums: Mapping[str, Column]) -> DataFrame:
    """rows with sums of some values up to and with each row, in the order of in_order."""
    v = rows.withColumns({f"_value_{n}": c for n, c in sums.items()})
    ahead = v.groupBy("part").agg(*[F.sum(f"_value_{n}").alias(f"_sum_{n}") for n in sums])
    before = _parts().rowsBetween(Window.unboundedPreceding, -1)
    ahead = ahead.select("part", *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_ahead_{n}") for n in sums])
    here = _places().rowsBetween(Window.unboundedPreceding, 0)
    v = v.withColumns({f"_here_{n}": F.sum(f"_value_{n}").over(here) for n in sums}).join(F.broadcast(ahead), "part")
    return v.select(*rows.columns, *[(F.col(f"_here_{n}") + F.col(f"_ahead_{n}")).alias(n) for n in sums])


def _next_point(events: DataFrame) -> DataFrame:
    """Column found: point of the first row behind each row that has one, in the order of in_order."""
    firsts = events.groupBy("part").agg(F.min(F.when(F.col("point").isNotNull(), F.struct("place", "point"))).alias("_first"))
    # backwards, since a frame that runs to the end would be read again for each row
    behind = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    firsts = firsts.select("part", F.last("_first.point", True).over(behind(Window.partitionBy(F.lit(0)).orderBy(F.desc("part")))).alias("_later"))
    here = F.last("point", True).over(behind(Window.partitionBy("part").orderBy(F.desc("place"))))
    return events.withColumn("_here", here).join(F.broadcast(firsts), "part").withColumn("found", F.coalesce("_here", "_later")).drop("_here", "_later")


def _leaves(part: pa.Table) -> pa.Table:
    """n, leaves: where the chain from each record of a partition first leaves the partition; null if it ends inside."""
    part = part.sort_by("n")
    first, to = part.column("n")[0].as_py(), part.column("to").to_pylist()
    end = first + len(to)
    leaves: list[int | None] = [None] * len(to)
    for i in range(len(to) - 1, -1, -1):
        leaves[i] = to[i] if to[i] is None or to[i] >= end else leaves[to[i] - first]
    return pa.table({"n": part.column("n"), "leaves": pa.array(leaves, pa.int64())})


def _marked(part: pa.Table) -> pa.Table:
    """n, part, place, begins: 1 for records of a partition that the chain enters at or reaches from there."""
    part = part.sort_by("n")
    first, to, begins = part.column("n")[0].as_py(), part.column("to").to_pylist(), part.column("begins").to_pylist()
    for i, next_one in enumerate(to):
        if begins[i] and next_one is not None and next_one < first + len(to):
            begins[next_one - first] = 1
    return part.select(["n", "part", "place"]).append_column("begins", pa.array(begins, pa.int64()))


def _reached(stages: Stages, starts: DataFrame, jumps: DataFrame) -> DataFrame:
    """n: all records that chains of jumps (n, to) reach from starts (n), starts included."""
    if jumps.count() <= WALK:
        to, found = dict(jumps.collect()), set()
        for (n,) in starts.join(jumps, "n", "left_semi").collect():
            while n is not None and n not in found:
                found.add(n)
                n = to.get(n)
        walked = starts.sparkSession.createDataFrame([(n,) for n in sorted(found)], "n long")
        return starts.unionByName(walked).distinct()
    reached = starts
    while True:
        more = stages.write(reached.join(jumps, "n").select(F.col("to").alias("n")), "more")
        if more.isEmpty():
            return reached.distinct()
        reached = stages.write(reached.unionByName(more).distinct(), "reached")
        onward = jumps.select(F.col("n").alias("to"), F.col("to").alias("onward"))
        jumps = stages.write(jumps.join(onward, "to").select("n", F.col("onward").alias("to")), "jumps")


def budget_chunks(rows: DataFrame, keys: Sequence[str], order: Sequence[str], cost: str, most: int) -> DataFrame:
    """rows with column chunk, from 0 in each group: records in order, a new chunk where the budget would be passed; none is split.

    A record above the budget is a chunk of its own. Null costs count 0, null keys are a group; costs are whole numbers of
    0 or more. Without keys all rows are one order. An empty table gives no rows. order tells the records of a group apart
    (equal ones are taken in any order); column names may not begin with an underscore.
    """
    stages = Stages(rows.sparkSession, "chunks")
    names = rows.columns
    plain = rows.select(F.struct("*").alias("row"), F.struct(*keys).alias("key") if keys else F.lit(0).alias("key"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.coalesce(F.col(cost).cast("long"), F.lit(0)).alias("cost"))
    told = in_order(stages, plain, ["key", *(f"o{i}" for i in range(len(order)))], "rows").select("row", "key", "cost", "part", "place")
    told = running(told, {"n": F.lit(1).cast("long"), "upto": F.col("cost")})
    told = stages.write(told.withColumn("before", F.col("upto") - F.col("cost")), "sums")

    # the first record whose running sum exceeds a value: sums (points) and values (probes) sorted together, each value once
    points = told.where("cost > 0").groupBy(F.col("upto").alias("value")).agg(F.min("n").alias("point"))
    probes = told.select((F.col("before") + most).alias("value")).distinct()
    events = points.withColumn("probe", F.lit(0)).unionByName(probes.select("value", F.lit(None).cast("long").alias("point"), F.lit(1).alias("probe")))
    found = _next_point(in_order(stages, events, ["value", "probe"], "events")).where("probe = 1").select((F.col("value") - most).alias("before"), "found")
    groups = stages.write(told.groupBy("key").agg(F.min("n").alias("first"), F.max("n").alias("last")), "groups")
    after = F.when(F.col("cost") > most, F.col("n") + 1).otherwise(F.col("found"))
    chain = told.select("n", "key", "before", "cost", "part", "place").join(found, "before").join(groups if keys else F.broadcast(groups), "key")
    chain = stages.write(chain.select("n", "part", "place", F.when(after <= F.col("last"), after).alias("to")), "chain")

    leaves = stages.write(chain.groupBy("part").applyInArrow(_leaves, "n long, leaves long"), "leaves")
    starts = groups.select(F.col("first").alias("n"))
    entries = leaves.where("leaves is not null").select(F.col("leaves").alias("n")).unionByName(starts).distinct()
    jumps = stages.write(leaves.where("leaves is not null").join(entries, "n", "left_semi").select("n", F.col("leaves").alias("to")), "jumps")
    entered = _reached(stages, starts, jumps).withColumn("begins", F.lit(1).cast("long"))
    marked = chain.join(entered, "n", "left").withColumn("begins", F.coalesce("begins", F.lit(0)))
    marked = stages.write(marked.groupBy("part").applyInArrow(_marked, "n long, part int, place long, begins long"), "marked")
    numbers = running(marked, {"number": F.col("begins")}).select("n", "number")
    numbers = stages.write(told.select("row", "key", "n").join(numbers, "n").select("row", "key", "number"), "numbers")
    firsts = numbers.groupBy("key").agg(F.min("number").alias("first"))
    return numbers.join(firsts if keys else F.broadcast(firsts), "key").select(*[F.col("row")[c].alias(c) for c in names], (F.col("number") - F.col("first")).alias("chunk"))
