"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Tokens are words. Targets are filled by weight under a cap of a multiple of each source's size. The total is cut into
blocks of BLOCK words; blocks go to sources by highest quotients target / (2k + 1), and each source's blocks go to its
shards the same way. A shard is a bounded number of documents of one source in seeded order, laid end to end as a
stream of blocks that starts over when a source is taken more than once; its quota is that many blocks from the start
of the seeded stream. A hot source has more shards, not larger ones, and gives its blocks first to racks of RACK shards
each. Only column expressions, joins and windows over a shard, a rack or the racks of a source; two windows span all
sources, one row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partsieve.llm.shared import WORD, whole, written

#: Words of a block: the grain of the quotas.
BLOCK = 16
#: Documents of a shard, about: bounds every window over documents.
SHARD_DOCS = 4096
#: Shards of a rack: bounds every window over shards.
RACK = 4096


def _apportion(parties: DataFrame, group: list[str], votes: str, seats: str, tie: list[str], out: str) -> DataFrame:
    """Column out: the integer seats of each party of a group, by Sainte-Lague.

    With p parties, V votes and N seats, the divisor lies between V / (N + p/2) and V / (N - p/2), so only the
    quotients between those two are ranked, about three a party however many the seats; those before are certain.
    Parties without votes get none; equal quotients go in the order of tie.
    """
    in_group = Window.partitionBy(*group)
    p = parties.withColumn("_v", F.sum(votes).over(in_group)).withColumn("_p", F.count("*").over(in_group))
    share = F.col(votes) / F.col("_v")
    p = p.withColumn("_low", F.when(F.col(votes) > 0, F.greatest(F.lit(0), F.floor(share * (F.col(seats) - F.col("_p") / 2) - 0.5))).otherwise(0).cast("long"))
    p = p.withColumn("_high", F.when(F.col(votes) > 0, F.ceil(share * (F.col(seats) + F.col("_p") / 2) + 1.5)).otherwise(0).cast("long"))
    p = p.withColumn("_open", F.col(seats) - F.sum("_low").over(in_group))
    k = p.select(*group, *tie, votes, "_low", "_open", F.explode(F.when(F.col("_high") > F.col("_low"), F.sequence("_low", F.col("_high") - 1)).otherwise(F.array())).alias("_k"))
    place = F.row_number().over(in_group.orderBy((F.col(votes) / (2 * F.col("_k") + 1)).desc(), *tie))
    won = k.withColumn("_place", place).where("_place <= _open").groupBy(*group, *tie).agg(F.count("*").alias("_won"))
    keys = list(dict.fromkeys([*group, *tie]))
    return p.join(won, keys, "left").withColumn(out, F.col("_low") + F.coalesce("_won", F.lit(0))).drop("_v", "_p", "_low", "_high", "_open", "_won")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """sizes: source, source_size, n_docs; adds rank and target.

    Sources in code point order, null last, take the weights in turn. Filling by weight with the excess of capped
    sources shared again is a water level: by rising cap * size / weight, the first source whose ratio exceeds the level
    left over by those before it sets the level for itself and all after it. One row a source.
    """
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    named = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("rank", F.row_number().over(order)).withColumn("weight", named)
    s = s.withColumn("limit", F.lit(float(cap)) * F.col("source_size")).withColumn("ratio", F.col("limit") / F.col("weight"))
    every = Window.partitionBy(F.lit(0))
    before = every.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    s = s.withColumn("total", F.lit(float(share)) * F.sum("source_size").over(every)).withColumn("all_weight", F.sum("weight").over(every))
    level = (F.col("total") - F.coalesce(F.sum("limit").over(before), zero)) / (F.col("all_weight") - F.coalesce(F.sum("weight").over(before), zero))
    s = s.withColumn("level", level)
    final = F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "rank", "level"))).over(every)["level"]
    return s.withColumn("target", F.least("limit", F.coalesce(F.col("weight") * final, "limit"))).select("source", "source_size", "n_docs", "rank", "target")


def n_words(text: Column) -> Column:
    """Words of a text, null: 0."""
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def _placed(rows: DataFrame, weights: tuple[float, ...], share: float, cap: float, seed: int, block: int, shard_docs: int) -> DataFrame:
    """rows: id, source, size and others; adds source_size, target, and for each row its place in its shard: pos, end (words
    up to it), shard_size, words (the shard's quota), full (times that the shard is taken as a whole), rest (words of the
    last, partial time)."""
    rows = rows.withColumn("key", F.concat(F.when(F.col("source").isNull(), "n").otherwise("s"), F.coalesce("source", F.lit(""))))
    rows = written(rows.withColumn("at", F.xxhash64(F.lit(seed), "id", "key", "size")), "mix-sizes")
    sizes = rows.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    targets = source_targets(sizes.drop("key"), weights, share, cap).withColumn("all", F.lit(0))
    every = Window.partitionBy("all")
    targets = targets.withColumn("blocks", F.round(F.sum("target").over(every) / block).cast("long"))
    quotas = _apportion(targets, ["all"], "target", "blocks", ["rank"], "quota")
    quotas = quotas.withColumn("shards", F.ceil(F.col("n_docs") / shard_docs).cast("long"))
    quotas = quotas.withColumn("key", F.concat(F.when(F.col("source").isNull(), "n").otherwise("s"), F.coalesce("source", F.lit(""))))
    quotas = written(quotas.select("key", "source_size", "target", "quota", "shards"), "mix-quotas")
    dealt = rows.join(quotas.select("key", "shards"), "key").withColumn("shard", F.pmod(F.xxhash64(F.lit("shard"), "at"), "shards")).drop("shards")
    shards = dealt.groupBy("key", "shard").agg(F.sum("size").alias("shard_size")).withColumn("rack", (F.col("shard") / RACK).cast("long"))
    shards = written(shards, "mix-shards")
    racks = shards.groupBy("key", "rack").agg(F.sum("shard_size").alias("rack_size")).join(quotas, "key")
    racks = _apportion(racks, ["key"], "rack_size", "quota", ["rack"], "rack_quota").select("key", "rack", "source_size", "target", "rack_quota")
    shards = _apportion(shards.join(racks, ["key", "rack"]), ["key", "rack"], "shard_size", "rack_quota", ["shard"], "shard_quota")
    shards = shards.select("key", "shard", "source_size", "target", "shard_size", "shard_quota")
    in_shard = Window.partitionBy("key", "shard").orderBy("at", "id", "size")
    placed = dealt.withColumn("end", F.sum("size").over(in_shard.rowsBetween(Window.unboundedPreceding, 0))).withColumn("pos", F.row_number().over(in_shard))
    placed = placed.join(shards, ["key", "shard"])
    placed = placed.withColumn("words", F.least(F.col("shard_quota") * block, (F.lit(cap) * F.col("shard_size")).cast("long")))
    full = F.expr("if(shard_size > 0, words div shard_size, 0)")
    return placed.withColumn("full", full).withColumn("rest", F.expr("if(shard_size > 0, words % shard_size, 0)"))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    seed: int = 7,
    block: int = BLOCK,
    shard_docs: int = SHARD_DOCS,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of docs: id, size, source_size, target (its source's), taken (words of it, repeats counted).

    Null texts have size 0 and are never taken; the null source is a source of its own, the last. Equal rows stand
    side by side in the seeded order and share what falls on them in an arbitrary, but always the same, way. No
    document is taken more than cap times. Reruns agree: the order hashes ids and the seed. Other columns, whatever their
    names, are not read. An empty table gives no rows; if there are no words at all, every target and taken is 0.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), n_words(F.col(text_col)).alias("size"))
    part = F.least(F.greatest(F.col("rest") - (F.col("end") - F.col("size")), F.lit(0)), F.col("size"))
    taken = (F.col("full") * F.col("size") + part).cast("long").alias("taken")
    placed = _placed(rows, weights, share, cap, seed, block, shard_docs)
    return placed.select(F.col("id").alias(id_col), "size", "source_size", "target", taken)


def mixed(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    seed: int = 7,
    block: int = BLOCK,
    shard_docs: int = SHARD_DOCS,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """The mix itself, with the columns of docs: each document as often as the mix takes it, in whole documents.

    A shard's documents that its last, partial time takes whole count; what is left of the quota behind them goes to the
    document behind them whose size is nearest to it, if that is nearer than leaving it out. Rows go by their id, null or
    not, and their text; rows that share both are one document that comes as often as all of them are taken. Texts
    without words are never taken. Columns may have any names. An empty table gives no rows.
    """
    names = docs.columns
    at, source_at, text_at = (names.index(c) for c in (id_col, source_col, text_col))
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    text = F.col(f"c{text_at}")
    rows = plain.select(F.col(f"c{at}").alias("id"), F.xxhash64(text.cast("string")).alias("tx"), F.col(f"c{source_at}").cast("string").alias("source"), n_words(text).alias("size"))
    placed = _placed(rows, weights, share, cap, seed, block, shard_docs)
    shard = Window.partitionBy("key", "shard")
    whole_time = F.col("end") <= F.col("rest")
    left = F.col("rest") - F.coalesce(F.max(F.when(whole_time, F.col("end"))).over(shard), F.lit(0))
    placed = placed.withColumn("left", left).withColumn("off", F.when(~whole_time & (F.col("size") > 0), F.abs(F.col("size") - F.col("left"))))
    placed = placed.withColumn("best", F.min(F.when(F.col("off") < F.col("left"), F.struct("off", "pos"))).over(shard))
    more = (whole_time & (F.col("size") > 0)) | F.coalesce(F.col("best.pos") == F.col("pos"), F.lit(False))
    times = placed.select("id", "tx", F.when(F.col("size") > 0, F.col("full") + more.cast("int")).otherwise(0).alias("times"))
    times = times.groupBy("id", "tx").agg(F.sum("times").cast("int").alias("times"), F.count("*").alias("n")).where("times > 0")
    times = written(times, "mix-times").toDF("mix_id", "mix_tx", "times", "n")
    keyed = plain.select(F.struct("*").alias("row"), F.col(f"c{at}").alias("id"), F.xxhash64(text.cast("string")).alias("tx"))
    both = keyed.join(times, F.col("id").eqNullSafe(F.col("mix_id")) & (F.col("tx") == F.col("mix_tx")))
    one = both.where("n = 1").select("row", "times")
    if not times.where("n > 1").isEmpty():
        one = one.unionByName(both.where("n > 1").groupBy("mix_id", "mix_tx").agg(F.first("row").alias("row"), F.first("times").alias("times")).select("row", "times"))
    return one.withColumn("time", F.explode(F.sequence(F.lit(1), "times"))).select("row.*").toDF(*names)
