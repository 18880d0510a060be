"""Links between records of different sources: shared keys, titles, token similarity."""

from __future__ import annotations

import heapq
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partsieve.operators.components import components
from partsieve.staging import Stages


def cross_references(rows: DataFrame) -> DataFrame:
    """rows: id, source, key. Pairs id_a < id_b of different sources with the same key, first record of each source.

    At most one record a source and key goes on, so a key gives no more pairs than sources have pairs.
    """
    first = rows.where("key is not null").groupBy("key", "source").agg(F.min("id").alias("id"))
    a, b = first.alias("a"), first.alias("b")
    met = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.source") != F.col("b.source")) & (F.col("a.id") < F.col("b.id")))
    return met.select(F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b")).distinct()


def last_per_key(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key: what a lookup table holds after a scan."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def token_jaccard(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """left: a, tokens; right: b, tokens (distinct). Pairs a, b, score with a Jaccard similarity of least or more.

    Only the rarest tokens of each set are joined on: two sets that reach the threshold share one of the first
    size - ceil(least * size) + 1 in any common order, here by frequency. Tokens of every title are so left out.
    """
    tokens = left.select(F.explode("tokens").alias("t")).unionAll(right.select(F.explode("tokens").alias("t")))
    rank = tokens.groupBy("t").agg(F.count("*").alias("n"))

    def prefixes(rows: DataFrame, key: str) -> DataFrame:
        ranked = rows.select(key, F.explode("tokens").alias("t")).join(rank, "t").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("n", "t"))).alias("r"))
        first = F.slice("r", 1, (F.size("r") - F.ceil(F.lit(least) * F.size("r")) + 1).cast("int"))
        return ranked.select(key, F.explode(F.transform(first, lambda x: x["t"])).alias("t"))

    met = prefixes(left, "a").join(prefixes(right, "b"), "t").select("a", "b").distinct()
    both = met.join(left.toDF("a", "x"), "a").join(right.toDF("b", "y"), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return both.select("a", "b", (shared / (F.size("x") + F.size("y") - shared)).alias("score")).where(F.col("score") >= least)


def greedy_pairs(scored: DataFrame, rounds: int = 1000) -> DataFrame:
    """a, b, score: every a in order takes its best b (highest score, then least b) that no a before it took.

    Each round settles all a that are first in order at their best b among those still open, so the choice equals the
    one made row by row, and no task sees all pairs. The first a of all is always settled. Each round is written, so plans
    do not grow; pairs that are still open after all rounds raise an error, none is dropped.
    """
    stages = Stages(scored.sparkSession, "pairs")
    left, won_by_round = stages.write(scored.select("a", "b", "score"), "left"), []
    for _ in range(rounds):
        if left.isEmpty():
            break
        best = left.groupBy("a").agg(F.min(F.struct((-F.col("score")).alias("score"), "b")).alias("m")).select("a", F.col("m.b").alias("b"), (-F.col("m.score")).alias("score"))
        first = left.groupBy("b").agg(F.min("a").alias("first"))
        won = stages.write(best.join(first, "b").where("a = first").select("a", "b", "score"), "won")
        won_by_round.append(won)
        still = stages.write(left.join(won.select("a"), "a", "left_anti").join(won.select("b"), "b", "left_anti"), "left")
        stages.drop(left)
        left = still
    else:
        if not left.isEmpty():
            raise RuntimeError(f"pairs are still open after {rounds} rounds: allow more")
    return reduce(DataFrame.unionByName, won_by_round) if won_by_round else left


def _taken_in_order(rows: pd.DataFrame) -> pd.DataFrame:
    """The pairs of one component: side 0 links class id to class other by score, side 1 is a right id and its class, side 2 a left id and its class."""
    links, right, left = (rows[rows["side"] == k] for k in (0, 1, 2))
    open_b, at = {c: np.sort(g.to_numpy()) for c, g in right.groupby("other")["id"]}, {}
    levels: dict[int, list] = {}
    for a, score, b in sorted(zip(links["id"], -links["score"], links["other"], strict=True)):
        own = levels.setdefault(a, [])
        if not own or own[-1][0] != score:
            own.append((score, []))
        own[-1][1].append((open_b[b][0], b))
    for own in levels.values():
        own.reverse()
        for _, heads in own:
            heapq.heapify(heads)
    out = []
    for a, c in left.sort_values("id")[["id", "other"]].itertuples(index=False):
        own = levels[c]
        while own:
            score, heads = own[-1]
            while heads:  # a head that others took since is replaced by its class's next
                b, of = heads[0]
                k = at.get(of, 0)
                if k == len(open_b[of]):
                    heapq.heappop(heads)
                elif open_b[of][k] != b:
                    heapq.heapreplace(heads, (open_b[of][k], of))
                else:
                    break
            if heads:
                at[of] = k + 1
                out.append((a, b, -score))
                break
            own.pop()
    return pd.DataFrame(out, columns=["a", "b", "score"])


def greedy_titles(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """left: a, tokens; right: b, tokens (distinct; ids are longs, once each). greedy_pairs of token_jaccard, without their pairs.

    Titles of equal tokens are one class, named by its least id, and similarities are found between classes. Of a class
    only the least b that is still there can be anyone's best, so the pairs follow from a's, b's and links of classes, in
    the order of a. Who comes later gets what is left, which is serial by nature: the titles that links of classes connect
    are one task's, at some ten bytes a title; other components run beside it.
    """
    stages = Stages(left.sparkSession, "titles")

    def classes(rows: DataFrame, what: str) -> tuple[DataFrame, DataFrame]:
        keyed = stages.write(rows.toDF("id", "tokens").withColumn("tokens", F.array_sort("tokens")), what)
        told = stages.write(keyed.groupBy("tokens").agg(F.min("id").alias("class")), f"{what}-classes")
        return keyed.join(told, "tokens").select("id", F.col("class").alias("other")), told

    (a_rows, a_told), (b_rows, b_told) = classes(left, "left"), classes(right, "right")
    links = stages.write(token_jaccard(a_told.select(F.col("class").alias("a"), "tokens"), b_told.select(F.col("class").alias("b"), "tokens"), least), "links")
    name = lambda side, c: F.concat(F.lit(side), F.col(c).cast("string"))
    group = stages.write(components(links.select(name("a", "a").alias("a"), name("b", "b").alias("b"))), "components")
    none = F.lit(None).cast("double").alias("score")
    rows = links.select(name("a", "a").alias("node"), F.lit(0).alias("side"), F.col("a").alias("id"), F.col("b").alias("other"), "score")
    rows = rows.unionAll(b_rows.select(name("b", "other"), F.lit(1), "id", "other", none)).unionAll(a_rows.select(name("a", "other"), F.lit(2), "id", "other", none))
    rows = rows.join(group, "node").select("component", "side", "id", "other", "score")
    return rows.groupBy("component").applyInPandas(_taken_in_order, "a long, b long, score double")


def best_per_pair(rows: DataFrame, pair: list[str], most: list[str], least: list[str]) -> DataFrame:
    """One row of each pair: the one with the most, then the least, of some columns."""
    w = Window.partitionBy(*pair).orderBy(*[F.col(c).desc() for c in most], *[F.col(c).asc() for c in least])
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
