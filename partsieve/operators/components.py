"""Connected components of an edge list: forests of bounded parts of it, joined by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partsieve.staging import Stages

#: Edges of a part, about.
PART = 1 << 16


def _roots(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """The least node that each of n nodes reaches by the edges x, y."""
    root = np.arange(n)
    while len(x):
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
        x, y = root[x], root[y]
        x, y = x[x != y], y[x != y]
    return root


def _forest(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges a, b -> every node a of theirs hung on the least node b that these edges reach; after PART edges, what is left of them goes on."""
    held: list[pa.RecordBatch] = []

    def hung() -> pa.RecordBatch:
        a, b = (pa.concat_arrays([h.column(k) for h in held]) for k in (0, 1))
        nodes = pc.unique(pa.concat_arrays([a, b]))
        nodes = nodes.take(pc.sort_indices(nodes))
        x, y = (pc.index_in(k, value_set=nodes).to_numpy().astype(np.int64) for k in (a, b))
        root = _roots(x, y, len(nodes))
        low = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays([nodes.take(pa.array(low)), nodes.take(pa.array(root[low]))], names=["a", "b"])

    rows = 0
    for part in parts:
        held.append(part)
        rows += part.num_rows
        if rows >= 4 * PART:
            yield hung()
            held, rows = [], 0
    if held:
        yield hung()


def _hang(tables: Stages, edges: DataFrame, up: bool) -> DataFrame:
    """Every neighbour of a node (up: larger ones of both directions; else smaller ones) hung on the node's least neighbour.

    The least neighbours are written first, so that the join exchanges both sides and a node of very many edges is split.
    """
    if up:
        edges = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = tables.write(edges.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a")), "least")
    hung = edges.join(least, "a")
    moved = hung.where("b > a" if up else "b < a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not up:
        moved = moved.unionByName(least.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """node, component (its least reachable node) for every node of the edges (columns a and b of one ordered type).

    Parts of PART edges, about, become forests first: one part is done with that, more of them are joined by rounds.
    Each round halves the height of the trees or so; every one is written to the shared folder in place of the one
    before, and the loop ends when a round changes nothing. Self loops and nulls are ignored; nodes that only have those
    are not returned.
    """
    tables = Stages(edges.sparkSession, "components")
    edges = tables.write(edges.select("a", "b").where("a <> b"), "given")
    parts = -(-edges.count() // PART)
    kind = edges.schema["a"].dataType.simpleString()
    dealt = edges.coalesce(1) if parts <= 1 else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).repartition(parts, "a")
    now = tables.write(dealt.mapInArrow(_forest, f"a {kind}, b {kind}"), "edges")
    tables.drop(edges)
    seen = None
    for _ in range(rounds if parts > 1 else 0):
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        large = tables.write(_hang(tables, now, up=True), "large")
        tables.drop(now)
        now = tables.write(_hang(tables, large, up=False), "edges")
        tables.drop(large)
    else:
        if parts > 1:
            raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
