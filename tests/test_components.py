"""Connected components against a plain search, in one part and in many."""

import random

import pytest
from pyspark.sql import functions as F

from partsieve import staging
from partsieve.operators import components as module
from partsieve.operators.components import components


def _least(pairs):
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    found = {}
    for start in sorted(near):
        todo = [start]
        while todo:
            x = todo.pop()
            if x not in found:
                found[x] = start
                todo += near[x]
    return found


@pytest.mark.parametrize("part", [1 << 16, 40])
def test_components_are_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(module, "PART", part)
    r = random.Random(5)
    pairs = [(f"n{r.randrange(400)}", f"n{r.randrange(400)}") for _ in range(250)] + [("hub", f"m{i}") for i in range(60)] + [("é", "z"), ("a", "a")]
    edges = spark.createDataFrame([*pairs, ("x", None), (None, "y")], "a string, b string")
    got = components(edges)
    assert got.count() == got.select("node").distinct().count()
    assert {x["node"]: x["component"] for x in got.collect()} == _least([p for p in pairs if p[0] != p[1]])


def test_few_edges_take_no_rounds(spark, monkeypatch):
    """A chain of 3000 edges took a dozen rounds of four tables each."""
    names, write = [], staging.Stages.write
    monkeypatch.setattr(staging.Stages, "write", lambda self, df, what: names.append(what) or write(self, df, what))
    order = list(range(3001))
    random.Random(2).shuffle(order)
    chain = spark.createDataFrame(list(zip(order, order[1:], strict=False)), "a long, b long")
    assert components(chain).agg(F.count("*"), F.max("component")).first() == (3001, 0)
    assert names == ["given", "edges"]


def test_no_edges(spark):
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).collect() == []
