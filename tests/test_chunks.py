"""Budget chunks against a scan in order."""

import random

import pytest

from partsieve.operators import chunks
from partsieve.operators.chunks import budget_chunks
from partsieve.plans import catalogue
from tests.oracle import differences


def scan(rows, most):
    """rows: key, order, cost."""
    out, key, first = {}, None, True
    for k, o, cost in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        if first or k != key:
            key, chunk, held, first = k, 0, cost or 0, False
        elif held + (cost or 0) > most:
            chunk, held = chunk + 1, cost or 0
        else:
            held += cost or 0
        out[k, o] = chunk
    return out


@pytest.mark.parametrize("walk", [1 << 17, 0])
@pytest.mark.parametrize("most", [1, 7, 50, 10**6])
def test_against_a_scan(spark, monkeypatch, most, walk):
    """Entries of partitions walked, and found by doubling."""
    monkeypatch.setattr(chunks, "WALK", walk)
    r = random.Random(most)
    costs = [0, 0, 0, 1, 2, 5, 9, 60, None]
    rows = [(r.choice([None, 1, 2, 3]) if i % 3 else 1, i, r.choice(costs)) for i in range(400)] + [(4, i, 0) for i in range(40)]
    df = spark.createDataFrame(rows, "k long, o long, cost long").repartition(7)
    got = {(x["k"], x["o"]): x["chunk"] for x in budget_chunks(df, ["k"], ["o"], "cost", most).collect()}
    assert got == scan(rows, most)
    alone = {x["o"]: x["chunk"] for x in budget_chunks(df.where("k = 1"), [], ["o"], "cost", most).collect()}
    assert alone == {o: c for (k, o), c in scan(rows, most).items() if k == 1}


def test_empty(spark):
    df = spark.createDataFrame([], "k long, o long, cost long")
    assert budget_chunks(df, [], ["o"], "cost", 5).count() == 0 and budget_chunks(df, ["k"], ["o"], "cost", 5).columns == ["k", "o", "cost", "chunk"]


@pytest.mark.parametrize("name", ["conversation_batches", "document_batches"])
def test_queries(spark, name):
    assert differences(spark, name, catalogue.QUERIES[name], catalogue.ORACLES[name], "/root/testdata/sf0.01") == ""
