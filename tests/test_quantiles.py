"""Exact quantiles by selection against numpy, with ranges narrowed over several rounds."""

import random

import numpy as np
import pytest

from partsieve.operators import quantiles
from partsieve.plans import catalogue
from tests.oracle import differences

AT = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


@pytest.mark.parametrize("buckets, few", [(4096, 10_000), (4, 3), (2, 1)])
def test_against_numpy(spark, monkeypatch, buckets, few):
    monkeypatch.setattr(quantiles, "BUCKETS", buckets)
    monkeypatch.setattr(quantiles, "FEW", few)
    r = random.Random(buckets)
    groups = {"a": [r.gauss(0, 1) for _ in range(500)], "b": [7.5] * 300, None: [float(i % 3) for i in range(200)], "c": [1.0], "d": [r.choice([-1e9, 0.1, 0.1, 3.0]) for _ in range(150)]}
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("a", None)] * 50 + [("e", None)]
    r.shuffle(rows)
    got = {x["k"]: (x["n"], x["quantiles"]) for x in quantiles.exact_quantiles(spark.createDataFrame(rows, "k string, v double").repartition(6), ["k"], "v", AT).collect()}
    assert got.keys() == groups.keys()
    for k, vs in groups.items():
        assert got[k][0] == len(vs) and got[k][1] == pytest.approx(list(np.quantile(vs, AT)), rel=1e-12)


def test_edges(spark):
    rows = spark.createDataFrame([(1, 2.0), (1, 4.0)], "k long, v double")
    assert [r["quantiles"] for r in quantiles.exact_quantiles(rows, [], "v", [0.5]).collect()] == [[3.0]]
    assert quantiles.exact_quantiles(rows.limit(0), ["k"], "v", [0.5]).count() == 0
    with pytest.raises(Exception, match="not finite"):
        quantiles.exact_quantiles(spark.createDataFrame([(1, float("nan"))], "k long, v double"), ["k"], "v", [0.5]).collect()


@pytest.mark.parametrize("name", ["line_quartiles", "document_quartiles"])
def test_queries(spark, name):
    assert differences(spark, name, catalogue.QUERIES[name], catalogue.ORACLES[name], "/root/testdata/sf0.01") == ""
