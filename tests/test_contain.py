"""The substring join against plain search."""

import os
import random

import pytest
from pyspark.sql import functions as F

from partsieve.operators import contain
from partsieve.operators.contain import Automaton, contains_join, pattern_counts
from partsieve.plans import catalogue, records
from tests.oracle import TABLES, differences


@pytest.mark.parametrize("dictionary", [1 << 21, 40])
@pytest.mark.parametrize("fold", [False, True])
def test_against_search(spark, monkeypatch, dictionary, fold):
    """One dictionary, and several that texts meet in several groups."""
    monkeypatch.setattr(contain, "DICTIONARY", dictionary)
    monkeypatch.setattr(contain, "GROUP", 500)
    r = random.Random(1)
    texts = [(None if i % 9 == 0 else i % 50, "".join(r.choices("aAbB é🙂", k=r.randrange(40)))) for i in range(120)] + [(1, None), (2, ""), (3, "ab" * 20_000)]
    patterns = [(i % 30, "".join(r.choices("aAbBé", k=r.randrange(1, 5)))) for i in range(60)] + [(None, "aa"), (1, ""), (2, None), (4, "aa")]
    lower = (lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s)) if fold else (lambda s: s)
    want = sorted((str(i), str(j), lower(t).count(lower(p)), lower(t).find(lower(p))) for i, t in texts for j, p in patterns if t is not None and p and lower(p) in lower(t))
    a, b = spark.createDataFrame(texts, "i long, text string"), spark.createDataFrame(patterns, "j int, text string")
    got = sorted((str(x["i"]), str(x["j"]), x["n"], x["first"]) for x in contains_join(a.repartition(3), b, "i", "text", "j", "text", fold).collect())
    assert got == want
    assert contains_join(a, b.limit(0), "i", "text", "j", "text").count() == 0 == contains_join(a.limit(0), b, "i", "text", "j", "text").count()


def test_counts(spark):
    words = ["aa", "aba", "", "aa"]
    df = spark.createDataFrame([("aaaaababa",), (None,), ("",)], "t string")
    assert [r["c"] for r in df.select(pattern_counts(df["t"], words).alias("c")).collect()] == [[2, 1, 0, 2], [0] * 4, [0] * 4]
    assert Automaton([]).count("x") == {}


@pytest.mark.parametrize("name", ["benchmark_passages", "repo_like_join", "keyword_classes"])
def test_queries(spark, name):
    assert differences(spark, name, catalogue.QUERIES[name], catalogue.ORACLES[name], "/root/testdata/sf0.01") == ""
    assert catalogue.QUERIES[name](spark, "/root/testdata/sf0.01").count() > 10


def test_addresses_and_links_that_repeat(spark, monkeypatch, tmp_path):
    """The join grows with distinct links and addresses, not with the product of their copies."""
    base = "/root/testdata/sf0.01"
    for name in TABLES:
        os.symlink(f"{base}/{name}.parquet", tmp_path / f"{name}.parquet")
    for name, key, step in (("customer", "c_custkey", 45_000), ("supplier", "s_suppkey", 1500)):
        os.unlink(tmp_path / f"{name}.parquet")
        copies = spark.read.parquet(f"{base}/{name}.parquet").withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(7))))
        copies.withColumn(key, F.col(key) + F.col("copy") * step).drop("copy").write.parquet(str(tmp_path / f"{name}.parquet"))
    found = []
    monkeypatch.setattr(records, "contains_join", lambda *a, **k: found.append(contains_join(*a, **k)) or found[-1])
    plain = catalogue.QUERIES["repo_like_join"](spark, base).count()
    assert catalogue.QUERIES["repo_like_join"](spark, str(tmp_path)).count() == 8 * plain
    assert found[1].count() == found[0].count()
    assert differences(spark, "repo_like_join", catalogue.QUERIES["repo_like_join"], catalogue.ORACLES["repo_like_join"], str(tmp_path)) == ""
