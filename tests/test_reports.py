"""Queries that SQL cannot express, against brute force."""

import re

import pytest

from partsieve.operators.link import greedy_pairs
from partsieve.plans import catalogue
from partsieve.session import table

SF = "/root/testdata/sf0.001"


def test_chunks_are_packed_in_order(spark):
    rows = sorted(catalogue.QUERIES["budget_chunks"](spark, SF).collect(), key=lambda r: (r["conv_id"], r["turn"], r["role"]))
    conv, chunk, held, several = None, 0, 0, 0
    for r in rows:
        if r["conv_id"] != conv:
            conv, chunk, held = r["conv_id"], 0, 0
        elif held + r["tokens"] > 100 and held:
            chunk, held = chunk + 1, 0
        held += r["tokens"]
        several += chunk > 0
        assert r["chunk"] == chunk
    assert several and len(rows) == table(spark, SF, "conversations").count()


def test_greedy_pairs_are_those_of_a_scan(spark):
    parts = [r.asDict() for r in table(spark, SF, "part").collect()]
    words = lambda *c: set(re.findall("[a-z0-9]+", " ".join(c).lower()))
    left = {p["p_partkey"]: words(p["p_name"], p["p_type"]) for p in parts if p["p_partkey"] % 5 == 0}
    right = {p["p_partkey"]: words(p["p_name"], p["p_brand"]) for p in parts if p["p_partkey"] % 5 == 1}
    want, used = {}, set()
    for a in sorted(left):
        scored = [(-len(left[a] & y) / len(left[a] | y), b) for b, y in right.items() if b not in used and len(left[a] & y) / len(left[a] | y) >= 0.3]
        if scored:
            want[a] = min(scored)[1]
            used.add(want[a])
    got = {r["a"]: r["b"] for r in catalogue.QUERIES["greedy_titles"](spark, SF).collect()}
    assert got == want and len(want) > 5


def test_titles_that_repeat(spark, tmp_path):
    """Copies compete for the same partners: settled pair by pair these took more rounds than greedy_pairs allows."""
    names, types, brands = ["large bolt", "small bolt", "hot ring"], ["SMALL", "ECONOMY", "LARGE"], ["Brand#1", "Small#2"]
    parts = [(k, names[k * 7 % 11 % 3], types[k * 5 % 13 % 3], brands[k % 17 % 2]) for k in range(6000)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_type string, p_brand string").write.parquet(str(tmp_path / "part.parquet"))
    words = lambda *c: frozenset(re.findall("[a-z0-9]+", " ".join(c).lower()))
    left = {k: words(n, x) for k, n, x, _ in parts if k % 5 == 0}
    right = {k: words(n, x) for k, n, _, x in parts if k % 5 == 1}
    scores = {(x, y): len(x & y) / len(x | y) for x in set(left.values()) for y in set(right.values())}
    want, free = [], dict(right)
    for a in sorted(left):
        scored = [(-scores[left[a], y], b) for b, y in free.items() if scores[left[a], y] >= 0.3]
        if scored:
            score, b = min(scored)
            want.append((a, b, -score))
            del free[b]
    got = [tuple(r) for r in catalogue.QUERIES["greedy_titles"](spark, str(tmp_path)).select("a", "b", "score").orderBy("a").collect()]
    assert got == want and len({b for _, b, _ in want}) > 1000


def test_open_pairs_are_an_error(spark):
    """A chain of pairs settles one a round: none is lost, and too few rounds are told."""
    chain = spark.createDataFrame([(i, b, 1.0 - (b - i) / 10) for i in range(6) for b in (i - 1, i) if b >= 0], "a long, b long, score double")
    got = {(r["a"], r["b"]) for r in greedy_pairs(chain).collect()}
    used, want = set(), set()
    for i in range(6):
        b = next(b for b in (i - 1, i) if b >= 0 and b not in used)
        used.add(b)
        want.add((i, b))
    assert got == want
    with pytest.raises(RuntimeError, match="still open"):
        greedy_pairs(chain, rounds=1)
