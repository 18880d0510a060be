"""Sketches tell sets that are almost near enough from those that are, and each node has one set."""

import numpy as np

from partsieve.llm import similarity
from partsieve.llm.ngram_join import Shingler, ngram_dedup, set_number
from partsieve.llm.shared import Tables
from partsieve.llm.similarity import SETS, SimilarityJoin, parity, shared_members


def test_sets_short_of_the_threshold_are_ruled_out():
    r = np.random.default_rng(1)
    passed = 0
    for _ in range(200):
        both, x, y = np.split(r.integers(0, 1 << 63, 325, dtype=np.uint64), [269, 297])  # 28 of 297 members differ: similarity 0.828
        a, b = (np.frombuffer(parity(np.concatenate([both, z])), np.uint8) for z in (x, y))
        passed += 185 * int(np.bitwise_count(a ^ b).sum()) <= 15 * 594
    assert passed < 5


def test_one_set_a_node(spark):
    rows = [(n, 3, bytes([n]), b"p") for n in (1, 2, 2, 3, 3, 3)]
    join = SimilarityJoin(None, None, None, shared_members(lambda p: p), 85, 100, Tables(spark, "once"), single=True)
    sets = join._once(join.tables.write(spark.createDataFrame(rows, SETS), "sets"))
    assert sorted(tuple(x) for x in sets.collect()) == [(n, 3, bytes([n]), b"p") for n in (1, 2, 3)]


def test_keys_of_the_same_members_are_compared_once(spark, monkeypatch):
    """Two documents that share many keys, too little for a link, and two that are near: short sketches meet once a pair."""
    r, dealt, near = np.random.default_rng(3), [], similarity.SimilarityJoin._near
    x = [f"w{i}" for i in r.integers(0, 10**6, 1200)]
    y, z = x[:1080] + [f"v{i}" for i in range(120)], x[:1120] + [f"u{i}" for i in range(80)]
    other = [f"o{i}" for i in range(1200)]
    texts = [" ".join(words) for words in (x, y, other, [*other[:900], *(f"p{i}" for i in range(300))], z)]

    def counted(self, opened, nearest):
        dealt.extend((row["key"], row["node"], len(row["sketch"])) for row in opened.collect())
        return near(self, opened, nearest)

    monkeypatch.setattr(similarity.SimilarityJoin, "_near", counted)
    monkeypatch.setattr(similarity.SimilarityJoin, "_first_links", lambda self: None)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {row["doc_id"] for row in ngram_dedup(docs).collect()} == {0, 2, 3}
    groups = {}
    for key, node, size in dealt:
        groups.setdefault(key, set()).add(node)
        assert size <= 1024 // similarity.FOLDS
    assert len(groups) == len({frozenset(g) for g in groups.values()}) <= 5


def test_only_groups_that_left_pairs_out_are_compared_again(spark, monkeypatch):
    """Twelve near copies, each with more near pairs than the first round tests, and sixteen texts that share keys but are not near."""
    r, rounds, near = np.random.default_rng(4), [], similarity.SimilarityJoin._near
    words = lambda mark, n: [f"{mark}{i}" for i in r.integers(0, 10**6, n)]
    x, y = words("x", 1160), words("y", 900)
    copies = [" ".join(x + words("u", 40)) for _ in range(12)]
    far = [" ".join(y + words("v", 300)) for _ in range(16)]
    nodes = [{set_number(Shingler(5)(t.encode())) for t in some} for some in (copies, far)]

    def counted(self, opened, nearest):
        rounds.append({row["node"] for row in opened.collect()})
        return near(self, opened, nearest)

    monkeypatch.setattr(similarity.SimilarityJoin, "_near", counted)
    monkeypatch.setattr(similarity.SimilarityJoin, "_first_links", lambda self: None)
    monkeypatch.setattr(similarity.SimilarityJoin, "_merge", lambda self, links: None)  # so that no group closes
    ngram_dedup(spark.createDataFrame(list(enumerate(copies + far)), "doc_id long, text string"))
    assert len(rounds) == 2 and rounds[0] & nodes[0] and rounds[0] & nodes[1]
    assert rounds[1] & nodes[0] and not rounds[1] & nodes[1]
