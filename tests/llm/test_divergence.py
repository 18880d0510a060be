"""The divergence audit against SQL and against a count in plain Python."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from partsieve.llm import divergence as module
from partsieve.llm import queries as q
from partsieve.llm.divergence import divergence
from tests.oracle import differences


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    name = "op12_divergence_audit"
    assert differences(spark, name, q.QUERIES[name], q.ORACLES[name], f"/root/testdata/{sf}") == ""


def plain(rows, least, top=10):
    """rows: lang, source, text."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = ["".join(c.lower() if c < "\x80" else c for c in w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        counts[lang, source].update(words)
        docs[lang].update(set(words))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        sources = [s for g, s in groups if g == lang]

        def shares(count):
            total = sum(count[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 2) // total for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            parts = {"pair": {o: sum(f(p[s][t], p[o][t]) for t in kept) for o in sources if o != s}, "term": {t: f(p[s][t], whole[t]) for t in kept if counts[lang, s][t] and p[s][t] > whole[t]}}
            for part, found in parts.items():
                ranked = sorted(found.items(), key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, v, i) for i, (item, v) in enumerate(ranked, 1) if part == "pair" or i <= top}
    return out


def test_against_plain_counts(spark, monkeypatch):
    """Many sources, rare and frequent terms, blocks and tiles of small size, tasks that hand on early; nulls and clashing names."""
    monkeypatch.setattr(module, "BLOCK", 4)
    monkeypatch.setattr(module, "TILE_TERMS", 3)
    monkeypatch.setattr(module, "LIGHT", 3)
    r = random.Random(3)
    words = [f"w{a}{b}" for a in "abcdefg" for b in "äbcdéfg"] + ["Ünder", "ÜNDER", "x1y", "it's"]
    rows = [(r.choice(["en", "de", None]), r.choice([f"s{i}" for i in range(11)] + [None]), " ".join(r.choices(words, [1 / (k + 1) for k in range(len(words))], k=r.randrange(30)))) for _ in range(300)]
    rows += [("fr", "only", "a b c"), ("it", "a", None), ("it", "b", "")] + [("en", "s1", "same words here")] * 4
    docs = spark.createDataFrame(rows, "lang string, source string, text string").withColumns({c: F.lit(1) for c in ("term", "n", "p", "number", "tile", "value")})
    for least in (3, 10):
        got = {tuple(x) for x in divergence(docs.repartition(5), least, held=20).collect()}
        assert got == plain(rows, least)
    assert divergence(docs.limit(0)).count() == 0


def test_very_long_text(spark):
    rows = [("en", s, "left right " * n + "z" * 3_000_000) for s, n in (("a", 300_000), ("b", 1))]
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    assert {tuple(x) for x in divergence(docs, 2).collect()} == plain(rows, 2)
