"""Hot anchors of suffix deduplication and the recursion of its sorter, against brute force."""

import random
from collections import Counter

import numpy as np

from partsieve.llm import induced_sort, suffix_dedup


def test_hot_anchors_are_counted(spark, monkeypatch):
    r = random.Random(5)
    text = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    passage, prefix = text(450), text(60)
    docs = {i: text(120) + (prefix[i:] if i < 40 else "") + passage + text(150) for i in range(90)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4)
    sorted_bytes = []
    made = suffix_dedup.written

    def watched(frame, name):
        out = made(frame, name)
        if name == "suffix-groups":
            sorted_bytes.append(out.agg({"n": "max"}).first()[0] or 0)
        return out

    monkeypatch.setattr(suffix_dedup, "HOT", 20, raising=False)
    monkeypatch.setattr(suffix_dedup, "written", watched)
    count = Counter(t[i : i + 200] for t in docs.values() for i in range(len(t) - 199))
    for x in suffix_dedup.suffix_dedup(df).collect():
        t = docs[x["doc_id"]]
        gone = {i + k for i in range(len(t) - 199) if count[t[i : i + 200]] > 1 for k in range(200)}
        assert bytes(x["kept"]).decode() == "".join(c for i, c in enumerate(t) if i not in gone)
    assert max(sorted_bytes) <= 20


def test_sort_names_recurses(monkeypatch):
    monkeypatch.setattr(induced_sort, "NAMES_IN_MEMORY", 8)
    r = np.random.default_rng(6)
    for n, k in ((50, 3), (400, 2), (1000, 5)):
        names = np.append(r.integers(1, k + 1, n), 0)
        t = names.tolist()
        assert induced_sort.sort_names(names).tolist() == sorted(range(n + 1), key=lambda i: t[i:])
