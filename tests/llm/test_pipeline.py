"""Stages of the pipeline held against brute force on their own inputs."""

from collections import Counter

import corpus_pipeline as p
from partsieve.llm.queries import op2_quality_classifier
from tests.llm.test_operators import LOWER, SF, components, fair_targets, shingles, words


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in p.STAGES:
        out = p.written(stage(spark, docs, SF), "test")
        before, after = [r["doc_id"] for r in docs.collect()], [r["doc_id"] for r in out.collect()]
        assert set(after) <= set(before) and after
        text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
        if name == "quality classifier":
            assert sorted(after) == sorted(r["doc_id"] for r in op2_quality_classifier(spark, SF).where("predicted = 1").collect())
        if name == "mixing":
            source, size, taken = {r["doc_id"]: r["source"] for r in docs.collect()}, Counter(), Counter(after)
            for i, t in text.items():
                size[source[i]] += len(words(t))
            got = Counter()
            for i, n in taken.items():
                assert n <= 2
                got[source[i]] += n * len(words(text[i]))
            for k, target in fair_targets(size).items():  # tiny sources: as near as whole documents come is a document's size
                assert abs(got[k] - target) <= max(len(words(text[i])) for i in text if source[i] == k)
        if name == "exact dedup":
            largest = {}
            for i, t in text.items():
                key = t.translate(LOWER)
                largest[key] = max(i, largest.get(key, i))
            assert sorted(after) == sorted(largest.values())
        if name == "n-gram Jaccard join":
            assert sorted(after) == sorted(i for i, c in components({i: shingles(t, 5) for i, t in text.items()}, 80, 100).items() if i == c)
        if name == "byte-level BPE":
            assert out.where("not round_trip").count() == 0
        else:
            assert out.columns == columns
        docs = out
