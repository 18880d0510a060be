"""The training-data operators against brute force, the public tokenizer and DuckDB."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from partsieve.llm import queries as q
from partsieve.llm.exact_dedup import exact_groups
from partsieve.llm.line_dedup import line_dedup
from partsieve.llm.mixing import mix, mixed
from partsieve.llm.ngram_join import ngram_components
from partsieve.llm.quality_model import quality_scores
from partsieve.llm.repetition import quality_rules
from partsieve.llm.suffix_dedup import suffix_dedup
from tests.oracle import differences

SF = "/root/testdata/sf0.001"
LOWER = {i: i + 32 for i in range(65, 91)}


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def shingles(text, n):
    w = words(text.translate(LOWER))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def components(sets, num, den):
    held, shared = defaultdict(list), Counter()
    for k, s in sets.items():
        for x in s:
            held[x].append(k)
    for keys in held.values():
        shared.update((a, b) for i, a in enumerate(sorted(keys)) for b in sorted(keys)[i + 1 :])
    up = {k: k for k in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for (a, b), n in shared.items():
        if den * n >= num * (len(sets[a]) + len(sets[b]) - n):
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    return {k: root(k) for k in sets}


@pytest.mark.parametrize("name", sorted(q.ORACLES))
def test_oracle(spark, name):
    assert not differences(spark, name, q.QUERIES[name], q.ORACLES[name], SF)


def test_bpe_is_tiktokens(spark, docs):
    import base64
    import struct

    import public_tokenizers as P
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in q.op1_byte_bpe(spark, SF).collect():
        ids = enc.encode_ordinary(docs[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()


def test_quality_separates_held_out(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [(r["score"], truth[r["doc_id"]]) for r in q.op2_quality_classifier(spark, sf).where("held_out").collect() if r["doc_id"] in truth]
    good, bad = [s for s, y in rows if y == 1], [s for s, y in rows if y == 0]
    assert all(0 <= s <= 1 for s, _ in rows)
    assert sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad)) > 0.97
    assert sum(g >= 0.3 for g in good) >= 0.98 * len(good) and sum(b < 0.3 for b in bad) >= 0.7 * len(bad)


def test_held_out_labels_do_not_change_scores(spark):
    import zlib

    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    assert {r["doc_id"] for r in docs.where(held).collect()} == {r["doc_id"] for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0}
    scores = [{r["doc_id"]: r["score"] for r in quality_scores(docs, x).collect()} for x in (labels, labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality"))))]
    assert scores[0] == scores[1]


def test_repetition_counts(spark, docs):
    for r in q.op5_quality_rules(spark, SF).collect():
        t = docs[r["doc_id"]]
        w, lines = words(t), [x for x in t.split("\n") if words(x)]
        thirds = Counter(zip(w, w[1:], w[2:], strict=False))
        in_third = {i + k for i, x in enumerate(zip(w, w[1:], w[2:], strict=False)) if thirds[x] > 1 for k in range(3)}
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(in_third))
        assert tuple(r[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert r["base_failed"] == (len(w) < 50 or 100 * len(in_third) > 50 * len(w))


def test_repetition_verdict(spark, docs):
    def twice(b, n):
        seen = Counter(b[i : i + n] for i in range(len(b) - n + 1))
        return [i for i in range(len(b) - n + 1) if seen[b[i : i + n]] > 1]

    decided = 0
    for r in q.op5_quality_rules(spark, SF).collect():
        b = docs[r["doc_id"]].encode()
        least = max(11, len(b).bit_length() - 1)
        covered = {i + k for i in twice(b, least) for k in range(least)}
        low, high = 0, len(b)
        while low < high:  # whether some n bytes repeat is monotone in n
            n = (low + high + 1) // 2
            low, high = (n, high) if twice(b, n) else (low, n - 1)
        longest = low if low >= least else 0
        assert (r["n_bytes"], r["covered_bytes"], r["longest_repeat"]) == (len(b), len(covered), longest)
        assert r["kept"] == (not r["base_failed"] and len(covered) <= 0.12 * len(b) and longest <= 500)
        decided += r["kept"] != (not r["base_failed"])
    assert decided


def test_repeated_bytes(spark, docs):
    raw = {i: t.encode() for i, t in docs.items()}
    count = Counter(b[i : i + 200] for b in raw.values() for i in range(len(b) - 199))
    for r in q.op6_suffix_dedup(spark, SF).collect():
        b = raw[r["doc_id"]]
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if count[b[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and not h for g, h in zip(gone, b"\0" + gone, strict=False))
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())


def fair_targets(sizes):
    """Targets by source: 5, 2, 1, repeating, of 150 % of all words, at most twice a source's own; the excess reshared until none is left."""
    names = sorted((k for k in sizes if k is not None), key=lambda k: k.encode("utf-32-be")) + [None] * (None in sizes)
    weight = {k: (5, 2, 1)[i % 3] for i, k in enumerate(names)}
    full, total = {}, 1.5 * sum(sizes.values())
    while True:
        rest = [k for k in names if k not in full]
        level = (total - sum(full.values())) / sum(weight[k] for k in rest) if rest else 0
        over = [k for k in rest if level * weight[k] > 2 * sizes[k]]
        if not over:
            return full | {k: level * weight[k] for k in rest}
        full |= {k: 2.0 * sizes[k] for k in over}


def test_mix(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    source, text = {r["doc_id"]: r["source"] for r in table}, {r["doc_id"]: r["text"] or "" for r in table}
    rows = q.op7_mixing(spark, "/root/testdata/sf0.01").collect()
    sizes, taken = Counter(), Counter()
    for i, t in text.items():
        sizes[source[i]] += len(words(t))
    targets = fair_targets(sizes)
    for r in rows:
        assert r["size"] == len(words(text[r["doc_id"]])) and 0 <= r["taken"] <= 2 * r["size"]
        assert r["source_size"] == sizes[source[r["doc_id"]]] and r["target"] == pytest.approx(targets[source[r["doc_id"]]])
        taken[source[r["doc_id"]]] += r["taken"]
    assert all(abs(taken[k] / t - 1) < 0.01 for k, t in targets.items())
    assert sorted(map(tuple, rows)) == sorted(map(tuple, q.op7_mixing(spark, "/root/testdata/sf0.01").collect()))
    # whole documents come as near
    whole = Counter()
    for r in mixed(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect():
        whole[r["source"]] += len(words(r["text"]))
    assert all(abs(whole[k] / t - 1) < 0.01 for k, t in targets.items())


def test_components(spark, docs):
    sets = {i: shingles(t, 4) for i, t in docs.items()}
    want = components(sets, 85, 100)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in q.op10_ngram_join(spark, SF).collect()} == {i: (len(s), want[i]) for i, s in sets.items()}


@pytest.mark.parametrize("f", [exact_groups, line_dedup, mix, ngram_components, quality_rules, suffix_dedup])
def test_nulls_copies_and_no_rows(spark, f):
    long = " ".join(f"word{i % 97}" for i in range(3000))
    rows = [(1, None, "a", None), (2, "", None, 1), (None, "x y z w v", "a", 2), (3, long, "b", 3), (3, long, "b", 3), (4, long.upper(), "b", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size long")
    assert f(docs).count() == len(rows)
    assert f(docs.limit(0)).count() == 0
