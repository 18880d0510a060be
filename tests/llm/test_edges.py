"""Null and repeated ids, null, empty and very long texts, ties, repeated rows, empty tables, clashing column names."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from partsieve.llm import queries as q
from partsieve.llm.bpe import Bpe
from partsieve.llm.exact_dedup import exact_dedup, exact_groups
from partsieve.llm.line_dedup import line_dedup
from partsieve.llm.mixing import mix, mixed
from partsieve.llm.ngram_join import ngram_components, ngram_dedup
from partsieve.llm.quality_model import good_documents, quality_scores
from partsieve.llm.repetition import quality_rules
from partsieve.llm.suffix_dedup import suffix_dedup
from partsieve.llm.url_rules import judge_urls

LONG = " ".join(f"word{i * i % 4999}" for i in range(60_000))
TOKEN = "y" * 300_000
SAME = " ".join(f"a{i}" for i in range(40))
NEAR = SAME.replace("a39", "b")
ROWS = [
    (None, SAME, "s", 1), (5, SAME.upper(), "s", 2), (None, "a unique text", "t", 3), (7, "x y", "t", 4), (9, "X y", None, 5), (7, "only here", None, 6),
    (9, NEAR, "s", 7), (1, None, "s", 8), (2, "", "t", 9), (3, LONG, "t", 10), (3, LONG, "t", 10), (4, LONG + " end", "s", 11), (6, TOKEN, "t", 12), (8, TOKEN + "z", "t", 13),
]
CLASHING = ["lost_id", "_id", "_one", "_gone", "id", "tx", "row", "hit", "page", "slot", "words", "norm", "key", "size", "told_id", "stays", "told", "group", "c0"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(ROWS, "doc_id long, text string, source string, n long")
    return rows.select("doc_id", "text", F.lit("en").alias("lang"), "source", "n", *[F.lit(str(i)).alias(c) for i, c in enumerate(CLASHING)])


def kept(df):
    return Counter((r["doc_id"], r["text"], r["n"]) for r in df.collect())


def rows(*numbers):
    return Counter(next((i, t, n) for i, t, _, n in ROWS if n == k) for k in numbers)


def test_exact_dedup_goes_by_content(docs):
    out = exact_dedup(docs)
    assert out.columns == docs.columns
    # 5 before null, 9 before 7; 2 before 1 of the empty ones; one of the two equal rows
    assert kept(out) == rows(2, 3, 5, 6, 7, 9, 10, 11, 12, 13)
    assert kept(exact_dedup(docs.limit(0))) == Counter()


def test_exact_groups(docs):
    got = Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_groups(docs).collect())
    assert got == Counter({(None, 5, 2, False): 1, (5, 5, 2, True): 1, (None, None, 1, True): 1, (7, 9, 2, False): 1, (9, 9, 2, True): 1, (7, 7, 1, True): 1, (9, 9, 1, True): 1, (1, 2, 2, False): 1, (2, 2, 2, True): 1, (3, 3, 2, True): 2, (4, 4, 1, True): 1, (6, 6, 1, True): 1, (8, 8, 1, True): 1})


def test_ngram_dedup_goes_by_rows(docs):
    out = ngram_dedup(docs)
    assert out.columns == docs.columns
    # SAME, its upper case and NEAR are one group, 5 before 9 before null; 7 before 9; 3 and 4 are near, the rows of 3 one document
    assert kept(out) == rows(2, 3, 4, 6, 8, 9, 10, 12, 13)
    assert kept(ngram_dedup(docs.limit(0))) == Counter()


def test_ngram_components(docs):
    got = Counter((r["doc_id"], r["n_shingles"] > 0, r["component_id"]) for r in ngram_components(docs).collect())
    assert got == Counter({(None, True, 5): 1, (5, True, 5): 1, (9, True, 5): 1, (None, True, None): 1, (7, True, 7): 2, (9, True, 7): 1, (1, False, 1): 1, (2, False, 2): 1, (3, True, 3): 2, (4, True, 3): 1, (6, True, 6): 1, (8, True, 8): 1})


def test_mixes(docs):
    got = mix(docs).collect()
    assert len(got) == len(ROWS)
    n_words = lambda t: len((t or "").split())
    for source in ("s", "t", None):
        size = sum(n_words(t) for _, t, s, _ in ROWS if s == source)
        assert {r["source_size"] for r in got if r["size"] and r["source_size"] == size} == {size}
        own = [r for r in got if r["source_size"] == size]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 16 and all(r["taken"] <= 2 * r["size"] for r in own)
    out = mixed(docs)
    assert out.columns == docs.columns
    counts = kept(out)
    assert all(n_words(t) for _, t, _ in counts) and any(i is None for i, _, _ in counts)
    assert kept(mixed(docs.limit(0))) == Counter() and mix(docs.limit(0)).count() == 0


@pytest.mark.parametrize("f", [line_dedup, quality_rules, suffix_dedup])
def test_row_for_row(docs, f):
    out = f(docs).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(r[0] for r in ROWS)
    assert f(docs.limit(0)).count() == 0
    if f is suffix_dedup:  # what follows the repeated bytes stays: z, and end (its space occurs inside, too)
        left = sorted(len(r["kept"]) for r in out if r["n_bytes"] > 10_000)
        assert left == [0, 0, 0, 1, 3]
    if f is quality_rules:
        assert {r["doc_id"]: r["kept"] for r in out if r["doc_id"] in (1, 2, 6, 8)} == {1: False, 2: False, 6: False, 8: False}


def test_bpe(spark, docs):
    bpe = q.multilingual_bpe(spark)
    assert isinstance(bpe, Bpe)
    for r in bpe.round_trip(docs, carry=["n", "id"]).collect():
        assert bytes(r["decoded"]) == (r["text"] or "").encode() and len(r["ids"]) % 4 == 0
    for r in docs.select("text", bpe.decode(bpe.encode(F.col("text"))).alias("back")).collect():
        assert bytes(r["back"]) == (r["text"] or "").encode()
    assert bpe.round_trip(docs.limit(0)).count() == 0


def test_quality(spark, docs):
    labels = spark.createDataFrame([(None, 1), (3, 1), (3, 0), (4, None), (6, 0), (7, 1), (99, 0)], "doc_id long, quality int")
    out = quality_scores(docs, labels).collect()
    assert len(out) == len(ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in out)
    assert good_documents(docs, labels).columns == docs.columns
    assert good_documents(docs.limit(0), labels).count() == 0
    none = quality_scores(docs, labels.limit(0)).collect()
    assert len({r["score"] for r in none}) == 1


def test_urls(spark):
    urls = [(1, "HTTP://A.Example.NET/en/x?y"), (1, None), (None, "no link"), (2, "http://org"), (2, "http://org/fr/"), (3, "http://x.org/fr/" + "z" * 50_000), (4, "://"), (5, "http://net?x"), (5, "http://net?x")]
    pages = spark.createDataFrame(urls, "page_id long, url string").withColumns({c: F.lit(1) for c in ("host", "path", "rule", "verdict", "key", "range", "best")})
    got = Counter((r["page_id"], r["host"], r["rule"], r["verdict"]) for r in judge_urls(pages, q.url_rules(spark)).collect())
    # of the rules that fit a.example.net/en/x the longest allows; org without a path is no page of /fr/
    assert got == Counter({(1, "a.example.net", "example.net/en/", "allow"): 1, (1, "", None, "allow"): 1, (None, "", None, "allow"): 1, (2, "org", None, "allow"): 1, (2, "org", "org/fr/", "allow"): 1, (3, "x.org", "org/fr/", "allow"): 1, (4, "", None, "allow"): 1, (5, "net", None, "allow"): 2})
    assert judge_urls(pages.limit(0), q.url_rules(spark)).count() == 0
    no_rules = judge_urls(pages, q.url_rules(spark).limit(0))
    assert {r["verdict"] for r in no_rules.collect()} == {"allow"}


def test_stages_keep_columns_and_take_empty_tables(spark, docs, tmp_path):
    spark.createDataFrame([(3, 1, 0), (7, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), str(tmp_path)).count() == 0
