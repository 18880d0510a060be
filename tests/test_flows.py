"""Articles over splits, and the queue stream against a plain fold, with restarts."""

import random

import pytest
from pyspark.sql import functions as F

from partsieve.plans import catalogue
from partsieve.sources.articles import data_availability, last_text, read_articles, repository_links, titles_by_doi
from partsieve.streaming.queue import BUCKETS, queue_state, run_queue
from tests.oracle import differences


def test_records_across_splits(spark, tmp_path):
    """A file of many splits, some of them inside one article; state does not carry over from one article to the next."""
    body = "x" * 3000
    articles = [f'<article n="{i}"><front>' + (f'<article-id pub-id-type="doi">10.1/{i % 40}</article-id>' if i % 4 else "") + (f"<article-title>T<b>{i}</b> &amp; é</article-title>" if i % 7 else "") + f"</front><body>{body}</body></article>\n" for i in range(60)]
    (tmp_path / "a.xml").write_text("<?xml version='1.0'?>\n<articles>" + "".join(articles) + "</articles>\n<article-set>no</article-set>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        found = read_articles(spark, f"{tmp_path}/a.xml")
        assert found.rdd.getNumPartitions() > 100 and found.count() == 60
        assert found.where(last_text(F.col("record"), "body") == body).count() == 60
        want = {}
        for i in range(60):
            if i % 4 and i % 7:
                want[f"10.1/{i % 40}"] = f"T{i} & é"
        assert {r["doi"]: r["title"] for r in titles_by_doi(found).collect()} == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_queue_with_restarts(spark, tmp_path):
    r = random.Random(4)
    rows = sorted((r.randrange(0, 10**8), i, r.randrange(25), r.choice([0, 0, 3]), r.choice(["a", "b"])) for i in range(300))
    result = {"item": F.col("item"), "ts": F.timestamp_millis("at"), "number": F.col("number"), "component_count": F.col("n"), "version": F.col("version")}
    delay, late = 10**7, 5000
    for some in (rows[:100], rows[100:180], rows[180:]):
        spark.createDataFrame(some, "at long, number long, item long, n long, version string").write.mode("append").parquet(f"{tmp_path}/in")
        run_queue(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/checkpoint", result, delay, "5 seconds")
    last = {item: (at, n, version) for at, _, item, n, version in rows}
    end = rows[-1][0] - late
    want = {item: (0 if n == 0 and at + delay < end else 1, n, version) for item, (at, n, version) in last.items()}
    got = {x["item"]: (x["processed"], x["component_count"], x["version"]) for x in queue_state(spark, f"{tmp_path}/out").collect()}
    assert got == want and {0, 1} == {p for p, _, _ in want.values()}


def test_queue_of_many_items(spark, tmp_path):
    """State has one row a bucket, not one an item; items, counts, versions and times may be null, times differ by microseconds."""
    r = random.Random(5)
    items = [None, *range(2**60, 2**60 + 2500)]
    rows = [(10**12 + i * 1000 + r.randrange(1000), 9000 - i, r.choice(items), r.choice([0, 0, 2**60 + 1, None]), r.choice(["a", "b", None])) for i in range(8000)]
    rows += [(10**12 + 8 * 10**6 + 100, 9, 7, 0, "a"), (10**12 + 8 * 10**6 + 900, 1, 7, 5, "b"), (None, 9001, 8, 0, "a"), (10**12 + 8 * 10**6, 9002, 8, 1, "b")]
    result = {"item": F.col("item"), "ts": F.timestamp_micros("at"), "number": F.col("number"), "component_count": F.col("n"), "version": F.col("version")}
    for some in (rows[:3000], rows[3000:]):
        spark.createDataFrame(some, "at long, number long, item long, n long, version string").write.mode("append").parquet(f"{tmp_path}/in")
        run_queue(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/checkpoint", result, 2000, "1 second")
    last = {}
    for at, number, item, n, version in rows:
        last[item] = max(last.get(item, (0, 0)), (at or 2**63 - 1, number, n, version), key=lambda x: x[:2])
    end = 10**9 + 8000 - 1000
    want = {item: (0 if n == 0 and at // 1000 + 2000 < end else 1, n, version) for item, (at, _, n, version) in last.items()}
    got = {x["item"]: (x["processed"], x["component_count"], x["version"]) for x in queue_state(spark, f"{tmp_path}/out").collect()}
    assert got == want and {0, 1} == {p for p, _, _ in want.values()}
    assert spark.read.format("statestore").load(f"{tmp_path}/checkpoint").count() <= BUCKETS < len(want)


@pytest.mark.parametrize("name", ["article_titles", "article_bodies", "article_statements", "article_repositories", "queue_stream"])
def test_queries(spark, name):
    assert differences(spark, name, catalogue.QUERIES[name], catalogue.ORACLES[name], "/root/testdata/sf0.01") == ""


def test_statements_and_links(spark):
    records = [
        '<article><custom-meta id="data-availability"><meta-value> </meta-value></custom-meta><custom-meta><meta-name>DATA AVAILABILITY statement</meta-name><meta-value>a <i> b </i>c &amp; d</meta-value></custom-meta>',
        "<article><p>See HTTPS://GitHub.com/A/b) and\nhttps://gitlab.x.org/c/d], https://www.gitlab.com/e/f</p>",
        "<article>",
    ]
    rows = spark.createDataFrame([(i, r) for i, r in enumerate(records)], "i long, record string")
    got = {r["i"]: (r["s"], [tuple(x) for x in r["l"]]) for r in rows.select("i", data_availability(F.col("record")).alias("s"), repository_links(F.col("record")).alias("l")).collect()}
    assert got == {0: ("abc & d", []), 1: (None, [("HTTPS://GitHub.com/A/b", "GitHub"), ("https://www.gitlab.com/e/f", "GitLab"), ("https://gitlab.x.org/c/d", "GitLab")]), 2: (None, [])}
