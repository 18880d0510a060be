"""Stored tables: failed jobs, two writers, readers during a write, changes that touch some buckets only."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from partsieve.plans import catalogue
from partsieve.sources.store import Conflict, StoredTable
from tests.oracle import differences


@pytest.fixture
def table(spark, tmp_path):
    return StoredTable(spark, f"{tmp_path}/t", ["k"], 8)


def rows(spark, *cells):
    return spark.createDataFrame(cells, "k long, v string")


def all_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_versions_and_readers(spark, table):
    with pytest.raises(ValueError):
        table.read()
    assert table.version() == 0 and table.replace(rows(spark, (1, "a"), (2, "b"), (None, "n"))) == 1
    reader = table.read()
    assert table.replace(rows(spark, (1, "new"))) == 2
    assert all_of(reader) == Counter([(1, "a"), (2, "b"), (None, "n")])  # begun before the write, read after it
    assert all_of(table.read()) == Counter([(1, "new")]) and all_of(table.read(1)) == all_of(reader)
    assert table.replace(spark.createDataFrame([], "k long, v string")) == 3 and table.read().count() == 0


def test_failed_job_leaves_the_table(spark, table):
    table.replace(rows(spark, (1, "a")))
    broken = rows(spark, (1, "x"), (2, "y")).withColumn("v", F.when(F.col("k") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        table.replace(broken)
    with pytest.raises(Exception, match="lost"):
        table.upsert(broken, [], {"v": "last"})
    assert table.version() == 1 and all_of(table.read()) == Counter([(1, "a")])
    table.upsert(rows(spark, (2, "b")), [], {"v": "last"})
    table.vacuum(1)
    assert table.version() == 2 and all_of(table.read()) == Counter([(1, "a"), (2, "b")])


def test_of_two_writers_one_is_told(spark, table):
    table.replace(rows(spark, (1, "a")))
    seen = table.version()
    assert table.replace(rows(spark, (1, "first")), expected=seen) == 2
    with pytest.raises(Conflict):
        table.replace(rows(spark, (1, "second")), expected=seen)
    with pytest.raises(Conflict):
        table.replace_groups(rows(spark, (1, "third")), expected=seen)
    assert all_of(table.read()) == Counter([(1, "first")])


def test_changes_touch_their_buckets_only(spark, table):
    table.replace(spark.range(100).select(F.col("id").alias("k"), F.lit("old").alias("v")))
    before = set(table.read().inputFiles())
    table.replace_groups(rows(spark, (3, "x"), (3, "y"), (200, "z")))
    after = set(table.read().inputFiles())
    assert len(before & after) >= 6 and before - after and after - before
    want = Counter({(i, "old"): 1 for i in range(100) if i != 3}) + Counter([(3, "x"), (3, "y"), (200, "z")])
    assert all_of(table.read()) == want
    assert table.replace_groups(rows(spark, (3, "x")).limit(0)) == 2  # nothing comes in: no version
    table.replace_groups(rows(spark, (None, "n"), (None, "m")))
    table.replace_groups(rows(spark, (None, "o")))
    assert all_of(table.read()) == want + Counter([(None, "o")])


def test_upsert_policies(spark, table):
    table.upsert(rows(spark, (1, "a"), (2, None)), [], {"v": "last_known"})
    table.upsert(rows(spark, (1, None), (2, "b"), (3, "c")), [], {"v": "last_known"})
    assert all_of(table.read()) == Counter([(1, "a"), (2, "b"), (3, "c")])


@pytest.mark.parametrize("name", ["stored_trees", "stored_prices", "rebuilt_references"])
def test_queries(spark, name):
    assert differences(spark, name, catalogue.QUERIES[name], catalogue.ORACLES[name], "/root/testdata/sf0.01") == ""
    assert catalogue.QUERIES[name](spark, "/root/testdata/sf0.01").count() > 10
