"""Part taxonomy over all of its cases, and expressions computed once for each distinct text."""

from collections import Counter

from pyspark.sql import functions as F

from partsieve.operators.distinct import by_distinct
from partsieve.plans import catalogue, records
from partsieve.session import table
from tests.oracle import differences

SF = "/root/testdata/sf0.01"


def test_taxonomy_on_every_case(spark):
    lines = table(spark, SF, "lineitem")
    for key, values in (("l_orderkey", records._REFS), ("l_partkey", records._NAMES), ("l_suppkey", records._FEET)):
        assert lines.select((F.col(key) % len(values)).alias("case")).distinct().count() == len(values)
    assert differences(spark, "part_taxonomy", catalogue.QUERIES["part_taxonomy"], catalogue.ORACLES["part_taxonomy"], SF) == ""


def test_by_distinct(spark):
    cells = [(1, "a", None), (2, "a", None), (3, None, None), (4, None, 5), (5, "b", 5)]
    rows = spark.createDataFrame(cells, "n long, k string, m long")
    got = by_distinct(rows, ["k", "m"], {"both": F.concat_ws("-", "k", "m")})
    assert got.columns == ["n", "k", "m", "both"]
    assert Counter(tuple(r) for r in got.collect()) == Counter((n, k, m, "-".join(str(x) for x in (k, m) if x is not None)) for n, k, m in cells)
    assert by_distinct(rows.limit(0), ["k"], {"x": F.col("k")}).count() == 0
