"""Text helpers on the values that tell them from their near relatives."""

import pytest
from pyspark.sql import functions as F

from partsieve.functions import text

CASES = {
    "title_case": [("o'neil mc-donald 3d", "O'Neil Mc-Donald 3D"), ("ÉCLAIR über", "Éclair Über"), ("", "")],
    "strip": [("  a  ", "a"), ("\t\n", "")],
    "collapse": [("a  b \n c", "a b c")],
    "repo_key": [(" HTTPS://GitHub.com/A/B.git/ ", "github.com/a/b"), ("https://www.github.com/a/b", None), ("gitlab.com/a/b?x/y", "gitlab.com/a/b?x")],
    "doi": [("https://dx.doi.org/10.1/ABC ", "10.1/abc"), ("10.1/x", "10.1/x")],
    "strict_int": [(" -7 ", -7), ("12.0", None), ("1,000", None)],
    "to_int": [("1,234.9", 1234), ("-0.5", 0), ("$5", None), ("", None)],
    "to_float": [("$1,234.50", 1234.5), ("1e3", 1000.0), ("nan", None)],
}


@pytest.mark.parametrize("name", CASES)
def test_values(spark, name):
    rows = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(CASES[name])], "i int, x string")
    got = {r["i"]: r["y"] for r in rows.select("i", getattr(text, name)(F.col("x")).alias("y")).collect()}
    assert [got[i] for i in sorted(got)] == [y for _, y in CASES[name]]
