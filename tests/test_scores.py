"""Documentation scores, with customers that have no orders."""

import os

from pyspark.sql import functions as F

from partsieve.plans import catalogue
from tests.oracle import TABLES, differences

SF = "/root/testdata/sf0.01"


def test_doc_scores_without_orders(spark, tmp_path):
    for name in TABLES:
        os.symlink(f"{SF}/{name}.parquet", tmp_path / f"{name}.parquet")
    os.unlink(tmp_path / "orders.parquet")
    spark.read.parquet(f"{SF}/orders.parquet").where(F.col("o_custkey") % 3 > 0).write.parquet(str(tmp_path / "orders.parquet"))
    assert differences(spark, "doc_scores", catalogue.QUERIES["doc_scores"], catalogue.ORACLES["doc_scores"], str(tmp_path)) == ""
