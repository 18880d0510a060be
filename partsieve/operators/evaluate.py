"""Agreement of predictions with ground truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(rows: DataFrame, predicted: Column, truth: Column) -> DataFrame:
    """One row: tp, fp, tn, fn and the rates, 0 where a denominator is."""
    n = rows.agg(
        F.count_if(predicted & truth).alias("tp"),
        F.count_if(predicted & ~truth).alias("fp"),
        F.count_if(~predicted & ~truth).alias("tn"),
        F.count_if(~predicted & truth).alias("fn"),
    )
    rate = lambda x, y: F.coalesce(F.try_divide(F.col(x), F.col(x) + F.col(y)), F.lit(0.0))
    return n.select("*", rate("fp", "tn").alias("fpr"), rate("fn", "tp").alias("fnr"), rate("tp", "fp").alias("precision"), rate("tp", "fn").alias("recall"))
