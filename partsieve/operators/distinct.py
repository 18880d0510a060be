"""Dear expressions over texts that repeat: computed once for each distinct text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_distinct(rows: DataFrame, keys: Sequence[str], columns: Mapping[str, Column]) -> DataFrame:
    """rows with columns, expressions over keys alone, computed once for each combination of keys that occurs.

    The combinations are joined back, nulls to nulls; Spark broadcasts them where it measures that they are few, and else
    joins by sorting, splitting keys of very many rows. rows are read twice. Worth it where one row costs much and texts
    repeat, as names and labels do; not for texts that do not.
    """
    told = rows.select(*keys).distinct().select(*keys, *[c.alias(n) for n, c in columns.items()])
    told = told.withColumnsRenamed({k: f"_told_{i}" for i, k in enumerate(keys)})
    same = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(told[f"_told_{i}"]) for i, k in enumerate(keys)])
    return rows.join(told, same).drop(*[f"_told_{i}" for i in range(len(keys))])
