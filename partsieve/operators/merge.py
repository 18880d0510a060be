"""Upserts without a row store: union of old and new rows with an ordinal, one aggregation per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _kept(column: str, policy: str, order: Column) -> Column:
    c = F.col(column)
    said = F.when(c.isNotNull(), order)
    return {
        "first": F.min_by(F.struct(c), order)[column],
        "last": F.max_by(F.struct(c), order)[column],
        "first_known": F.min_by(c, said),
        "last_known": F.max_by(c, said),
    }[policy].alias(column)


def merge(rows: DataFrame, keys: Sequence[str], order: Sequence[str], policies: Mapping[str, str]) -> DataFrame:
    """One row a key. Policies by column: first, last (nulls overwrite), first_known, last_known (nulls do not).

    order: columns of a total order within a key. Null keys conflict like any others; see merge_partial.
    """
    at = F.struct(*order)
    return rows.groupBy(*keys).agg(*[_kept(c, p, at) for c, p in policies.items()])


def merge_partial(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key whose parts are all known; rows with a null in the key never conflict and all stay."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    whole = F.struct(*[F.col(c) for c in rows.columns])
    first = rows.where(known).groupBy(*keys).agg(F.min_by(whole, F.struct(*order)).alias("row")).select("row.*")
    return first.unionByName(rows.where(~known))


def replace_groups(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete and insert: groups that come in replace those that are there."""
    return existing.join(incoming.select(*keys).distinct(), list(keys), "left_anti").unionByName(incoming)


def fill_known(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """existing with its null fields filled from incoming (one row a key); known fields and other rows stay as they are."""
    others = [c for c in existing.columns if c not in keys]
    new = incoming.select(*keys, *[F.col(c).alias(f"new_{i}") for i, c in enumerate(others)])
    return existing.join(new, list(keys), "left").select(*keys, *[F.coalesce(F.col(c), F.col(f"new_{i}")).alias(c) for i, c in enumerate(others)])
