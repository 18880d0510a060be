"""Documentation scores from flags and signals: completeness, coverage, depth, openness."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights of the completeness score.
WEIGHTS = {"bom": 20, "license": 15, "repo": 15, "readme": 10, "doc_url": 10, "description": 10, "contributors": 10, "author": 5, "timestamps": 3, "tags": 2}
DIMENSIONS = ["description", "license", "multi_license", "repo", "doc_url", "bom", "contributors", "tags", "publication", "readme", "issues"]


def _one(flag: Column) -> Column:
    return F.when(F.coalesce(flag.cast("boolean"), F.lit(False)), 1).otherwise(0)


def completeness(flags: dict[str, Column]) -> Column:
    """0 to 100; absent and null flags count nothing."""
    return reduce(lambda a, b: a + b, [_one(flags[k]) * w for k, w in WEIGHTS.items() if k in flags], F.lit(0)).cast("long")


def coverage(flags: dict[str, Column]) -> Column:
    """Share of twelve dimensions, the first of which always holds, half to even."""
    n = reduce(lambda a, b: a + b, [_one(flags[k]) for k in DIMENSIONS if k in flags], F.lit(1))
    return F.bround(n / 12 * 100).cast("long")


def depth(description_len: Column, bom_count: Column, license_specificity: Column, health: Column, contributors: Column, releases: Column, years: Column) -> Column:
    """Mean of the signals that are there, each 0 to 100, half to even; none give 0."""
    up_to = lambda c, most: F.when(c.isNotNull(), F.least(c / F.lit(float(most)), F.lit(1.0)) * 100)
    signals = F.array_compact(
        F.array(
            F.when(description_len > 0, up_to(description_len, 500)),
            F.when(bom_count > 0, up_to(bom_count, 10)),
            license_specificity.cast("double"),
            health.cast("double"),
            F.when(contributors > 0, up_to(contributors, 5)),
            up_to(releases, 3),
            F.when(years.isNotNull(), F.greatest(F.lit(0.0), 100 - years * 20)),
        )
    )
    total = F.aggregate(signals, F.lit(0.0), lambda a, b: a + b)
    return F.coalesce(F.bround(F.try_divide(total, F.size(signals))), F.lit(0)).cast("long")


def openness(flags: dict[str, Column]) -> Column:
    """0 to 8: published files, parts list, assembly, editable files (repo again), licence, version control, contribution guide, issues."""
    names = ["repo", "bom", "assembly", "repo", "license", "vcs", "contributing", "issues"]
    return reduce(lambda a, b: a + b, [_one(flags[k]) for k in names if k in flags], F.lit(0)).cast("long")
