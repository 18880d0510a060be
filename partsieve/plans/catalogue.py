"""All registered queries and oracles but those of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from partsieve.plans import domain, files, flows, pages, parts_files, records, relational, reports, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = relational.QUERIES | domain.QUERIES | records.QUERIES | reports.QUERIES | files.QUERIES | flows.QUERIES | pages.QUERIES | parts_files.QUERIES | stored.QUERIES
ORACLES: dict[str, str] = relational.ORACLES | domain.ORACLES | records.ORACLES | reports.ORACLES | files.ORACLES | flows.ORACLES | pages.ORACLES | parts_files.ORACLES | stored.ORACLES
