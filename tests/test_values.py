"""Electrical values in the reference's three notations."""

import random
import re

import pytest
from pyspark.sql import functions as F

from partsieve.functions import rules
from partsieve.functions.rules import electrical_value
from partsieve.operators.distinct import by_distinct
from partsieve.plans import domain
from tests.oracle import differences

CASES = [
    ("10k", "resistor", 1e4, "ohm"), ("10k", None, None, None), ("4.7 meg", "resistor", 4.7e6, "ohm"), ("10k", "capacitor", None, None), ("4k7", None, 4700.0, "ohm"),
    ("2u2", "capacitor", 2.2e-6, "F"), ("2u2", "inductor", 2.2e-6, "H"), ("4r7", None, 4.7, "ohm"), ("1m5", "resistor", 1.5e-3, "ohm"), ("1m5", "inductor", 1.5e-3, "H"),
    ("1m5", "diode", None, None), ("2meg2", None, 2.2e6, "ohm"), ("3gohm", None, 3e9, "ohm"), ("1megohm", None, 1e6, "ohm"), ("16mhz", "crystal", 0.016, "Hz"),
    ("5v", None, 5.0, "V"), ("2a", None, 2.0, "A"), ("100nf", None, 1e-7, "F"), ("", None, None, None), (None, "resistor", None, None),
]


def test_three_notations(spark):
    rows = spark.createDataFrame([(i, *c[:2]) for i, c in enumerate(CASES)], "id int, name string, category string")
    got = {r["id"]: r["v"] for r in rows.select("id", electrical_value(F.col("name"), F.col("category")).alias("v")).collect()}
    for i, (_, _, value, unit) in enumerate(CASES):
        assert got[i]["unit"] == unit
        assert got[i]["value"] == (None if value is None else pytest.approx(value))


def test_patterns_are_searched_only_where_their_texts_are(spark):
    r, words = random.Random(2), ["cc", "BY", "nc", "-", " ", "sa", "4.0", "CERN", "ohl", "s", "2", "\n", "gnu", "GPL", "v3", "mit", "Creative", "commons", "0", "null", "creativecommons.org/licenses/by-", "other", "é"]
    texts = ["".join(r.choices(words, k=r.randrange(6))) for _ in range(2000)] + ["other", "Null\n", "MİT", None]
    rows = spark.createDataFrame([(x,) for x in texts], "x string").select("x", F.lower("x").alias("low"))
    for pattern, _ in rules.LICENSES:
        held = [x.lower() for x in texts if x is not None and re.search(pattern, x, re.IGNORECASE | re.ASCII)]
        assert all(any(all(y in x for y in needed) for needed in rules.literals(pattern)) for x in held)
    got = rows.select(rules.first_match(F.col("x"), rules.LICENSES).alias("a"), rules.first_match(F.col("x"), rules.LICENSES, F.col("low")).alias("b")).collect()
    assert all(x["a"] == x["b"] for x in got) and len({x["a"] for x in got}) >= 10


def test_values_are_read_once_for_each_text(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(domain, "by_distinct", lambda rows, keys, columns: asked.append((keys, set(columns))) or by_distinct(rows, keys, columns))
    assert differences(spark, "part_values", domain.part_values, domain.ORACLES["part_values"], "/root/testdata/sf0.01") == ""
    assert differences(spark, "license_documents", domain.license_documents, domain.ORACLES["license_documents"], "/root/testdata/sf0.01") == ""
    assert asked == [(["reference", "raw"], {"category", "quantity", "v"})]
