"""Flattened verdicts against the same rules in plain Python, over random JSON."""

import json
import random

from partsieve.functions import verdicts
from partsieve.plans import catalogue
from tests.oracle import differences

VALUES = [None, True, False, 0, 1, 2.5, 0.0, "", "x", "12", " 7 ", [], [0], {}, {"a": 1}, -3]


def plain(v):
    out = {}
    for name, group, field, kind in verdicts.FIELDS:
        g = v
        for part in group.split("."):
            g = g.get(part, {}) if isinstance(g, dict) else None
        x = g.get(field) if isinstance(g, dict) else None
        if not isinstance(g, dict):
            out[name] = None
        elif kind == "flag":
            out[name] = int(bool(x))
        elif kind == "count":
            try:
                out[name] = int(x) if x else 0
            except (ValueError, TypeError):
                out[name] = None
        elif kind == "licence" and not g.get("present"):
            out[name] = None
        else:
            out[name] = x if x is None or isinstance(x, str) else "0" if type(x) is float and x == 0 else json.dumps(x, separators=(",", ":"))
    return out


def test_against_plain_rules(spark):
    r = random.Random(6)

    def group(fields):
        return r.choice([{f: r.choice(VALUES) for f in fields if r.random() < 0.8}] * 6 + [None, "text", 3, []])

    rows = []
    for i in range(200):
        v = {}
        for outer in dict.fromkeys(g.split(".")[0] for _, g, _, _ in verdicts.FIELDS):
            inner = list(dict.fromkeys(g.split(".")[1] for _, g, _, _ in verdicts.FIELDS if g.startswith(outer + ".")))
            fields = [f for _, g, f, _ in verdicts.FIELDS if g.split(".")[0] == outer] + ["present"]
            if r.random() < 0.85:
                v[outer] = {k: group(fields) for k in inner if r.random() < 0.8} if inner and r.random() < 0.9 else group(fields)
        rows.append((i, json.dumps(v), v))
    df = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(900, "[1]"), (901, "no"), (902, None)], "id long, t string")
    got = {x["id"]: x.asDict() for x in verdicts.flattened(df, "t").collect()}
    assert len(got) == len(rows)
    for i, _, v in rows:
        assert got[i] == {"id": i} | plain(v), v


def test_query(spark):
    assert differences(spark, "verdict_fields", catalogue.QUERIES["verdict_fields"], catalogue.ORACLES["verdict_fields"], "/root/testdata/sf0.01") == ""


def test_fields_of_a_kind_are_read_by_one_expression(spark):
    """Fields side by side, each with expressions of its own, are more than the JVM compiles."""
    df = spark.createDataFrame([(1, ' \n{"bom": {"present": 1}}'), (2, ' [{"bom": 1}]'), (3, '"{}"'), (4, "{bad}")], "id long, t string")
    out = verdicts.flattened(df, "t")
    assert [(x["id"], x["bom_present"]) for x in out.collect()] == [(1, 1)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("transform(") == 4 and plan.count("schema_of_variant") < 20
