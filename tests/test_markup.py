"""Tables out of markup: nested tables, spans, broken markup, headers, totals, entities, links."""

import pytest

from partsieve.plans import catalogue
from partsieve.sources import markup
from tests.oracle import differences


def grid(spark, *texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "k long, html string")
    found = {}
    for r in markup.table_cells(rows, "k", "html").collect():
        found.setdefault((r["id"], r["table"]), {})[r["tr"], r["col"]] = r["value"]
    return {key: [[cells.get((tr, c)) for c in range(max(c for t, c in cells if t == tr) + 1)] for tr in sorted({t for t, _ in cells})] for key, cells in found.items()}


CASES = {
    "plain": ("<table><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></table>", {1: [["a", "b"], ["c"]]}),
    "never closed": ("x<TABLE border=1><TR><TD>a<TD>b<TR><TD>c", {1: [["a", "b"], ["c"]]}),
    "row never opened": ("<table><td>a</td><td>b</td></tr><td>c</td></table>", {1: [["a", "b"], ["c"]]}),
    "closes nothing": ("</table></td><table><tr></td><td>a</td></tr></table></table></table> t <table><tr><td>b</table>", {1: [["a"]], 2: [["b"]]}),
    "nested": ("<table><tr><td>a<table><tr><td>in</td></tr></table>after</td><td>b</td></tr></table>", {1: [["a after", "b"]], 2: [["in"]]}),
    "rowspan": ("<table><tr><td rowspan=2>a</td><td>b</td><td rowspan='3'>c</td></tr><tr><td>d</td></tr><tr><td>e</td><td>f</td></tr></table>", {1: [["a", "b", "c"], ["a", "d", "c"], ["e", "f", "c"]]}),
    "colspan": ('<table><tr><td colspan="2">a</td><td>b</td></tr><tr><td>c</td><td colspan=0>d</td></tr></table>', {1: [["a", "a", "b"], ["c", "d"]]}),
    "both, over the end": ("<table><tr><td>x</td><td colspan=2 rowspan=9>a</td></tr><tr><td>y</td><td>z</td></tr></table>", {1: [["x", "a", "a"], ["y", "a", "a", "z"]]}),
    "text": ("<table><tr><td> <b>a</b>&amp;b &lt;c&gt; &#65;&#x42;&#xD800; &nbsp; d<br>e<!-- <td>no --></td><td><script>'<td>'</script></td></tr></table>", {1: [["a &b <c> AB&#xD800; d e", ""]]}),
    "links": ('<table><tr><td>see <ext-link xlink:href="http://x.org/1">here</ext-link></td><td><ext-link href="http://y">http://y</ext-link></td></tr></table>', {1: [["see here [http://x.org/1]", "http://y"]]}),
    "other tags": ("<thead2><table><theadx><tr><td>a</td></tr></table>", {1: [["a"]]}),
}


def test_grids(spark):
    got = grid(spark, *(html for html, _ in CASES.values()), None, "", "no tables")
    want = {(i, t): rows for i, (_, tables) in enumerate(CASES.values()) for t, rows in tables.items()}
    for i, name in enumerate(CASES):
        assert {k: v for k, v in got.items() if k[0] == i} == {k: v for k, v in want.items() if k[0] == i}, name
    assert got.keys() == want.keys()


BOM = "<table><thead><tr><th>Part<th>Quantity</tr></thead><tbody><tr><td>R1</td><td>2</td><td>extra</td></tr><tr><td></td></tr><tr><td>Grand Total</td><td>9</td></tr></tbody><tfoot><tr><td>foot</td></tr></tfoot></table>"
FILES = "<table><tr><th>Design file name</th><th>Part number</th><th>Source</th></tr><tr><td>a</td><td>b</td><td>c</td></tr></table>"
SPECS = "<table><tr><td>x</td><td>y</td></tr></table><table><tr><th>Specifications table</th><td>t</td></tr><tr><td>Hardware name</td><td>Pump</td></tr><tr><td>License</td><td>MIT</td></tr><tr><td>License</td><td>CERN</td></tr><tr><td>empty</td><td></td></tr></table><table><tr><td>cost</td><td>5</td></tr></table>"


def test_rows_of_parts(spark):
    rows = spark.createDataFrame([(None, BOM), (None, BOM), (2, FILES), (3, SPECS)], "k long, html string")
    cells = markup.table_cells(rows, "k", "html")
    got = sorted((str(r["id"]), r["tr"], r["header"], r["value"]) for r in markup.parts_rows(cells).collect())
    assert got == sorted([("None", 2, "Part", "R1"), ("None", 2, "Quantity", "2"), ("None", 2, "column_2", "extra")] * 2)
    body = sorted((r["table"], r["tr"], r["header"], r["value"]) for r in markup.table_rows(cells).where("id = 2").collect())
    assert body == [(1, 2, "Design file name", "a"), (1, 2, "Part number", "b"), (1, 2, "Source", "c")]
    assert {(r["id"], r["key"], r["value"]) for r in markup.specifications(cells).collect()} == {(3, "Hardware name", "Pump"), (3, "License", "CERN")}
    assert markup.parts_rows(markup.table_cells(rows.limit(0), "k", "html")).count() == 0


@pytest.mark.parametrize("n", [3000])
def test_large_table(spark, n):
    html = "<table>" + "".join(f"<tr><td rowspan={1 + i % 3}>{i}<td>b{i}" for i in range(n))
    got = grid(spark, html)[0, 1]
    assert len(got) == n and sorted({x for r in got for x in r if x and x[0] == "b"}) == sorted(f"b{i}" for i in range(n))


@pytest.mark.parametrize("name", ["page_parts", "page_specifications"])
def test_queries(spark, name):
    assert differences(spark, name, catalogue.QUERIES[name], catalogue.ORACLES[name], "/root/testdata/sf0.01") == ""
