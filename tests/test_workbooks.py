"""Spreadsheets and delimited parts lists."""

import io
import zipfile

import pytest

from partsieve.plans import catalogue
from partsieve.sources.bom import records
from partsieve.sources.workbooks import parse_workbooks, sheet_cells
from tests.oracle import differences


def book(sheet, strings="", workbook='<sheet name="a" r:id="r1"/>', rels='<Relationship Id="r1" Target="worksheets/s.xml"/>'):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, xml in (("xl/workbook.xml", workbook), ("xl/_rels/workbook.xml.rels", rels), ("xl/worksheets/s.xml", sheet), ("xl/sharedStrings.xml", strings)):
            z.writestr(name, xml)
    return out.getvalue()


def test_cells(spark):
    sheet = """<row><c r="A1" t="s"><v>1</v></c><c r="B1"/><c r="ZZ12" t="b"><v>1</v></c><c r="C3" t="str"><f>A1&amp;""</f><v>a &lt; b</v></c>
<c r="D4" s="3"><v>2.50</v></c><c r="E5" t="inlineStr"><is><r><t>in</t></r><r><t xml:space="preserve"> line</t></r></is></c><c r="F6" t="s"><v>9</v></c><c t="s"><v>0</v></c></row>"""
    strings = "<sst><si><t>zero</t></si><si><t>one &amp; </t><rPh><t>hint</t></rPh><t>all</t></si><si/></sst>"
    files = spark.createDataFrame([("x.xlsx", book(sheet, strings)), ("bad.xlsx", b"no zip"), ("none.xlsx", book("", workbook="")), ("null.xlsx", None)], "path string, content binary")
    got = {(r["path"], r["row"], r["col"], r["value"]) for r in sheet_cells(files).collect()}
    assert got == {("x.xlsx", 1, 1, "one & all"), ("x.xlsx", 12, 702, "true"), ("x.xlsx", 3, 3, "a < b"), ("x.xlsx", 4, 4, "2.50"), ("x.xlsx", 5, 5, "in line")}
    assert parse_workbooks(files.limit(0)).count() == 0


def test_headers(spark):
    cell = lambda at, v: f'<c r="{at}" t="inlineStr"><is><t>{v}</t></is></c>'
    sheet = cell("A3", "Description") + cell("B3", "Value") + cell("C3", "Package") + cell("D3", "Value") + cell("A4", "d") + cell("B5", "v") + cell("A5", "e") + cell("D5", "w") + cell("C6", "only a package") + cell("Z7", "no header")
    rows = parse_workbooks(spark.createDataFrame([("x.xlsx", book(sheet))], "path string, content binary")).collect()
    assert {(r["row"], r["component_name"], r["footprint"]) for r in rows} == {(4, "d", None), (5, "v", None)}


def test_titles_and_tabs():
    assert records(b"Title only\nRef,Value\nR1,10k\n") == [{"ref": "R1", "value": "10k"}]
    assert records(b"a, b\nRef\tValue\nR1\t1,5\n", "\t") == [{"ref": "R1", "value": "1,5"}]
    assert records(b"no separator\nat all\n") == [] == records(b"")


@pytest.mark.parametrize("name", ["workbook_parts", "delimited_parts"])
def test_queries(spark, name):
    assert differences(spark, name, catalogue.QUERIES[name], catalogue.ORACLES[name], "/root/testdata/sf0.01") == ""
    assert catalogue.QUERIES[name](spark, "/root/testdata/sf0.01").count() == 2000
