"""Parts lists out of files of every kind, made of the parts, a few hundred a file."""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partsieve.session import table as t
from partsieve.sources.bom import parse_bom
from partsieve.sources.workbooks import parse_workbooks

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


#: Parts of a file.
PARTS = 300
_FILE = f"p_partkey // {PARTS}"
_NAME = "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_name || ' & <' || p_type || '>' END"


def _workbook(rows: pa.Table) -> pa.Table:
    """One xlsx file: its first sheet is the second part; designators inline, texts shared, numbers plain, some cells left out."""
    rows = rows.sort_by("p_partkey").to_pydict()
    strings: dict[str, int] = {}
    text = lambda at, s: f'<c r="{at}" t="s"><v>{strings.setdefault(s, len(strings))}</v></c>' if s is not None else f'<c r="{at}" s="1"/>'
    lines = ['<row r="2">' + "".join(text(f"{c}2", h) for c, h in zip(("A", "B", "D", "E", "AB"), ("RefDes", " Value", "QTY", "Mfg", "Unit Price"), strict=True)) + "</row>"]
    for i, (key, name, brand, size, cents) in enumerate(zip(*(rows[c] for c in ("p_partkey", "name", "p_brand", "p_size", "cents")), strict=True), 3):
        cells = f'<c r="A{i}" t="inlineStr"><is><t>R{key}</t></is></c>' + text(f"B{i}", name) + f'<c r="D{i}"><v>{size}</v></c>' + text(f"E{i}", brand) + f'<c r="AB{i}" s="2"><f>1+1</f><v>{cents}</v></c>'
        lines.append(f'<row r="{i}">{cells}</row>')
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr("xl/workbook.xml", '<workbook><sheets><sheet name="Parts" sheetId="2" r:id="rId7"/><sheet name="Other" sheetId="1" r:id="rId1"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="rId1" Target="worksheets/sheet1.xml"/><Relationship Target="/xl/worksheets/sheet2.xml" Id="rId7"/></Relationships>')
        book.writestr("xl/worksheets/sheet1.xml", '<worksheet><sheetData><row r="1"><c r="A1"><v>9</v></c></row></sheetData></worksheet>')
        book.writestr("xl/worksheets/sheet2.xml", "<worksheet><sheetData>" + "".join(lines) + "</sheetData></worksheet>")
        book.writestr("xl/sharedStrings.xml", "<sst>" + "".join(f'<si><r><t xml:space="preserve">{escape(s[:2])}</t></r><r><t>{escape(s[2:])}</t></r></si>' for s in strings) + "</sst>")
    return pa.table({"path": [f"book{rows['file'][0]}.xlsx"], "content": pa.array([out.getvalue()], pa.binary())})


@query(f"""SELECT 'book' || {_FILE} || '.xlsx' AS path, p_partkey % {PARTS} + 3 AS "row", 'R' || p_partkey AS reference, {_NAME} AS component_name, CAST(p_size AS VARCHAR) AS quantity_raw, p_brand AS manufacturer, CAST(CAST(round(p_retailprice * 100) AS BIGINT) AS VARCHAR) AS unit_cost_raw FROM part""")
def workbook_parts(s: SparkSession, d: str) -> DataFrame:
    """Parts lists of spreadsheets."""
    rows = t(s, d, "part").select(F.expr(f"p_partkey DIV {PARTS}").alias("file"), "p_partkey", F.expr(_NAME).alias("name"), "p_brand", "p_size", F.round(F.col("p_retailprice") * 100).cast("long").alias("cents"))
    files = rows.groupBy("file").applyInArrow(_workbook, "path string, content binary")
    return parse_workbooks(files).select("path", "row", "reference", "component_name", "quantity_raw", "manufacturer", "unit_cost_raw")


@query(f"""SELECT 'list' || {_FILE} || CASE {_FILE} % 4 WHEN 3 THEN '.tsv' ELSE '.csv' END AS path, CAST(p_partkey % {PARTS} AS INT) AS line, 'R' || p_partkey AS reference, p_name || CASE {_FILE} % 4 WHEN 1 THEN '; "x"' WHEN 3 THEN ', y' ELSE '' END AS component_name,
CAST(p_size AS VARCHAR) AS quantity_raw, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_brand END AS part_number FROM part""")
def delimited_parts(s: SparkSession, d: str) -> DataFrame:
    """Parts lists of delimited files: with comments and preambles, semicolons and quotes, UTF-16 under a title, tabs."""
    kind = F.expr(f"p_partkey DIV {PARTS}") % 4
    name = F.when(kind == 1, F.concat(F.lit('"'), "p_name", F.lit('; ""x"""'))).when(kind == 3, F.concat("p_name", F.lit(", y"))).otherwise(F.col("p_name"))
    number = F.when(F.col("p_partkey") % 5 == 0, "").otherwise(F.col("p_brand"))
    sep = F.when(kind == 1, ";").when(kind == 3, "\t").otherwise(",")
    line = F.concat_ws("\u0001", F.concat(F.lit("R"), "p_partkey"), name, F.col("p_size"), number)
    rows = t(s, d, "part").select(F.expr(f"p_partkey DIV {PARTS}").alias("file"), kind.alias("kind"), "p_partkey", F.replace(line, F.lit("\u0001"), sep).alias("line"))
    files = rows.groupBy("file", "kind").agg(F.array_join(F.array_sort(F.collect_list(F.struct("p_partkey", "line")))["line"], "\n").alias("body"))
    head = F.when(F.col("kind") == 0, '# made by hand\nSource:,board.sch\n"Date:",now\n\nRef,Value,Qty,MPN\n').when(F.col("kind") == 1, "Designator;Comment;Quantity;Manufacturer Part Number\n").when(F.col("kind") == 2, "Parts of a board\nReference,Value,Qty,Part Number\n").otherwise("A title, with a comma\nRefs\tValue\tCount\tMPN\n")
    text = F.concat(head, "body")
    content = F.when(F.col("kind") == 2, F.concat(F.unhex(F.lit("FFFE")), F.encode(text, "UTF-16LE"))).otherwise(F.encode(text, "UTF-8"))
    path = F.concat(F.lit("list"), "file", F.when(F.col("kind") == 3, ".tsv").otherwise(".csv"))
    return parse_bom(files.select(path.alias("path"), content.alias("content"))).select("path", "line", "reference", "component_name", "quantity_raw", "part_number")
