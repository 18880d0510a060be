"""Parts lists out of spreadsheets (xlsx), as joins over the parts of each file.

A workbook is a zip of XML parts. A file is unzipped once, into one row a part; what the parts say, which sheet is the
first, what its cells hold and what shared strings they point to, are tables joined on the file.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from partsieve.sources.bom import HEADERS, canonical_columns
from partsieve.sources.markup import unescaped

WANTED = ("xl/workbook.xml", "xl/_rels/workbook.xml.rels", "xl/sharedStrings.xml", "xl/worksheets/")


def _unzipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            try:
                with zipfile.ZipFile(io.BytesIO(content.as_py() or b"")) as book:
                    found = [(n, book.read(n).decode("utf-8", "replace")) for n in book.namelist() if n.startswith(WANTED)]
            except zipfile.BadZipFile:
                continue
            yield pa.RecordBatch.from_pydict({"path": pa.array([path] * len(found), pa.string()), "part": pa.array([n for n, _ in found], pa.string()), "xml": pa.array([x for _, x in found], pa.string())})


def _attribute(markup: str, name: str) -> Column:
    return F.regexp_extract(markup, rf'(?s)^[^>]*?\s{name}="([^"]*)"', 1)


def _texts(markup: Column) -> Column:
    """All texts (t elements) of a string, one after the other; hints on how to read it (rPh) are none."""
    return unescaped(F.array_join(F.regexp_extract_all(F.regexp_replace(markup, r"(?s)<rPh\b.*?</rPh>", ""), F.lit(r"(?s)<t(?:\s[^>]*)?(?<!/)>(.*?)</t>")), ""))


def sheet_cells(files: DataFrame) -> DataFrame:
    """path, row, col (both from 1), value: the cells of the first sheet of each workbook (path, content), as text.

    Numbers are as they are written, truth values are true or false, shared and inline strings their text, formulas their
    last result; empty cells are left out, and so are files that are no zip or have no sheet.
    """
    parts = files.select("path", "content").mapInArrow(_unzipped, "path string, part string, xml string")
    part = lambda name: parts.where(F.col("part") == name)
    sheet = F.regexp_extract("xml", r"(?s)(<sheet\s[^>]*>)", 1)
    first = part("xl/workbook.xml").select("path", sheet.alias("sheet")).select("path", _attribute("sheet", "r:id").alias("id"))
    links = part("xl/_rels/workbook.xml.rels").select("path", F.explode(F.regexp_extract_all("xml", F.lit(r"(?s)(<Relationship\s[^>]*>)"))).alias("link"))
    links = links.select("path", _attribute("link", "Id").alias("id"), F.concat(F.lit("xl/"), F.regexp_replace(_attribute("link", "Target"), "^(/?xl/|/)", "")).alias("part"))
    sheets = parts.where(F.col("part").startswith("xl/worksheets/")).join(first.join(links, ["path", "id"]), ["path", "part"], "left_semi")

    cells = sheets.select("path", F.explode(F.split("xml", r"(?=<c[\s>])")).alias("cell")).where(F.col("cell").rlike(r"^<c\s[^>]*(?<!/)>"))
    place = _attribute("cell", "r")
    letters = F.split(F.regexp_extract(place, "^([A-Z]{1,3})", 1), "")
    number = F.aggregate(letters, F.lit(0), lambda n, x: F.when(x == "", n).otherwise(n * 26 + F.ascii(x) - 64))
    inside = F.regexp_extract("cell", r"(?s)<v(?:\s[^>]*)?>(.*?)</v>", 1)
    cells = cells.select("path", F.regexp_extract(place, r"(\d+)$", 1).try_cast("long").alias("row"), number.cast("long").alias("col"), _attribute("cell", "t").alias("kind"), unescaped(inside).alias("inside"), _texts(F.col("cell")).alias("own"))
    cells = cells.withColumn("index", F.when(F.col("kind") == "s", F.col("inside").try_cast("int")))
    strings = part("xl/sharedStrings.xml").select("path", F.posexplode(F.split("xml", r"<si(?:\s[^>]*)?/?>")).alias("index", "string"))
    strings = strings.select("path", (F.col("index") - 1).alias("index"), _texts(F.col("string")).alias("shared"))
    kind = F.col("kind")
    value = F.when(kind == "s", F.col("shared")).when(kind == "inlineStr", F.col("own")).when(kind == "b", F.when(F.col("inside") == "1", "true").otherwise("false")).otherwise(F.col("inside"))
    out = cells.join(strings, ["path", "index"], "left").select("path", "row", "col", value.alias("value"))
    return out.where("value <> '' and row is not null and col > 0")


def parse_workbooks(files: DataFrame) -> DataFrame:
    """Canonical parts-list rows of workbooks (path, content), as sources.bom gives them for delimited files: path, row, then
    the columns of HEADERS. The first row with a cell has the headers; rows without a known column but a footprint are left out."""
    cells = sheet_cells(files)
    of_file = Window.partitionBy("path")
    named = cells.withColumn("head", F.min("row").over(of_file))
    header = F.max(F.when(F.col("row") == F.col("head"), F.lower(F.trim("value")))).over(Window.partitionBy("path", "col"))
    named = named.withColumn("header", header).where("row > head and header is not null")
    one = named.groupBy("path", "row", "header").agg(F.min_by("value", "col").alias("value"))
    rows = one.groupBy("path", "row").agg(F.map_from_entries(F.collect_list(F.struct("header", "value"))).alias("cells"))
    out = rows.select("path", "row", *canonical_columns(F.col("cells")))
    return out.where(F.coalesce(*[c for c in HEADERS if c != "footprint"]).isNotNull())


def read_workbooks(spark: SparkSession, path: str) -> DataFrame:
    """Canonical parts-list rows of all xlsx files under a path."""
    return parse_workbooks(spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.xlsx").load(path))
