"""Parts lists in XML: four dialects told by their root element, read with Spark's XML functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partsieve.functions.links import is_false_path
from partsieve.functions.text import strip
from partsieve.sources.bom import HEADERS

# Where each dialect keeps its rows.
_KICAD = "components struct<comp: array<struct<_ref: string, value: string, footprint: string, manufacturer: string, mpn: string, fields: struct<field: array<struct<_name: string, _VALUE: string>>>>>>"
_FLAT = "component array<map<string, string>>"
_PARTS = "parts struct<part: array<struct<_name: string, _value: string, _device: string, attribute: array<struct<_name: string, _value: string>>>>>"
_EAGLE = f"drawing struct<schematic: struct<{_PARTS.replace(' ', ': ', 1)}>>"
_SHEET = "Worksheet array<struct<Table: struct<Row: array<struct<Cell: array<struct<Data: struct<_VALUE: string>>>>>>>>"


def _entries(pairs: list[tuple[str, Column]]) -> Column:
    return F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in pairs])


def _named(items: Column, key: str, value: str) -> Column:
    """Entries of a list of named values; null gives none."""
    found = F.transform(items, lambda x: F.struct(F.lower(strip(x[key])).alias("key"), x[value].alias("value")))
    return F.coalesce(found, F.array().cast("array<struct<key: string, value: string>>"))


def _kicad(text: Column) -> Column:
    rows = F.from_xml(text, _KICAD)["components"]["comp"]
    fields = lambda r: _entries([("reference", r["_ref"]), ("value", r["value"]), ("footprint", r["footprint"]), ("manufacturer", r["manufacturer"]), ("mpn", r["mpn"])])
    return F.transform(rows, lambda r: F.concat(fields(r), _named(r["fields"]["field"], "_name", "_VALUE")))


def _flat(text: Column) -> Column:
    rows = F.from_xml(text, _FLAT)["component"]
    return F.transform(rows, lambda r: F.transform(F.map_entries(r), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))))


def _eagle(text: Column) -> Column:
    rows = F.filter(F.from_xml(text, _EAGLE)["drawing"]["schematic"]["parts"]["part"], lambda r: r["_name"].isNotNull())
    fields = lambda r: _entries([("reference", r["_name"]), ("value", r["_value"]), ("footprint", r["_device"])])
    return F.transform(rows, lambda r: F.concat(fields(r), _named(r["attribute"], "_name", "_value")))


def _sheet(text: Column) -> Column:
    rows = F.from_xml(text, _SHEET, {"ignoreNamespace": "true"})["Worksheet"][0]["Table"]["Row"]
    cells = F.filter(F.transform(rows, lambda r: F.transform(r["Cell"], lambda c: F.coalesce(strip(c["Data"]["_VALUE"]), F.lit("")))), lambda r: F.size(r) > 0)
    names = F.transform(F.get(cells, F.lit(0)), lambda h: F.lower(h))
    pair = lambda r: F.filter(F.zip_with(names, F.slice(r, 1, F.size(names)), lambda k, v: F.struct(k.alias("key"), v.alias("value"))), lambda e: F.coalesce(e["key"] != "", F.lit(False)))
    return F.transform(F.slice(cells, 2, F.greatest(F.size(cells) - 1, F.lit(0))), pair)


def xml_parts(files: DataFrame) -> DataFrame:
    """files: path, content (bytes). Canonical rows: path, line (from 0), the columns of HEADERS.

    UTF-16 files are told by their mark, others are UTF-8. Other roots and texts that do not parse give no rows, nor do
    rows without a known cell other than the footprint. Of headers that are equal without case, the last counts.
    """
    utf16 = F.hex(F.substring("content", 1, 2)).isin("FFFE", "FEFF")
    text = F.when(utf16, F.decode("content", "UTF-16")).otherwise(F.decode("content", "UTF-8"))
    text = F.regexp_replace(text, r"^\x{FEFF}|^\s*<\?xml[^>]*\?>", "")
    root = F.regexp_extract("text", r"^(?:\s|<!--[\s\S]*?-->|<[?!][^>]*>)*<(?:\w+:)?(\w+)", 1)
    rows = F.when(F.col("root") == "export", _kicad(F.col("text"))).when(F.col("root") == "schematic", _flat(F.col("text"))).when(F.col("root") == "eagle", _eagle(F.col("text"))).when(F.col("root") == "Workbook", _sheet(F.col("text")))
    each = files.where(~is_false_path(F.col("path"))).select("path", text.alias("text")).withColumn("root", root).select("path", F.posexplode(rows).alias("line", "cells"))
    said = F.filter(F.reverse("cells"), lambda e: strip(e["value"]) != "")
    cell = lambda h: F.get(F.filter(said, lambda e: e["key"] == h), F.lit(0))["value"]
    out = each.select("path", "line", *[F.coalesce(*map(cell, names)).alias(c) for c, names in HEADERS.items()])
    return out.where(F.coalesce(*[F.col(c) for c in HEADERS if c != "footprint"]).isNotNull())


def read_xml_parts(spark: SparkSession, path: str) -> DataFrame:
    """Canonical rows of all XML files under a path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.xml").load(path)
    return xml_parts(files.select("path", "content"))
