"""Bills of materials from delimited files with unknown encodings, preambles and headers."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Header names of each canonical column, the preferred first (lower case).
HEADERS = {
    "reference": [
        "designator", "reference", "ref", "refdes", "references", "designation", "part/designator", "ref name (refdes)", "refs",
        "reference(s)", "designators", "reference designator", "reference designators", "ref des", "parts", "line-note", "line note",
    ],
    "component_name": [
        "value", "description", "device", "name", "part", "comment", "component", "value5", "part description", "part name", "cmp name",
        "libpart", "libref", "comments", "descr", "designitemid", "parttype",
    ],
    "quantity_raw": [
        "qty", "quantity", "qnty", "count", "qty:", "quantity per pcb", "num used", "build quantity", "order qty", "order qty.",
    ],
    "manufacturer": [
        "manufacturer", "mf", "vendor", "manufacturer 1", "manufacturer (avl)", "supplier", "manufacturer name", "manufacturers name",
        "mfr.", "mfg", "supplier name",
    ],
    "part_number": [
        "mpn", "manufacturer part", "partnumber", "manufacturer p/n", "partno", "part number", "part no", "manufacture part number",
        "manufacturer part number 1", "part no and description", "man. p/n", "sup. p/n", "manufacturer part number",
        "manufacturers part number", "manufacturer's part number", "mfr. no", "mfr. no.", "manf part #", "mfg part #",
        "digi-key part number", "digikey", "mouser part number", "mouser", "lcsc", "lcsc part #", "lcsc part number", "supplier pn",
        "supplier part number", "supplier p/n", "part no.", "p/n", "spn",
    ],
    "unit_cost_raw": [
        "cost", "price", "unit price $", "cost/pcs", "price/part", "cost (feb-16)", "price (ex. vat)", "unit price", "unit cost",
        "extended price", "total cost", "price each",
    ],
    "footprint": [
        "footprint", "package", "pattern", "case/package", "case", "pcb footprint", "footprint lib",
    ],
}
PREAMBLE = {"", "source:", "date:", "tool:", "generator:"}
SHAPE = "path string, line int, " + ", ".join(f"{c} string" for c in HEADERS)


def decode(raw: bytes) -> str:
    """UTF-16 by its mark, else UTF-8 with replacement."""
    for mark, name in ((b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be"), (b"\xef\xbb\xbf", "utf-8")):
        if raw.startswith(mark):
            return raw[len(mark) :].decode(name, "replace")
    return raw.decode("utf-8", "replace")


def records(raw: bytes, sep: str | None = None) -> list[dict[str, str]]:
    """Rows by lower-cased header: comments, preamble and leading lines without the separator are dropped. The separator is
    guessed from the first line that is left, if it is not given."""
    lines = [x for x in decode(raw).splitlines() if x.strip() and not x.lstrip().startswith("#")]
    while lines and lines[0].split(",")[0].strip().strip('"').lower() in PREAMBLE:
        lines.pop(0)
    if not lines:
        return []
    tabs, semis, commas = (lines[0].count(c) for c in "\t;,")
    sep = sep or ("\t" if tabs > max(semis, commas) else ";" if semis > commas else ",")
    head = next((i for i, x in enumerate(lines) if sep in x), len(lines))
    table = list(csv.reader(io.StringIO("\n".join(lines[head:])), delimiter=sep))
    names = [h.strip().lower() for h in table[0]] if table else []
    return [dict(zip(names, row, strict=False)) for row in table[1:]]


def canonical(row: dict[str, str]) -> dict[str, str | None]:
    """The seven columns of a row: for each the first of its headers that holds something."""
    return {c: next((row[h] for h in names if row.get(h)), None) for c, names in HEADERS.items()}


def _parse(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        out = []
        for path, content in zip(part["path"], part["content"], strict=True):
            for i, row in enumerate(records(bytes(content), "\t" if path.lower().endswith(".tsv") else None)):
                cells = canonical(row)
                if any(v for c, v in cells.items() if c != "footprint"):
                    out.append({"path": path, "line": i} | cells)
        yield pd.DataFrame(out, columns=["path", "line", *HEADERS])


def parse_bom(files: DataFrame) -> DataFrame:
    """Canonical parts-list rows of delimited files (path, content), as Spark's binaryFile source gives them; line counts the
    rows of a file from 0. Files ending in .tsv are cut at tabs; files without known columns give none. One file is one
    task's row, and is parsed whole."""
    return files.select("path", "content").mapInPandas(_parse, SHAPE)


def read_bom(spark: SparkSession, path: str) -> DataFrame:
    """Canonical parts-list rows of all delimited files under a path."""
    return parse_bom(spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{csv,tsv,txt}").load(path))


def canonical_columns(cells: Column) -> list[Column]:
    """The columns of HEADERS out of a map from lower-cased headers to texts: for each the first of its headers that holds
    something."""
    return [F.coalesce(*[F.nullif(F.try_element_at(cells, F.lit(h)), F.lit("")) for h in names]).alias(c) for c, names in HEADERS.items()]
