"""Tables out of HTML and article XML, rebuilt from the stream of their tags.

A text is split before every tag that shapes a table; each part is a tag and what follows it up to the next. Depths,
tables, rows and cells are running sums and last values over the parts of one text, so broken markup needs no repair: a
cell ends where another begins, a row that was never opened begins with its first cell, tags that close nothing change
nothing. All windows share one shuffle, by text. Which columns a cell takes depends on the cells that reach down from the
rows above: a small function over the sorted cells places them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHAPING = ("table", "thead", "tbody", "tfoot", "tr", "td", "th")
#: What is no text of a page.
IGNORED = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
NAMED = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&amp;": "&"}
#: First cells of a table of specifications.
SPECS_WORDS = ("hardware name", "subject area", "hardware type", "cost", "license")
#: Words of the headers of a parts list, two of which make one.
PARTS_WORDS = ("designator", "component", "part", "number", "quantity", "cost", "price", "total", "source", "supplier", "material")
#: Words of the headers of a list of design files, none of which a parts list has.
DESIGN_WORDS = ("design file name", "file type", "location of the file")
#: Cells that make a row a sum of others.
TOTALS = ("total", "grand total", "subtotal")
#: Columns that one cell covers at most, and rows: the limits of HTML.
MOST_COLUMNS, MOST_ROWS = 1000, 65534


def unescaped(text: Column) -> Column:
    """Named entities of NAMED and numeric ones as their characters; numbers that are no character stay."""
    parts = F.split(text, "(?i)(?=&#x?[0-9a-f]{1,6};)")
    digits = lambda p: F.regexp_extract(p, "(?i)^&#(x?[0-9a-f]{1,6});", 1)

    def decoded(p: Column) -> Column:
        code = F.conv(F.regexp_replace(digits(p), "(?i)^x", ""), 16, 10).cast("long")
        code = F.when(F.lower(digits(p)).startswith("x"), code).otherwise(digits(p).try_cast("long"))
        fine = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(fine, F.concat(char, F.regexp_replace(p, "^&#[^;]*;", ""))).otherwise(p)

    numbers = F.when(text.contains("&#"), F.array_join(F.transform(parts, decoded), "")).otherwise(text)
    return reduce(lambda t, name: F.replace(t, F.lit(name), F.lit(NAMED[name])), NAMED, numbers)


#: Stands between the parts of a cell's text; no tag reaches over it.
BREAK = "\x01"


def clean(text: Column) -> Column:
    """Text between tags: without them, unescaped, white space collapsed."""
    plain = unescaped(F.regexp_replace(text, f"<[^>{BREAK}]*>", " "))
    return F.trim(F.regexp_replace(plain, rf"[\s\u00a0{BREAK}]+", " "))


def _span(part: Column, name: str, most: int) -> Column:
    said = F.regexp_extract(part, rf"(?i)^[^>]*?\b{name}\s*=\s*[\"']?\s*(\d{{1,6}})", 1).try_cast("int")
    number = F.when(said.isNull(), 1).when(said == 0, most if name == "rowspan" else 1).when(said > most, most).otherwise(said)
    return F.when(F.lower(F.substring(part, 1, 200)).contains(name), number).otherwise(1)


def tag_stream(rows: DataFrame, id_col: str, markup_col: str) -> DataFrame:
    """text_row (a number for each row), id, at, tag, closes, part (the shaping tag and the markup up to the next one)."""
    before = rf"(?i)(?=</?(?:{'|'.join(SHAPING)})(?![a-z0-9:-]))"
    texts = rows.select(F.col(id_col).alias("id"), F.col(markup_col).alias("markup")).where(F.col("markup").rlike("(?i)<table"))
    texts = texts.select(F.monotonically_increasing_id().alias("text_row"), "id", F.regexp_replace("markup", IGNORED, " ").alias("markup"))
    parts = texts.select("text_row", "id", F.posexplode(F.split("markup", before)).alias("at", "part"))
    tag = F.lower(F.regexp_extract("part", "^</?([A-Za-z]+)", 1))
    return parts.select("text_row", "id", "at", tag.alias("tag"), F.col("part").startswith("</").alias("closes"), "part").where(F.col("tag").isin(*SHAPING))


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells in the order of their tables, on a grid: each takes the next free columns, and holds them for its rows."""
    table = row = None
    taken: dict[int, int] = {}  # the last row in which a cell above holds a column

    for batch in batches:
        out: list[tuple] = []
        names = batch.schema.names
        lists = [batch.column(c).to_pylist() for c in ("text_row", "table", "tr", "colspan", "rowspan", "height")]
        for i, (text, number, tr, wide, high, height) in enumerate(zip(*lists, strict=True)):
            if (text, number) != table:
                table, row, taken = (text, number), None, {}
            if tr != row:
                row, col = tr, 0
            for _ in range(wide):
                while taken.get(col, 0) >= tr:
                    col += 1
                last = min(tr + high - 1, height)
                if high > 1:
                    taken[col] = last
                out += [(i, t, col) for t in range(tr, last + 1)]
                col += 1
        placed = pa.Table.from_batches([batch]).take(pa.array([i for i, _, _ in out], pa.int64()))
        for name, values in (("tr", [t for _, t, _ in out]), ("col", [c for _, _, c in out])):
            placed = placed.set_column(names.index(name), name, pa.array(values, pa.int64()))
        yield from placed.combine_chunks().to_batches()


def table_cells(rows: DataFrame, id_col: str, markup_col: str) -> DataFrame:
    """text_row, id, table, tr, col, section (thead, tbody, tfoot or null), value: the grid of every table of every text.

    Tables count from 1 in the order in which they open, rows from 1, columns from 0. A table inside a cell is a table of
    its own, and its text is not the cell's. A cell over several rows or columns has its value in all of them, within the
    rows that the table has. Links of articles (ext-link) that the text does not show follow it in brackets. Texts without
    a table, null ones included, give no cells; null and repeated ids are texts of their own; other columns are not read.
    """
    stream = tag_stream(rows, id_col, markup_col)
    of_text = Window.partitionBy("text_row").orderBy("at")
    opens = ~F.col("closes")
    tag = F.col("tag")
    step = F.when(tag == "table", F.when(opens, 1).otherwise(-1)).otherwise(0)
    s = stream.withColumn("sum", F.sum(step).over(of_text)).withColumn("number", F.sum(F.when((tag == "table") & opens, 1).otherwise(0)).over(of_text))
    s = s.withColumn("depth", F.col("sum") - F.least(F.min("sum").over(of_text), F.lit(0)))  # closing tags that close nothing do not count
    at_depth = Window.partitionBy("text_row", "depth").orderBy("at")
    s = s.withColumn("table", F.last(F.when((tag == "table") & opens, F.col("number")), True).over(at_depth)).where("depth > 0")

    of_table = Window.partitionBy("text_row", "table").orderBy("at")
    cell_tag = tag.isin("td", "th")
    event = F.when(cell_tag & opens, "cell").when(cell_tag | ((tag == "tr") & opens), "row").when((tag != "table") | opens, "out")
    s = s.withColumn("event", event).withColumn("state", F.last("event", True).over(of_table))
    s = s.withColumn("before", F.last("event", True).over(of_table.rowsBetween(Window.unboundedPreceding, -1)))
    new_row = ((tag == "tr") & opens) | (cell_tag & opens & (F.col("before") == "out"))
    part = F.when(tag.isin("thead", "tbody", "tfoot"), F.when(opens, tag).otherwise("")).when((tag == "table") & opens, "")
    s = s.withColumn("tr", F.sum(new_row.cast("long")).over(of_table)).withColumn("cell", F.sum((cell_tag & opens).cast("long")).over(of_table))
    s = s.withColumn("section", F.nullif(F.last(part, True).over(of_table), F.lit(""))).where("state = 'cell'")

    starts = lambda c: F.max(F.when(cell_tag & opens, c))
    cells = s.groupBy("text_row", "table", "cell").agg(
        F.first("id").alias("id"), starts(F.col("tr")).alias("tr"), starts(F.col("section")).alias("section"),
        starts(F.col("part")).alias("part"), F.array_sort(F.collect_list(F.struct("at", "part"))).alias("parts"),
    )
    markup = F.array_join(F.transform("parts", lambda x: F.regexp_replace(x["part"], "^<[^>]*>?", "")), BREAK)
    cells = cells.withColumn("markup", markup)
    links = F.regexp_extract_all("markup", F.lit(r"(?is)<ext-link\b[^>]*?href\s*=\s*\"([^\"]*)\""))
    shown = lambda v, h: F.when((h == "") | v.contains(h), v).otherwise(F.concat(v, F.lit(" ["), h, F.lit("]")))
    value = F.when(F.col("markup").contains("ext-link"), F.aggregate(links, clean(F.col("markup")), shown)).otherwise(clean(F.col("markup")))
    spans = [_span(F.col("part"), n, most).cast("long").alias(n) for n, most in (("colspan", MOST_COLUMNS), ("rowspan", MOST_ROWS))]
    height = F.max("tr").over(Window.partitionBy("text_row", "table"))
    cells = cells.select("text_row", "id", "table", "cell", "tr", F.lit(0).cast("long").alias("col"), "section", value.alias("value"), *spans, height.alias("height"))
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cells.schema)
    grid = cells.sortWithinPartitions("text_row", "table", "cell").mapInArrow(_placed, shape)
    return grid.select("text_row", "id", "table", "tr", "col", "section", "value")


def _headed(cells: DataFrame) -> DataFrame:
    """cells, dealt by their texts, with head (the row of their table's headers), is_head and header."""
    of_table = Window.partitionBy("text_row", "table")
    section = F.coalesce("section", F.lit(""))
    c = cells.withColumn("head", F.coalesce(F.min(F.when(section == "thead", F.col("tr"))).over(of_table), F.min("tr").over(of_table)))
    c = c.withColumn("bodies", F.max(section == "tbody").over(of_table)).withColumn("is_head", F.col("tr") == F.col("head"))
    named = F.max(F.when(F.col("is_head"), F.col("value"))).over(Window.partitionBy("text_row", "table", "col"))
    return c.withColumn("header", F.coalesce(named, F.concat(F.lit("column_"), F.col("col"))))


def _body(headed: DataFrame) -> DataFrame:
    of_row = Window.partitionBy("text_row", "table", "tr")
    section = F.coalesce("section", F.lit(""))
    said, total = F.max(F.col("value") != "").over(of_row), F.max(F.lower("value").isin(*TOTALS)).over(of_row)
    body = F.when(F.col("bodies"), section == "tbody").otherwise(section != "thead")
    c = headed.where(~F.col("is_head") & body).withColumn("kept", said & ~total).where("kept")
    return c.select("text_row", "id", "table", "tr", "col", "header", "value")


def table_rows(cells: DataFrame) -> DataFrame:
    """text_row, id, table, tr, col, header, value: the body of every table, each cell with the header of its column.

    The header is the first row of thead, or else the first row; it is no row of the body. Where there is a tbody, only its
    rows are the body. Columns without a header are called column_0 and on. Rows without text and sums of other rows
    (a cell of TOTALS) are left out.
    """
    return _body(_headed(cells))


def hits(text: Column, words: Sequence[str]) -> Column:
    """How many of some words are in a text, whatever their case."""
    return reduce(lambda n, w: n + F.lower(text).contains(w).cast("int"), words, F.lit(0))


def parts_rows(cells: DataFrame) -> DataFrame:
    """table_rows of the tables that are parts lists: two hits of PARTS_WORDS or more in their headers, none of DESIGN_WORDS."""
    of_table = Window.partitionBy("text_row", "table")
    in_heads = lambda words: F.sum(F.when(F.col("is_head"), hits(F.col("value"), words)).otherwise(0)).over(of_table)
    headed = _headed(cells).withColumns({"design": in_heads(DESIGN_WORDS), "parts": in_heads(PARTS_WORDS)})
    return _body(headed.where("design = 0 and parts >= 2"))


def specifications(cells: DataFrame) -> DataFrame:
    """text_row, id, key, value: the first two cells of each row of a text's first table that has a word of SPECS_WORDS in the
    first cell of a row; of rows with the same key the last one's value. Rows without key or value, and titles, are left out."""
    first, second = (F.max(F.when(F.col("col") == i, F.col("value"))) for i in (0, 1))
    pairs = cells.groupBy("text_row", "id", "table", "tr").agg(first.alias("key"), second.alias("value"))
    known = F.lower("key").rlike("|".join(map(re.escape, SPECS_WORDS)))
    pairs = pairs.withColumn("is_specs", F.max(known).over(Window.partitionBy("text_row", "table")))
    pairs = pairs.where("is_specs and key <> '' and value <> '' and not contains(lower(key), 'specifications table')")
    pairs = pairs.withColumn("first", F.min("table").over(Window.partitionBy("text_row"))).where(F.col("table") == F.col("first"))
    return pairs.groupBy("text_row", "id", "key").agg(F.max_by("value", "tr").alias("value"))
