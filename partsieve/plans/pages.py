"""Tables out of pages: every page gets a parts table and a table of specifications out of other tables, and is read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partsieve.session import table as t
from partsieve.sources import markup

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def _pages(s: SparkSession, d: str) -> DataFrame:
    """page_id, html: each page's own markup with two tables at the end of its article.

    A page's order gives the lines of its parts table, with suppliers over two rows, tables inside cells, tags that are
    never closed, entities, upper case, and a total; pages without an order have none. Every page has specifications.
    """
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    lines = t(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("page_id")).agg(F.array_sort(F.collect_list(line)).alias("lines"))

    def row(x: Column, i: Column) -> Column:
        inner = F.when(x["l_partkey"] % 7 == 0, F.concat(F.lit("<table><tr><th>Key<th>Value</tr><tr><td>k<td>"), x["l_suppkey"], F.lit("</table>"))).otherwise("")
        ends = F.when(x["l_partkey"] % 3 == 0, "").otherwise("</td>")
        two = F.when(i + 1 < F.size("lines"), '<td rowspan="2">').otherwise("<td>")
        supplier = F.when(i % 2 == 0, F.concat(two, F.lit("<b>Supplier</b> &amp; Co&#46; "), x["l_suppkey"], ends)).otherwise("")
        cost = F.concat(F.lit('<td align="right">'), x["l_extendedprice"].cast("decimal(14,2)").cast("string"), ends)
        return F.concat(F.lit("<tr><td>R"), x["l_partkey"], inner, ends, supplier, F.lit("<td>"), x["l_quantity"].cast("int"), ends, cost, F.when(x["l_partkey"] % 5 == 0, "").otherwise("</tr>\n"))

    head = F.lit('<table class="bom"><thead><tr><th>Designator<th>Supplier</th><th>Quantity</th><th>Total <i>cost</i></th></tr></thead><tbody>')
    body = F.array_join(F.transform("lines", row), "")
    total = F.concat(F.lit("<tr><td>Total</td><td></td><td>"), F.size("lines"), F.lit("</td></tr></tbody></table>"))
    parts = F.when(F.col("lines").isNotNull(), F.concat(head, body, total)).otherwise("")
    parts = F.when(F.col("page_id") % 4 == 1, F.replace(parts, F.lit("<td"), F.lit("<TD"))).otherwise(parts)
    specs = F.concat(F.lit("<table><tr><td>Hardware name</td><td>Kit "), "page_id", F.lit("</td></tr><tr><th>License<td>MIT &lt;"), F.col("page_id") % 3, F.lit("&gt;</tr></table></article>"))
    pages = t(s, d, "pages").join(lines, "page_id", "left")
    return pages.select("page_id", F.replace("html", F.lit("</article>"), F.concat(parts, specs)).alias("html"))


@query("""WITH l AS (SELECT page_id, l_partkey, l_suppkey, l_quantity, l_extendedprice, row_number() OVER (PARTITION BY page_id ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS i FROM pages JOIN lineitem ON l_orderkey = page_id),
x AS (SELECT *, CASE WHEN i % 2 = 1 THEN l_suppkey ELSE lag(l_suppkey) OVER (PARTITION BY page_id ORDER BY i) END AS supplier FROM l)
SELECT page_id, CAST(1 AS BIGINT) AS table_no, i + 1 AS row_no, unnest(['Designator', 'Supplier', 'Quantity', 'Total cost']) AS header,
unnest(['R' || l_partkey, 'Supplier & Co. ' || supplier, CAST(CAST(l_quantity AS INT) AS VARCHAR), CAST(CAST(l_extendedprice AS DECIMAL(14, 2)) AS VARCHAR)]) AS cell FROM x""")
def page_parts(s: SparkSession, d: str) -> DataFrame:
    """Cells of the parts tables of all pages, with their headers; other tables and sums are left out."""
    rows = markup.parts_rows(markup.table_cells(_pages(s, d), "page_id", "html"))
    return rows.select(F.col("id").alias("page_id"), F.col("table").cast("long").alias("table_no"), F.col("tr").alias("row_no"), "header", F.col("value").alias("cell"))


@query("SELECT page_id, unnest(['Hardware name', 'License']) AS key, unnest(['Kit ' || page_id, 'MIT <' || page_id % 3 || '>']) AS value FROM pages")
def page_specifications(s: SparkSession, d: str) -> DataFrame:
    """Keys and values of the table of specifications of every page."""
    found = markup.specifications(markup.table_cells(_pages(s, d), "page_id", "html"))
    return found.select(F.col("id").alias("page_id"), "key", "value")
