"""Files of every format, written from the tables into the scratch folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partsieve.session import table as t
from partsieve.sources import parts_xml, tables
from partsieve.staging import scratch

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


_PART = "p_partkey long, p_name string, p_brand string, p_size long, p_retailprice double"


def _parts(s: SparkSession, d: str) -> DataFrame:
    odd = F.when(F.col("p_partkey") % 7 == 0, F.concat("p_name", F.lit(', "big"\nline'))).when(F.col("p_partkey") % 7 != 1, F.col("p_name"))
    return t(s, d, "part").select("p_partkey", odd.alias("p_name"), "p_brand", F.col("p_size").cast("long").alias("p_size"), "p_retailprice")


_PART_SQL = """SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN p_name || ', "big"' || chr(10) || 'line' WHEN 1 THEN NULL ELSE p_name END AS p_name, p_brand, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part"""


@query(_PART_SQL)
def csv_typed(s: SparkSession, d: str) -> DataFrame:
    tables.write_csv(_parts(s, d), path := scratch(s, "csv"))
    return tables.read_csv(s, path, _PART)


@query(f"SELECT CAST(p_partkey AS BIGINT) AS p_partkey, p_brand, CAST(p_size AS BIGINT) AS p_size, p_retailprice + 1 AS more FROM ({_PART_SQL})")
def csv_inferred(s: SparkSession, d: str) -> DataFrame:
    tables.write_csv(_parts(s, d), path := scratch(s, "csv"))
    return tables.read_csv(s, path, infer=True).select(F.col("p_partkey").cast("long"), "p_brand", F.col("p_size").cast("long"), (F.col("p_retailprice") + 1).alias("more"))


@query(f"SELECT p_name, p_brand, CAST(p_size AS VARCHAR) || 'mm' AS size FROM ({_PART_SQL})")
def csv_strings(s: SparkSession, d: str) -> DataFrame:
    tables.write_csv(_parts(s, d), path := scratch(s, "csv"))
    return tables.read_csv(s, path).select("p_name", "p_brand", F.concat("p_size", F.lit("mm")).alias("size"))


@query("SELECT n_regionkey, n_nationkey, n_name FROM nation")
def json_arrays(s: SparkSession, d: str) -> DataFrame:
    """One array of objects a file."""
    rows = t(s, d, "nation").groupBy("n_regionkey").agg(F.to_json(F.collect_list(F.struct("n_regionkey", "n_nationkey", "n_name"))).alias("value"))
    rows.write.partitionBy("n_regionkey").text(path := scratch(s, "json"))
    return tables.read_json_array(s, f"{path}/*/part-*", "n_regionkey long, n_nationkey long, n_name string")


@query("SELECT c_custkey, o_orderkey, o_totalprice FROM customer JOIN orders ON o_custkey = c_custkey")
def json_nested(s: SparkSession, d: str) -> DataFrame:
    """Objects with a nested list, exploded."""
    inner = t(s, d, "orders").groupBy("o_custkey").agg(F.collect_list(F.struct("o_orderkey", "o_totalprice")).alias("orders"))
    t(s, d, "customer").join(inner, F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "orders").write.json(path := scratch(s, "nested"))
    rows = s.read.schema("c_custkey long, orders array<struct<o_orderkey: long, o_totalprice: double>>").json(path)
    return rows.select("c_custkey", F.explode("orders").alias("o")).select("c_custkey", "o.*")


@query("SELECT event_id, user_id, event_type FROM events WHERE event_id % 5 <> 0")
def jsonl_tolerant(s: SparkSession, d: str) -> DataFrame:
    """Lines of objects, a fifth of them broken."""
    line = F.to_json(F.struct("event_id", "user_id", "event_type"))
    t(s, d, "events").select(F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("x"), line)).otherwise(line).alias("value")).write.text(path := scratch(s, "jsonl"))
    return tables.read_jsonl(s, path, "event_id long, user_id long, event_type string")


@query("SELECT p_brand AS line FROM part WHERE p_partkey % 3 = 0")
def line_list(s: SparkSession, d: str) -> DataFrame:
    """A list of lines with blank ones and comments between them."""
    value = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("  "), "p_brand")).when(F.col("p_partkey") % 3 == 1, F.lit(" ")).otherwise(F.concat(F.lit("# "), "p_brand"))
    t(s, d, "part").select(value.alias("value")).write.text(path := scratch(s, "lines"))
    return tables.read_lines(s, path)


@query('SELECT s_suppkey AS "a.key", s_name AS "a.b.name", s_acctbal AS balance FROM supplier')
def json_flattened(s: SparkSession, d: str) -> DataFrame:
    """Nested objects as columns with dotted names."""
    nested = F.struct(F.col("s_suppkey").alias("key"), F.struct(F.col("s_name").alias("name")).alias("b")).alias("a")
    t(s, d, "supplier").select(nested, F.col("s_acctbal").alias("balance")).write.json(path := scratch(s, "flat"))
    return tables.flattened(s.read.schema("a struct<key: long, b: struct<name: string>>, balance double").json(path))


@query("""SELECT CAST(conv_id AS VARCHAR) AS custom_id, 'm' AS model, text AS content FROM conversations WHERE turn = 0""")
def request_lines(s: SparkSession, d: str) -> DataFrame:
    """Requests written as JSON lines in two runs, the second appended, and merged again."""
    rows = t(s, d, "conversations").where("turn = 0")
    path = scratch(s, "requests")
    for half in (0, 1):
        tables.requests(rows.where(F.col("conv_id") % 2 == half), "conv_id", F.col("text"), "m").write.mode("append").text(path)
    shape = "custom_id string, body struct<model: string, messages: array<struct<role: string, content: string>>>"
    return s.read.schema(shape).json(path).select("custom_id", "body.model", F.col("body.messages")[0]["content"].alias("content"))


@query("""SELECT p_partkey, CAST(0 AS INT) AS line, 'R' || p_partkey AS reference, p_name AS component_name, p_brand AS part_number, CASE WHEN p_size % 2 = 0 THEN 'p' || p_size END AS footprint FROM part""")
def xml_parts(s: SparkSession, d: str) -> DataFrame:
    """Parts lists in XML, one made from each part: two dialects by turns."""
    foot = "CASE WHEN p_size % 2 = 0 THEN 'p' || p_size ELSE '' END"
    kicad = f"'<export><components><comp ref=\"R' || p_partkey || '\"><value>' || p_name || '</value><footprint>' || {foot} || '</footprint><fields><field name=\"MPN\">' || p_brand || '</field></fields></comp></components></export>'"
    eagle = f"'<eagle><drawing><schematic><parts><part name=\"R' || p_partkey || '\" value=\"' || p_name || '\" device=\"' || {foot} || '\"><attribute name=\"mpn\" value=\"' || p_brand || '\"/></part></parts></schematic></drawing></eagle>'"
    files = t(s, d, "part").select(F.col("p_partkey").cast("string").alias("path"), F.encode(F.expr(f"CASE WHEN p_partkey % 2 = 0 THEN {kicad} ELSE {eagle} END"), "UTF-8").alias("content"))
    return parts_xml.xml_parts(files).select(F.col("path").cast("long").alias("p_partkey"), "line", "reference", "component_name", "part_number", "footprint")
