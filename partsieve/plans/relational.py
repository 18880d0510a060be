"""Relational queries: filters, projections, joins, subqueries, aggregates, ordered picks, sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from partsieve.functions.text import present
from partsieve.operators.link import last_per_key
from partsieve.session import table as t

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its name, with its DuckDB SQL."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


@query("SELECT doc_id, source, lang FROM documents WHERE text IS NOT NULL AND text <> ''")
def present_filter(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "documents").where(present(F.col("text"))).select("doc_id", "source", "lang")


@query("SELECT page_id, url FROM pages WHERE url ILIKE '%example%'")
def ilike_filter(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "pages").where(F.col("url").ilike("%example%")).select("page_id", "url")


@query(r"SELECT page_id FROM pages WHERE regexp_matches(lower(url), '/(de|fr|en)/')")
def regex_contains(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "pages").where(F.lower("url").rlike("/(de|fr|en)/")).select("page_id")


@query("SELECT l_orderkey, l_partkey, p_name FROM lineitem JOIN part ON l_partkey = p_partkey WHERE coalesce(p_name, p_brand, p_type) IS NOT NULL AND l_quantity > 45")
def any_nonnull(s: SparkSession, d: str) -> DataFrame:
    rows = t(s, d, "lineitem").where("l_quantity > 45").join(t(s, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.where(F.coalesce("p_name", "p_brand", "p_type").isNotNull()).select("l_orderkey", "l_partkey", "p_name")


@query("SELECT c_custkey AS id, 'acctbal' AS metric, c_acctbal AS value FROM customer UNION ALL SELECT c_custkey, 'nation', CAST(c_nationkey AS DOUBLE) FROM customer")
def unpivot_metrics(s: SparkSession, d: str) -> DataFrame:
    wide = t(s, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("acctbal"), F.col("c_nationkey").cast("double").alias("nation"))
    return wide.unpivot("id", ["acctbal", "nation"], "metric", "value")


@query("SELECT doc_id, trim(x) AS part FROM (SELECT doc_id, unnest(string_split(text, ',')) AS x FROM documents) WHERE trim(x) <> ''")
def explode_split(s: SparkSession, d: str) -> DataFrame:
    parts = t(s, d, "documents").select("doc_id", F.explode(F.split("text", ",", -1)).alias("x"))
    return parts.select("doc_id", F.trim("x").alias("part")).where("part <> ''")


@query("SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'")
def inner_join_filter(s: SparkSession, d: str) -> DataFrame:
    c = t(s, d, "customer").where("c_mktsegment = 'BUILDING'")
    return t(s, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@query("SELECT a.s_suppkey AS a, b.s_suppkey AS b FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey")
def self_join_pairs(s: SparkSession, d: str) -> DataFrame:
    a, b = (t(s, d, "supplier").select(F.col("s_nationkey").alias(f"n{k}"), F.col("s_suppkey").alias(k)) for k in "ab")
    return a.join(b, (F.col("na") == F.col("nb")) & (F.col("a") < F.col("b"))).select("a", "b")


@query("""SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS n, round(sum(l_extendedprice), 2) AS total FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def three_way_join(s: SparkSession, d: str) -> DataFrame:
    rows = t(s, d, "lineitem").join(t(s, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return rows.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total"))


@query("""SELECT c_custkey, o.last_date, o.most FROM customer LEFT JOIN (SELECT o_custkey, strftime(max(o_orderdate), '%Y-%m-%d') AS last_date, max(o_totalprice) AS most
FROM orders GROUP BY 1) o ON o_custkey = c_custkey""")
def left_join_preagg(s: SparkSession, d: str) -> DataFrame:
    o = t(s, d, "orders").groupBy("o_custkey").agg(F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("last_date"), F.max("o_totalprice").alias("most"))
    return t(s, d, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "last_date", "most")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F' AND o_totalprice > 200000)")
def anti_join(s: SparkSession, d: str) -> DataFrame:
    """Customers without a large order that is finished."""
    large = t(s, d, "orders").where("o_orderstatus = 'F' AND o_totalprice > 200000")
    return t(s, d, "customer").join(large, F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND quality = 1)")
def anti_join_condition(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "documents").join(t(s, d, "labels").where("quality = 1"), "doc_id", "left_anti").select("doc_id")


@query("SELECT p_brand, max_by(p_partkey, p_partkey) AS part, arg_max(p_name, p_partkey) AS name FROM part GROUP BY p_brand")
def lookup_last_wins(s: SparkSession, d: str) -> DataFrame:
    return last_per_key(t(s, d, "part"), "p_brand", ["p_partkey"]).select("p_brand", F.col("p_partkey").alias("part"), F.col("p_name").alias("name"))


@query("SELECT d.doc_id, coalesce(l.quality, -1) AS quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def left_coalesce_default(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "documents").join(t(s, d, "labels"), "doc_id", "left").select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"))


@query("""SELECT doc_id, EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) AS labelled,
EXISTS (SELECT 1 FROM conversations c WHERE c.conv_id = d.doc_id) AS discussed FROM documents d""")
def exists_flags(s: SparkSession, d: str) -> DataFrame:
    labelled = t(s, d, "labels").select("doc_id").distinct().withColumn("l", F.lit(True))
    discussed = t(s, d, "conversations").select(F.col("conv_id").alias("doc_id")).distinct().withColumn("c", F.lit(True))
    rows = t(s, d, "documents").join(labelled, "doc_id", "left").join(discussed, "doc_id", "left")
    return rows.select("doc_id", F.coalesce("l", F.lit(False)).alias("labelled"), F.coalesce("c", F.lit(False)).alias("discussed"))


@query("""SELECT c_custkey, (SELECT CAST(count(*) AS BIGINT) FROM orders WHERE o_custkey = c_custkey) AS n_orders,
(SELECT CAST(count(DISTINCT o_orderpriority) AS BIGINT) FROM orders WHERE o_custkey = c_custkey) AS n_priorities FROM customer""")
def scalar_count(s: SparkSession, d: str) -> DataFrame:
    n = t(s, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.countDistinct("o_orderpriority").alias("p"))
    rows = t(s, d, "customer").join(n, F.col("c_custkey") == F.col("o_custkey"), "left")
    return rows.select("c_custkey", F.coalesce("n", F.lit(0)).alias("n_orders"), F.coalesce("p", F.lit(0)).alias("n_priorities"))


@query("SELECT p_partkey FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 50)")
def in_subquery(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "part").join(t(s, d, "lineitem").where("l_quantity >= 50"), F.col("p_partkey") == F.col("l_partkey"), "left_semi").select("p_partkey")


@query("""SELECT 'orders' AS name, CAST(count(*) AS BIGINT) AS n FROM orders UNION ALL SELECT 'lineitem', CAST(count(*) AS BIGINT) FROM lineitem
UNION ALL SELECT 'part', CAST(count(*) AS BIGINT) FROM part UNION ALL SELECT 'documents', CAST(count(*) AS BIGINT) FROM documents""")
def table_counts(s: SparkSession, d: str) -> DataFrame:
    one = lambda n: t(s, d, n).agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n")
    return reduce(DataFrame.unionByName, [one(n) for n in ("orders", "lineitem", "part", "documents")])


@query("SELECT min(o_totalprice) AS least, max(o_totalprice) AS most, strftime(max(o_orderdate), '%Y-%m-%d') AS last_date FROM orders")
def global_scalars(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "orders").agg(F.min("o_totalprice").alias("least"), F.max("o_totalprice").alias("most"), F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("last_date"))


@query("SELECT source, lang, CAST(count(*) AS BIGINT) AS n FROM documents GROUP BY 1, 2 ORDER BY n DESC")
def group_count_desc(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "documents").groupBy("source", "lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"))


@query("""SELECT lang, CAST(count(DISTINCT text) AS BIGINT) AS n_texts, CAST(count(DISTINCT text) FILTER (WHERE n_chars > 1000) AS BIGINT) AS n_long,
CAST(count(*) FILTER (WHERE n_chars < 200) AS BIGINT) AS n_short FROM documents GROUP BY 1""")
def count_distinct_filter(s: SparkSession, d: str) -> DataFrame:
    long = F.when(F.col("n_chars") > 1000, F.col("text"))
    return t(s, d, "documents").groupBy("lang").agg(F.countDistinct("text").alias("n_texts"), F.countDistinct(long).alias("n_long"), F.count_if(F.col("n_chars") < 200).alias("n_short"))


@query("""SELECT p_brand, CAST(count(*) AS BIGINT) AS n, round(avg(l_quantity), 4) AS quantity, round(avg(l_discount), 6) AS discount
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def mean_by_group(s: SparkSession, d: str) -> DataFrame:
    rows = t(s, d, "lineitem").join(t(s, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.groupBy("p_brand").agg(F.count("*").alias("n"), F.round(F.avg("l_quantity"), 4).alias("quantity"), F.round(F.avg("l_discount"), 6).alias("discount"))


_FLAGS = {"long": "n_chars > 1000", "dated": "text LIKE '%20%'", "licensed": "text ILIKE '%license%'", "linked": "text LIKE '%http%'"}


@query("SELECT source, CAST(count(*) AS BIGINT) AS n, " + ", ".join(f"round(100.0 * count(*) FILTER (WHERE {c}) / count(*), 4) AS {k}" for k, c in _FLAGS.items()) + " FROM documents GROUP BY 1")
def presence_rates(s: SparkSession, d: str) -> DataFrame:
    rates = [F.round(100.0 * F.count_if(F.expr(c)) / F.count("*"), 4).alias(k) for k, c in _FLAGS.items()]
    return t(s, d, "documents").groupBy("source").agg(F.count("*").alias("n"), *rates)


@query("""SELECT source, string_agg(gap, ',' ORDER BY gap) AS gaps FROM (""" + " UNION ALL ".join(f"SELECT source, '{k}' AS gap FROM documents GROUP BY 1 HAVING count(*) >= 10 AND 100.0 * count(*) FILTER (WHERE {c}) / count(*) < 30" for k, c in _FLAGS.items()) + ") GROUP BY 1")
def gap_list(s: SparkSession, d: str) -> DataFrame:
    rates = presence_rates(s, d).where("n >= 10").unpivot("source", list(_FLAGS), "gap", "rate").where("rate < 30")
    return rates.groupBy("source").agg(F.array_join(F.array_sort(F.collect_list("gap")), ",").alias("gaps"))


@query("SELECT doc_id, " + " + ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END" for c in _FLAGS.values()) + " AS n_flags FROM documents")
def flag_sum(s: SparkSession, d: str) -> DataFrame:
    total = reduce(lambda a, b: a + b, [F.when(F.expr(c), 1).otherwise(0) for c in _FLAGS.values()])
    return t(s, d, "documents").select("doc_id", total.alias("n_flags"))


@query("SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderdate, o_orderkey) AS orders FROM orders GROUP BY 1")
def ordered_collect(s: SparkSession, d: str) -> DataFrame:
    got = F.array_sort(F.collect_list(F.struct("o_orderdate", "o_orderkey")))
    return t(s, d, "orders").groupBy("o_custkey").agg(F.array_join(F.transform(got, lambda x: x["o_orderkey"].cast("string")), ",").alias("orders"))


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders) WHERE n = 1")
def first_per_key(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "orders").groupBy("o_custkey").agg(F.min("o_orderkey").alias("o_orderkey"))


@query("""SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders) WHERE n = 1""")
def best_with_ties(s: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return t(s, d, "orders").withColumn("n", F.row_number().over(w)).where("n = 1").select("o_custkey", "o_orderkey", "o_totalprice")


@query("""(SELECT 'top' AS side, o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10)
UNION ALL (SELECT 'bottom', o_orderkey FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10)""")
def topk_bottomk(s: SparkSession, d: str) -> DataFrame:
    o = t(s, d, "orders")
    top = o.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10).select(F.lit("top").alias("side"), "o_orderkey")
    return top.unionByName(o.orderBy("o_totalprice", "o_orderkey").limit(10).select(F.lit("bottom").alias("side"), "o_orderkey"))


@query("""SELECT p_partkey, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_size > 25 DESC, p_retailprice DESC, p_partkey) AS INTEGER) AS place FROM part""")
def stable_rank(s: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("p_brand").orderBy((F.col("p_size") > 25).desc(), F.desc("p_retailprice"), "p_partkey")
    return t(s, d, "part").select("p_partkey", F.row_number().over(w).alias("place"))


@query("SELECT n_name AS name FROM nation UNION SELECT r_name FROM region")
def union_distinct(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "nation").select(F.col("n_name").alias("name")).unionByName(t(s, d, "region").select(F.col("r_name").alias("name"))).distinct()


@query("SELECT DISTINCT lower(p_brand) AS brand FROM part WHERE lower(p_brand) NOT IN (SELECT lower(p_brand) FROM part WHERE p_size = 50)")
def set_difference_ci(s: SparkSession, d: str) -> DataFrame:
    low = t(s, d, "part").select(F.lower("p_brand").alias("brand"), "p_size")
    return low.select("brand").distinct().join(low.where("p_size = 50"), "brand", "left_anti")


@query("SELECT CAST(x AS INTEGER) AS quarter, CAST(count(*) AS BIGINT) AS n FROM (SELECT quarter(o_orderdate) AS x FROM orders) GROUP BY 1")
def date_parts(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "orders").groupBy(F.quarter("o_orderdate").alias("quarter")).agg(F.count("*").alias("n"))


@query("""SELECT count(*) AS n, CAST(count(v) AS BIGINT) AS n_known, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, min(v) AS least,
round(quantile_cont(v, 0.25), 6) AS q1, round(quantile_cont(v, 0.5), 6) AS median, round(quantile_cont(v, 0.75), 6) AS q3, max(v) AS most FROM (SELECT value AS v FROM events)""")
def describe(s: SparkSession, d: str) -> DataFrame:
    v = F.col("value")
    q = lambda p, n: F.round(F.percentile(v, F.lit(p)), 6).alias(n)
    return t(s, d, "events").agg(F.count("*").alias("n"), F.count(v).alias("n_known"), F.round(F.avg(v), 6).alias("mean"), F.round(F.stddev_samp(v), 6).alias("std"), F.min(v).alias("least"), q(0.25, "q1"), q(0.5, "median"), q(0.75, "q3"), F.max(v).alias("most"))


@query("SELECT CAST(floor(l_quantity / 5) AS BIGINT) AS bin, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1")
def histogram(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "lineitem").groupBy(F.floor(F.col("l_quantity") / 5).alias("bin")).agg(F.count("*").alias("n"))


_PAIRS = [("l_quantity", "l_extendedprice"), ("l_quantity", "l_discount"), ("l_extendedprice", "l_tax")]


@query(" UNION ALL ".join(f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) AS r FROM lineitem" for a, b in _PAIRS))
def corr_matrix(s: SparkSession, d: str) -> DataFrame:
    one = t(s, d, "lineitem").agg(*[F.round(F.corr(a, b), 6).alias(f"{a}.{b}") for a, b in _PAIRS])
    cells = [F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"`{a}.{b}`").alias("r")) for a, b in _PAIRS]
    return one.select(F.inline(F.array(*cells)))


@query("""SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS DOUBLE) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, CAST(count(*) AS BIGINT) AS n
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def price_summary(s: SparkSession, d: str) -> DataFrame:
    rows = t(s, d, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp"))
    revenue = F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(revenue, 2).alias("revenue"), F.count("*").alias("n"))
