"""Guards, joins, upserts and report aggregates over the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from partsieve.functions.text import present, title_key
from partsieve.operators.chunks import budget_chunks as chunked
from partsieve.operators.link import greedy_titles as titles_paired
from partsieve.operators.link import last_per_key
from partsieve.operators.merge import fill_known, merge
from partsieve.operators.quantiles import exact_quantiles
from partsieve.session import table as t

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


@query("""SELECT doc_id, coalesce(k.class, 'unknown') AS class FROM documents LEFT JOIN (SELECT doc_id AS id, CASE WHEN quality = 1 THEN 'hardware' WHEN toxic = 1 THEN 'other' ELSE 'ambiguous' END AS class FROM labels) k ON CAST(doc_id AS VARCHAR) = CAST(k.id AS VARCHAR)
WHERE coalesce(k.class, 'unknown') IN ('hardware', 'ambiguous')""")
def class_filter(s: SparkSession, d: str) -> DataFrame:
    """Documents of two classes by a lookup joined on ids as text; without a class they are unknown."""
    kind = F.when(F.col("quality") == 1, "hardware").when(F.col("toxic") == 1, "other").otherwise("ambiguous")
    look = t(s, d, "labels").select(F.col("doc_id").cast("string").alias("key"), kind.alias("class"))
    rows = t(s, d, "documents").withColumn("key", F.col("doc_id").cast("string")).join(look, "key", "left")
    return rows.select("doc_id", F.coalesce("class", F.lit("unknown")).alias("class")).where(F.col("class").isin("hardware", "ambiguous"))


@query("""SELECT page_id, url, length(html) AS n FROM pages WHERE url IS NOT NULL AND trim(url) <> '' AND contains(lower(url), 'example.org') AND html IS NOT NULL AND length(html) > 100""")
def record_guards(s: SparkSession, d: str) -> DataFrame:
    """Records with a link to one venue and a text of more than 100 characters."""
    rows = t(s, d, "pages").where(present(F.trim("url")) & F.lower("url").contains("example.org"))
    return rows.select("page_id", "url", F.length("html").cast("long").alias("n")).where("n > 100")


@query("""SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority <> '' AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) ORDER BY o_orderkey LIMIT 50""")
def work_queue(s: SparkSession, d: str) -> DataFrame:
    """The first 50 orders that are still to be processed: open, with a priority, without lines."""
    rows = t(s, d, "orders").where((F.col("o_orderstatus") == "O") & present(F.col("o_orderpriority")))
    return rows.join(t(s, d, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").select("o_orderkey", "o_custkey").orderBy("o_orderkey").limit(50)


@query("""SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_extendedprice > 0 AND l_shipdate IS NOT NULL AND year(l_shipdate) < 1998 AND l_returnflag <> 'N'""")
def history_filter(s: SparkSession, d: str) -> DataFrame:
    """Lines whose price can be carried back: priced, dated, before a year, returned."""
    return t(s, d, "lineitem").where("l_extendedprice > 0 AND l_shipdate IS NOT NULL AND year(l_shipdate) < 1998 AND l_returnflag <> 'N'").select("l_orderkey", "l_linenumber")


@query("""WITH a AS (SELECT p_partkey, trim(regexp_replace(lower(p_name || '!'), '[^a-z0-9 ]', '', 'g')) AS k FROM part), b AS (SELECT k, max(p_partkey) AS last FROM a WHERE p_partkey % 3 = 0 GROUP BY 1) SELECT p_partkey, last FROM a LEFT JOIN b USING (k)""")
def title_join(s: SparkSession, d: str) -> DataFrame:
    """Records of two sources joined on normalized titles, the last of each title on the right."""
    a = t(s, d, "part").select("p_partkey", title_key(F.concat("p_name", F.lit("!"))).alias("k"))
    b = last_per_key(a.where("p_partkey % 3 = 0"), "k", ["p_partkey"]).select("k", F.col("p_partkey").alias("last"))
    return a.join(b, "k", "left").select("p_partkey", "last")


@query("""SELECT l_orderkey, l_linenumber, o_orderdate, p_name, p_brand FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus = 'F' LEFT JOIN part ON p_partkey = l_partkey AND p_size > 25""")
def two_left_joins(s: SparkSession, d: str) -> DataFrame:
    """Lines with what two lookups know of them."""
    o = t(s, d, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_orderdate")
    p = t(s, d, "part").where("p_size > 25").select("p_partkey", "p_name", "p_brand")
    rows = t(s, d, "lineitem").join(o, F.col("o_orderkey") == F.col("l_orderkey"), "left").join(p, F.col("p_partkey") == F.col("l_partkey"), "left")
    return rows.select("l_orderkey", "l_linenumber", "o_orderdate", "p_name", "p_brand")


@query("""WITH r AS (SELECT c_custkey AS id, 'https://github.com/Own' || c_nationkey || '/R' || c_custkey % 7 AS url FROM customer), k AS (SELECT 'own' || s_nationkey AS o, 'r' || s_suppkey % 7 AS n, s_suppkey FROM supplier)
SELECT s_suppkey, min(id) AS id FROM k JOIN r ON lower(url) LIKE '%github.com/' || o || '/' || n GROUP BY 1""")
def repo_join(s: SparkSession, d: str) -> DataFrame:
    """Records and projects joined by owner and repository: the key is cut out of the link, not searched in every link."""
    cut = lambda group: F.regexp_extract(F.lower("url"), r"github\.com/([^/]+)/([^/]+)$", group)
    url = F.concat(F.lit("https://github.com/Own"), "c_nationkey", F.lit("/R"), F.col("c_custkey") % 7)
    r = t(s, d, "customer").select(F.col("c_custkey").alias("id"), url.alias("url")).select("id", cut(1).alias("o"), cut(2).alias("n"))
    k = t(s, d, "supplier").select("s_suppkey", F.concat(F.lit("own"), "s_nationkey").alias("o"), F.concat(F.lit("r"), F.col("s_suppkey") % 7).alias("n"))
    return k.join(r.groupBy("o", "n").agg(F.min("id").alias("id")), ["o", "n"]).select("s_suppkey", "id")


@query("""WITH c AS (SELECT c_custkey, c_nationkey, c_acctbal FROM customer), l AS (SELECT o_custkey, count(*) AS n, avg(o_totalprice) AS m FROM orders GROUP BY 1), q AS (SELECT l_suppkey % 100 AS id, max(l_quantity) AS q FROM lineitem GROUP BY 1)
SELECT c_custkey, n_name, l.n, round(m, 4) AS m, q FROM c JOIN nation ON n_nationkey = c_nationkey JOIN l ON o_custkey = c_custkey LEFT JOIN q ON q.id = c_custkey""")
def four_way_scores(s: SparkSession, d: str) -> DataFrame:
    """Evaluations, projects and scores, with repository figures where there are some."""
    n = t(s, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.round(F.avg("o_totalprice"), 4).alias("m"))
    q = t(s, d, "lineitem").groupBy((F.col("l_suppkey") % 100).alias("id")).agg(F.max("l_quantity").alias("q"))
    rows = t(s, d, "customer").join(t(s, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).join(n, F.col("o_custkey") == F.col("c_custkey")).join(q, F.col("id") == F.col("c_custkey"), "left")
    return rows.select("c_custkey", "n_name", "n", "m", "q")


@query("""SELECT d.doc_id, coalesce(b.y, a.y) AS verdict FROM documents d LEFT JOIN (SELECT doc_id, quality AS y FROM labels) a ON a.doc_id = d.doc_id LEFT JOIN (SELECT doc_id, toxic + 10 AS y FROM labels WHERE doc_id % 3 = 0) b ON b.doc_id = d.doc_id""")
def second_round(s: SparkSession, d: str) -> DataFrame:
    """First verdicts, overridden by those of a second round."""
    a = t(s, d, "labels").select("doc_id", F.col("quality").alias("a"))
    b = t(s, d, "labels").where("doc_id % 3 = 0").select("doc_id", (F.col("toxic") + 10).alias("b"))
    return t(s, d, "documents").join(a, "doc_id", "left").join(b, "doc_id", "left").select("doc_id", F.coalesce("b", "a").alias("verdict"))


@query("""WITH i AS (SELECT 1990 + n_nationkey AS y, 50.0 + n_nationkey * n_nationkey AS v FROM nation)
SELECT o_orderkey, CASE WHEN b.v IS NULL OR a.v IS NULL THEN NULL ELSE round(o_totalprice * (a.v / b.v), 4) END AS price FROM orders LEFT JOIN i a ON a.y = year(o_orderdate) LEFT JOIN i b ON b.y = year(o_orderdate) + 8""")
def historical_prices(s: SparkSession, d: str) -> DataFrame:
    """Prices carried back by a yearly index, joined for the year then and the year now; null where it lacks one."""
    i = t(s, d, "nation").select((F.lit(1990) + F.col("n_nationkey")).alias("y"), (F.lit(50.0) + F.col("n_nationkey") * F.col("n_nationkey")).alias("v"))
    o = t(s, d, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("y"))
    then, now = i.toDF("y", "then"), i.toDF("y_now", "now")
    rows = o.join(then, "y", "left").join(now, F.col("y") + 8 == F.col("y_now"), "left")
    return rows.select("o_orderkey", F.round(F.col("o_totalprice") * (F.col("then") / F.nullif("now", F.lit(0.0))), 4).alias("price"))


@query("""SELECT c_custkey, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000) THEN 100 WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) THEN 50 END AS specific FROM customer""")
def case_exists(s: SparkSession, d: str) -> DataFrame:
    """A grade by what the children of a row hold, from one aggregate of them."""
    o = t(s, d, "orders").groupBy("o_custkey").agg(F.max("o_totalprice").alias("most"))
    grade = F.when(F.col("most") > 400000, 100).when(F.col("o_custkey").isNotNull(), 50)
    return t(s, d, "customer").join(o, F.col("o_custkey") == F.col("c_custkey"), "left").select("c_custkey", grade.alias("specific"))


@query("SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_orderkey, l_linenumber, l_quantity, l_extendedprice) AS n FROM lineitem) WHERE n > 1")
def not_first(s: SparkSession, d: str) -> DataFrame:
    """The rows that deduplication deletes: all but the first of each key."""
    w = Window.partitionBy("l_partkey", "l_suppkey").orderBy("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return t(s, d, "lineitem").withColumn("n", F.row_number().over(w)).where("n > 1").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")


@query("""SELECT DISTINCT c_custkey, x AS tag FROM (SELECT c_custkey, unnest(list_concat(string_split(lower(c_mktsegment), 'i'), string_split(lower(c_name), '#'))) AS x FROM customer) WHERE x <> ''""")
def tag_union(s: SparkSession, d: str) -> DataFrame:
    """Two lists of tags as one set, one tag a row."""
    tags = F.array_union(F.split(F.lower("c_mktsegment"), "i"), F.split(F.lower("c_name"), "#"))
    return t(s, d, "customer").select("c_custkey", F.explode(F.array_distinct(tags)).alias("tag")).where("tag <> ''")


@query("""SELECT l_partkey, l_suppkey, min(l_orderkey) AS first FROM lineitem GROUP BY 1, 2""")
def distinct_pairs(s: SparkSession, d: str) -> DataFrame:
    """Distinct pairs with the place of their first occurrence, so that the order can be kept."""
    return t(s, d, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.min("l_orderkey").alias("first"))


@query("""SELECT 'both' AS kind, count(*) AS n FROM (SELECT o_custkey FROM orders INTERSECT SELECT c_custkey FROM customer) UNION ALL SELECT 'left', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders) UNION ALL SELECT 'either', count(*) FROM (SELECT c_custkey FROM customer UNION SELECT o_custkey FROM orders)""")
def set_counts(s: SparkSession, d: str) -> DataFrame:
    """Sizes of the intersection, difference and union of two key sets."""
    a, b = t(s, d, "customer").select(F.col("c_custkey").alias("k")), t(s, d, "orders").select(F.col("o_custkey").alias("k"))
    named = {"both": a.intersect(b), "left": a.subtract(b), "either": a.union(b).distinct()}
    return reduce(DataFrame.unionByName, [x.agg(F.count("*").alias("n")).select(F.lit(k).alias("kind"), "n") for k, x in named.items()])


@query("""SELECT o_orderstatus, quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS median, quantile_cont(o_totalprice, 0.75) AS q3, count(*) AS n FROM orders GROUP BY 1""")
def group_quartiles(s: SparkSession, d: str) -> DataFrame:
    q = F.percentile("o_totalprice", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    rows = t(s, d, "orders").groupBy("o_orderstatus").agg(q.alias("q"), F.count("*").alias("n"))
    return rows.select("o_orderstatus", F.get("q", F.lit(0)).alias("q1"), F.get("q", F.lit(1)).alias("median"), F.get("q", F.lit(2)).alias("q3"), "n")


def _quartile_sql(table: str, key: str, value: str) -> str:
    of = ", ".join(f"quantile_cont(CAST({value} AS DOUBLE), {q}) AS {name}" for q, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3")))
    return f"SELECT {key}, {of}, count({value}) AS n FROM {table} GROUP BY 1"


def _quartiles(rows: DataFrame, key: str, value: str) -> DataFrame:
    found = exact_quantiles(rows, [key], value, [0.25, 0.5, 0.75])
    return found.select(key, *[F.col("quantiles")[i].alias(name) for i, name in enumerate(("q1", "median", "q3"))], "n")


@query(_quartile_sql("lineitem", "l_returnflag", "l_extendedprice"))
def line_quartiles(s: SparkSession, d: str) -> DataFrame:
    """Quartiles of prices by return flag, three groups of very many rows, by distributed selection."""
    return _quartiles(t(s, d, "lineitem"), "l_returnflag", "l_extendedprice")


@query(_quartile_sql("documents", "source", "n_chars"))
def document_quartiles(s: SparkSession, d: str) -> DataFrame:
    """Quartiles of document sizes by source, by distributed selection."""
    return _quartiles(t(s, d, "documents"), "source", "n_chars")


@query("""SELECT count(*) FILTER (WHERE c_acctbal IS NULL) AS n_null, count(*) FILTER (WHERE c_acctbal < 0) AS below, count(*) FILTER (WHERE c_acctbal > 100) AS above, count(*) FILTER (WHERE c_acctbal = 0) AS at_floor, count(*) FILTER (WHERE c_acctbal = 100) AS at_ceiling FROM customer""")
def sanity_counts(s: SparkSession, d: str) -> DataFrame:
    """How many scores are missing, out of their range, at its floor and at its ceiling."""
    c = F.col("c_acctbal")
    return t(s, d, "customer").agg(*[F.count_if(x).alias(n) for n, x in {"n_null": c.isNull(), "below": c < 0, "above": c > 100, "at_floor": c == 0, "at_ceiling": c == 100}.items()])


_RATED = {"flag": ("l_returnflag = 'A'", "l_linestatus = 'F'", "l_quantity > 25"), "late": ("l_tax > 0.04", "l_discount > 0.05", "l_tax > 0.05"), "dear": ("l_extendedprice > 50000", "l_quantity > 25", "l_extendedprice > 40000")}


@query("SELECT field, avg(CAST(a = b AS INT)) AS ab, avg(CAST(a = c AS INT)) AS ac, avg(CAST(b = c AS INT)) AS bc, avg(CAST(a = b AND b = c AS INT)) AS abc, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS field, {a} AS a, {b} AS b, {c} AS c FROM lineitem" for k, (a, b, c) in _RATED.items()) + ") GROUP BY 1")
def field_agreement(s: SparkSession, d: str) -> DataFrame:
    """How often three raters agree on each field, in pairs and all together; fields are unpivoted, so the input is read once."""
    fields = F.array(*[F.struct(F.lit(k).alias("field"), *[F.expr(x).alias(n) for n, x in zip("abc", xs, strict=True)]) for k, xs in _RATED.items()])
    rows = t(s, d, "lineitem").select(F.explode(fields).alias("x")).select("x.*")
    share = lambda x: F.avg(x.cast("int"))
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    return rows.groupBy("field").agg(share(a == b).alias("ab"), share(a == c).alias("ac"), share(b == c).alias("bc"), share((a == b) & (b == c)).alias("abc"), F.count("*").alias("n"))


@query("""SELECT user_id, count(*) FILTER (WHERE event_type <> 'error') AS n_issues, count(*) FILTER (WHERE event_type = 'click') AS n_open, count(DISTINCT event_type) AS n_types, list_sort(list(event_id))[1:5] AS first_ids FROM events GROUP BY 1""".replace("list_sort(list(event_id))[1:5]", "array_to_string(list_sort(list(event_id))[1:5], ',')"))
def event_mix(s: SparkSession, d: str) -> DataFrame:
    """Counts of each user's events by kind, and the first five ids."""
    e = t(s, d, "events").groupBy("user_id").agg(F.collect_list(F.struct("event_id", "event_type")).alias("e"))
    n = lambda f: F.size(F.filter("e", f)).cast("long")
    first = F.array_join(F.transform(F.slice(F.array_sort(F.transform("e", lambda x: x["event_id"])), 1, 5), lambda x: x.cast("string")), ",")
    types = F.size(F.array_distinct(F.transform("e", lambda x: x["event_type"]))).cast("long")
    return e.select("user_id", n(lambda x: x["event_type"] != "error").alias("n_issues"), n(lambda x: x["event_type"] == "click").alias("n_open"), types.alias("n_types"), first.alias("first_ids"))


@query("""SELECT * FROM (SELECT 'top' AS side, c_custkey, c_acctbal, (SELECT round(avg(c_acctbal), 6) FROM customer) AS mean FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 5)
UNION ALL SELECT * FROM (SELECT 'bottom', c_custkey, c_acctbal, (SELECT round(avg(c_acctbal), 6) FROM customer) FROM customer ORDER BY c_acctbal, c_custkey LIMIT 5)""")
def top_and_bottom(s: SparkSession, d: str) -> DataFrame:
    """The five largest and the five smallest of a figure, with its mean."""
    c = t(s, d, "customer").select("c_custkey", "c_acctbal")
    pick = lambda side, *order: c.orderBy(*order).limit(5).select(F.lit(side).alias("side"), "*")
    ends = pick("top", F.desc("c_acctbal"), "c_custkey").unionByName(pick("bottom", "c_acctbal", "c_custkey"))
    return ends.join(F.broadcast(c.agg(F.round(F.avg("c_acctbal"), 6).alias("mean"))), F.lit(True))


@query("SELECT p_partkey, p_name FROM part ORDER BY md5('42' || CAST(p_partkey AS VARCHAR)), p_partkey LIMIT 20")
def seeded_sample(s: SparkSession, d: str) -> DataFrame:
    """Twenty rows in the order of a seeded hash: the same at every run and for any partitioning."""
    return t(s, d, "part").orderBy(F.md5(F.concat(F.lit("42"), F.col("p_partkey").cast("string"))), "p_partkey").limit(20).select("p_partkey", "p_name")


@query()
def budget_chunks(s: SparkSession, d: str) -> DataFrame:
    """Turns of each conversation cut into chunks of at most 100 tokens, in order and whole; no SQL, a test holds it against brute force."""
    rows = t(s, d, "conversations").select("conv_id", "turn", "role", F.floor(F.length("text") / 4).cast("long").alias("tokens"))
    return chunked(rows, ["conv_id"], ["turn", "role"], "tokens", 100).withColumn("chunk", F.col("chunk").cast("int"))


def _chunk_sql(table: str, columns: str, order: str, most: int) -> str:
    """One order cut greedily, record by record."""
    return f"""WITH RECURSIVE o AS (SELECT {columns}, coalesce(length(text), 0) // 4 AS tokens, row_number() OVER (ORDER BY {order}) AS n FROM {table}),
c AS (SELECT *, tokens AS held, CAST(0 AS BIGINT) AS chunk FROM o WHERE n = 1 UNION ALL
SELECT o.*, CASE WHEN held + o.tokens > {most} THEN o.tokens ELSE held + o.tokens END, chunk + CAST(held + o.tokens > {most} AS INT) FROM c JOIN o ON o.n = c.n + 1)
SELECT {columns}, tokens, chunk FROM c"""


@query(_chunk_sql("conversations", "conv_id, turn, role", "conv_id, turn, role", 2000))
def conversation_batches(s: SparkSession, d: str) -> DataFrame:
    """All turns in one order, cut into batches of at most 2000 tokens."""
    rows = t(s, d, "conversations").select("conv_id", "turn", "role", F.floor(F.coalesce(F.length("text"), F.lit(0)) / 4).cast("long").alias("tokens"))
    return chunked(rows, [], ["conv_id", "turn", "role"], "tokens", 2000)


@query(_chunk_sql("documents", "doc_id", "doc_id", 20000))
def document_batches(s: SparkSession, d: str) -> DataFrame:
    """All documents in one order, cut into batches of at most 20000 tokens."""
    rows = t(s, d, "documents").select("doc_id", F.floor(F.coalesce(F.length("text"), F.lit(0)) / 4).cast("long").alias("tokens"))
    return chunked(rows, [], ["doc_id"], "tokens", 20000)


@query("""WITH h AS (SELECT p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN p_brand END AS description, CASE WHEN p_size % 3 = 0 THEN p_type END AS kind FROM part), g AS (SELECT p_partkey AS id, p_name AS description, lower(p_type) AS kind FROM part WHERE p_partkey % 4 <> 0)
SELECT h.id, coalesce(h.description, g.description) AS description, coalesce(h.kind, g.kind) AS kind FROM h LEFT JOIN g USING (id)""")
def fill_nulls(s: SparkSession, d: str) -> DataFrame:
    """Fields that a record lacks, from another source; what it has stays."""
    p = t(s, d, "part")
    old = p.select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).alias("description"), F.when(F.col("p_size") % 3 == 0, F.col("p_type")).alias("kind"))
    new = p.where("p_partkey % 4 <> 0").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("description"), F.lower("p_type").alias("kind"))
    return fill_known(old, new, ["id"])


@query("""WITH n AS (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_quantity > 40 GROUP BY 1)
SELECT o_orderkey, CASE WHEN n.n IS NULL AND o_orderstatus = 'F' THEN 0 WHEN n.n IS NOT NULL THEN 1 ELSE CAST(o_orderstatus = 'O' AS INT) END AS processed, coalesce(n.n, 0) AS component_count FROM orders LEFT JOIN n ON l_orderkey = o_orderkey""")
def mark_processed(s: SparkSession, d: str) -> DataFrame:
    """Orders marked as processed with their count of lines; finished ones without a line go back to the queue."""
    n = t(s, d, "lineitem").where("l_quantity > 40").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    rows = t(s, d, "orders").join(n, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    state = F.when(F.col("n").isNull() & (F.col("o_orderstatus") == "F"), 0).when(F.col("n").isNotNull(), 1).otherwise((F.col("o_orderstatus") == "O").cast("int"))
    return rows.select("o_orderkey", state.alias("processed"), F.coalesce("n", F.lit(0)).alias("component_count"))


_ORDER = "(l_shipdate, l_orderkey, l_linenumber, l_quantity, l_extendedprice)"


@query(f"SELECT l_partkey, l_suppkey, l_returnflag, max_by(l_extendedprice, {_ORDER}) AS price, min_by(l_linestatus, {_ORDER}) AS currency FROM lineitem GROUP BY 1, 2, 3")
def price_upsert(s: SparkSession, d: str) -> DataFrame:
    """Prices by component, distributor and source: the last price, but the first currency."""
    rows = t(s, d, "lineitem").withColumns({"price": F.col("l_extendedprice"), "currency": F.col("l_linestatus")})
    return merge(rows, ["l_partkey", "l_suppkey", "l_returnflag"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"], {"price": "last", "currency": "first"})


@query("""SELECT c_custkey AS id, coalesce(NULL, c_name) AS name FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT o_custkey + 1000000, 'from orders' FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey % 2 = 1)""")
def backfill(s: SparkSession, d: str) -> DataFrame:
    """Rows that are there get the fields they lack, rows that are not there are added."""
    old = t(s, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("id"), F.lit(None).cast("string").alias("name"))
    new = t(s, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    more = t(s, d, "orders").where("o_custkey % 2 = 1").select((F.col("o_custkey") + 1000000).alias("id"), F.lit("from orders").alias("name")).distinct()
    return fill_known(old, new, ["id"]).unionByName(more.join(old, "id", "left_anti"))


@query("""WITH e AS (SELECT o_custkey AS project, 'f' || o_orderkey % 20 AS path, o_orderstatus AS kind, o_orderkey FROM orders), u AS (SELECT project, path, arg_min(kind, o_orderkey) AS kind FROM e GROUP BY 1, 2)
SELECT project, string_agg(path || ':' || kind, ' ' ORDER BY path) AS tree FROM (SELECT *, row_number() OVER (PARTITION BY project ORDER BY path) AS n FROM u) WHERE n <= 8 GROUP BY 1""")
def file_trees(s: SparkSession, d: str) -> DataFrame:
    """File entries, the first of each path, and of each project the first eight by path."""
    e = t(s, d, "orders").select(F.col("o_custkey").alias("project"), F.concat(F.lit("f"), F.col("o_orderkey") % 20).alias("path"), F.col("o_orderstatus").alias("kind"), "o_orderkey")
    u = merge(e, ["project", "path"], ["o_orderkey"], {"kind": "first"})
    tree = F.slice(F.array_sort(F.collect_list(F.struct("path", "kind"))), 1, 8)
    return u.groupBy("project").agg(F.array_join(F.transform(tree, lambda x: F.concat_ws(":", x["path"], x["kind"])), " ").alias("tree"))


@query("""SELECT c_custkey, CAST(CAST(c_acctbal > 0 AS INT) * 2 + CAST(c_nationkey % 2 = 0 AS INT) + CAST(c_mktsegment = 'BUILDING' AS INT) + CAST(coalesce(quality = 1, false) AS INT) + CAST(coalesce(toxic = 0, false) AS INT) AS BIGINT) AS corrected FROM customer LEFT JOIN labels ON doc_id = c_custkey""")
def corrected_openness(s: SparkSession, d: str) -> DataFrame:
    """Openness whose proxies are replaced by verdicts where there is one; without one they do not hold."""
    rows = t(s, d, "customer").join(t(s, d, "labels"), F.col("doc_id") == F.col("c_custkey"), "left")
    flags = [F.col("c_acctbal") > 0, F.col("c_acctbal") > 0, F.col("c_nationkey") % 2 == 0, F.col("c_mktsegment") == "BUILDING", F.col("quality") == 1, F.col("toxic") == 0]
    total = reduce(lambda a, b: a + b, [F.coalesce(f, F.lit(False)).cast("long") for f in flags])
    return rows.select("c_custkey", total.alias("corrected"))


@query()
def greedy_titles(s: SparkSession, d: str) -> DataFrame:
    """Benchmark items and parts of the most similar titles, each used once, items in order; a test holds it against brute force."""
    tokens = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("([a-z0-9]+)")))
    left = t(s, d, "part").where("p_partkey % 5 = 0").select(F.col("p_partkey").alias("a"), tokens(F.concat_ws(" ", "p_name", "p_type")).alias("tokens"))
    right = t(s, d, "part").where("p_partkey % 5 = 1").select(F.col("p_partkey").alias("b"), tokens(F.concat_ws(" ", "p_name", "p_brand")).alias("tokens"))
    return titles_paired(left, right, 0.3)
