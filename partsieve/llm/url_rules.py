"""URL filters by a sort-merge range join.

A rule is a host and a path prefix. Written with the host's labels reversed, then the path, a rule is the interval of
all keys it is a prefix of, and intervals are nested or apart. A url gives one key for each ancestor of its host that a
rule could name. Keys and interval starts are dealt out by ranges of keys, sorted, and swept once with a stack of the
rules that are open: its top is the longest rule for that key. A rule goes to every range it reaches into; ranges come
from a sample of bounded size. Urls are reduced to distinct (host, path) first, so a hot url is one key.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from partsieve.llm.shared import written

#: Sampled keys for each range, and the most characters of a range's bound.
SAMPLE_PER_RANGE, BOUND_CHARS = 32, 64
TOP = "\U0010ffff"
SWEPT = "host string, path string, rule_host string, rule_path string, rule_verdict string"


def url_host(url: Column) -> Column:
    """Between the first :// and the next / ? # or the end, A-Z lower-cased; empty without ://."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    found = F.regexp_extract(F.coalesce(rest, F.lit("")), r"^([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """From the host's end to the next ? # or the end; empty without ://."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(labels, "."), F.lit("\u0001"), path)


def _ranges(cuts: list[bytes], where):
    """Range of a key: how many of the sorted cuts lie before it; one bound a range, of BOUND_CHARS characters at most."""

    @F.arrow_udf(IntegerType())
    def at(keys: pa.Array) -> pa.Array:
        return pa.array([where(cuts, k.as_py().encode()) for k in keys], pa.int32())

    return at


def _sweep(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (range, key, kind): kind 0 opens a rule, kind 1 asks for the innermost open one."""
    stack: list[tuple[str, tuple]] = []
    at = None
    for part in parts:
        found = []
        for r in part.to_pylist():
            if r["range"] != at:
                at, stack = r["range"], []
            while stack and not r["key"].startswith(stack[-1][0]):
                stack.pop()
            if r["kind"] == 0:
                stack.append((r["key"], (r["rule_host"], r["rule_path"], r["rule_verdict"])))
            elif stack:
                found.append((r["host"], r["path"], *stack[-1][1]))
        columns = list(zip(*found, strict=True)) or [()] * 5
        names = ("host", "path", "rule_host", "rule_path", "rule_verdict")
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=names)


def judge_urls(pages: DataFrame, rules: DataFrame, otherwise: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of pages: id, host, path, rule (host and path of the rule that decides, or null), verdict.

    rules: host, path, verdict. A rule fits its host and all subdomains if the url's path starts with the rule's; the
    longest (characters of host and path, then of host) wins, and of equal rules that disagree, block. Null urls and
    urls without :// have empty host and path, fit no rule and get the verdict otherwise. Rules with a null or empty
    host or a null path fit nothing. Ids may be null or repeat; other columns are not read; empty tables are fine.
    """
    spark = pages.sparkSession
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    asked = pages.select(F.col(id_col), url_host(url).alias("host"), url_path(url).alias("path"))
    good = rules.where((F.col("host") != "") & F.col("path").isNotNull()).groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    depth = good.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0
    labels = F.reverse(F.split("host", r"\."))
    keys = asked.where("host != ''").select("host", "path").distinct()
    up_to = F.least(F.size("labels"), F.lit(depth))
    levels = F.transform(F.sequence(F.lit(1), up_to), lambda i: _key(F.slice("labels", 1, i), F.col("path")))
    keys = keys.withColumn("labels", labels).select("host", "path", F.explode(F.when(up_to > 0, levels)).alias("key"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sample = keys.select("key").distinct().orderBy(F.xxhash64("key")).limit(ranges * SAMPLE_PER_RANGE)
    seen = sorted({r[0] for r in sample.select(F.substring("key", 1, BOUND_CHARS)).collect()}, key=str.encode)
    bounds = [seen[i * len(seen) // ranges] for i in range(1, ranges)] if seen else []
    cuts = [b.encode() for b in dict.fromkeys(bounds)]
    low, high = _ranges(cuts, bisect_right), _ranges(cuts, bisect_left)
    no = F.lit(None).cast("string")
    asks = keys.select(low("key").alias("range"), "key", F.lit(1).alias("kind"), "host", "path", no.alias("rule_host"), no.alias("rule_path"), no.alias("rule_verdict"))
    opens = good.withColumn("key", _key(labels, F.col("path")))
    opens = opens.withColumn("low", low("key")).withColumn("high", high(F.concat("key", F.lit(TOP))))
    opens = opens.select(F.explode(F.sequence("low", "high")).alias("range"), "key", F.lit(0).alias("kind"), no.alias("host"), no.alias("path"), F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict"))
    swept = asks.unionByName(opens).repartition(ranges, "range").sortWithinPartitions("range", "key", "kind").mapInArrow(_sweep, SWEPT)
    length = F.length("rule_host") + F.length("rule_path")
    best = F.max(F.struct(length, F.length("rule_host"), F.concat("rule_host", "rule_path").alias("rule"), F.col("rule_verdict").alias("verdict")))
    best = swept.groupBy("host", "path").agg(best.alias("best"))
    best = written(best, "url-best")  # so that the join exchanges both sides and a url of very many pages is split
    judged = asked.join(best, ["host", "path"], "left")
    verdict = F.coalesce("best.verdict", F.lit(otherwise))
    return judged.select(id_col, "host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict"))
