"""Audit of how far sources of a language diverge in their terms, exact in integers.

Terms are counted once, in tasks, and merged by Spark. Terms in more than LIGHT groups of a language are heavy: they go to
dense tiles, matrices of some terms by two blocks of sources, whose pair sums numpy adds up. All others are light, and
most of their cells are zero counts. For two groups a light term without counts gives the same value whatever the term, so
a pair starts from that value times the number of light terms and is corrected: once for each group and share that
occurs (how many light terms have it there), and once for each pair of groups in which one term occurs, out of its
postings, at most LIGHT long. Both sums are added; no cell is approximated or left out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partsieve.llm.shared import Tables, whole

#: Groups of a light term at most.
LIGHT = 8
#: Terms of a tile, about, and sources of each of its two blocks.
TILE_TERMS, BLOCK = 128, 128
#: Counts that a task holds before it hands them on (a default), and bytes of a text that are cut into terms at once.
HELD, CUT = 1 << 19, 1 << 20
#: A-Z become a-z, other ASCII characters but letters become spaces; bytes of other characters stay.
TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _terms(text: str) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of bounded size; one term is never cut."""
    raw, at = text.encode().translate(TERMS), 0
    while at < len(raw):
        end = raw.find(b" ", at + CUT)
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


def _counted(most: int, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, text to lang, source, term, n, docs: once for each group and term, as long as a task can hold them."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            for i in range(0, len(terms), 1 << 16):
                some = terms[i : i + (1 << 16)]
                same = [pa.array([x] * len(some), pa.string()) for x in (lang, source)]
                counts = [pa.array([c[t] for t in some], pa.int64()) for c in (n, docs)]
                yield pa.RecordBatch.from_arrays([*same, pa.array([t.decode() for t in some], pa.string()), *counts], names=["lang", "source", "term", "n", "docs"])
        held.clear()

    for part in parts:
        for lang, source, text in zip(*(part.column(i) for i in range(3)), strict=True):
            n, docs = held.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
            before, own = len(n), set()
            for terms in _terms(text.as_py()):
                n.update(terms)
                own.update(terms)
            docs.update(own)
            size += len(n) - before
            if size > most:
                yield from flush()
                size = 0
    yield from flush()


def share(n: str, total: str, kinds: str) -> Column:
    """1 + floor(10^9 * (n + 2) / (total + 2 * kinds)), in whole numbers of up to 30 digits; kinds is not 0."""
    return F.expr(f"(CAST({n} + 2 AS DECIMAL(20, 0)) * CAST(1000000000 AS DECIMAL(10, 0))) div CAST({total} + 2 * {kinds} AS DECIMAL(20, 0)) + 1")


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)) of two shares: at most 10^18 before the division."""
    square = (p - q) * (p - q)
    return F.call_function("div", square, p + q)


def _tile(table: pa.Table) -> pa.Table:
    """Sums of gaps over the terms of one tile, for the pairs of groups of its two blocks."""
    lang, low, high = (table.column(c)[0].as_py() for c in ("lang", "low", "high"))
    base = table.filter(pc.is_null(table.column("term")))
    numbers, zero, of_block = (base.column(c).to_numpy() for c in ("number", "p", "own"))
    order = np.argsort(numbers)
    numbers, zero, of_block = numbers[order], zero[order], of_block[order]
    cells = table.filter(pc.is_valid(table.column("term")))
    terms = cells.column("term").combine_chunks().dictionary_encode()
    dense = np.repeat(zero[None, :], len(terms.dictionary), axis=0)
    dense[terms.indices.to_numpy(), np.searchsorted(numbers, cells.column("number").to_numpy())] = cells.column("p").to_numpy()
    elsewhere = base.column("terms")[0].as_py() - len(dense)  # terms of the tile that no group of the two blocks has
    out_i, out_j, out_value = [], [], []
    for i in np.flatnonzero(of_block == low):
        js = np.flatnonzero((of_block == high) & (numbers > numbers[i]))
        p, q = dense[:, [i]], dense[:, js]
        out_i.append(np.full(len(js), numbers[i]))
        out_j.append(numbers[js])
        nowhere = (zero[i] - zero[js]) ** 2 // (zero[i] + zero[js])
        out_value.append(((p - q) ** 2 // (p + q)).sum(0) + elsewhere * nowhere)
    i, j, value = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (out_i, out_j, out_value))
    return pa.table({"lang": pa.array([lang] * len(i), pa.string()), "i": pa.array(i, pa.int64()), "j": pa.array(j, pa.int64()), "value": pa.array(value, pa.int64())})


def divergence(docs: DataFrame, least_docs: int = 10, top: int = 10, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", held: int = HELD) -> DataFrame:
    """lang, source, part, item, value, rank of every (lang, source) that occurs.

    Part pair: item is another source of the language, value the sum of the gaps between the two groups' shares over all
    terms in at least least_docs rows of the language (0 without such terms). Part term: item is such a term that the group
    has more of than its language, value the gap between the two shares; the top ones only. Rank counts from 1 in each
    group and part, by value descending, then item ascending by its UTF-8 bytes.

    Null lang, source and text count as empty strings, which are a language, a source and a text without terms. Rows are
    documents: equal rows count twice, ids are not read, nor are other columns, whatever their names. A group without
    terms has pairs; an empty table gives no rows. A language with S sources gives S * (S - 1) pairs: that is the result.
    """
    spark = docs.sparkSession
    tables = Tables(spark, "divergence")
    rows = docs.select(whole(F.col(lang_col)).alias("lang"), whole(F.col(source_col)).alias("source"), whole(F.col(text_col)).alias("text"))
    counted = rows.mapInArrow(partial(_counted, held), "lang string, source string, term string, n long, docs long")
    # dealt by language and term once: groups of a term, its documents and its total need no other shuffle
    counts = counted.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    counts = counts.withColumns({"df": F.sum("docs").over(of_term), "total": F.sum("n").over(of_term), "spread": F.count("*").over(of_term)})
    kept = tables.write(counts.where(F.col("df") >= least_docs).select("lang", "term", "source", "n", "total", "spread"), "kept")

    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.countDistinct("term").alias("kinds"), F.countDistinct(F.when(F.col("spread") <= LIGHT, F.col("term"))).alias("light"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("group_total"))
    groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.na.fill(0, ["group_total", "lang_total", "kinds", "light"])
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1
    groups = groups.withColumn("number", number).withColumn("zero", F.when(F.col("kinds") > 0, share("0", "group_total", "kinds")))
    groups = tables.write(groups, "groups")

    shares = kept.join(groups.drop("light"), ["lang", "source"]).withColumn("p", share("n", "group_total", "kinds"))
    light = shares.where(F.col("spread") <= LIGHT)
    sums = _heavy(shares.where(F.col("spread") > LIGHT), groups).unionByName(_light(light, groups))
    sums = sums.groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))
    a = groups.select("lang", "source", F.col("number").alias("i"), F.col("zero").alias("zero_i"), "light")
    b = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("j"), F.col("zero").alias("zero_j"))
    pairs = a.join(b, "lang").where("i < j").join(sums, ["lang", "i", "j"], "left")
    value = F.coalesce("value", F.lit(0)) + F.when(F.col("light") > 0, F.col("light") * gap(F.col("zero_i"), F.col("zero_j"))).otherwise(0)
    pairs = pairs.withColumn("value", value)
    both = pairs.select("lang", "source", "item", "value").unionByName(pairs.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))

    terms = shares.withColumn("q", share("total", "lang_total", "kinds")).where("p > q")
    terms = terms.select("lang", "source", F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = lambda df, part: df.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit(part))
    out = ranked(both, "pair").unionByName(ranked(terms, "term").where(F.col("rank") <= top))
    return out.select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), "rank")


def _heavy(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, i, j, value: sums of gaps over the heavy terms. Blocks of sources meet in pairs, so a tile is bounded however
    many sources a language has."""
    block = lambda c: F.floor(F.col(c) / BLOCK)
    tiles = F.ceil(F.col("kinds") / TILE_TERMS).cast("long")
    blocks = groups.groupBy("lang").agg((F.max(block("number")) + 1).alias("blocks"))
    cells = shares.select("lang", "term", "number", "p", F.pmod(F.xxhash64("term"), tiles).alias("tile"), F.lit(None).cast("long").alias("terms"))
    used = cells.groupBy("lang", "tile").agg(F.countDistinct("term").alias("terms"))
    base = groups.select("lang", F.lit(None).cast("string").alias("term"), "number", F.col("zero").alias("p")).join(used, "lang")
    each = cells.unionByName(base).join(blocks, "lang").withColumn("own", block("number"))
    each = each.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    each = each.select("lang", "tile", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "term", "number", "p", "terms")
    return each.groupBy("lang", "tile", "low", "high").applyInArrow(_tile, "lang string, i long, j long, value long")


def _light(light: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, i, j, value: what the counts of light terms change in the value that a pair has without them."""
    other = groups.select("lang", F.col("number").alias("other"), F.col("zero").alias("zero_other"))
    seen = light.groupBy("lang", "number", "zero", "p").agg(F.count("*").alias("times"))
    one = seen.join(other, "lang").where("number <> other")
    changed = F.col("times") * (gap(F.col("p"), F.col("zero_other")) - gap(F.col("zero"), F.col("zero_other")))
    one = one.groupBy("lang", F.least("number", "other").alias("i"), F.greatest("number", "other").alias("j")).agg(F.sum(changed).alias("value"))

    postings = light.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("number", "p", "zero"))).alias("posts"))
    later = lambda k: F.slice("posts", k + 2, F.lit(LIGHT))
    met = F.flatten(F.transform("posts", lambda x, k: F.transform(later(k), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    p, q, p0, q0 = (F.col(c) for c in ("pair.a.p", "pair.b.p", "pair.a.zero", "pair.b.zero"))
    two = postings.select("lang", F.explode(met).alias("pair"))
    two = two.select("lang", F.col("pair.a.number").alias("i"), F.col("pair.b.number").alias("j"), (gap(p, q) - gap(p, q0) - gap(p0, q) + gap(p0, q0)).alias("value"))
    return one.unionByName(two.groupBy("lang", "i", "j").agg(F.sum("value").alias("value")))
