"""Line deduplication over overlapping windows of three consecutive lines.

Every window is hashed (128 bits, from the lines themselves), repeated windows are found over all documents with their
first occurrence in (id, line) order, and every later occurrence removes its three lines; overlapping windows merge
into one covered stretch. Counting is a two-phase aggregation, so a window that a third of all rows hold costs one row
a task; only windows that repeat go on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partsieve.llm.shared import bit_set, filter_pages, whole, with_hit, written

#: Lines of a window.
LINES = 3


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, tx (hash of the text), lines."""
    text = whole(F.col(text_col))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("tx"), F.split(text, "\n", -1).alias("lines"))


def _windows(rows: DataFrame) -> DataFrame:
    """id, tx, line, h1, h2 of each window that has a character other than white space; head: the first of its document."""

    def one(i):
        parts = [F.get("lines", i + k) for k in range(LINES)]
        said = F.concat(*parts).rlike(r"[^\x20\x09-\x0D]")
        return F.struct(i.alias("line"), F.when(said, F.xxhash64(*parts)).alias("h1"), F.xxhash64(F.lit("second"), *parts).alias("h2"))

    starts = F.when(F.size("lines") >= LINES, F.sequence(F.lit(0), F.size("lines") - LINES))
    found = F.filter(F.transform(starts, one), lambda w: w["h1"].isNotNull())
    return rows.select("id", "tx", F.posexplode(found).alias("k", "w")).select("id", "tx", (F.col("k") == 0).alias("head"), "w.*")


def _covered(starts: str) -> Column:
    return F.array_distinct(F.flatten(F.transform(starts, lambda s: F.sequence(s, s + LINES - 1))))


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, tx, gone, gone_of_copies: line numbers (from 0) that a row of this id and text (by its hash) loses, and those that
    its copies lose, rows of the same id and text but one; null where there are none. Other rows lose nothing."""
    windows = written(_windows(_rows(docs, id_col, text_col)), "line-windows")
    here = F.struct(F.col("id"), F.col("tx"), F.col("line"))
    first = windows.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(here).alias("first")).where("n > 1").drop("n")
    first = written(first, "line-first")  # so that the join exchanges both sides and a window of very many places is split
    later = windows.join(first, ["h1", "h2"]).where(~here.eqNullSafe(F.col("first")))
    copies = windows.where("head").groupBy(F.col("id").alias("copied_id"), F.col("tx").alias("copied_tx")).agg(F.count("*").alias("n")).where("n > 1")
    copied = windows.join(copies, F.col("id").eqNullSafe(F.col("copied_id")) & (F.col("tx") == F.col("copied_tx")))
    both = later.select("id", "tx", "line", F.lit(None).cast("int").alias("copied")).unionByName(copied.select("id", "tx", F.lit(None).cast("int").alias("line"), F.col("line").alias("copied")))
    told = both.groupBy("id", "tx").agg(F.collect_set("line").alias("starts"), F.collect_set("copied").alias("copied"))
    some = lambda c: F.when(F.size(c) > 0, _covered(c))
    return told.select("id", "tx", some("starts").alias("gone"), some("copied").alias("gone_of_copies"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_lines, n_removed, kept (the text without the removed lines).

    Lines are cut at newlines only; null counts as empty, and an empty text has one empty line. Documents of fewer
    than three lines have no window, windows of white space only are ignored. Occurrences are ordered by id, nulls
    first, then (rows of the same id) by a hash of the text, then line. Rows go by id and text: another text under the same
    id, null or not, keeps its own lines, and of rows that share both, one stays as it is and the others lose every line
    of a window. Only rows that lose lines are shuffled. Other columns, whatever their names, are not read. An empty table
    gives no rows.
    """
    told = written(removed_lines(docs, id_col, text_col), "line-told")
    pages = filter_pages(told.count())
    rows = with_hit(_rows(docs, id_col, text_col), bit_set(told, ["id", "tx"], pages), ["id", "tx"], pages)
    whole_rows = rows.where("not hit").select("id", F.size("lines").alias("n_lines"), F.lit(0).alias("n_removed"), F.array_join("lines", "\n").alias("kept"))
    named = told.withColumnsRenamed({"id": "told_id", "tx": "told_tx"})
    hit = rows.where("hit").join(named, F.col("id").eqNullSafe(F.col("told_id")) & (F.col("tx") == F.col("told_tx")), "left").select("id", "tx", "lines", "gone", "gone_of_copies")
    # copies are equal rows: one of them, and how many there are, says all
    same = hit.where("gone_of_copies is not null").groupBy("id", "tx").agg(F.first("lines").alias("lines"), F.first("gone").alias("gone"), F.first("gone_of_copies").alias("of_copies"), F.count("*").alias("n"))
    again = same.where("n > 1").select("id", "lines", F.col("of_copies").alias("gone"), F.explode(F.sequence(F.lit(2).cast("long"), "n")).alias("copy")).drop("copy")
    lost = hit.where("gone_of_copies is null").select("id", "lines", "gone").unionByName(same.select("id", "lines", "gone")).unionByName(again)
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce("gone", F.array().cast("array<int>")))
    lost = lost.select("id", F.size("lines").alias("n_lines"), "lines", stay.alias("stay"))
    lost = lost.select("id", "n_lines", (F.col("n_lines") - F.size("stay")).alias("n_removed"), F.array_join(F.transform("stay", lambda i: F.get("lines", i)), "\n").alias("kept"))
    out = whole_rows.unionByName(lost)
    return out.select(F.col("id").alias(id_col), F.col("n_lines").cast("long").alias("n_lines"), F.col("n_removed").cast("long").alias("n_removed"), "kept")
