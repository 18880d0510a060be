"""Exact deduplication by progressive refinement: length, then a hash of the first characters, then a hash of everything.

The first scan makes one narrow row a document (length, prefix hash); texts themselves are never shuffled. Lengths
that occur once are settled there, then prefixes that occur once. Which (length, prefix) groups survive goes back to
the second scan as a bit set of bounded size, so only documents of surviving groups have their full content read and
hashed; a false positive of the bit set costs one hash and changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partsieve.llm.shared import ascii_lower, bit_set, filter_pages, whole, with_hit, written

#: Characters of the prefix hash.
PREFIX_CHARS = 256

def _survivors(keys: DataFrame) -> tuple[DataFrame, int]:
    """Bit set of the (length, prefix) groups with two documents or more, and its pages."""
    by_prefix = written(keys.groupBy("n_bytes", "prefix").agg(F.count("*").alias("n")), "exact-prefixes")
    by_length = by_prefix.groupBy("n_bytes").agg(F.sum("n").alias("n_length")).where("n_length > 1")
    several = written(by_prefix.where("n > 1").join(by_length, "n_bytes", "left_semi"), "exact-survivors")
    pages = filter_pages(several.count())
    return bit_set(several, ["n_bytes", "prefix"], pages), pages


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[Column] = ()) -> DataFrame:
    """One row per row of docs: id, keep_id (largest id of the equal texts), group_size, kept, then carry.

    carry: expressions over the normalised text, in column norm, that the second scan adds.

    Texts are equal when identical after lower-casing A-Z only; null counts as empty, so null and empty texts form
    one group. Null ids stay null and lose against any id. Rows that share an id and a text are the same document and
    get the same row. Other columns of docs, whatever their names, are not read. An empty table gives no rows.
    """
    text = ascii_lower(whole(F.col(text_col)))
    narrow = docs.select(F.col(id_col).alias("id"), text.alias("norm")).select(
        "id",
        "norm",
        F.octet_length("norm").alias("n_bytes"),
        F.xxhash64(F.substring("norm", 1, PREFIX_CHARS)).alias("prefix"),
    )
    bits, pages = _survivors(narrow.select("n_bytes", "prefix"))
    marked = with_hit(narrow, bits, ["n_bytes", "prefix"], pages)
    rows = marked.select("id", F.when(F.col("hit"), F.unhex(F.sha2("norm", 256))).alias("digest"), *carry)
    rows = written(rows, "exact-digests")
    groups = rows.where("digest is not null").groupBy("digest").agg(F.max("id").alias("keep"), F.count("*").alias("n")).where("n > 1")
    groups = written(groups, "exact-groups")  # so that the join exchanges both sides and a digest of very many rows is split
    alone = rows.where("digest is null").withColumns({"keep": F.col("id"), "n": F.lit(1).cast("long")})
    one = rows.where("digest is not null").join(groups, "digest", "left").unionByName(alone)
    keep = F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep"))
    return one.select(
        F.col("id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        keep.eqNullSafe(F.col("id")).alias("kept"),
        *(F.col(c) for c in rows.columns[2:]),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of equal texts, all its columns: the one with the largest id (null before all others; of rows
    that share it, one picked by a hash of all its columns).

    Rows go by their content, not by their id: another text under the id of a row that goes stays. Null and empty texts
    are one group. Only rows of groups that survive length and prefix have their columns aggregated, first in each task.
    Columns may have any names. An empty table gives no rows.
    """
    names = docs.columns
    at, text_at = names.index(id_col), names.index(text_col)
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    norm = ascii_lower(whole(F.col(f"c{text_at}")))
    keyed = plain.select(F.struct("*").alias("row"), norm.alias("norm"), F.octet_length(norm).alias("n_bytes"), F.xxhash64(F.substring(norm, 1, PREFIX_CHARS)).alias("prefix"))
    bits, pages = _survivors(keyed.select("n_bytes", "prefix"))
    marked = with_hit(keyed, bits, ["n_bytes", "prefix"], pages)
    alone = marked.where("not hit").select("row")
    rank = F.struct(F.col(f"row.c{at}").isNotNull(), F.col(f"row.c{at}"), F.xxhash64(F.to_json(F.col("row"))))
    one = marked.where("hit").select(F.unhex(F.sha2("norm", 256)).alias("digest"), "row").groupBy("digest").agg(F.max_by("row", rank).alias("row")).select("row")
    return alone.unionByName(one).select("row.*").toDF(*names)
