"""Stored tables: groups replaced, records merged, links rebuilt, each a version of a table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partsieve.operators.link import cross_references
from partsieve.session import table as t
from partsieve.sources.store import StoredTable
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


@query("""SELECT conv_id, turn, role AS kind FROM conversations WHERE conv_id % 5 <> 0 AND conv_id % 50 <> 1
UNION ALL SELECT conv_id, turn + 100, 'new' FROM conversations WHERE conv_id % 5 = 0 AND turn < 2
UNION ALL SELECT DISTINCT conv_id, CAST(-1 AS BIGINT), 'last' FROM conversations WHERE conv_id % 50 = 1""")
def stored_trees(s: SparkSession, d: str) -> DataFrame:
    """Entries of each conversation, stored; a fifth of them replaced as a whole, then one in fifty."""
    rows = t(s, d, "conversations")
    table = StoredTable(s, scratch(s, "trees"), ["conv_id"])
    table.replace(rows.select("conv_id", "turn", F.col("role").alias("kind")))
    table.replace_groups(rows.where("conv_id % 5 = 0 AND turn < 2").select("conv_id", (F.col("turn") + 100).alias("turn"), F.lit("new").alias("kind")))
    table.replace_groups(rows.where("conv_id % 50 = 1").select("conv_id").distinct().select("conv_id", F.lit(-1).cast("long").alias("turn"), F.lit("last").alias("kind")))
    return table.read()


@query("""WITH r AS (SELECT lang, source, doc_id % 499 AS slot, doc_id, n_chars, doc_id % 2 AS batch FROM documents)
SELECT lang, source, slot, arg_max(doc_id, (batch, doc_id)) AS doc_id, arg_max(n_chars, (batch, doc_id)) AS n_chars, arg_min(doc_id, (batch, doc_id)) AS first_doc FROM r GROUP BY 1, 2, 3""")
def stored_prices(s: SparkSession, d: str) -> DataFrame:
    """Records by language, source and slot, in two batches: the last size, but the first document."""
    rows = t(s, d, "documents").select("lang", "source", (F.col("doc_id") % 499).alias("slot"), "doc_id", "n_chars", F.col("doc_id").alias("first_doc"))
    table = StoredTable(s, scratch(s, "prices"), ["lang", "source", "slot"])
    for batch in (0, 1):
        table.upsert(rows.where(F.col("doc_id") % 2 == batch), ["doc_id"], {"doc_id": "last", "n_chars": "last", "first_doc": "first"})
    return table.read()


@query("""WITH f AS (SELECT md5(lower(coalesce(text, ''))) AS key, source, min(doc_id) AS id FROM documents GROUP BY 1, 2)
SELECT DISTINCT a.id AS id_a, b.id AS id_b FROM f a JOIN f b ON a.key = b.key AND a.source <> b.source AND a.id < b.id""")
def rebuilt_references(s: SparkSession, d: str) -> DataFrame:
    """Cross references of even documents, cleared and rebuilt over all documents."""
    rows = t(s, d, "documents").select(F.col("doc_id").alias("id"), "source", F.md5(F.lower(F.coalesce("text", F.lit("")))).alias("key"))
    table = StoredTable(s, scratch(s, "references"), ["id_a"])
    table.replace(cross_references(rows.where("id % 2 = 0")))
    table.replace(cross_references(rows))
    return table.read()
