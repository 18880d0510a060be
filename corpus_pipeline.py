"""The training-data pipeline: quality classifier, exact dedup, near dedup, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes and rereads what each one returns, so a
lost executor costs at most one stage's tasks. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partsieve.llm.exact_dedup import exact_dedup
from partsieve.llm.mixing import mixed
from partsieve.llm.ngram_join import ngram_dedup
from partsieve.llm.quality_model import good_documents
from partsieve.llm.queries import multilingual_bpe
from partsieve.llm.shared import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels that are not held out, does not reject."""
    return good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 of their five-word shingles."""
    return ngram_dedup(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at weights 5, 2, 1, repeating, as often as the mix takes each document."""
    return mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, decoded again as a check: doc_id, lang, source, n_tokens, ids, round_trip."""
    bpe = multilingual_bpe(spark)
    both = bpe.round_trip(docs, carry=["lang", "source"])
    same = F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "utf-8")
    return both.select("doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("n-gram Jaccard join", near), ("mixing", mixing), ("byte-level BPE", tokens)]

#: Learned scores and seeded hashes are not SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
