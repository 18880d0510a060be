"""Helpers of the training-data operators: the shared folder, written tables, text columns, bit sets."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word is a run of characters that are not ASCII white space; bytes.split() cuts at the same six.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir; one of our own only in a local session that has none."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not (spark.sparkContext.master + "[").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="partsieve-")
        spark.conf.set("spark.checkpoint.dir", found)
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table written to the shared folder: cuts lineage, survives the loss of any executor, is computed once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/partsieve/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Tables:
    """Written tables of one job, deleted one by one when their successors are written."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        self._paths: dict[int, tuple[DataFrame, str]] = {}

    def write(self, df: DataFrame, what: str) -> DataFrame:
        path = f"{shared_dir(self.spark)}/partsieve/{self.name}-{what}-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = out, path
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        """Deletes tables that write() returned; nothing that is still to be read may come from them."""
        jvm = self.spark.sparkContext._jvm
        for t in tables:
            if t is not None and id(t) in self._paths:
                path = jvm.org.apache.hadoop.fs.Path(self._paths.pop(id(t))[1])
                path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def free(self) -> None:
        """Lets Spark delete the shuffle files of finished steps now: its cleaner acts on what the driver's garbage collection finds."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def whole(text: Column) -> Column:
    """Null counts as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it was."""
    return F.translate(text, UPPER, LOWER)


#: Bits of one page of a bit set: 4 KB.
PAGE_BITS = 32768


def filter_pages(n: int, most: int = 2048) -> int:
    """Pages of a bit set for n keys: 16 bits a key, at most so many pages (8 MB). Beyond that more rows pass the filter for
    nothing and the join behind it, which is exact, gets more rows: at worst all of them."""
    pages = 16
    while pages < most and pages * PAGE_BITS < 16 * n:
        pages *= 2
    return pages


def bit_set(keys: DataFrame, columns: list[str], pages: int) -> DataFrame:
    """Bit set (page, words: 32 bits each) of the hashes of some columns: at most pages * 8 KB, whatever the number of keys."""
    slot = F.pmod(F.xxhash64(*columns), F.lit(pages * PAGE_BITS))
    slots = keys.select(slot.alias("slot"))
    bits = slots.groupBy((F.col("slot") / PAGE_BITS).cast("int").alias("page")).agg(F.expr(f"bitmap_construct_agg(slot % {PAGE_BITS})").alias("bits"))
    word = lambda i: F.conv(F.hex(F.substring("bits", i * 4 + 1, F.lit(4))), 16, 10).cast("long")
    return bits.select("page", F.transform(F.sequence(F.lit(0), F.lit(PAGE_BITS // 32 - 1)), word).alias("words"))


def with_hit(rows: DataFrame, bits: DataFrame, columns: list[str], pages: int) -> DataFrame:
    """Column hit: false where a row's key is certainly not in the bit set. The set is broadcast: its size is bounded."""
    slot = F.pmod(F.xxhash64(*columns), F.lit(pages * PAGE_BITS))
    both = rows.withColumn("slot", slot).withColumn("page", (F.col("slot") / PAGE_BITS).cast("int")).join(F.broadcast(bits), "page", "left")
    at = F.col("slot") % PAGE_BITS
    # a bitmap's bytes come least first, a word's value has its first byte on top
    bit = F.getbit(F.get("words", (at / 32).cast("int")), (at % 32).bitwiseXOR(F.lit(24)).cast("int"))
    return both.withColumn("hit", F.coalesce(bit == 1, F.lit(False))).drop("page", "slot", "words")


def keep_one_of(docs: DataFrame, told: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """docs without the rows that told (id, tx, stays; once each) lets go, and with one of each that it lets stay.

    tx is xxhash64 of the text. Rows that told does not name stay as they are and are not shuffled, but for the few that
    the filter passes for nothing. Columns may have any names.
    """
    told = written(told, "told")
    pages = filter_pages(told.count())
    names = docs.columns
    at, text = names.index(id_col), names.index(text_col)
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    keyed = plain.select(F.struct("*").alias("row"), F.col(f"c{at}").alias("id"), F.xxhash64(F.col(f"c{text}").cast("string")).alias("tx"))
    marked = with_hit(keyed, bit_set(told, ["id", "tx"], pages), ["id", "tx"], pages)
    t = told.select(F.col("id").alias("told_id"), F.col("tx").alias("told_tx"), "stays")
    both = marked.where("hit").join(t, F.col("id").eqNullSafe(F.col("told_id")) & (F.col("tx") == F.col("told_tx")), "left")
    one = both.where("stays").groupBy("id", "tx").agg(F.first("row").alias("row")).select("row")
    out = marked.where("not hit").select("row").unionByName(both.where("stays is null").select("row")).unionByName(one)
    return out.select("row.*").toDF(*names)
