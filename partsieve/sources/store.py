"""Stored tables that change as a whole: immutable bucket folders and a log of versions, each committed by one rename.

A version names the folder of every bucket. A writer writes new folders, beside those that are there, and commits by
renaming a finished log entry to the next version's name, which fails if another writer was first. So a failed job leaves
the table as it was, a reader keeps the version that it began with, and of two writers one is told. Rows are dealt to
buckets by a hash of their key; a change rewrites the buckets that its keys fall into, and no others are read or written.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from partsieve.operators.merge import merge, replace_groups


class Conflict(Exception):
    """Another writer committed the version that this one would have."""


class StoredTable:
    """A table in a folder. keys say which rows change together; buckets is fixed by the first version."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _fs(self):
        return self._at("log").getFileSystem(self._conf)

    def version(self) -> int:
        """The last version; 0 before the first."""
        fs, log = self._fs(), self._at("log")
        if not fs.exists(log):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(log)]
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != "."), default=0)

    def _entry(self, version: int) -> dict:
        """schema, keys, buckets, folders (bucket to folder) of a version."""
        if version == 0:
            return {"schema": None, "keys": self.keys, "buckets": self.buckets, "folders": {}}
        rows = self.spark.read.text(f"{self.path}/log/{version:020d}.json", wholetext=True).collect()
        entry = json.loads(rows[0]["value"])
        if entry["keys"] != self.keys:
            raise ValueError(f"{self.path} is kept by {entry['keys']}, not by {self.keys}")
        return entry

    def _commit(self, version: int, entry: dict) -> int:
        fs = self._fs()
        fs.mkdirs(self._at("log"))
        draft, final = self._at(f"log/.{uuid.uuid4().hex}.draft"), self._at(f"log/{version:020d}.json")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self._conf)
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.valueOf("NONE")
        try:
            context.rename(draft, final, options)
        except Exception as e:
            fs.delete(draft, False)
            if "FileAlreadyExistsException" in str(e):
                raise Conflict(f"{self.path}: version {version} is there already") from None
            raise
        return version

    def _read(self, entry: dict, buckets: Sequence[int] | None = None) -> DataFrame:
        folders = [f"{self.path}/{folder}/bucket={b}" for b, folder in entry["folders"].items() if buckets is None or int(b) in buckets]
        schema = StructType.fromJson(entry["schema"])
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the last one if not given; what is committed later does not change them."""
        version = self.version() if version is None else version
        if version == 0:
            raise ValueError(f"{self.path} has no version yet")
        return self._read(self._entry(version))

    def _bucketed(self, rows: DataFrame, buckets: int) -> DataFrame:
        return rows.withColumn("bucket", F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int"))

    def _write(self, rows: DataFrame, buckets: int) -> dict[str, str]:
        """Folders of the buckets that have rows. A bucket of very many rows, such as one hot key's, is written by several tasks."""
        folder = f"data/{uuid.uuid4().hex}"
        self._bucketed(rows, buckets).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.path}/{folder}")
        fs = self._fs()
        names = [s.getPath().getName() for s in fs.listStatus(self._at(folder))]
        return {n.removeprefix("bucket="): folder for n in names if n.startswith("bucket=")}

    def replace(self, rows: DataFrame, expected: int | None = None) -> int:
        """A version of these rows alone. expected: the version that it may follow; the last one if not given."""
        before = self.version() if expected is None else expected
        buckets = self._entry(before)["buckets"]
        return self._commit(before + 1, {"schema": rows.schema.jsonValue(), "keys": self.keys, "buckets": buckets, "folders": self._write(rows, buckets)})

    def change(self, incoming: DataFrame, apply: Callable[[DataFrame, DataFrame], DataFrame], expected: int | None = None) -> int:
        """A version in which apply(rows of the buckets that incoming's keys fall into, incoming) stands for those rows.

        apply must leave rows of other keys as they are. Buckets that no incoming key falls into are neither read nor written.
        """
        before = self.version() if expected is None else expected
        entry = self._entry(before)
        if before == 0:
            entry["schema"] = incoming.schema.jsonValue()
        touched = [r["bucket"] for r in self._bucketed(incoming, entry["buckets"]).select("bucket").distinct().collect()]  # at most all buckets
        if not touched:
            return before
        found = self._write(apply(self._read(entry, touched), incoming), entry["buckets"])
        kept = {b: folder for b, folder in entry["folders"].items() if int(b) not in touched}
        return self._commit(before + 1, entry | {"folders": kept | found})

    def replace_groups(self, incoming: DataFrame, expected: int | None = None) -> int:
        """Incoming rows take the place of all rows that share a key with one of them. Null keys are a key like any other."""

        def apply(old: DataFrame, new: DataFrame) -> DataFrame:
            said = F.struct(*[F.struct(F.col(k).isNull(), F.col(k)) for k in self.keys])
            both = replace_groups(old.withColumn("_key", F.to_json(said)), new.select(*old.columns).withColumn("_key", F.to_json(said)), ["_key"])
            return both.select(*old.columns)

        return self.change(incoming, apply, expected)

    def upsert(self, incoming: DataFrame, order: Sequence[str], policies: Mapping[str, str], expected: int | None = None) -> int:
        """One row a key: what is there and what comes in merged by the policies of operators.merge, old rows first."""

        def apply(old: DataFrame, new: DataFrame) -> DataFrame:
            rows = old.withColumn("_new", F.lit(0)).unionByName(new.select(*old.columns).withColumn("_new", F.lit(1)))
            return merge(rows, self.keys, ["_new", *order], {c: policies[c] for c in old.columns if c not in self.keys}).select(*old.columns)

        return self.change(incoming, apply, expected)

    def vacuum(self, keep: int = 2) -> None:
        """Deletes what none of the last versions needs: log entries, folders, and what failed jobs left. Not to be run while a
        writer writes or a reader reads an older version."""
        fs, last = self._fs(), self.version()
        versions = range(max(1, last - keep + 1), last + 1)
        used = {f for v in versions for f in self._entry(v)["folders"].values()}
        for status in fs.listStatus(self._at("log")):
            name = status.getPath().getName()
            if name.endswith(".draft") or (name.endswith(".json") and int(name.removesuffix(".json")) not in versions):
                fs.delete(status.getPath(), False)
        for status in fs.listStatus(self._at("data")):
            if f"data/{status.getPath().getName()}" not in used:
                fs.delete(status.getPath(), True)
