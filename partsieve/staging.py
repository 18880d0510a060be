"""Tables written to the folder that driver and executors share, and read again: they cut lineage and outlive executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(s: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster shares; a local session without one gets a temporary folder."""
    base = s.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not (s.sparkContext.master + "[").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="partsieve-")
    return f"{base.rstrip('/')}/partsieve-{name}-{uuid.uuid4().hex}"


class Stages:
    """Tables of one job. Each is computed once; drop() deletes those that nothing is to read any more."""

    def __init__(self, s: SparkSession, name: str):
        self.s, self.name = s, name
        self._paths: dict[int, tuple[DataFrame, str]] = {}

    def write(self, df: DataFrame, what: str) -> DataFrame:
        path = scratch(self.s, f"{self.name}-{what}")
        df.write.option("compression", "zstd").parquet(path)
        out = self.s.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = out, path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.s.sparkContext._jvm
        for t in tables:
            path = jvm.org.apache.hadoop.fs.Path(self._paths.pop(id(t))[1])
            path.getFileSystem(self.s.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
