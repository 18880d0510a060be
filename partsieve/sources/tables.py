"""Readers and writers of CSV, JSON and line files with explicit or no types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: str | StructType | None = None, infer: bool = False) -> DataFrame:
    """CSV with a header, quotes doubled inside quotes, lines inside quoted cells.

    schema: explicit types, by position, cells that do not parse are null; infer: types from the cells; neither: all
    text. Missing cells are null.
    """
    reader = spark.read.option("header", "true").option("quote", '"').option("escape", '"').option("multiLine", "true")
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", str(infer).lower()).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", "true").option("escape", '"').mode("overwrite").csv(path)


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that hold one JSON array, or one object, each."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object a line; lines that do not parse are left out."""
    with_bad = spark.read.schema(f"{schema}, bad_line string").option("columnNameOfCorruptRecord", "bad_line").json(path)
    return with_bad.where("bad_line IS NULL").drop("bad_line")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Column line: lines that hold something and are no # comments, without white space around them."""
    lines = spark.read.text(path).select(F.trim("value").alias("line"))
    return lines.where("line <> '' AND NOT startswith(line, '#')")


def flattened(df: DataFrame) -> DataFrame:
    """Nested structs as columns with dotted names, at any depth."""
    out: list[Column] = []

    def walk(schema: StructType, path: list[str]) -> None:
        for f in schema:
            if isinstance(f.dataType, StructType):
                walk(f.dataType, [*path, f.name])
            else:
                out.append(F.col(".".join(f"`{p}`" for p in [*path, f.name])).alias(".".join([*path, f.name])))

    walk(df.schema, [])
    return df.select(*out)


def requests(rows: DataFrame, key: str, text: Column, model: str) -> DataFrame:
    """Column value: one JSON request a row, for a JSON-lines file."""
    body = F.struct(F.lit(model).alias("model"), F.array(F.struct(F.lit("user").alias("role"), text.alias("content"))).alias("messages"))
    return rows.select(F.to_json(F.struct(F.col(key).cast("string").alias("custom_id"), body.alias("body"))).alias("value"))
