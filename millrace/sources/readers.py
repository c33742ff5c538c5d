"""Readers. All return lazy frames; a fixed schema avoids the extra inference pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    infer: bool = False,
    encoding: str = "UTF-8",
    multiline: bool = False,
) -> DataFrame:
    """CSV with a header row. Without schema or inference every column is a string."""
    reader = spark.read.option("header", True).option("encoding", encoding)
    reader = reader.option("multiLine", multiline)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def read_delimited(
    spark: SparkSession, path: str, names: Sequence[str], types: Sequence[str] | None = None, sep: str = "\t"
) -> DataFrame:
    """Header-less delimited text with given column names; strings unless typed."""
    kinds = types or ["string"] * len(names)
    ddl = ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds))
    return spark.read.option("sep", sep).schema(ddl).csv(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, kept distributed."""
    return spark.table(name)
