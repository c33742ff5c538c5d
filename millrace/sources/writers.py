"""Writers. Every one replaces the target folder and keeps one file per partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str) -> None:
    """CSV folder with a header in every part file."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_delimited(df: DataFrame, path: str, sep: str = "\t") -> None:
    """Header-less delimited folder, the form of a key/count job output."""
    df.write.mode("overwrite").option("sep", sep).csv(path)


def write_result(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Parquet folder that replaces any earlier result."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
