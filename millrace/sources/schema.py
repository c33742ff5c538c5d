"""Column lookup, renaming, pruning and schema reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.sizing import unpivot_row


def clean_column_names(df: DataFrame) -> DataFrame:
    """Trim blanks around column names."""
    return df.toDF(*[c.strip() for c in df.columns])


def find_column(
    df: DataFrame, aliases: Sequence[str], mode: str = "exact", fallback: int | None = None
) -> str:
    """Name of the first column that fits an alias, case-insensitive.

    `exact` compares trimmed names, `contains` looks for the alias inside the name.
    Without a hit the column at position `fallback` is taken, if one is given.
    """
    for alias in aliases:
        wanted = alias.strip().lower()
        for name in df.columns:
            have = name.strip().lower()
            if have == wanted or (mode == "contains" and wanted in have):
                return name
    if fallback is None:
        raise KeyError(f"no column fits {list(aliases)}")
    return df.columns[fallback]


def rename_select(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep the mapped columns under their new names, in mapping order."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in mapping.items()])


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*names)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Names of the numeric columns, in schema order."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)).cast("bigint"))


def schema_report(df: DataFrame) -> DataFrame:
    """(column, type, non_null) per column, from one aggregate."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    return unpivot_row(
        counts,
        [
            F.struct(F.lit(c).alias("column"), F.lit(kind).alias("type"), F.col(f"`{c}`").alias("non_null"))
            for c, kind in df.dtypes
        ],
    )


def preview(df: DataFrame, n: int, order: Sequence[str] = (), tail: bool = False) -> DataFrame:
    """First n rows; last n rows of an ordered frame. Without an order the choice is Spark's."""
    if not order:
        if tail:
            raise ValueError("the last rows need an order")
        return df.limit(n)
    keys = [F.col(c).desc() if tail else F.col(c).asc() for c in order]
    return df.orderBy(*keys).limit(n)
