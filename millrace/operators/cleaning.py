"""Cleaning: casts, filters, duplicates, nulls, imputation, outliers, audits."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.numeric import clamp
from millrace.functions.text import plain_number, scrub, unparseable
from millrace.operators.quantiles import quantile_values
from millrace.operators.sizing import unpivot_row
from millrace.sources.schema import string_columns


def apply_columns(df: DataFrame, cols: Sequence[str], rule: Callable[[str], Column]) -> DataFrame:
    """The same rule over several columns in one projection."""
    return df.withColumns({c: rule(c) for c in cols})


def cast_columns(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Typed casts; values that do not fit become null."""
    return df.withColumns({c: F.col(c).try_cast(kind) for c, kind in kinds.items()})


def trim_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return apply_columns(df, cols, F.trim)


def scrub_strings(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Drop unusual characters from every string column but the excluded ones.

    Parse dates before the scrub: it removes their separators.
    """
    return apply_columns(df, string_columns(df, exclude), scrub)


def drop_error_rows(df: DataFrame, col: str, marker: str = "ERROR") -> DataFrame:
    """Remove marker rows. Rows without a value go too, as the comparison is unknown there."""
    return df.filter(F.upper(F.col(col)) != marker)


def filter_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows whose raw text is a plain number in all the columns."""
    test = F.lit(True)
    for c in cols:
        test = test & plain_number(c)
    return df.filter(test)


def non_numeric_rows(df: DataFrame, col: str) -> DataFrame:
    """Audit: rows whose text is present but is not a number."""
    return df.filter(unparseable(col))


def deduplicate(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """One row per distinct row; copies merge before the shuffle."""
    return df.dropDuplicates(list(subset)) if subset else df.distinct()


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(subset=list(subset) if subset else None)


def impute_median(df: DataFrame, cols: Mapping[str, int | None]) -> DataFrame:
    """Null becomes the exact median; a digit count rounds the filled value."""
    medians = quantile_values(df, list(cols), {"median": 0.5})
    filled = {}
    for c, digits in cols.items():
        middle = F.lit(medians[f"{c}_median"])
        filled[c] = F.coalesce(F.col(c), middle if digits is None else F.round(middle, digits))
    return df.withColumns(filled)


def impute_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(values))


def impute_when(df: DataFrame, col: str, condition: Column, value: object) -> DataFrame:
    """Null becomes `value` only where the condition holds."""
    fill = F.col(col).isNull() & condition
    return df.withColumn(col, F.when(fill, F.lit(value)).otherwise(F.col(col)))


def clip_percentiles(
    df: DataFrame, col: str, low: float = 0.01, high: float = 0.99, out: str | None = None
) -> DataFrame:
    """Pull values beyond the two quantiles back to them."""
    q = quantile_values(df, [col], {"low": low, "high": high})
    return df.withColumn(out or f"{col}_clean", clamp(col, F.lit(q[f"{col}_low"]), F.lit(q[f"{col}_high"])))


def clip_report(df: DataFrame, col: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """One row: the two bounds, how many values lie outside, how many rows there are."""
    q = quantile_values(df, [col], {"low": low, "high": high})
    at, to = F.lit(q[f"{col}_low"]), F.lit(q[f"{col}_high"])
    return df.agg(
        F.count_if((F.col(col) < at) | (F.col(col) > to)).alias("outside"), F.count(F.lit(1)).alias("n_rows")
    ).select(at.alias("low"), to.alias("high"), "outside", "n_rows")


def iqr_outliers(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """(column, q1, q3, low, high, outliers) with fences k interquartile ranges away."""
    found = quantile_values(df, cols, {"q1": 0.25, "q3": 0.75})
    fences = {}
    for c in cols:
        q1, q3 = found[f"{c}_q1"], found[f"{c}_q3"]
        if q1 is not None:
            fences[c] = (q1, q3, q1 - k * (q3 - q1), q3 + k * (q3 - q1))

    def beyond(c: str, low: float, high: float) -> Column:
        value = F.col(c).cast("double")
        return F.count_if(~F.isnan(value) & ((value < low) | (value > high))).alias(c)

    if not fences:
        schema = "column string, q1 double, q3 double, low double, high double, outliers bigint"
        return df.sparkSession.createDataFrame([], schema)
    row = df.agg(*[beyond(c, low, high) for c, (_, _, low, high) in fences.items()])
    names = ("q1", "q3", "low", "high")
    entries = [
        F.struct(
            F.lit(c).alias("column"), *[F.lit(v).alias(n) for n, v in zip(names, limits)], F.col(c).alias("outliers")
        )
        for c, limits in fences.items()
    ]
    return unpivot_row(row, entries)


def duplicate_count(df: DataFrame) -> DataFrame:
    """One row: rows beyond the first of each set of equal rows."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))
    return groups.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


def null_report(df: DataFrame) -> DataFrame:
    """(column, nulls, percent) with the emptiest columns first."""
    total = F.count(F.lit(1)).alias("__rows")
    counts = df.agg(total, *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    report = unpivot_row(
        counts,
        [
            F.struct(
                F.lit(c).alias("column"),
                (F.col("__rows") - F.col(f"`{c}`")).alias("nulls"),
                F.try_divide((F.col("__rows") - F.col(f"`{c}`")) * 100.0, F.col("__rows")).alias("percent"),
            )
            for c in df.columns
        ],
    )
    return report.orderBy(F.desc("nulls"), "column")


def cardinality_report(df: DataFrame, approx: bool = False) -> DataFrame:
    """(column, n_distinct), largest first. `approx` trades a shuffle for a 5 % sketch."""
    if approx:
        counts = df.agg(*[F.approx_count_distinct(F.col(f"`{c}`")).alias(c) for c in df.columns])
        report = unpivot_row(
            counts,
            [
                F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("n_distinct"))
                for c in df.columns
            ],
        )
    else:
        cells = F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
                for c in df.columns
            ]
        )
        distinct = df.select(F.explode(cells).alias("cell")).select("cell.*").distinct()
        report = distinct.groupBy("column").agg(F.count("value").alias("n_distinct"))
    return report.orderBy(F.desc("n_distinct"), "column")
