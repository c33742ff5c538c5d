"""Aggregates, profiles and distribution tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.numeric import as_flag
from millrace.operators.quantiles import long_values, quantile_values, quantiles_wide
from millrace.operators.sizing import broadcast_if_small, unpivot_row


def _rows() -> Column:
    return F.count(F.lit(1))


def drop_null_keys(df: DataFrame, keys: Sequence[str], null_group: str = "drop") -> DataFrame:
    """Rows whose keys are all present ('drop') or every row ('keep')."""
    if null_group not in ("drop", "keep"):
        raise ValueError("null_group is 'drop' or 'keep'")
    return df.dropna(subset=list(keys)) if null_group == "drop" and keys else df


def describe(df: DataFrame, cols: Sequence[str], quartiles: bool = True) -> DataFrame:
    """(column, count, mean, std, min[, q1, median, q3], max) per column."""
    shown = {}
    for c in cols:
        value = F.col(c).cast("double")
        shown[c] = F.when(~F.isnan(value), value)
    # one aggregate over all columns; the quartiles enter as numbers
    cuts = quantile_values(df, cols, {"q1": 0.25, "median": 0.5, "q3": 0.75}) if quartiles else {}
    row = df.agg(
        *[
            f(value).alias(f"{name}|{c}")
            for c, value in shown.items()
            for name, f in (("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))
        ]
    )
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            *[F.col(f"{name}|{c}").alias(name) for name in ("count", "mean", "std", "min")],
            *[F.lit(cuts[f"{c}_{name}"]).cast("double").alias(name) for name in ("q1", "median", "q3") if quartiles],
            F.col(f"max|{c}").alias("max"),
        )
        for c in cols
    ]
    return unpivot_row(row, entries).filter("count > 0")


def group_agg(
    df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column], null_group: str = "keep"
) -> DataFrame:
    """Several named aggregates per key."""
    source = drop_null_keys(df, keys, null_group)
    return source.groupBy(*keys).agg(*[expr.alias(name) for name, expr in measures.items()])


def group_sum(df: DataFrame, keys: Sequence[str], total: Column, name: str = "total") -> DataFrame:
    """Total per key, largest first."""
    return group_agg(df, keys, {name: total}).orderBy(F.desc(name), *keys)


def group_count(df: DataFrame, keys: Sequence[str], null_group: str = "drop") -> DataFrame:
    """Rows per key, most frequent first."""
    return group_agg(df, keys, {"n": _rows()}, null_group).orderBy(F.desc("n"), *keys)


def frequency_share(df: DataFrame, col: str) -> DataFrame:
    """(value, n, percent) of the non-null total."""
    counts = group_agg(df, [col], {"n": _rows()}, "drop")
    total = df.agg(F.count(col)).scalar()
    return counts.withColumn("percent", F.col("n") * 100.0 / total).orderBy(F.desc("n"), col)


def daily_count(df: DataFrame, ts: str) -> DataFrame:
    return group_agg(df.select(F.col(ts).cast("date").alias("day")), ["day"], {"n": _rows()}, "drop")


def daily_sum(df: DataFrame, ts: str, total: Column, name: str = "total") -> DataFrame:
    """Total per day in date order."""
    dated = df.withColumn("day", F.col(ts).cast("date"))
    return group_agg(dated, ["day"], {name: total}, "drop").orderBy("day")


def count_by(df: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    """Rows per composite key. Records with an empty part are skipped.

    Copies of a key merge in every map task, so a key that holds a large share of
    the rows sends one record per task through the shuffle.
    """
    keyed = df.select(*[expr.alias(name) for name, expr in keys.items()])
    for name, kind in keyed.dtypes:
        if kind == "string":
            keyed = keyed.filter(F.col(name) != "")
    return group_agg(keyed, list(keys), {"n": _rows()}, "drop")


def group_stats(df: DataFrame, key: str, col: str, digits: int = 2) -> DataFrame:
    """(key, mean, median, std, n) per group, rounded."""
    present = drop_null_keys(df, [key])
    moments = group_agg(
        present, [key], {"mean": F.avg(col), "std": F.stddev_samp(col), "n": F.count(col)}
    )
    medians = quantiles_wide(present, [col], {"median": 0.5}, [key]).drop("column")
    out = moments.join(medians, key, "left")
    return out.withColumns({c: F.round(c, digits) for c in ("mean", "median", "std")})


def group_median(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """(key, column, median) per group and column."""
    return quantiles_wide(df, cols, {"median": 0.5}, [key])


def group_rate(df: DataFrame, key: str, condition: Column, null_group: str = "drop") -> DataFrame:
    """(key, rate, n): percent of rows that meet the condition, highest first."""
    flagged = df.select(key, as_flag(condition).alias("hit"))
    rates = group_agg(flagged, [key], {"rate": F.avg("hit") * 100.0, "n": _rows()}, null_group)
    return rates.orderBy(F.desc("rate"), key)


def target_profile(df: DataFrame, col: str) -> DataFrame:
    """One row: mean, median, sample std and bias-corrected skewness."""
    n = F.count(col).cast("double")
    correction = F.try_divide(F.sqrt(n * (n - 1)), n - 2)
    moments = df.agg(
        F.avg(col).alias("mean"),
        F.stddev_samp(col).alias("std"),
        F.when(F.stddev_pop(col) > 0, F.skewness(col) * correction).alias("skew"),
    )
    median = quantile_values(df, [col], {"median": 0.5})[f"{col}_median"]
    return moments.withColumn("median", F.lit(median))


def segment_compare(df: DataFrame, inside: Column, condition: Column) -> DataFrame:
    """One row: rate of the condition in and out of a segment, segment size and share."""
    flags = df.select(as_flag(inside).alias("seg"), as_flag(condition).alias("hit"))
    seg, rest = F.col("seg") == 1, F.col("seg") == 0
    return flags.agg(
        (F.avg(F.when(seg, F.col("hit"))) * 100.0).alias("rate_inside"),
        (F.avg(F.when(rest, F.col("hit"))) * 100.0).alias("rate_outside"),
        F.count_if(seg).alias("size"),
        (F.avg("seg") * 100.0).alias("share"),
    )


def conditional_totals(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """(flag, total, percent) for every 0/1 column, from one aggregate."""
    sums = df.agg(_rows().alias("__rows"), *[F.sum(c).cast("bigint").alias(c) for c in flags])
    return unpivot_row(
        sums,
        [
            F.struct(
                F.lit(c).alias("flag"),
                F.col(c).alias("total"),
                F.try_divide(F.col(c) * 100.0, F.col("__rows")).alias("percent"),
            )
            for c in flags
        ],
    )


def pivot(df: DataFrame, row: str, col: str, values: Sequence[object], measure: Column) -> DataFrame:
    """Long to wide with the column values given, so no extra pass looks for them."""
    return df.groupBy(row).pivot(col, list(values)).agg(measure)


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, n): counts of two categories in long form."""
    return group_agg(df, [a, b], {"n": _rows()}, "drop")


def date_range(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.min(col).cast("date").alias("first"), F.max(col).cast("date").alias("last"))


def histogram(df: DataFrame, col: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """(by..., bin, low, high, n): equal-width counts over the overall range, last bin closed.

    Only bins that hold rows are listed.
    """
    values = long_values(df, [col], by)
    limits = values.agg(F.min("value").alias("lo"), F.max("value").alias("hi")).first()
    lo, hi = limits["lo"] or 0.0, limits["hi"] or 0.0
    width = (hi - lo) / bins
    position = F.least(F.floor((F.col("value") - lo) / width), F.lit(bins - 1)) if hi > lo else F.lit(0)
    counts = values.groupBy(*by, position.cast("int").alias("bin")).agg(_rows().alias("n"))
    return counts.withColumns({"low": lo + F.col("bin") * width, "high": lo + (F.col("bin") + 1) * width})


def box_stats(df: DataFrame, col: str, by: str, k: float = 1.5) -> DataFrame:
    """(by, q1, median, q3, whisker_low, whisker_high, outliers) per group.

    Whiskers are the furthest values within k interquartile ranges of the box.
    """
    boxes = quantiles_wide(df, [col], {"q1": 0.25, "median": 0.5, "q3": 0.75}, [by]).drop("column")
    spread = k * (F.col("q3") - F.col("q1"))
    joined = long_values(df, [col], [by]).join(broadcast_if_small(boxes), by)
    inside = (F.col("value") >= F.col("q1") - spread) & (F.col("value") <= F.col("q3") + spread)
    return joined.groupBy(by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def overall_mean_by(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    return group_agg(df, keys, {f"avg_{c}": F.avg(c) for c in cols})


def month_sums(daily: DataFrame, day: str, col: str) -> DataFrame:
    """(year, month, total) from a daily table."""
    return daily.groupBy(F.year(day).alias("year"), F.month(day).alias("month")).agg(F.sum(col).alias("total"))


def month_profile(daily: DataFrame, day: str, col: str) -> DataFrame:
    """(month, mean_daily): mean of the daily totals of each calendar month over all years."""
    return daily.groupBy(F.month(day).alias("month")).agg(F.avg(col).alias("mean_daily"))


def distinct_days(df: DataFrame, ts: str) -> DataFrame:
    """One row: number of days with at least one record."""
    return daily_count(df, ts).agg(_rows().alias("days"))
