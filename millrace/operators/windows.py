"""Top-n, peaks, moving averages, differences and hold-outs.

Every window is partitioned. Windows over single rows use `row_number() <= n`,
which Spark cuts down in each task before the shuffle; the others run on
aggregated series of one row per period.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows of every group in the given order, with their rank."""
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.filter(F.col("rank") <= n)


def peak_per_group(counts: DataFrame, group: str, day: str, n: str) -> DataFrame:
    """Busiest day of every group (earliest day on ties), busiest group first."""
    best = F.max_by(F.struct(day, n), F.struct(F.col(n), -F.unix_date(day)))
    peaks = counts.groupBy(group).agg(best.alias("best")).select(group, "best.*")
    return peaks.orderBy(F.desc(n), group)


def _frame(n: int, centered: bool) -> tuple[int, int]:
    if not centered:
        return -(n - 1), 0
    return -(n // 2), (n - 1) // 2


def moving_average(
    df: DataFrame, keys: Sequence[str], order: str, col: str, n: int, centered: bool = True, out: str | None = None
) -> DataFrame:
    """Mean over n neighbouring rows, null until the frame is full.

    The frame counts rows, not days, so absent days are skipped. An even n reaches
    one row further back than forward. Use it on series of one row per period.
    """
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(*_frame(n, centered))
    mean = F.when(F.count(col).over(w) == n, F.avg(col).over(w))
    return df.withColumn(out or f"ma{n}", mean)


def difference(df: DataFrame, keys: Sequence[str], order: str, col: str, d: int = 1) -> DataFrame:
    """Lag-d difference of a series; the first d rows of each series are dropped."""
    if d == 0:
        return df.withColumn("diff", F.col(col))
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("diff", F.col(col) - F.lag(col, d).over(w)).filter(F.col("diff").isNotNull())


def holdout_last(df: DataFrame, keys: Sequence[str], order: str, n: int) -> DataFrame:
    """Mark the last n periods of each series as 'test', the rest as 'train'."""
    back = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))
    return df.withColumn("part", F.when(back <= n, "test").otherwise("train"))


def top_k(df: DataFrame, col: Column, k: int, ascending: bool = False, ties: Sequence[str] = ()) -> DataFrame:
    """k largest (or smallest) rows; each task keeps only k candidates."""
    return df.orderBy(col.asc() if ascending else col.desc(), *ties).limit(k)
