"""Running totals over a globally ordered column, without a one-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def order_cuts(df: DataFrame, order: str) -> list[float]:
    """Approximate equal-share cut points of a column, read to the driver (two per shuffle partition).

    They only spread the work; results do not depend on where they fall.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = max(2 * partitions, 16)
    marks = [i / slices for i in range(1, slices)]
    cuts = df.agg(F.percentile_approx(order, marks, 4 * slices).alias("cuts")).first()["cuts"]
    return sorted(set(cuts or []))


def slice_of(value: Column, table: Column, slices: int) -> Column:
    """Number of the sorted cut points in `table`, `slices` at most, at or below the value, by binary search."""
    if not slices:
        return F.lit(0)
    step, steps = 1, []
    while step <= slices:
        steps.insert(0, step)
        step *= 2
    return F.aggregate(
        F.lit(steps),
        F.lit(0),
        lambda found, jump: F.when(F.get(table, found + jump - 1) <= value, found + jump).otherwise(found),
    )


def running_totals_by(counts: DataFrame, by: str, order: str, cols: Sequence[str]) -> DataFrame:
    """`running_totals` within each of a few groups, all in one job.

    Every group has its own cut points, so each slice of each group is about as large as
    the others of its group. Groups are few (models, folds): one row of cut points each is broadcast.
    """
    partitions = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = max(2 * partitions, 16)
    marks = [i / slices for i in range(1, slices)]
    cuts = counts.groupBy(by).agg(F.percentile_approx(order, marks, 4 * slices).alias("__cuts"))
    at = slice_of(F.col(order), F.col("__cuts"), slices - 1)
    sliced = counts.join(F.broadcast(cuts), by).withColumn("__slice", at).drop("__cuts")
    within = Window.partitionBy(by, "__slice").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = sliced.withColumns({f"__{c}": F.sum(c).over(within) for c in cols})
    slices_of = sliced.groupBy(by, "__slice").agg(*[F.sum(c).alias(f"__{c}_slice") for c in cols])
    before = Window.partitionBy(by).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(by)
    offsets = slices_of.select(
        by, "__slice",
        *[F.coalesce(F.sum(f"__{c}_slice").over(before), F.lit(0)).alias(f"__{c}_before") for c in cols],
        *[F.sum(f"__{c}_slice").over(whole).alias(f"{c}_all") for c in cols],
    )
    joined = local.join(F.broadcast(offsets), [by, "__slice"])
    totals = {f"{c}_upto": F.col(f"__{c}") + F.col(f"__{c}_before") for c in cols}
    return joined.select(*counts.columns, *[v.alias(k) for k, v in totals.items()], *[f"{c}_all" for c in cols])


def running_totals(counts: DataFrame, order: str, cols: Sequence[str], cuts: Sequence[float]) -> DataFrame:
    """Add `<col>_upto` (rows up to and including this value) and `<col>_all` for each column.

    `counts` holds one row per distinct value of `order`. Values are cut into ordered
    slices; each slice is summed on its own, and the totals of the earlier slices (two
    per shuffle partition) are added from a broadcast table.
    """
    sliced = counts.withColumn("__slice", slice_of(F.col(order), F.lit(list(cuts)), len(cuts)))
    within = Window.partitionBy("__slice").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = sliced.withColumns({f"__{c}": F.sum(c).over(within) for c in cols})

    slices = sliced.groupBy("__slice").agg(*[F.sum(c).alias(f"__{c}_slice") for c in cols])
    every = Window.partitionBy(F.lit(0)).orderBy("__slice")
    before = every.rowsBetween(Window.unboundedPreceding, -1)
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = slices.select(
        "__slice",
        *[F.coalesce(F.sum(f"__{c}_slice").over(before), F.lit(0)).alias(f"__{c}_before") for c in cols],
        *[F.sum(f"__{c}_slice").over(whole).alias(f"{c}_all") for c in cols],
    )
    joined = local.join(F.broadcast(offsets), "__slice")
    totals = {f"{c}_upto": F.col(f"__{c}") + F.col(f"__{c}_before") for c in cols}
    return joined.select(*counts.columns, *[v.alias(k) for k, v in totals.items()], *[f"{c}_all" for c in cols])
