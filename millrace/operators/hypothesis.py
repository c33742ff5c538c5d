"""Two-sample t test with equal variances, from group moments."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from millrace.functions.special import t_two_sided


@F.pandas_udf(DoubleType())
def t_p_value(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series(t_two_sided(t, dof), index=t.index)


def _moments(df: DataFrame, group: str, col: str) -> DataFrame:
    return (
        df.dropna(subset=[group, col])
        .groupBy(F.col(group).alias("g"))
        .agg(F.count(col).alias("n"), F.avg(col).alias("m"), F.var_samp(col).alias("v"))
    )


def ttest_ind(df: DataFrame, group: str, a: object, b: object, col: str, alpha: float = 0.05) -> DataFrame:
    """One row comparing groups a and b: means, difference, t, degrees, p and verdict.

    Both groups are reduced to (count, mean, variance) in one pass; only that row is
    turned into a p-value.
    """
    m = _moments(df.filter(F.col(group).isin(a, b)), group, col)
    pick = lambda which, field: F.max(F.when(F.col("g") == F.lit(which), F.col(field)))
    sides = m.agg(
        pick(a, "n").alias("n1"), pick(a, "m").alias("mean1"), pick(a, "v").alias("v1"),
        pick(b, "n").alias("n2"), pick(b, "m").alias("mean2"), pick(b, "v").alias("v2"),
    ).withColumns({"group1": F.lit(a), "group2": F.lit(b)})
    return _verdict(sides, alpha)


MAX_GROUPS = 1_000


def ttest_pairs(
    df: DataFrame, group: str, col: str, alpha: float = 0.05, max_groups: int = MAX_GROUPS
) -> DataFrame:
    """The same test for every pair of groups. Pairs are of group summaries, never of rows.

    Refuses more than `max_groups` groups, as the result has a row for every pair.
    """
    summary = F.array_sort(F.collect_list(F.struct("g", "n", "m", "v")))
    known = _moments(df, group, col)
    if known.limit(max_groups + 1).count() > max_groups:
        raise ValueError(f"more than {max_groups} groups to compare in pairs")
    groups = known.agg(summary.alias("all"))
    left = groups.select("all", F.posexplode("all").alias("i", "x"))
    pairs = left.select(
        "x", F.explode(F.slice("all", F.col("i") + 2, F.greatest(F.size("all") - F.col("i") - 1, F.lit(0)))).alias("y")
    )
    sides = pairs.select(
        *[F.col(f"x.{f}").alias(name) for f, name in (("g", "group1"), ("n", "n1"), ("m", "mean1"), ("v", "v1"))],
        *[F.col(f"y.{f}").alias(name) for f, name in (("g", "group2"), ("n", "n2"), ("m", "mean2"), ("v", "v2"))],
    )
    return _verdict(sides, alpha)


def _verdict(sides: DataFrame, alpha: float) -> DataFrame:
    n1, n2, v1, v2 = (F.col(c) for c in ("n1", "n2", "v1", "v2"))
    dof = n1 + n2 - 2
    pooled = F.try_divide((n1 - 1) * v1 + (n2 - 1) * v2, dof)
    error = F.sqrt(pooled * (1.0 / n1 + 1.0 / n2))
    tested = sides.select(
        "group1", "group2", "n1", "n2", "mean1", "mean2",
        (F.col("mean1") - F.col("mean2")).alias("difference"),
        F.try_divide(F.col("mean1") - F.col("mean2"), error).alias("t"),
        dof.alias("dof"),
    )
    return tested.withColumn("p", t_p_value("t", F.col("dof").cast("double"))).withColumn(
        "significant", F.col("p") < alpha
    )
