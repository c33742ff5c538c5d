"""Pearson correlation from moments gathered in one pass."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.blocks import block_sum
from millrace.operators.sizing import unpivot_row

#: Up to so many pairs are columns of one aggregate; more are summed as blocks, as a plan grows with its columns.
NARROW = 60
#: Rows looked at for a value near the middle of each column, which is taken off before squares are added up.
LOOKED_AT = 1_000


def pair_correlations(df: DataFrame, left: Sequence[str], right: Sequence[str]) -> pa.Array:
    """Correlation of every left with every right column, row by row; null where there is none.

    Each task multiplies its rows as matrices: values, their squares and the masks of what
    is present give all sums of all pairs, each over the rows where both are there. Blocks of
    the tasks meet by position. A pair of which a column does not vary has none; one with a
    NaN among its rows has NaN.
    """
    names = list(dict.fromkeys([*left, *right]))
    at_left, at_right = [names.index(c) for c in left], [names.index(c) for c in right]
    typed = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    head = typed.limit(LOOKED_AT).toArrow()
    middles = []
    for column in head.columns:
        seen = np.sort(column.drop_null().to_numpy())
        seen = seen[np.isfinite(seen)]
        middles.append(seen[len(seen) // 2] if len(seen) else 0.0)
    middle, shape = np.array(middles), (8, len(left), len(right))

    def block(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(shape)
        for batch in batches:
            present = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            x = np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns])
            lost = np.isnan(x).astype(float)
            x = np.where(present * (1 - lost) > 0, x - middle, 0.0)
            a, b, va, vb = x[:, at_left], x[:, at_right], present[:, at_left], present[:, at_right]
            total[0] += va.T @ vb
            total[1] += a.T @ vb
            total[2] += va.T @ b
            total[3] += (a * a).T @ vb
            total[4] += va.T @ (b * b)
            total[5] += a.T @ b
            if lost.any():
                total[6] += lost[:, at_left].T @ vb
                total[7] += va.T @ lost[:, at_right]
        return total.ravel()

    n, sa, sb, saa, sbb, sab, lost_a, lost_b = block_sum(typed, block, int(np.prod(shape))).reshape(shape)
    with np.errstate(invalid="ignore", divide="ignore"):
        va, vb = saa - sa * sa / n, sbb - sb * sb / n
        r = (sab - sa * sb / n) / np.sqrt(va * vb)
    # Below the digits of the sums there is no variation.
    none = (lost_a == 0) & ~(va > 1e-13 * saa) | (lost_b == 0) & ~(vb > 1e-13 * sbb)
    return pa.array(np.where(lost_a + lost_b > 0, np.nan, r).ravel(), mask=none.ravel())


def _pearson(x: Column, y: Column) -> Column:
    """Correlation of the rows where both are present; null when either does not vary."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    # Merged moments of equal values may differ from zero in the last digit; their limits do not.
    varies = (F.min(a) < F.max(a)) & (F.min(b) < F.max(b))
    spread = F.stddev_pop(a) * F.stddev_pop(b)
    return F.when(varies & (spread > 0), F.covar_pop(a, b) / spread)


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(a, b, r) for every ordered pair of columns, the diagonal included."""
    pairs = list(combinations_with_replacement(cols, 2))
    if len(pairs) > NARROW:
        r = pair_correlations(df, cols, cols)
        names = np.array(list(cols), dtype=object)
        table = pa.table({"a": pa.array(np.repeat(names, len(names))), "b": pa.array(np.tile(names, len(names))), "r": r})
        return df.sparkSession.createDataFrame(table, "a string, b string, r double")
    typed = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    row = typed.agg(
        *[_pearson(F.col(a), F.col(b)).alias(f"r{i}") for i, (a, b) in enumerate(pairs)]
    )
    entries = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            entries.append(F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"r{i}").alias("r")))
    return unpivot_row(row, entries)


def correlation_with(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """(column, r) with the target, strongest first."""
    if len(cols) > NARROW:
        table = pa.table({"column": list(cols), "r": pair_correlations(df, [target], cols)})
        out = df.sparkSession.createDataFrame(table, "column string, r double")
        return out.orderBy(F.desc_nulls_last(F.abs("r")), "column")
    typed = df.select(F.col(target).cast("double").alias("__y"), *[F.col(c).cast("double").alias(c) for c in cols])
    row = typed.agg(*[_pearson(F.col("__y"), F.col(c)).alias(c) for c in cols])
    out = unpivot_row(row, [F.struct(F.lit(c).alias("column"), F.col(c).alias("r")) for c in cols])
    return out.orderBy(F.desc_nulls_last(F.abs("r")), "column")


def select_by_correlation(
    df: DataFrame, target: str, cols: Sequence[str], threshold: float = 0.2
) -> list[str]:
    """Names of the columns whose |r| with the target is above the threshold, strongest first."""
    strong = correlation_with(df, target, cols).filter(F.abs("r") > threshold)
    return [row["column"] for row in strong.collect()]  # at most len(cols) rows
