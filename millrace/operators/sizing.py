"""Joins with a side whose size is checked before it is broadcast."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 50_000


def local_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> pa.Table | None:
    """The rows of `df` when there are at most `max_rows`, else None.

    At most max_rows + 1 narrow rows ever reach the driver.
    """
    head = df.limit(max_rows + 1).toArrow()
    return head if head.num_rows <= max_rows else None


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` marked for broadcast when it has at most `max_rows` rows, else `df` as it is.

    The small case becomes a local relation, so `df` is computed once and every later
    use sees the same rows. The large case stays distributed and joins by shuffle,
    where adaptive execution splits skewed keys.
    """
    head = local_if_small(df, max_rows)
    return df if head is None else F.broadcast(df.sparkSession.createDataFrame(head, schema=df.schema))


def unpivot_row(row: DataFrame, entries: list) -> DataFrame:
    """Turn a one-row frame into one row per entry; each entry is a struct column."""
    return row.select(F.explode(F.array(*entries)).alias("entry")).select("entry.*")
