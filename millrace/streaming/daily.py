"""Day-tumbling counts per group on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


DAY = 86_400  # seconds


def daily_counts_stream(stream: DataFrame, group: str, ts: str, lateness: str | None = None) -> DataFrame:
    """(group, day, n) that keeps counting; every row counts, however late it comes.

    The state holds one number per group and day. With `lateness` the state of a day is
    dropped once the watermark passes it, and rows that are later still are not counted.
    Counts merge in every task before the shuffle, as in the batch form.
    """
    # the wall-clock day as an instant, so days do not shift with the session's time zone
    number = F.unix_date(F.col(ts).cast("date"))
    timed = stream.dropna(subset=[group, ts]).withColumn("__day", F.timestamp_seconds(number * F.lit(DAY)))
    timed = timed.withWatermark("__day", lateness) if lateness else timed
    counts = timed.groupBy("__day", group).agg(F.count(F.lit(1)).alias("n"))
    day = F.date_from_unix_date((F.unix_seconds("__day") / DAY).cast("int"))
    return counts.select(group, day.alias("day"), "n")
