"""Alerts on a stream: levels with cuts frozen from history, and runs of periods under a limit."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.anomaly import level_of
from millrace.operators.quantiles import quantile_values


def frozen_cuts(history: DataFrame, score: str, critical: float = 0.10, caution: float = 0.25) -> tuple[float, float]:
    """The two score limits of the past, as numbers."""
    found = quantile_values(history, [score], {"critical": critical, "caution": caution})
    return found[f"{score}_critical"], found[f"{score}_caution"]


def alert_stream(stream: DataFrame, score: str, cuts: tuple[float, float]) -> DataFrame:
    """Rows with their `level`; stateless, so it scales with the source."""
    return stream.withColumn("level", level_of(F.col(score), F.lit(cuts[0]), F.lit(cuts[1])))


def below_bound_stream(stream: DataFrame, key: str) -> DataFrame:
    """(key, month, value, lower, run): how many periods in a row, this one included, lie under the limit.

    `stream` is (key, month, value, lower); months may come in any order and any split into
    batches. The state of a key holds its months, so it is bounded by the calendar. A month is
    written when its run is new or changes, also to 0 when a late month above the limit cuts
    the run: the last row written for a month holds (see `lasting_alerts`). A month that comes
    again replaces what was known of it; of several in one batch the smallest value holds. Rows
    without a key or month are left out; a missing value or limit is not under.
    """
    kind = dict(stream.dtypes)[key]
    out = f"`{key}` {kind}, month date, value double, lower double, run long"
    kept = "months array<date>, values array<double>, lowers array<double>, runs array<bigint>"

    def follow(label: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        known = {}
        if state.exists:
            known = {m: [v, low, run] for m, v, low, run in zip(*state.get)}
        before = {m: tuple(x) for m, x in known.items()}
        news = pd.concat(list(batches)).sort_values(["month", "value"], ascending=[True, False])
        for m, v, low in zip(news["month"], news["value"], news["lower"]):
            known[m] = [None if pd.isna(v) else float(v), None if pd.isna(low) else float(low), 0]
        months, start = sorted(known), 0
        under = [None not in known[m][:2] and known[m][0] < known[m][1] for m in months]
        for i, m in enumerate(months):
            known[m][2] = 0
            if under[i] and (i + 1 == len(months) or not under[i + 1]):
                for run_month in months[start : i + 1]:
                    known[run_month][2] = i + 1 - start
            if not under[i]:
                start = i + 1
        state.update(([*months], *[[known[m][j] for m in months] for j in range(3)]))
        told = [m for m in months if tuple(known[m]) != before.get(m) and (known[m][2] or m in before and before[m][2])]
        if told:
            yield pd.DataFrame({key: [label[0]] * len(told), "month": told, **{c: [known[m][j] for m in told] for j, c in enumerate(("value", "lower", "run"))}})

    rows = stream.select(key, F.col("month").cast("date").alias("month"), F.col("value").cast("double").alias("value"), F.col("lower").cast("double").alias("lower"))
    return rows.dropna(subset=[key, "month"]).groupBy(key).applyInPandasWithState(follow, out, kept, "update", "NoTimeout")


def lasting_alerts(written: DataFrame, key: str, k: int) -> DataFrame:
    """(key, month, value, lower, run) of the months that are in a run of at least k, from all rows the stream has written."""
    last = written.groupBy(key, "month").agg(F.max_by(F.struct("value", "lower", "run"), "batch").alias("last"))
    return last.select(key, "month", "last.*").filter(F.col("run") >= k)
