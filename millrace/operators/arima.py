"""Stationarity, order search, back-test and forecast of many monthly series.

Each series is packed into one short array (one number per period). The order grid is
exploded in Spark, so every (series, order) fit is an independent piece of work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import arma
from millrace.functions.numeric import MAPE_BANDS, grade
from millrace.functions.special import unit_root_p

#: Periods that one series may have, if there is to be a limit. Fits cost time in proportion.
MAX_PERIODS: int | None = None


def pack(series: DataFrame, key: str, max_periods: int | None = None) -> DataFrame:
    """(key, months, ys): one row per series in month order.

    Periods without a value between known ones stay as NaN, which the likelihood skips; those
    before the first and after the last are left out, and a series without a known value has
    no row. A count before anything is gathered refuses frames that hold a period twice, so
    what is gathered is bounded by the calendar and not by the raw table.
    """
    present = series.filter(F.col("value").isNotNull())
    counted = series.groupBy(key, "month").count().groupBy(key).agg(F.count("count").alias("n"), F.max("count").alias("most"))
    row = counted.filter(F.col(key).isNotNull()).agg(F.max("n").alias("n"), F.max("most").alias("most")).first()
    limit = MAX_PERIODS if max_periods is None else max_periods
    if limit is not None and (row["n"] or 0) > limit:
        raise ValueError(f"more than {limit} periods in a series: {row['n']}")
    if (row["most"] or 0) > 1:
        raise ValueError("more than one row for a period of a series; aggregate to periods first")
    spans = present.groupBy(key).agg(F.min("month").alias("__first"), F.max("month").alias("__last"))
    inside = series.join(spans, key).filter(F.col("month").between(F.col("__first"), F.col("__last")))
    value = F.coalesce(F.col("value").cast("double"), F.lit(float("nan"))).alias("value")
    sized = inside.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col("month"), value))).alias("s"))
    return sized.select(key, F.col("s.month").alias("months"), F.col("s.value").alias("ys"))


def _spread(rows: DataFrame, *cols: str) -> DataFrame:
    """One fit is small in bytes and long in time: keep the tasks apart instead of merging them by size."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cols)


def _map(rows: DataFrame, fn, added: str) -> DataFrame:
    """Apply `fn(row) -> list of dicts` to every row of a packed frame, keeping the key column."""
    key = rows.columns[0]
    kind = dict(rows.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [{key: row[key], **found} for row in batch.to_dict("records") for found in fn(row)]
            if out:
                yield pd.DataFrame(out)

    return rows.mapInPandas(run, f"`{key}` {kind}, {added}")


def _every_key(series: DataFrame, key: str, found: DataFrame) -> DataFrame:
    """`found` with a row for each key of `series`, also one without a known value."""
    keys = series.select(key).filter(F.col(key).isNotNull()).distinct()
    reason = F.when(F.col("__found").isNull(), "no value").otherwise(F.col("reason"))
    return keys.join(found.withColumn("__found", F.lit(1)), key, "left").withColumn("reason", reason).drop("__found")


def adf_test(series: DataFrame, key: str, alpha: float = 0.05, max_lags: int | None = None) -> DataFrame:
    """(key, statistic, lags, p, stationary, d, reason): unit-root test, one row per key of `series`.

    Where the test has no result all its columns are null and `reason` tells why.
    """

    def test(row: dict) -> list[dict]:
        try:
            tau, lags, _ = arma.unit_root(np.asarray(row["ys"]), max_lags)
        except np.linalg.LinAlgError as problem:
            empty = dict.fromkeys(("statistic", "lags", "p", "stationary", "d"))
            return [{**empty, "reason": str(problem)}]
        p = unit_root_p(tau)
        found = {"statistic": tau, "lags": lags, "p": p, "stationary": p < alpha, "d": 0 if p < alpha else 1}
        return [{**found, "reason": None}]

    packed = _spread(pack(series, key), key)
    tested = _map(packed, test, "statistic double, lags int, p double, stationary boolean, d int, reason string")
    return _every_key(series, key, tested)


def arima_grid(series: DataFrame, key: str, max_p: int = 2, max_q: int = 2, d: int | None = None) -> DataFrame:
    """(key, p, d, q, aic, reason) for every series and order.

    Without `d` each series takes 0 or 1 from its unit-root test. An order that cannot be
    fitted has a null aic and a reason.
    """

    def fit(row: dict) -> list[dict]:
        values = np.asarray(row["ys"])
        level, aic, reason = d, None, None
        try:
            if level is None:
                level = 0 if unit_root_p(arma.unit_root(values)[0]) < 0.05 else 1
            aic = float(arma.fit(values, row["p"], level, row["q"])["aic"])
            if not np.isfinite(aic):
                aic, reason = None, "no finite likelihood"
        except np.linalg.LinAlgError as problem:
            reason = str(problem)
        return [{"p": row["p"], "d": level, "q": row["q"], "aic": aic, "reason": reason}]

    orders = F.array(
        *[F.struct(F.lit(p).alias("p"), F.lit(q).alias("q")) for p in range(max_p + 1) for q in range(max_q + 1)]
    )
    grid = pack(series, key).select(key, "ys", F.explode(orders).alias("o")).select(key, "ys", "o.p", "o.q")
    return _map(_spread(grid, key, "p", "q"), fit, "p int, d int, q int, aic double, reason string")


def best_order(grid: DataFrame, key: str) -> DataFrame:
    """(key, p, d, q, aic, reason) with the lowest AIC; the smaller order on ties.

    A series of which no order could be fitted has null orders and a reason.
    """
    fitted = F.when(F.col("aic").isNotNull(), F.struct("aic", "p", "q"))
    best = F.min_by(F.struct("p", "d", "q", "aic"), fitted)
    out = grid.groupBy(key).agg(best.alias("best"), F.max("reason").alias("why"))
    return out.select(key, "best.*", F.when(F.col("best").isNull(), F.col("why")).alias("reason"))


def arima_forecast(series: DataFrame, key: str, orders: DataFrame, h: int = 6) -> DataFrame:
    """(key, step, month, mean, lower, upper, reason): h months ahead with 95 % limits.

    `orders` is (key, p, d, q). A series without an order, or whose order cannot be
    fitted, has null forecasts and a reason.
    """

    def ahead(row: dict) -> list[dict]:
        values = np.asarray(row["ys"])
        out = [
            {"step": i + 1, "last": row["last"], "mean": None, "lower": None, "upper": None, "reason": None}
            for i in range(h)
        ]
        reason = "no order" if pd.isna(row["p"]) else None
        if reason is None:
            p, d, q = int(row["p"]), int(row["d"]), int(row["q"])
            try:
                mean, error = arma.forecast(values, d, arma.fit(values, p, d, q), h)
            except np.linalg.LinAlgError as problem:
                reason = str(problem)
        for i, step in enumerate(out):
            if reason is None:
                margin = 1.959963984540054 * float(error[i])
                step.update(mean=float(mean[i]), lower=float(mean[i]) - margin, upper=float(mean[i]) + margin)
            step["reason"] = reason
        return out

    packed = pack(series, key).select(key, "ys", F.array_max("months").alias("last"))
    work = _spread(packed.join(orders.select(key, "p", "d", "q"), key, "left"), key)
    out = _map(work, ahead, "step int, last date, mean double, lower double, upper double, reason string")
    month = F.last_day(F.add_months("last", F.col("step"))).alias("month")
    return out.select(key, "step", month, "mean", "lower", "upper", "reason")


def split_last(series: DataFrame, key: str, h: int) -> tuple[DataFrame, DataFrame]:
    """Series without their last h known periods, and those periods. Empty periods before them stay."""
    known = F.col("value").isNotNull()
    newest = Window.partitionBy(key).orderBy(F.desc("month")).rowsBetween(Window.unboundedPreceding, 0)
    marked = series.withColumn("__back", F.sum(known.cast("int")).over(newest))
    return marked.filter(F.col("__back") > h).drop("__back"), marked.filter((F.col("__back") <= h) & known).drop("__back")


def arima_backtest(series: DataFrame, key: str, orders: DataFrame, h: int = 6) -> DataFrame:
    """(key, mape, rmse, grade, reason) of forecasting the last h known periods from the earlier ones.

    The i-th held-out period is compared with the i-th step ahead, so empty months
    between known ones shift neither side. A series without a forecast has nulls and a reason.
    """
    train, test = split_last(series, key, h)
    predicted = arima_forecast(train, key, orders, h).select(key, "step", "mean", "reason")
    step = F.row_number().over(Window.partitionBy(key).orderBy("month"))
    pairs = test.withColumn("step", step).join(predicted, [key, "step"], "left")
    error = F.col("value") - F.col("mean")
    scores = pairs.groupBy(key).agg(
        (F.avg(F.abs(F.try_divide(error, F.col("value")))) * 100.0).alias("mape"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.max("reason").alias("reason"),
    )
    return scores.withColumn("grade", grade("mape", MAPE_BANDS, "low", rising=False))


def series_summary(series: DataFrame, key: str, max_p: int = 2, max_q: int = 2, d: int | None = None) -> DataFrame:
    """(key, p_value, stationary, p, d, q, aic, mean_monthly, reason): one row per key of `series`."""
    tests = adf_test(series, key).select(key, F.round("p", 4).alias("p_value"), "stationary")
    means = series.groupBy(key).agg(F.round(F.avg("value"), 2).alias("mean_monthly"))
    orders = best_order(arima_grid(series, key, max_p, max_q, d), key).withColumn("aic", F.round("aic", 2))
    known = means.join(tests, key, "left").join(orders, key, "left")
    return known.select(key, "p_value", "stationary", "p", "d", "q", "aic", "mean_monthly", "reason")
