"""Monthly series: regular calendar, interpolation, decomposition, autocorrelation, alerts.

A series is a long frame (key, month, value) with one row per key and month, so the
windows below see a few rows per year however large the raw table is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def monthly_series(df: DataFrame, key: str, date: str, total: Column | str) -> DataFrame:
    """(key, month, value): monthly totals labelled by month end.

    `total` is a column to add up, or an aggregate such as `money_sum(col)`, whose decimal
    sum does not depend on the order of the rows but keeps two decimals only. Months
    without records between the first and the last of a key get 0.
    """
    measure = F.sum(F.col(total).cast("double")) if isinstance(total, str) else total.cast("double")
    totals = (
        df.withColumn("start", F.trunc(date, "month"))
        .dropna(subset=[key, "start"])
        .groupBy(key, "start")
        .agg(F.coalesce(measure, F.lit(0.0)).alias("total"))
    )
    following = F.lead("start").over(Window.partitionBy(key).orderBy("start"))
    # each month also writes the empty months up to the next one
    until = F.coalesce(F.add_months(following, -1), F.col("start"))
    months = totals.withColumn("until", until).select(
        key, "start", "total", F.explode(F.expr("sequence(start, until, interval 1 month)")).alias("at")
    )
    value = F.when(F.col("at") == F.col("start"), F.col("total")).otherwise(0.0)
    return months.select(key, F.last_day("at").alias("month"), value.alias("value"))


def align_and_interpolate(series: DataFrame, key: str) -> DataFrame:
    """Every key on the common calendar; inner gaps on a straight line, the end carried
    forward, the start left empty."""
    span = series.agg(
        F.struct(F.trunc(F.min("month"), "month").alias("lo"), F.trunc(F.max("month"), "month").alias("hi")).alias("s")
    ).scalar()
    calendar = series.select(key).distinct().select(
        key,
        F.posexplode(F.sequence(span["lo"], span["hi"], F.expr("interval 1 month"))).alias("i", "start"),
    )
    grid = calendar.select(key, "i", F.last_day("start").alias("month")).join(series, [key, "month"], "left")

    at = F.when(F.col("value").isNotNull(), F.col("i"))
    back = Window.partitionBy(key).orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(key).orderBy("i").rowsBetween(0, Window.unboundedFollowing)
    known = grid.select(
        key,
        "month",
        "i",
        F.last("value", True).over(back).alias("v0"),
        F.last(at, True).over(back).alias("i0"),
        F.first("value", True).over(ahead).alias("v1"),
        F.first(at, True).over(ahead).alias("i1"),
    )
    slope = (F.col("v1") - F.col("v0")) / (F.col("i1") - F.col("i0"))
    value = (
        F.when(F.col("i1").isNull() | (F.col("i1") == F.col("i0")), F.col("v0"))
        .when(F.col("i0").isNotNull(), F.col("v0") + slope * (F.col("i") - F.col("i0")))
    )
    return known.select(key, "month", value.alias("value"))


def seasonal_decompose(series: DataFrame, key: str, period: int = 12, model: str = "multiplicative") -> DataFrame:
    """(key, month, value, phase, trend, seasonal, resid) by the classical centred filter.

    Series shorter than two periods have no estimate and come back without factors.
    """
    if model not in ("multiplicative", "additive"):
        raise ValueError("model is 'multiplicative' or 'additive'")
    ratio = model == "multiplicative"
    half = period // 2
    order = Window.partitionBy(key).orderBy("month")
    frame = order.rowsBetween(-half, half)
    total = F.sum("value").over(frame)
    if period % 2 == 0:
        total = total - (F.lag("value", half).over(order) + F.lead("value", half).over(order)) / 2
    full = F.count("value").over(frame) == 2 * half + 1
    base = series.filter(F.col("value").isNotNull()).select(
        key,
        "month",
        "value",
        ((F.row_number().over(order) - 1) % period).alias("phase"),
        F.when(full, total / period).alias("trend"),
    )

    def off(a: Column, b: Column) -> Column:
        return F.try_divide(a, b) if ratio else a - b

    raw = base.groupBy(key, "phase").agg(F.avg(off(F.col("value"), F.col("trend"))).alias("raw"))
    centre = F.avg("raw").over(Window.partitionBy(key))
    factors = raw.select(key, "phase", off(F.col("raw"), centre).alias("seasonal"))
    joined = base.join(factors, [key, "phase"])
    fitted = F.col("trend") * F.col("seasonal") if ratio else F.col("trend") + F.col("seasonal")
    return joined.select(
        key, "month", "value", "phase", "trend", "seasonal", off(F.col("value"), fitted).alias("resid")
    )


def strongest_month(decomposed: DataFrame, key: str) -> DataFrame:
    """(key, month, seasonal): first month that carries the largest seasonal factor."""
    best = F.max_by(F.struct("month", "seasonal"), F.struct("seasonal", -F.unix_date("month")))
    return decomposed.groupBy(key).agg(best.alias("best")).select(key, "best.*")


def acf(series: DataFrame, key: str, nlags: int = 15) -> DataFrame:
    """(key, lag, r, band): biased autocorrelation and its widening 95 % band."""
    order = Window.partitionBy(key).orderBy("month")
    centred = series.filter(F.col("value").isNotNull()).withColumn(
        "x", F.col("value") - F.avg("value").over(Window.partitionBy(key))
    )
    lagged = centred.select(key, "x", *[F.lag("x", k).over(order).alias(f"x{k}") for k in range(1, nlags + 1)])
    sums = lagged.groupBy(key).agg(
        F.count("x").alias("n"),
        F.sum(F.col("x") * F.col("x")).alias("s0"),
        *[F.sum(F.col("x") * F.col(f"x{k}")).alias(f"s{k}") for k in range(1, nlags + 1)],
    )
    entries = F.array(
        *[
            F.struct(F.lit(k).alias("lag"), F.try_divide(F.col(f"s{k}"), F.col("s0")).alias("r"))
            for k in range(nlags + 1)
        ]
    )
    rows = sums.select(key, "n", F.explode(entries).alias("e")).select(key, "n", "e.*").filter("r is not null")
    earlier = Window.partitionBy(key).orderBy("lag").rowsBetween(Window.unboundedPreceding, -1)
    squares = F.sum(F.when(F.col("lag") > 0, F.col("r") * F.col("r"))).over(earlier)
    band = F.when(F.col("lag") == 0, 0.0).otherwise(1.96 * F.sqrt((1 + 2 * F.coalesce(squares, F.lit(0.0))) / F.col("n")))
    return rows.select(key, "lag", "r", band.alias("band"), "n")


def pacf(series: DataFrame, key: str, nlags: int = 15) -> DataFrame:
    """(key, lag, r, band): Yule-Walker partial autocorrelation from the autocorrelations."""
    import pandas as pd

    def partial(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("lag")
        r = rows["r"].to_numpy()
        out, phi = [1.0], []
        for k in range(1, len(r)):
            error = 1.0 - sum(f * r[j + 1] for j, f in enumerate(phi))
            last = (r[k] - sum(f * r[k - 1 - j] for j, f in enumerate(phi))) / error
            phi = [f - last * g for f, g in zip(phi, reversed(phi))] + [last]
            out.append(last)
        band = [0.0] + [1.96 / float(rows["n"].iloc[0]) ** 0.5] * (len(out) - 1)
        return pd.DataFrame({key: rows[key].to_numpy(), "lag": rows["lag"].to_numpy(), "r": out, "band": band})

    correlations = acf(series, key, nlags)  # nlags + 1 rows per key
    kind = dict(correlations.dtypes)[key]
    return correlations.groupBy(key).applyInPandas(partial, f"`{key}` {kind}, lag int, r double, band double")


def below_lower_bound(actual: DataFrame, forecast: DataFrame, key: str, k: int) -> DataFrame:
    """Months in a run of at least k consecutive periods with the actual value under the lower limit.

    `actual` is (key, month, value), `forecast` is (key, month, lower).
    """
    joined = actual.join(forecast.select(key, "month", "lower"), [key, "month"])
    order = Window.partitionBy(key).orderBy("month")
    marked = joined.withColumns(
        {"below": F.col("value") < F.col("lower"), "i": F.row_number().over(order)}
    ).filter("below")
    # consecutive rows share the difference between the two numberings
    island = F.col("i") - F.row_number().over(order)
    runs = marked.withColumn("island", island).withColumn(
        "run", F.count(F.lit(1)).over(Window.partitionBy(key, "island"))
    )
    return runs.filter(F.col("run") >= k).select(key, "month", "value", "lower", "run")
