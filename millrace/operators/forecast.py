"""Additive forecasts of many daily series: a trend with sparse changes, yearly and weekly waves.

Rows of a series are summed once into a Gram matrix; everything after that works on one
small row per series. A series has at most a few rows per calendar day, so the group that is
summed in one task is bounded by the calendar and not by the raw table.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import sparse_trend
from millrace.operators.lineage import materialize

# Changepoints, their share of the history, wave orders, prior scales.
CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8
CHANGEPOINT_SCALE = 0.05
TREND_SCALE = 5.0
WAVE_SCALE = 10.0
YEARLY = (365.25, 10)
WEEKLY = (7.0, 3)
#: Slope changes above this, for a series scaled to 1 over a history of length 1, count as found.
CHANGE_LEVEL = 0.05
#: Futures that are drawn, and the share of them that the band holds.
PATHS = 1000
LEVEL = 0.95
Z95 = 1.959963984540054

FIT = (
    "first date, last date, n long, scale double, noise double, weights array<double>, change_size double, "
    "low array<double>, high array<double>, steps int, gap double, converged boolean"
)


def _waves() -> list[tuple[str, float]]:
    """Name and angle per day of every wave; each has a sine and a cosine."""
    return [(label, 2 * math.pi * k / period) for label, (period, order) in (("yearly", YEARLY), ("weekly", WEEKLY)) for k in range(1, order + 1)]


def _design(day: np.ndarray, first: int, last: int, changepoints: int) -> np.ndarray:
    """Level, slope, hinges and waves, one row per day (counted from 1970)."""
    t = (day - first) / max(last - first, 1)
    at = CHANGEPOINT_RANGE * np.arange(1, changepoints + 1) / max(changepoints, 1)
    hinges = np.maximum(t[:, None] - at, 0.0)
    angles = day[:, None] * np.array([a for _, a in _waves()])
    waves = np.stack([np.sin(angles), np.cos(angles)], 2).reshape(len(day), -1)
    return np.column_stack([np.ones(len(day)), t, hinges, waves])


def series_grams(df: DataFrame, key: str, date: str, y: str, changepoints: int = CHANGEPOINTS) -> DataFrame:
    """key, first, last, n, scale, gram: the sums of (terms, y)(terms, y)' of each series, row by row.

    y is divided by its largest size `scale`. Rows without a date, or whose value is null or
    no finite number, are left out; a series without any has no row, a null key is a series.
    """
    kind = dict(df.dtypes)[key]
    y_col = F.col(y).cast("double")
    rows = df.select(
        F.col(key), F.datediff(F.col(date).cast("date"), F.lit("1970-01-01").cast("date")).alias("day"), y_col.alias("y")
    ).filter("day is not null and y is not null and not isnan(y) and abs(y) < double('infinity')")

    def grams(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["day", "y"])  # the sums do not depend on the order rows arrive in
        day, value = group["day"].to_numpy(float), group["y"].to_numpy(float)
        first, last, scale = day.min(), day.max(), np.abs(value).max() or 1.0
        wide = np.column_stack([_design(day, first, last, changepoints), value / scale])
        epoch = pd.Timestamp("1970-01-01")
        dates = [(epoch + pd.Timedelta(days=int(d))).date() for d in (first, last)]
        found = {key: [group[key].iloc[0]], "first": dates[:1], "last": dates[1:], "n": [len(day)], "scale": [scale]}
        return pd.DataFrame({**found, "gram": [(wide.T @ wide).ravel()]})

    return rows.groupBy(key).applyInPandas(grams, f"`{key}` {kind}, first date, last date, n long, scale double, gram array<double>")


def fit_series(grams: DataFrame, horizon: int = 90, changepoints: int = CHANGEPOINTS) -> DataFrame:
    """The key and the most likely model of every row of `series_grams`.

    `gap` is the largest violation of the optimality conditions relative to the penalty, and
    `converged` whether it is within 1e-6. `low` and `high` are offsets of the band for
    each day of the horizon, in units of y.
    """
    key = grams.columns[0]
    kind = dict(grams.dtypes)[key]
    waves = 2 * len(_waves())
    prior = np.r_[np.inf, TREND_SCALE, np.full(changepoints, np.inf), np.full(waves, WAVE_SCALE)]
    laplace = np.r_[0.0, 0.0, np.full(changepoints, CHANGEPOINT_SCALE), np.zeros(waves)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([solve(row) for row in batch.to_dict("records")])

    def solve(row: dict) -> dict:
        terms = len(prior) + 1
        weights, noise, gap, steps = sparse_trend.fit(np.asarray(row["gram"]).reshape(terms, terms), row["n"], prior, laplace)
        changes, span = weights[2 : 2 + changepoints], max((row["last"] - row["first"]).days, 1)
        seed = zlib.crc32(str(row[key]).encode())
        low, high = sparse_trend.future_band(changes, noise, span, horizon, seed, PATHS, LEVEL)
        return {
            key: row[key], "first": row["first"], "last": row["last"], "n": row["n"], "scale": row["scale"], "noise": noise * row["scale"],
            "weights": weights * row["scale"], "change_size": float(np.abs(changes).mean()) if changepoints else 0.0,
            "low": low * row["scale"], "high": high * row["scale"], "steps": steps, "gap": gap, "converged": gap <= sparse_trend.TOLERANCE,
        }

    return grams.mapInPandas(run, f"`{key}` {kind}, {FIT}")


@dataclass
class SeriesForecasts:
    """Fitted models, one row per series, and the days they were fitted on."""

    key: str
    history: DataFrame
    fits: DataFrame
    horizon: int
    changepoints: int

    def components(self, horizon: int | None = None) -> DataFrame:
        """(key, ds, trend, weekly, yearly) over the history and the horizon, in units of y."""
        return self._days(horizon).select(self.key, "ds", *self._parts())

    def predict(self, horizon: int | None = None) -> DataFrame:
        """(key, ds, yhat, yhat_lower, yhat_upper) over the history and the horizon.

        Inside the history the band is that of the noise; ahead it also holds draws of changes of the trend.
        """
        days = self._days(horizon)
        trend, weekly, yearly = self._parts()
        yhat = trend + weekly + yearly
        ahead = F.datediff("ds", "last")
        band = lambda side, z: F.when(ahead > 0, F.get(F.col(side), ahead - 1)).otherwise(F.col("noise") * z)
        return days.select(
            self.key, "ds", yhat.alias("yhat"), (yhat + band("low", -Z95)).alias("yhat_lower"), (yhat + band("high", Z95)).alias("yhat_upper")
        )

    def changes(self, level: float = CHANGE_LEVEL) -> DataFrame:
        """(key, ds, change): the days on which the slope changes by more than `level` of the scale over the whole history."""
        sizes = F.slice("weights", 3, self.changepoints) if self.changepoints else F.array().cast("array<double>")
        at = self.fits.select(self.key, "first", "last", "scale", F.posexplode(sizes).alias("i", "change"))
        day = F.round(F.datediff("last", "first") * CHANGEPOINT_RANGE * (F.col("i") + 1) / max(self.changepoints, 1)).cast("int")
        return at.filter(F.abs("change") > level * F.col("scale")).select(self.key, F.date_add("first", day).alias("ds"), "change")

    def _days(self, horizon: int | None) -> DataFrame:
        """Every day of the history and the horizon beside its model."""
        horizon = self.horizon if horizon is None else horizon
        if horizon > self.horizon:
            raise ValueError(f"fitted for {self.horizon} days ahead; fit again for {horizon}")
        ahead = F.sequence(F.date_add("last", 1), F.date_add("last", horizon)) if horizon else F.array().cast("array<date>")
        future = self.fits.select(self.key, F.explode(ahead).alias("ds"))
        days = self.history.select(F.col(self.key).alias("k"), "ds").distinct().unionByName(future.withColumnRenamed(self.key, "k"))
        return days.join(self.fits, days["k"].eqNullSafe(self.fits[self.key])).drop(days["k"])

    def _parts(self) -> tuple[Column, Column, Column]:
        weight = lambda i: F.get("weights", F.lit(i))
        t = F.datediff("ds", "first") / F.greatest(F.datediff("last", "first"), F.lit(1))
        trend = weight(0) + weight(1) * t
        for i in range(self.changepoints):
            trend = trend + weight(2 + i) * F.greatest(t - CHANGEPOINT_RANGE * (i + 1) / self.changepoints, F.lit(0.0))
        day = F.datediff("ds", F.lit("1970-01-01").cast("date")).cast("double")
        parts = {"weekly": F.lit(0.0), "yearly": F.lit(0.0)}
        for i, (label, angle) in enumerate(_waves()):
            at = 2 + self.changepoints + 2 * i
            parts[label] = parts[label] + weight(at) * F.sin(day * angle) + weight(at + 1) * F.cos(day * angle)
        return trend.alias("trend"), parts["weekly"].alias("weekly"), parts["yearly"].alias("yearly")


def series_forecasts(
    df: DataFrame, key: str, date: str, y: str, horizon: int = 90, changepoints: int = CHANGEPOINTS
) -> SeriesForecasts:
    """One model per value of `key`, all fitted in one job.

    Changes of the trend may happen at evenly spread days of the first four fifths of a
    history, and their Laplace prior leaves most of them at zero; slope and waves have
    Gaussian priors, the level has none. Several rows of a day are observations each.
    """

    fits = materialize(fit_series(series_grams(df, key, date, y, changepoints), horizon, changepoints))
    known = df.select(F.col(key), F.col(date).cast("date").alias("ds"), F.col(y).cast("double").alias("y")).dropna(subset=["ds", "y"])
    return SeriesForecasts(key, known.select(key, "ds"), fits, horizon, changepoints)


@dataclass
class AdditiveForecast:
    """The forecast of a single series."""

    whole: SeriesForecasts

    def components(self, horizon: int | None = None) -> DataFrame:
        """(ds, trend, weekly, yearly) over the history and the horizon, in units of y."""
        return self.whole.components(horizon).drop("series")

    def predict(self, horizon: int | None = None) -> DataFrame:
        """(ds, yhat, yhat_lower, yhat_upper) over the history and the horizon."""
        return self.whole.predict(horizon).drop("series")

    def changes(self, level: float = CHANGE_LEVEL) -> DataFrame:
        """(ds, change): days on which the slope changes."""
        return self.whole.changes(level).drop("series")


def additive_forecast(df: DataFrame, date: str, y: str, horizon: int = 90) -> AdditiveForecast:
    """Fit on a daily table (one row per day); `series_forecasts` for a single series."""
    days = df.select(F.lit(0).alias("series"), F.col(date).cast("date").alias("ds"), F.col(y).cast("double").alias("y")).dropna()
    s = days.agg(F.count("y").alias("n"), F.countDistinct("ds").alias("days")).first()
    if not s["n"]:
        raise ValueError("no day with a value to fit on")
    if s["days"] != s["n"]:
        raise ValueError("more than one row for a day; aggregate to days first")
    return AdditiveForecast(series_forecasts(days, "series", "ds", "y", horizon))
