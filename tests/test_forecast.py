"""Sparse additive forecasts: the solver, planted changes, the band, many series in one job."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import sparse_trend
from millrace.operators import forecast

DAY = dt.date(2020, 1, 1)


def descend(gram, target, ridge, lasso, sweeps=60_000):
    """The same sum by plain coordinate descent on all weights."""
    full, w = gram + np.diag(ridge), np.zeros(len(target))
    for _ in range(sweeps):
        for j in range(len(w)):
            u = target[j] - full[j] @ w + full[j, j] * w[j]
            w[j] = np.sign(u) * max(abs(u) - lasso[j], 0) / full[j, j]
    return w


@pytest.mark.parametrize("seed", range(5))
def test_solver_against_plain_descent(seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(60, 7)) @ (np.eye(7) + 0.5 * rng.normal(size=(7, 7)))
    y = x @ np.array([2, -1, 0, 0, 1.5, 0, 0]) + rng.normal(size=60)
    ridge, lasso = np.array([0, 0.1, 0, 0, 0, 0, 0.3]), np.array([0, 0, 15.0, 15, 15, 40, 0])
    found = sparse_trend.sparse_ridge(x.T @ x, x.T @ y, ridge, lasso, np.zeros(7))
    assert found.gap <= sparse_trend.TOLERANCE
    assert found.weights == pytest.approx(descend(x.T @ x, x.T @ y, ridge, lasso, 3000), abs=1e-6)


def simulated(rng, n, changes, noise, slope=0.05):
    t = np.arange(n)
    trend = 100 + slope * t + sum(size * np.maximum(t - at, 0) for at, size in changes)
    return trend + 3 * np.sin(2 * np.pi * t / 7) + rng.normal(0, noise, n)


def test_many_series_in_one_job(spark):
    rng = np.random.default_rng(2)
    n, step = 1095, 1095 * 0.8 / 120  # candidates a week apart
    planted = {"early": 30, "middle": 60, "late": 100, "flat": None, None: 45}
    rows = []
    for key, k in planted.items():
        y = simulated(rng, n, [] if k is None else [(k * step, 0.3)], 0.8)
        rows += [(key, DAY + dt.timedelta(days=i), float(v), 1) for i, v in enumerate(y)]
    rows += [("holes", DAY + dt.timedelta(days=i), 5.0 + i, 1) for i in range(0, 300, 3)]
    rows += [("holes", None, 1.0, 1), ("holes", DAY, None, 1), ("holes", DAY, float("nan"), 1), ("nothing", DAY, None, 1)]
    rows += [("one day", DAY, 7.0, 1), ("same day", DAY, 1.0, 1), ("same day", DAY, 3.0, 1), ("zeros", DAY, 0.0, 1), ("zeros", DAY + dt.timedelta(days=9), 0.0, 1)]
    df = spark.createDataFrame(rows, "series string, d date, y double, weights int")
    found = forecast.series_forecasts(df, "series", "d", "y", 30, 120)
    fits = {r["series"]: r for r in found.fits.collect()}
    assert set(fits) == {*planted, "holes", "one day", "same day", "zeros"}
    assert all(r["converged"] and r["gap"] <= 1e-6 for r in fits.values())

    changes = {}
    for r in found.changes().collect():
        changes.setdefault(r["series"], []).append((abs(r["change"]), r["ds"]))
    for key, k in planted.items():
        if k is None:
            assert key not in changes
        else:
            day = max(changes[key])[1]
            assert abs((day - DAY).days - k * step) <= 7
    ahead = {(r["series"], r["ds"]): r for r in found.predict().collect()}
    assert len(ahead) == sum(r["days"] + 30 for r in df.filter("d is not null and y is not null").groupBy("series").agg(F.countDistinct("d").alias("days")).collect())
    day = DAY + dt.timedelta(days=n + 20)
    assert ahead["middle", day]["yhat"] == pytest.approx(simulated(rng, n + 21, [(60 * step, 0.3)], 0)[-1], rel=0.03)
    assert ahead["holes", DAY + dt.timedelta(days=307)]["yhat"] == pytest.approx(312, rel=0.02)
    assert ahead["same day", DAY]["yhat"] == pytest.approx(2, abs=0.01) and ahead["zeros", DAY]["yhat"] == pytest.approx(0, abs=1e-6)
    parts = {(r["series"], r["ds"]): r for r in found.components().collect()}
    for at, r in parts.items():
        assert r["trend"] + r["weekly"] + r["yearly"] == pytest.approx(ahead[at]["yhat"])
        assert ahead[at]["yhat_lower"] < ahead[at]["yhat"] < ahead[at]["yhat_upper"]
    with pytest.raises(ValueError, match="fit again"):
        found.predict(31)


def test_rows_in_any_order_give_the_same_model(spark):
    rng = np.random.default_rng(8)
    y = simulated(rng, 300, [(100, 0.2)], 1.0)
    df = spark.createDataFrame([("a", DAY + dt.timedelta(days=i), float(v)) for i, v in enumerate(y)], "k string, d date, y double")
    one = forecast.series_forecasts(df, "k", "d", "y").predict().orderBy("ds").collect()
    two = forecast.series_forecasts(df.orderBy(F.rand(3)).repartition(5), "k", "d", "y").predict().orderBy("ds").collect()
    assert one == two


def test_band_holds_futures():
    """Futures drawn day by day: a change each day with the rate of the history, added up step by step."""
    rng = np.random.default_rng(4)
    changes, noise, span, horizon = np.array([0.4, 0, 0, -0.2, 0, 0, 0.3, 0]), 0.02, 400, 120
    low, high = sparse_trend.future_band(changes, noise, span, horizon, 9, 4000, 0.95)
    scale, inside = np.abs(changes).mean(), np.zeros(horizon)
    for _ in range(4000):
        slope, level = 0.0, 0.0
        for h in range(horizon):
            new = sum(rng.laplace(0, scale) * np.array([1, rng.uniform()]) for _ in range(rng.poisson(len(changes) / span)))
            size, part = (new[0], new[1]) if isinstance(new, np.ndarray) else (0.0, 0.0)
            level += slope / span + (part if abs(part) < abs(size) else size) / span
            slope += size
            y = level + noise * rng.standard_normal()
            inside[h] += low[h] <= y <= high[h]
    share = inside / 4000
    assert 0.93 <= share.mean() <= 0.97 and (abs(share - 0.95) < 0.03).all()
    assert (np.diff(high - low) > -0.01).all() and high[-1] - low[-1] > 2 * (high[0] - low[0])


def test_no_changes_no_drift():
    low, high = sparse_trend.future_band(np.zeros(25), 0.1, 500, 60, 1, 4000, 0.95)
    assert (abs(high - 0.196) < 0.02).all() and (abs(low + 0.196) < 0.02).all()
