"""The linear-time likelihood beside dense covariance matrices, with and without missing periods."""

from __future__ import annotations

import datetime as dt
import time

import numpy as np
import pytest

from millrace.functions import arma
from millrace.operators import arima


def covariance(ar, ma, n):
    g = arma.autocovariance(ar, ma, n)
    i = np.arange(n)
    return g[np.abs(i[:, None] - i[None, :])]


def dense(values, v, with_mean):
    """Log-likelihood, mean and variance of values with covariance v up to a factor."""
    n = len(values)
    root = np.linalg.cholesky(v)
    z = np.linalg.solve(root, np.column_stack([values, np.ones(n)]))
    mean = float(z[:, 0] @ z[:, 1] / (z[:, 1] @ z[:, 1])) if with_mean else 0.0
    rest = z[:, 0] - mean * z[:, 1]
    sigma2 = float(rest @ rest / n)
    return -0.5 * n * (np.log(2 * np.pi * sigma2) + 1) - float(np.log(np.diag(root)).sum()), mean, sigma2


def orders(rng):
    p, q = rng.integers(0, 4, 2)
    return arma.coefficients(np.clip(rng.normal(size=p), -1.8, 1.8)), -arma.coefficients(np.clip(rng.normal(size=q), -1.8, 1.8))


@pytest.mark.parametrize("seed", range(40))
def test_likelihood_equals_the_dense_one(seed):
    rng = np.random.default_rng(seed)
    ar, ma = orders(rng)
    for n in (4 + len(ar) + len(ma), 63, 64, 65, 200):
        w = rng.normal(size=n).cumsum() + rng.normal(size=n)
        assert arma.profile(w, ar, ma, True) == pytest.approx(dense(w, covariance(ar, ma, n), True), rel=1e-8, abs=1e-8)


@pytest.mark.parametrize("seed", range(30))
def test_missing_periods_are_skipped(seed):
    rng = np.random.default_rng(100 + seed)
    ar, ma = orders(rng)
    n = int(rng.integers(30, 160))
    levels = rng.normal(size=n).cumsum()
    missing = rng.random(n) < 0.25
    known = np.flatnonzero(~missing)
    levels[missing] = np.nan
    first, last = known[0], known[-1]
    _, w, gaps = arma.differenced(levels, 0)
    v = covariance(ar, ma, n)[np.ix_(known, known)]
    assert arma.profile(w, ar, ma, True, gaps) == pytest.approx(dense(levels[known], v, True), rel=1e-8, abs=1e-8)
    # Differences between known neighbours: sums of the single differences in between.
    _, w, gaps = arma.differenced(levels, 1)
    sums = np.zeros((len(known) - 1, last - first))
    for r, (a, b) in enumerate(zip(known[:-1], known[1:])):
        sums[r, a - first : b - first] = 1
    v = sums @ covariance(ar, ma, last - first) @ sums.T
    assert arma.profile(w, ar, ma, False, gaps) == pytest.approx(dense(np.diff(levels[known]), v, False), rel=1e-7, abs=1e-7)


@pytest.mark.parametrize("seed", range(20))
def test_forecast_is_the_conditional_mean(seed):
    rng = np.random.default_rng(200 + seed)
    ar, ma = orders(rng)
    n, h = 80, 6
    x = rng.normal(size=n) + 3
    missing = (rng.random(n) < 0.2) & (np.arange(n) < n - 1) & (np.arange(n) > 0)
    known = np.flatnonzero(~missing)
    v = covariance(ar, ma, n + h)
    want = 2 + v[n:][:, known] @ np.linalg.solve(v[np.ix_(known, known)], x[known] - 2)
    model = {"ar": ar, "ma": ma, "mean": 2.0, "sigma2": 1.0}
    assert arma.forecast(np.where(missing, np.nan, x), 0, model, h)[0] == pytest.approx(want, abs=1e-7)


@pytest.mark.parametrize("d", [1, 2])
def test_forecast_of_differences_fills_the_gaps(d):
    values = np.arange(40.0) * 3 + 5
    holes = values.copy()
    holes[[7, 8, 20, 38]] = np.nan
    model = {"ar": np.empty(0), "ma": np.empty(0), "mean": 0.0, "sigma2": 1.0}
    mean, _ = arma.forecast(holes, d, model, 3)
    step = 3 if d == 2 else 0
    assert mean == pytest.approx([values[-1] + step * i for i in (1, 2, 3)])


def test_recursion_crosses_blocks():
    rng = np.random.default_rng(1)
    for q in range(5):
        ma, x = rng.normal(size=q) * 0.4, rng.normal(size=(301, 2))
        want = np.zeros_like(x)
        for t in range(len(x)):
            want[t] = x[t] - sum(ma[j] * want[t - 1 - j] for j in range(min(q, t)))
        for n in (0, 1, 2, 63, 64, 65, 128, 301):
            assert np.allclose(arma.recursive_filter(ma, x[:n]), want[:n])


def test_long_daily_series_in_seconds():
    rng = np.random.default_rng(2)
    e = rng.normal(size=20_001)
    x = e[1:] + 0.5 * e[:-1]
    began = time.process_time()
    model = arma.fit(x.cumsum(), 0, 1, 1)
    assert time.process_time() - began < 60 and model["ma"][0] == pytest.approx(0.5, abs=0.03)


def test_gaps_in_a_table(spark):
    """A month without a value changes neither the order of the others nor the calendar of the forecast."""
    rng = np.random.default_rng(3)
    day, rows, values = dt.date(2010, 1, 31), [], []
    for i in range(120):
        y, m = divmod(i, 12)
        end = (dt.date(2010 + y + (m == 11), (m + 1) % 12 + 1, 1) - dt.timedelta(days=1))
        values.append(float(10 + 3 * (-1) ** i + rng.normal() * 0.1))
        gone = i % 17 == 5 or i in (0, 119)
        rows.append(("a", end, None if gone else values[-1]))
    assert rows[0][1] == day
    df = spark.createDataFrame(rows, "k string, month date, value double")
    packed = arima.pack(df, "k").first()
    assert len(packed.ys) == 118 and np.isnan(packed.ys).sum() == 7 and packed.months[0] == dt.date(2010, 2, 28)
    order = spark.createDataFrame([("a", 1, 0, 0)], "k string, p int, d int, q int")
    ahead = arima.arima_forecast(df, "k", order, 2).orderBy("step").collect()
    # Odd months are low, even ones high: a series closed up over its gaps would get this wrong.
    assert [r.month for r in ahead] == [dt.date(2019, 12, 31), dt.date(2020, 1, 31)]
    assert ahead[0]["mean"] == pytest.approx(7, abs=0.5) and ahead[1]["mean"] == pytest.approx(13, abs=0.5)
    aic = {(r.p, r.q): r.aic for r in arima.arima_grid(df, "k", 1, 0, d=0).collect()}
    assert aic[1, 0] < aic[0, 0] - 100
    train, test = arima.split_last(df, "k", 6)
    assert test.count() == 6 and train.filter("value is null").count() > 0
    with pytest.raises(ValueError, match="more than one row"):
        arima.pack(df.unionByName(df), "k")
