from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import arma, special
from millrace.operators import arima, correlation, hypothesis, series, windows
from millrace.plans import flows


def test_t_p_values_against_tables():
    # tabulated two-sided 5 % and 1 % points
    for t, dof, p in [(12.706, 1, 0.05), (2.228, 10, 0.05), (3.169, 10, 0.01), (2.042, 30, 0.05), (1.984, 100, 0.05), (1.96, 10**6, 0.05)]:
        assert special.t_two_sided(t, dof) == pytest.approx(p, abs=2e-4)
    assert special.t_two_sided(0.0, 5) == pytest.approx(1.0)
    assert special.t_two_sided(1e6, 5) < 1e-20


def test_unit_root_p():
    assert special.unit_root_p(-2.86) == pytest.approx(0.05, abs=0.002)
    assert special.unit_root_p(-30) == 0.0 and special.unit_root_p(3) == 1.0
    grid = [special.unit_root_p(x) for x in np.linspace(-6, 2.5, 60)]
    assert all(a <= b + 5e-3 for a, b in zip(grid, grid[1:]))


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 6.0, 5.0), (4.0, None, 5.0)], "x double, y double, z double")
    got = {(r.a, r.b): r.r for r in correlation.correlation_matrix(df, ["x", "y", "z"]).collect()}
    assert got[("x", "y")] == pytest.approx(1.0) and got[("x", "z")] is None
    assert len(got) == 9
    assert correlation.select_by_correlation(df, "x", ["y", "z"]) == ["y"]


def test_ttest_against_hand_values(spark):
    rows = [("a", float(x)) for x in (1, 2, 3, 4, 5)] + [("b", float(x)) for x in (2, 4, 6, 8, 10)] + [(None, 1.0), ("c", 1.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    row = hypothesis.ttest_ind(df, "g", "a", "b", "v").first()
    assert row.t == pytest.approx(-1.8973665961) and row.dof == 8
    assert row.p == pytest.approx(0.0943497728, abs=1e-8) and not row.significant
    pairs = hypothesis.ttest_pairs(df, "g", "v").collect()
    assert {(r.group1, r.group2) for r in pairs} == {("a", "b"), ("a", "c"), ("b", "c")}


def test_moving_average_frames(spark):
    df = spark.range(12).select(F.lit("k").alias("k"), "id", F.col("id").cast("double").alias("v"))
    got = {r.id: (r.ma3, r.ma12) for r in windows.moving_average(windows.moving_average(df, ["k"], "id", "v", 3), ["k"], "id", "v", 12).collect()}
    assert {i: m for i, (_, m) in got.items() if m is not None} == {6: 5.5}
    assert [got[i][0] for i in range(1, 11)] == [float(i) for i in range(1, 11)] and got[0][0] is None


def test_peak_prefers_the_earliest_day(spark):
    df = spark.createDataFrame(
        [("a", dt.date(2026, 1, 6), 3), ("a", dt.date(2026, 1, 2), 3), ("b", dt.date(2026, 1, 1), 9)], "g string, d date, n long"
    )
    assert [tuple(r) for r in windows.peak_per_group(df, "g", "d", "n").collect()] == [
        ("b", dt.date(2026, 1, 1), 9), ("a", dt.date(2026, 1, 2), 3),
    ]


def test_monthly_series_fills_zero(spark):
    df = spark.createDataFrame([("a", dt.date(2020, 1, 5), 1.0), ("a", dt.date(2020, 3, 9), 2.0)], "k string, d date, v double")
    got = sorted((r.month, r.value) for r in series.monthly_series(df, "k", "d", "v").collect())
    assert got == [(dt.date(2020, 1, 31), 1.0), (dt.date(2020, 2, 29), 0.0), (dt.date(2020, 3, 31), 2.0)]


def test_interpolation(spark):
    months = [dt.date(2020, m, d) for m, d in ((1, 31), (2, 29), (3, 31), (4, 30), (5, 31))]
    rows = [("a", m, v) for m, v in zip(months, (None, 1.0, None, 3.0, None))] + [("b", months[0], 1.0), ("b", months[4], 5.0)]
    df = spark.createDataFrame(rows, "k string, month date, value double")
    out = series.align_and_interpolate(df, "k").collect()
    assert [r.value for r in sorted((r for r in out if r.k == "a"), key=lambda r: r.month)] == [None, 1.0, 2.0, 3.0, 3.0]
    assert [r.value for r in sorted((r for r in out if r.k == "b"), key=lambda r: r.month)] == [1.0, 2.0, 3.0, 4.0, 5.0]


def monthly(spark, values, key="k"):
    rows = [(key, i, float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k string, i int, value double")
    return df.select("k", F.last_day(F.add_months(F.lit(dt.date(2000, 1, 1)), F.col("i"))).alias("month"), "value")


@pytest.mark.parametrize("model", ["multiplicative", "additive"])
def test_decomposition_recomposes(spark, model):
    wave = np.array([1.2, 0.8, 1.1, 0.9, 1.0, 1.3, 0.7, 1.0, 1.05, 0.95, 1.15, 0.85])
    values = (100 + np.arange(60)) * np.tile(wave / wave.mean(), 5)
    out = series.seasonal_decompose(monthly(spark, values), "k", model=model).dropna().collect()
    assert len(out) == 48
    for r in out:
        whole = r.trend * r.seasonal * r.resid if model == "multiplicative" else r.trend + r.seasonal + r.resid
        assert whole == pytest.approx(r.value)
    factors = {r.phase: r.seasonal for r in out}
    assert np.mean(list(factors.values())) == pytest.approx(1.0 if model == "multiplicative" else 0.0, abs=1e-9)
    assert max(factors, key=factors.get) == 5


def test_partial_autocorrelation_of_an_ar1(spark):
    rng = np.random.default_rng(1)
    x = [0.0]
    for e in rng.normal(size=400):
        x.append(0.7 * x[-1] + e)
    got = {r.lag: (r.r, r.band) for r in series.pacf(monthly(spark, x), "k").collect()}
    acf = {r.lag: r.r for r in series.acf(monthly(spark, x), "k").collect()}
    centred = np.array(x) - np.mean(x)
    assert acf[1] == pytest.approx(centred[1:] @ centred[:-1] / (centred @ centred))
    assert got[1][0] == pytest.approx(acf[1])
    assert got[2][0] == pytest.approx((acf[2] - acf[1] ** 2) / (1 - acf[1] ** 2))
    assert all(abs(got[k][0]) < 0.2 for k in range(2, 16)) and got[1][1] == pytest.approx(1.96 / 401**0.5)


def simulate(ar, ma, n, seed=0):
    rng = np.random.default_rng(seed)
    e = rng.normal(size=n + 100)
    x = np.zeros(n + 100)
    for t in range(2, n + 100):
        x[t] = sum(a * x[t - 1 - i] for i, a in enumerate(ar)) + e[t] + sum(m * e[t - 1 - i] for i, m in enumerate(ma))
    return x[100:]


def test_autocovariance_against_long_sums():
    ar, ma = np.array([0.5, -0.3]), np.array([0.4])
    psi = arma.psi_weights(ar, ma, 400)
    direct = [psi[: 400 - k] @ psi[k:] for k in range(12)]
    assert np.allclose(arma.autocovariance(ar, ma, 12), direct)


def test_likelihood_against_the_normal_density():
    w, ar, ma = simulate([0.6], [0.3], 40), np.array([0.6]), np.array([0.3])
    loglik, mean, sigma2 = arma.profile(w, ar, ma, True)
    g = arma.autocovariance(ar, ma, 40) * sigma2
    cov = np.array([[g[abs(i - j)] for j in range(40)] for i in range(40)])
    rest = w - mean
    direct = -0.5 * (40 * np.log(2 * np.pi) + np.linalg.slogdet(cov)[1] + rest @ np.linalg.solve(cov, rest))
    assert loglik == pytest.approx(direct)


def test_fit_finds_simulated_coefficients():
    model = arma.fit(5 + simulate([0.7], [], 500), 1, 0, 0)
    assert model["ar"][0] == pytest.approx(0.7, abs=0.08) and model["mean"] == pytest.approx(5, abs=0.5)
    model = arma.fit(simulate([], [0.6], 500), 0, 0, 1)
    assert model["ma"][0] == pytest.approx(0.6, abs=0.08) and model["sigma2"] == pytest.approx(1, abs=0.15)


def test_forecast_of_an_ar1_is_geometric():
    x = simulate([0.7], [], 200)
    model = {"ar": np.array([0.7]), "ma": np.empty(0), "mean": 2.0, "sigma2": 1.0}
    mean, error = arma.forecast(x, 0, model, 3)
    assert np.allclose(mean, [2 + 0.7**h * (x[-1] - 2) for h in (1, 2, 3)])
    assert np.allclose(error**2, np.cumsum(0.49 ** np.arange(3)))
    walk = {"ar": np.empty(0), "ma": np.empty(0), "mean": 0.0, "sigma2": 4.0}
    mean, error = arma.forecast(np.cumsum(x), 1, walk, 4)
    assert np.allclose(mean, np.cumsum(x)[-1]) and np.allclose(error**2, 4.0 * np.arange(1, 5))


def test_series_jobs_over_several_keys(spark):
    flat = simulate([0.3], [], 96, seed=3) + 50
    walk = np.cumsum(simulate([], [], 96, seed=4)) + 500
    both = monthly(spark, flat, "flat").unionByName(monthly(spark, walk, "walk"))
    tests = {r.k: r for r in arima.adf_test(both, "k").collect()}
    assert tests["flat"].stationary and not tests["walk"].stationary
    grid = arima.arima_grid(both, "k").collect()
    assert len(grid) == 18 and {r.d for r in grid if r.k == "walk"} == {1}
    schema = "k string, p int, d int, q int, aic double, reason string"
    orders = arima.best_order(spark.createDataFrame(grid, schema), "k")
    ahead = arima.arima_forecast(both, "k", orders, 6).collect()
    assert len(ahead) == 12 and all(r.lower < r["mean"] < r.upper for r in ahead)
    assert min(r.month for r in ahead) == dt.date(2008, 1, 31)
    scores = {r.k: r for r in arima.arima_backtest(both, "k", orders).collect()}
    assert scores["flat"].mape < 10 and scores["flat"].grade == "excellent"


def test_forecast_flow_tests_searches_and_backtests(spark):
    flat = simulate([0.7], [], 96, seed=3) + 50
    walk = np.cumsum(simulate([], [], 96, seed=4)) + 500
    both = monthly(spark, flat, "flat").unionByName(monthly(spark, walk, "walk"))
    rows = flows.forecast_chain(both, "k").collect()
    assert len(rows) == 6 and all(r.lower < r["mean"] < r.upper and r.rmse is not None for r in rows)
    of = {r.k: r for r in rows}
    assert of["flat"].stationary and of["flat"].d == 0 and of["flat"].p + of["flat"].q > 0
    assert not of["walk"].stationary and of["walk"].d == 1
    assert of["flat"].mape < 10


def test_packed_series_must_be_aggregated(spark, monkeypatch):
    monkeypatch.setattr(arima, "MAX_PERIODS", 10)
    with pytest.raises(Exception, match="more than 10 periods"):
        arima.pack(monthly(spark, range(20)), "k").collect()


def test_alert_needs_consecutive_months(spark):
    actual = monthly(spark, [5, 1, 5, 1, 1, 1, 5])
    limits = actual.select("k", "month", F.lit(2.0).alias("lower"))
    got = series.below_lower_bound(actual, limits, "k", 2).collect()
    assert len(got) == 3 and {r.run for r in got} == {3}
