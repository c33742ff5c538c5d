"""Nothing is rounded away, dropped or changed by the size of a table."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import arma
from millrace.operators import anomaly, arima, features, models, quantiles, series
from millrace.streaming.daily import daily_counts_stream
from millrace.streaming.sinks import latest, run_available


def months(start, values):
    out = []
    for i, v in enumerate(values):
        first = dt.date(start + i // 12, i % 12 + 1, 1)
        following = dt.date(first.year + first.month // 12, first.month % 12 + 1, 1)
        out.append((following - dt.timedelta(days=1), v))
    return out


def test_monthly_sums_keep_small_and_large_values(spark):
    rows = [("a", dt.date(2020, 1, 5), 0.004)] * 1000 + [("b", dt.date(2020, 1, 5), 1e17)] * 2
    df = spark.createDataFrame(rows, "k string, d date, v double")
    got = {r.k: r.value for r in series.monthly_series(df, "k", "d", "v").collect()}
    assert got["a"] == pytest.approx(4.0) and got["b"] == 2e17


@pytest.fixture(scope="module")
def mixed_series(spark):
    """Good series beside a constant, one of 1, 2 and 3 points, and one without any value."""
    rng = np.random.default_rng(0)
    data = {
        "good": list(np.cumsum(rng.normal(size=60)) + 50),
        "steady": list(rng.normal(size=60) + 20),
        "constant": [7.0] * 30,
        "one": [1.0],
        "two": [1.0, 2.0],
        "three": [1.0, 2.0, 4.0],
        "none": [None] * 5,
    }
    rows = [(k, *x) for k, values in data.items() for x in months(2015, [None if v is None else float(v) for v in values])]
    return spark.createDataFrame(rows, "k string, month date, value double")


def test_every_series_stays(mixed_series):
    keys = {"good", "steady", "constant", "one", "two", "three", "none"}
    tests = {r.k: r for r in arima.adf_test(mixed_series, "k").collect()}
    assert set(tests) == keys
    for k in ("constant", "one", "two", "three", "none"):
        assert tests[k].p is None and tests[k].stationary is None and tests[k].d is None and tests[k].reason
    assert tests["good"].p is not None and tests["good"].reason is None

    summary = {r.k: r for r in arima.series_summary(mixed_series, "k", 1, 0).collect()}
    assert set(summary) == keys
    assert summary["good"].aic is not None and summary["constant"].aic is None and summary["constant"].reason

    orders = arima.best_order(arima.arima_grid(mixed_series, "k", 1, 0), "k")
    ahead = {}
    for r in arima.arima_forecast(mixed_series, "k", orders, 3).collect():
        ahead.setdefault(r.k, []).append(r)
    assert set(ahead) == keys - {"none"} and all(len(v) == 3 for v in ahead.values())
    assert all(r["mean"] is not None for r in ahead["good"])
    assert all(r["mean"] is None and r.reason for r in ahead["constant"] + ahead["one"])


def test_two_differences_are_summed_up_twice():
    values = np.array([float(i * i) for i in range(1, 15)]) + np.tile([0.0, 0.5], 7)
    model = {"ar": np.zeros(0), "ma": np.zeros(0), "mean": 0.0, "sigma2": 1.0}
    mean, error = arma.forecast(values, 2, model, 3)
    slope = values[-1] - values[-2]
    assert mean == pytest.approx([values[-1] + slope * h for h in (1, 2, 3)])
    assert error == pytest.approx([1.0, math.sqrt(1 + 4), math.sqrt(1 + 4 + 9)])


def test_backtest_pairs_every_period(spark):
    """Empty months do not shift the periods that are compared."""
    known = months(2015, [float(10 + i % 3) for i in range(30)])
    gap = [r for i, r in enumerate(known) if i not in (24, 26)]
    df = spark.createDataFrame([("a", *r) for r in gap], "k string, month date, value double")
    orders = spark.createDataFrame([("a", 0, 1, 0)], "k string, p int, d int, q int")
    got = arima.arima_backtest(df, "k", orders, 4).first()
    values = [v for _, v in gap]
    errors = [v - values[-5] for v in values[-4:]]
    assert got.rmse == pytest.approx(math.sqrt(np.mean(np.square(errors))))


def test_too_many_periods_are_refused(mixed_series):
    with pytest.raises(ValueError, match="periods"):
        arima.pack(mixed_series, "k", max_periods=10)


def test_missing_labels_and_features_stay(spark):
    rows = [(i, float(i), None if i % 4 == 0 else i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, x double, y int")
    h = features.integer_hash("id")
    for out, column in (
        (features.stratified_split(df, "y", h, 0.5), "part"),
        (features.with_class_weights(df, "y"), "weight"),
        (models.stratified_folds(df, "y", h, 3), "fold"),
    ):
        assert out.count() == 40 and out.filter(F.col(column).isNull()).count() == 10
    gaps = df.withColumn("x", F.when(F.col("id") > 3, F.col("x")))
    assert features.assemble(gaps, ["x"], invalid="keep").count() == 40
    with pytest.raises(Exception, match="null|NULL"):
        features.assemble(gaps, ["x"]).collect()
    prep = features.fit_preparation(gaps, ["x"])
    assert prep.transform(gaps, invalid="keep").count() == 40


def test_quantiles_do_not_depend_on_the_size_of_a_group(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(int(g), float(v)) for g, v in zip(rng.integers(0, 4, 4000), rng.normal(size=4000) ** 3)]
    df = spark.createDataFrame(rows, "g int, v double")
    probs = [0.001, 0.1, 1 / 3, 0.5, 0.77, 0.999]
    ask = lambda: sorted(map(tuple, quantiles.exact_quantiles(df, ["v"], probs, ["g"]).select("g", "prob", "value").collect()))
    small = ask()
    monkeypatch.setattr(quantiles, "WHOLE_BELOW", 10)
    assert ask() == small
    monkeypatch.setattr(quantiles, "REFINE_ABOVE", 10)
    assert ask() == small
    monkeypatch.setattr(quantiles, "SKETCH_ROWS", 1)
    assert ask() == small


def test_trees_draw_about_as_many_rows_from_any_table(spark):
    for n in (100, 900, 20_000):
        df = spark.range(n).select("id", F.col("id").cast("double").alias("x"))
        sizes = [r["count"] for r in anomaly.tree_samples(df, ["id"], ["x"], 20, 1).groupBy("tree").count().collect()]
        assert len(sizes) == 20
        assert all(s == n for s in sizes) if n <= 300 else abs(np.mean(sizes) - 300) < 30
    pairs = anomaly.tree_samples(spark.range(900).select("id", F.col("id").cast("double").alias("x")), ["id"], ["x"], 20, 1)
    assert pairs.groupBy("tree", "x").count().filter("count > 1").isEmpty()


def test_late_rows_of_many_files_are_counted(spark, tmp_path):
    folder = f"{tmp_path}/in"
    days = [dt.datetime(2020, 1, d, 12) for d in (20, 1, 25, 2, 20, 1)]
    for i, d in enumerate(days):
        spark.createDataFrame([("a", d)], "kind string, ts timestamp").coalesce(1).write.parquet(f"{folder}/{i}")
    stream = spark.readStream.schema("kind string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")
    out = latest(run_available(daily_counts_stream(stream, "kind", "ts"), "update"), ["kind", "day"], "n")
    got = {r.day.day: r.n for r in out.collect()}
    assert got == {20: 2, 1: 2, 25: 1, 2: 1}


def test_daily_forecast_needs_one_row_per_day(spark):
    from millrace.operators import forecast

    day = dt.date(2024, 1, 1)
    rows = [(day + dt.timedelta(days=i), float(i % 7)) for i in range(40)]
    with pytest.raises(ValueError, match="more than one row"):
        forecast.additive_forecast(spark.createDataFrame(rows + rows[:1], "d date, y double"), "d", "y")
    with pytest.raises(ValueError, match="no day"):
        forecast.additive_forecast(spark.createDataFrame([], "d date, y double"), "d", "y")


def test_unit_root_knows_no_unit():
    walk = np.cumsum(np.random.default_rng(5).normal(size=80))
    plain = arma.unit_root(walk)
    for shifted in (walk * 1e7 + 5e8, walk * 1e-6 - 3):
        tau, lags, used = arma.unit_root(shifted)
        assert (lags, used) == plain[1:] and tau == pytest.approx(plain[0], rel=1e-5)
