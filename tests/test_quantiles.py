from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import profiling, quantiles

PROBS = [0.0, 0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]


def check(df, by=()):
    pdf = df.toPandas()
    got = quantiles.exact_quantiles(df, ["v"], PROBS, by).toPandas()
    groups = pdf.dropna(subset=["v"]).groupby(list(by)) if by else [((), pdf.dropna(subset=["v"]))]
    n = 0
    for key, part in groups:
        mine = got
        for name, k in zip(by, key if isinstance(key, tuple) else (key,)):
            mine = mine[mine[name] == k]
        mine = mine.sort_values("prob")
        assert np.allclose(mine["value"], np.quantile(part["v"], PROBS), rtol=1e-12)
        n += len(mine)
    assert n == len(got)


def skewed(spark, n=60_000):
    """A third of the rows hold one value; the rest follow a long tail."""
    return spark.range(n).select(
        (F.col("id") % 3 == 0).cast("int").alias("g"),
        F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.exp(F.pmod(F.xxhash64("id"), F.lit(10_000)) / 500.0)).alias("v"),
    )


@pytest.fixture
def brackets_only(monkeypatch):
    """Make small test tables take the path of large ones."""
    monkeypatch.setattr(quantiles, "WHOLE_BELOW", 1_500)


def test_small_table(spark):
    df = spark.createDataFrame([(x,) for x in (1.0, 2.0, 3.0, 10.0, None, float("nan"))], "v double")
    got = {r.prob: r.value for r in quantiles.exact_quantiles(df, ["v"], [0.25, 0.5]).collect()}
    assert got == {0.25: 1.75, 0.5: 2.5}


def test_skewed_table(spark):
    check(skewed(spark))


def test_skewed_groups(spark):
    check(skewed(spark), ["g"])


def test_brackets_give_the_same_values(spark, brackets_only):
    check(skewed(spark))
    check(skewed(spark), ["g"])


def test_widths_give_the_same_values(spark, brackets_only, monkeypatch):
    monkeypatch.setattr(quantiles, "REFINE_ABOVE", 0)
    check(skewed(spark))
    check(skewed(spark), ["g"])
    tiny = spark.createDataFrame([(x,) for x in (1.0, 1.0, 2.0, 50.0, None)], "v double")
    check(tiny)


def test_a_missed_rank_fails(spark):
    cells = spark.createDataFrame(
        [("v", None, 1, 90, 1.0, 100, [(0.5, 5.0, 9.0)]), ("v", 6.0, 0, 10, 6.0, 100, [(0.5, 5.0, 9.0)])],
        "column string, slot double, passed int, rows bigint, at double, n bigint, brackets " + quantiles.BRACKETS,
    )
    for largest in (100, None):
        with pytest.raises(Exception, match="missed its rank"):
            quantiles._pick(cells, ["column"], largest).collect()


def test_bracket_holds_a_small_share(spark, brackets_only):
    df = spark.range(100_000).select(F.col("id").cast("double").alias("v"))
    values = quantiles.long_values(df, ["v"])
    sketch = values.groupBy("column").agg(*quantiles._sketch([0.5])).collect()
    kept = quantiles._cells_by_column(df, ["v"], sketch).filter("slot is not null").count()
    assert kept < 2_000


def test_large_sketch_table_joins_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "SKETCH_ROWS", 3)
    monkeypatch.setattr(quantiles, "WHOLE_BELOW", 1_500)
    df = spark.range(20_000).select((F.col("id") % 10).alias("g"), F.col("id").cast("double").alias("v"))
    check(df, ["g"])


def test_many_small_groups(spark):
    check(spark.range(5_000).select((F.col("id") % 500).alias("g"), (F.pmod(F.xxhash64("id"), F.lit(997)) / 7.0).alias("v")), ["g"])


def test_several_columns_and_null_keys(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("a", 3.0, None), (None, 9.0, 9.0)], "g string, x double, y double")
    got = {(r.g, r.column): r.value for r in quantiles.exact_quantiles(df, ["x", "y"], [0.5], ["g"]).collect()}
    assert got == {("a", "x"): 2.0, ("a", "y"): 5.0}


def test_column_without_values(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert quantiles.exact_quantiles(df, ["v"], [0.5]).count() == 0
    assert quantiles.quantile_values(df, ["v"], {"m": 0.5}) == {"v_m": None}


def test_corrected_skewness_and_std(spark):
    df = spark.createDataFrame([(x,) for x in (1.0, 2.0, 3.0, 10.0)], "v double")
    row = profiling.target_profile(df, "v").first()
    assert row["skew"] == pytest.approx(1.763632614803888)
    assert row["std"] == pytest.approx(4.08248290463863)
    assert row["median"] == 2.5


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in range(11)], "v double")
    got = {r.bin: r.n for r in profiling.histogram(df, "v", 5).collect()}
    assert got == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert [(r.bin, r.n) for r in profiling.histogram(df, "v", 5).collect()] == [(0, 2)]


def test_null_group_switch(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",)], "g string")
    assert profiling.group_count(df, ["g"]).count() == 1
    assert profiling.group_count(df, ["g"], null_group="keep").count() == 2
    shares = {r.g: r.percent for r in profiling.frequency_share(df, "g").collect()}
    assert shares == {"a": 100.0}
