"""Many columns and many levels: blocks of pairwise sums, sparse one-hot vectors."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import correlation, features, wide_categories


def table(spark, n=700, k=14, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, k)) @ rng.normal(size=(k, k)) * 1e3 + 1e6
    x[:, 3] = 7.25
    rows = [[None if rng.random() < 0.1 else float(v) for v in r] for r in x]
    for r in rows:
        r[5] = None
    rows[3][6] = float("nan")
    for i, r in enumerate(rows):
        r[7] = r[7] if i % 2 else None
        r[8] = None if i % 2 else r[8]  # never together with column 7
    return spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(k))).repartition(5), [f"c{i}" for i in range(k)]


def test_blocks_equal_the_aggregate(spark, monkeypatch):
    df, cols = table(spark)
    assert len(cols) * (len(cols) + 1) / 2 > correlation.NARROW
    blocks = {(r.a, r.b): r.r for r in correlation.correlation_matrix(df, cols).collect()}
    against = {r["column"]: r.r for r in correlation.correlation_with(df, "c0", cols).collect()}
    monkeypatch.setattr(correlation, "NARROW", 10**6)
    plain = {(r.a, r.b): r.r for r in correlation.correlation_matrix(df, cols).collect()}
    assert blocks.keys() == plain.keys() and len(blocks) == len(cols) ** 2
    for pair, r in plain.items():
        assert blocks[pair] == (r if r is None else pytest.approx(r, abs=1e-9, nan_ok=True)), pair
    assert all(blocks["c3", c] is None and blocks["c5", c] is None for c in cols) and blocks["c7", "c8"] is None
    for c in cols:
        r = blocks["c0", c]
        assert against[c] == (r if r is None else pytest.approx(r, abs=1e-9, nan_ok=True))
    assert np.isnan(against["c6"])


def test_five_hundred_columns(spark):
    n, k = 300, 500
    cols = [F.rand(i).alias(f"c{i}") if i % 50 else (F.col("id") * 2.0).alias(f"c{i}") for i in range(k)]
    df = spark.range(n).select(*cols)
    r = {(x.a, x.b): x.r for x in correlation.correlation_matrix(df, [f"c{i}" for i in range(k)]).collect()}
    assert len(r) == k * k and r["c0", "c450"] == pytest.approx(1) and abs(r["c1", "c2"]) < 0.3
    x = df.toPandas().to_numpy()
    want = np.corrcoef(x.T)
    assert all(r[f"c{i}", f"c{j}"] == pytest.approx(want[i, j], abs=1e-9) for i in range(0, k, 37) for j in range(k))
    strong = correlation.select_by_correlation(df, "c0", [f"c{i}" for i in range(1, k)], 0.9)
    assert strong == sorted(f"c{i}" for i in range(50, k, 50))


def test_no_rows_have_no_correlation(spark):
    df, cols = table(spark)
    assert {r.r for r in correlation.correlation_matrix(df.limit(0), cols).collect()} == {None}


@pytest.mark.parametrize("drop_first", [False, True])
def test_sparse_equals_dense_for_few_levels(spark, drop_first):
    rows = [(i, float(i % 11), ["b", "a", "ä", "10", None][i % 5], i % 3, "only") for i in range(200)]
    df = spark.createDataFrame(rows, "id int, x double, kind string, n int, same string")
    train = df.filter("id < 120")
    other = df.unionByName(spark.createDataFrame([(900, 1.0, "never seen", 8, None)], df.schema))
    dense = features.fit_preparation(train, ["x"], ["kind", "n", "same"], drop_first)
    sparse = wide_categories.fit_wide_preparation(train, ["x"], ["kind", "n", "same"], drop_first)
    assert sparse.width == len(dense.names)
    assert [r["name"] for r in sparse.names().orderBy("i").collect()] == dense.names
    want = {r["id"]: r["features"].toArray() for r in dense.transform(other).collect()}
    got = {r["id"]: r["features"].toArray() for r in sparse.transform(other).collect()}
    assert want.keys() == got.keys() and all(np.allclose(want[i], got[i]) for i in want)
    assert sparse.transform(other).columns == [*other.columns, "features"]


def test_hundred_thousand_levels(spark):
    n = 100_000
    df = spark.range(n).select("id", F.concat(F.lit("p"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("product"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("skewed"))
    prep = wide_categories.fit_wide_preparation(df, [], ["product", "skewed"])
    assert prep.sizes == {"product": n, "skewed": 66_667}
    coded = prep.transform(df)
    assert len(coded._jdf.queryExecution().optimizedPlan().toString()) < 60_000
    sample = coded.filter("id % 9973 = 0").collect()
    assert len(sample) == 11
    for r in sample:
        assert r.features.size == prep.width and r.features.indices[0] == r.id and list(r.features.values) == [1.0, 1.0]
    assert coded.count() == n
    numbered = prep.dictionary.filter("column = 'skewed'").agg(F.min("position"), F.max("position"), F.countDistinct("position"), F.count("*")).first()
    assert numbered[0] == 0 and numbered[1] + 1 == numbered[2] == numbered[3] == prep.sizes["skewed"]


def test_empty_dictionary(spark):
    df = spark.createDataFrame([(1, None, 2.0)], "id int, kind string, x double")
    prep = wide_categories.fit_wide_preparation(df, ["x"], ["kind"])
    assert prep.width == 1 and list(prep.transform(df).first().features) == [0.0]
