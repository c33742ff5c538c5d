from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import anomaly, blocks, clustering, features, forecast, forest, lineage, logistic, metrics, models, ordering
from millrace.plans import closed_forms


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 2))
    z = 0.5 + 1.5 * x[:, 0] - x[:, 1]
    label = (rng.uniform(size=600) < 1 / (1 + np.exp(-z))).astype(int)
    y = 3 + 2 * x[:, 0] - 4 * x[:, 1] + rng.normal(size=600)
    rows = [(i, *map(float, r), float(t), int(b)) for i, (r, t, b) in enumerate(zip(x, y, label))]
    return spark.createDataFrame(rows, "id long, a double, b double, y double, label int").repartition(4)


def local(table):
    return table.orderBy("id").toPandas()


@pytest.mark.parametrize("alpha", [0.0, 50.0])
def test_linear_fits_against_closed_form(table, alpha):
    fit = models.ridge_regression(table, "y", ["a", "b"], alpha)
    pdf = local(table)
    x = pdf[["a", "b"]].to_numpy()
    xc, yc = x - x.mean(0), pdf["y"] - pdf["y"].mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(2), xc.T @ yc)
    assert np.allclose(fit.weights, w, rtol=1e-8)
    assert fit.intercept == pytest.approx(pdf["y"].mean() - x.mean(0) @ w)


@pytest.mark.parametrize("weighted", [False, True])
def test_logistic_against_newton(table, weighted):
    rows = features.with_class_weights(features.assemble(table, ["a", "b"]), "label")
    model = models.logistic_regression(rows, "label", c=0.5, weight="weight" if weighted else None)
    pdf = rows.toPandas()
    x = np.column_stack([np.ones(len(pdf)), pdf[["a", "b"]]])
    s = pdf["weight"].to_numpy() if weighted else np.ones(len(pdf))
    w = np.zeros(3)
    ridge = np.diag([0.0, 1.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        grad = 0.5 * x.T @ (s * (p - pdf["label"])) + ridge @ w
        w -= np.linalg.solve(0.5 * (x.T * (s * p * (1 - p))) @ x + ridge, grad)
    assert np.allclose([model.intercept, *model.coefficients], w, atol=1e-5)


def test_preparation_learns_from_train_only(spark):
    train = spark.createDataFrame([(1.0, "a"), (3.0, "b")], "x double, c string")
    test = spark.createDataFrame([(5.0, "zzz")], "x double, c string")
    prep = features.fit_preparation(train, ["x"], ["c"])
    assert prep.names == ["x", "c_a", "c_b"]
    assert prep.transform(test).select(vector_to_array("features")).first()[0] == [3.0, 0.0, 0.0]


def test_scalers_on_constant_columns(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert {r.x for r in features.standardize(df, ["x"]).collect()} == {0.0}
    assert {r.x for r in features.minmax_scale(df, ["x"]).collect()} == {0.5}


def test_one_hot_refuses_wide_columns(spark):
    df = spark.range(50).withColumn("c", F.col("id").cast("string"))
    with pytest.raises(ValueError):
        features.category_levels(df, ["c"], max_levels=10)


def test_splits_keep_shares_and_survive_repartitioning(spark):
    df = spark.range(20_000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    parts = features.random_split(df, features.integer_hash("id"), 0.8)
    assert parts.filter("part = 'train'").count() / 20_000 == pytest.approx(0.8, abs=0.01)
    again = features.random_split(df.repartition(7), features.integer_hash("id"), 0.8)
    assert parts.exceptAll(again).count() == 0
    strat = features.stratified_split(df, "y", features.text_hash("id"), 0.8)
    shares = strat.groupBy("y").agg(F.avg((F.col("part") == "train").cast("int")).alias("s")).collect()
    assert all(r.s == pytest.approx(0.8, abs=0.001) for r in shares)


def test_folds_are_equal_and_disjoint(spark):
    df = spark.range(5_000).withColumn("y", (F.col("id") % 7 == 0).cast("int"))
    folds = models.stratified_folds(df, "y", features.text_hash("id"), 5)
    sizes = folds.groupBy("y", "fold").count().groupBy("y").agg(F.min("count"), F.max("count"), F.count("*")).collect()
    assert all(r[3] == 5 and r[2] - r[1] <= 2 for r in sizes)


def test_cross_validation_and_forest(table):
    rows = features.assemble(table, ["a", "b"])
    folded = models.stratified_folds(rows, "label", features.integer_hash("id"), 3)
    out = models.cross_validate(folded, "label", 3, [0.01, 1.0]).collect()
    assert len(out) == 2 and all(0.75 < r.auc < 1 for r in out)
    forest = models.random_forest(rows, "label", trees=20)
    scored = models.predict_proba(forest, rows)
    assert metrics.roc_auc(scored, "label", "p").first().auc > 0.85
    assert models.feature_importance(forest, ["a", "b"], rows).count() == 2


def forest_rows(spark, n=4_000):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(size=(n, 3)), rng.integers(0, 2, (n, 2)), rng.random(n) < 0.004]).astype(float)
    y = ((x[:, 0] * x[:, 1] > 0) ^ (rng.random(n) < 0.1) | (x[:, 5] > 0)).astype(int)
    names = [f"x{i}" for i in range(6)]
    rows = [(i, int(t), 1.0 + i % 3, *map(float, r)) for i, (r, t) in enumerate(zip(x, y))]
    schema = "id int, label int, weight double, " + ", ".join(f"{c} double" for c in names)
    return features.assemble(spark.createDataFrame(rows, schema), names).repartition(5, "id")


def test_forest_is_as_good_as_the_library_s(spark):
    rows = lineage.materialize(forest_rows(spark))
    train, test = rows.filter("id % 4 > 0"), rows.filter("id % 4 = 0")
    ours = models.random_forest(train, "label", trees=40, depth=6, weight="weight")
    theirs = RandomForestClassifier(labelCol="label", numTrees=40, maxDepth=6, seed=1).setWeightCol("weight").fit(train)
    auc = metrics.roc_auc(models.predict_proba(ours, test), "label", "p").first().auc
    wanted = metrics.roc_auc(theirs.transform(test).withColumn("p", vector_to_array("probability")[1]), "label", "p").first().auc
    assert auc > 0.85 and abs(auc - wanted) < 0.03
    got, known = ours.featureImportances.toArray(), theirs.featureImportances.toArray()
    assert got.sum() == pytest.approx(1) and np.allclose(got, known, atol=0.1) and got[5] > 0


def test_trees_take_the_best_cut_of_their_draw(spark, monkeypatch):
    """Each split against brute force over the rows drawn; how trees share passes changes nothing."""
    rows = lineage.materialize(forest_rows(spark, 900))
    stored = []
    real = forest._blocks
    monkeypatch.setattr(forest, "_blocks", lambda *a: stored.append(real(*a)) or stored[-1])
    fit = models.random_forest(rows, "label", trees=3, depth=3, weight="weight", seed=9)
    blocks_ = [(r.block, np.frombuffer(r.bins, np.uint8).reshape(-1, 6), np.frombuffer(r.label, np.uint8), np.frombuffer(r.weight)) for r in stored[0].collect()]
    for t in range(3):
        draws = [forest.DRAWS[np.random.default_rng([9, t, b]).integers(0, 65536, len(y), np.uint16)] for b, _, y, _ in blocks_]
        x, y = (np.concatenate([v[k] for v in blocks_]) for k in (1, 2))
        w = np.concatenate([v[3] for v in blocks_]) * np.concatenate(draws)
        at = {0: np.flatnonzero(w)}
        for node in range(7):
            own = at.get(node, np.zeros(0, int))
            nodes, first = 2 ** int(np.log2(node + 1)), 2 ** int(np.log2(node + 1)) - 1
            tried = np.random.default_rng([9, int(np.log2(nodes))]).random((3, nodes, 6)).argsort(-1)[t, node - first, :3]
            impurity = lambda rows: 0.0 if not len(rows) else w[rows].sum() - sum(w[rows[y[rows] == c]].sum() ** 2 for c in (0, 1)) / w[rows].sum()
            drops = [impurity(own) - impurity(own[x[own, f] <= c]) - impurity(own[x[own, f] > c]) for f in tried for c in range(32)]
            if fit.feature[t, node] < 0:
                assert not len(own) or max(drops) < 1e-6
                continue
            right = x[own, fit.feature[t, node]] > fit.cut[t, node]
            assert fit.feature[t, node] in tried
            assert impurity(own) - impurity(own[~right]) - impurity(own[right]) == pytest.approx(max(drops))
            at[2 * node + 1], at[2 * node + 2] = own[~right], own[right]
            assert fit.share[t, 2 * node + 2, 1] == pytest.approx(w[own[right]] @ y[own[right]] / w[own[right]].sum())
    monkeypatch.setattr(forest, "PASS_NUMBERS", 1)
    monkeypatch.setattr(forest, "_blocks", lambda *a: stored[0])
    again = models.random_forest(rows, "label", trees=3, depth=3, weight="weight", seed=9)
    assert (again.feature == fit.feature).all() and (again.cut == fit.cut).all()


def test_forest_edges(spark):
    one = forest_rows(spark, 200).withColumn("label", F.lit(1))
    sure = models.predict_proba(models.random_forest(one, "label", trees=3), one)
    assert sure.agg(F.min("p"), F.max("p")).first() == (1.0, 1.0) and (forest.DRAWS.mean() == pytest.approx(1, abs=1e-3))
    assert models.predict_proba(models.random_forest(one, "label", trees=3), one.limit(0)).count() == 0
    with pytest.raises(ValueError, match="no row"):
        models.random_forest(one.limit(0), "label", trees=3)


def test_rows_find_their_place_by_bits():
    rng = np.random.default_rng(2)
    for depth, n in ((1, 5), (8, 130), (11, 200)):  # below the ninth level rows look up their tests
        feature, cut = rng.integers(0, 4, (3, 2 ** (depth + 1) - 1)).astype(np.int16), rng.integers(0, 31, (3, 2 ** (depth + 1) - 1)).astype(np.uint8)
        feature[:, 2**depth - 1 :] = -1
        feature[0, 2 % 2**depth :: 7], feature[2] = -1, -1
        for i in range(1, feature.shape[1]):
            feature[:, i] = np.where(feature[:, (i - 1) // 2] < 0, -1, feature[:, i])
        bins, share = rng.integers(0, 32, (n, 4)).astype(np.uint8), rng.random(feature.shape)
        pairs, which = forest._asked(feature, cut, depth)
        tests, ends, alive = forest._tests(np.ascontiguousarray(bins.T), pairs), forest._ends(feature, share), forest._alive(feature, depth)
        for t in range(3):
            place = forest._places(tests, which[t], depth, n)
            for row, at in zip(bins, place.tolist()):
                node = 0
                while feature[t, node] >= 0:
                    node = 2 * node + 1 + int(row[feature[t, node]] > cut[t, node])
                assert ends[t, at] == share[t, node]
                assert alive[t, at] == (node >= 2**depth - 1) and (not alive[t, at] or node == 2**depth - 1 + at)


def test_draws_of_many_rows_have_their_mean_and_spread():
    table = forest._draws().reshape(-1, 65536).astype(float)
    assert (table[0] == forest.DRAWS).all()
    assert np.allclose(table.mean(1), forest.SIZES, rtol=1e-4) and np.allclose(table.var(1), forest.SIZES, rtol=1e-3)
    n = np.r_[1, 31, 32, 1000, 200_001]
    own, size = forest._sized(n)
    assert (np.bincount(own, forest.SIZES[size]) == n).all()


def repeated_rows(spark, n=6_000):
    rng = np.random.default_rng(8)
    x = rng.integers(0, [5, 4, 3, 2, 2, 2, 2, 2, 2], (n, 9))  # nine features take two words
    y = ((x[:, 0] > 2) ^ (x[:, 1] > 1) ^ (rng.random(n) < 0.1)).astype(int)
    x[: n // 4], y[: n // 4] = 0, 0
    names = [f"x{i}" for i in range(9)]
    rows = [(i, int(t), 1.0 + 2 * int(t), *map(float, r)) for i, (r, t) in enumerate(zip(x, y))]
    schema = "id int, label int, weight double, " + ", ".join(f"{c} double" for c in names)
    return lineage.materialize(features.assemble(spark.createDataFrame(rows, schema), names).repartition(4, "id"))


def test_rows_of_equal_bins_are_worked_on_once(spark, monkeypatch):
    rows, stored, real = repeated_rows(spark), [], forest._blocks
    apart = models.random_forest(rows, "label", trees=60, depth=5, weight="weight")
    monkeypatch.setattr(forest, "GROUP_FROM", 6_000, raising=False)
    monkeypatch.setattr(forest, "_blocks", lambda *a: stored.append(real(*a)) or stored[-1])
    fit = models.random_forest(rows, "label", trees=60, depth=5, weight="weight")
    found, sums, kept = {}, np.zeros((60, 2)), 0
    for r in stored[0].collect():
        bins, y, w = np.frombuffer(r.bins, np.uint8).reshape(-1, 9), np.frombuffer(r.label, np.uint8), np.frombuffer(r.weight)
        size, kept = np.frombuffer(r["size"], np.uint8), kept + len(y)
        for key, n in zip(zip(map(tuple, bins), y, w), forest.SIZES[size]):
            found[key] = found.get(key, 0) + n
        for t in range(60):
            u = np.random.default_rng([42, t, r.block]).integers(0, 65536, len(y), np.uint16)
            sums[t] += np.bincount(y, w * forest._draws().reshape(-1, 65536)[size, u], 2)
    known, cuts = {}, fit.cuts
    for r in rows.collect():
        key = (tuple(int(np.searchsorted(c, v)) for c, v in zip(cuts, r.features)), r.label, r.weight)
        known[key] = known.get(key, 0) + 1
    assert found == known and kept < 6_000 and max(known.values()) > 1_400
    assert np.allclose(fit.share[:, 0], sums / sums.sum(1, keepdims=True))
    auc = [metrics.roc_auc(models.predict_proba(m, rows), "label", "p").first().auc for m in (apart, fit)]
    assert min(auc) > 0.85 and abs(auc[0] - auc[1]) < 0.01
    assert np.allclose(apart.featureImportances.toArray(), fit.featureImportances.toArray(), atol=0.05)
    again = models.random_forest(rows, "label", trees=60, depth=5, weight="weight")
    assert (again.feature == fit.feature).all() and (again.cut == fit.cut).all()


def test_long_sums_meet_in_pieces(spark):
    rows = spark.range(1_000).repartition(7)

    def block(batches):
        total = np.zeros(20_001)
        for batch in batches:
            np.add.at(total, 19 * batch.column(0).to_numpy(), 1.5)
        return total

    want = np.zeros(20_001)
    want[np.arange(1_000) * 19] = 1.5
    assert (blocks.long_sum(rows, block, 20_001) == want).all()
    assert (blocks.long_sum(rows.limit(0), block, 20_001) == 0).all()


def grid_rows(spark, n=1500, p=4, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, p)) * np.arange(1, p + 1)
    y = (rng.random(n) < 1 / (1 + np.exp(-x @ np.linspace(-1, 1, p) - 0.3))).astype(int)
    names = [f"x{i}" for i in range(p)]
    rows = [(i, int(i % 5), int(y[i]) if i % 97 else None, 1.0 + i % 3, *map(float, x[i])) for i in range(n)]
    schema = "id int, fold int, label int, weight double, " + ", ".join(f"{c} double" for c in names)
    return features.assemble(spark.createDataFrame(rows, schema), names), names


def newton(x, y, s, c, rounds=60):
    x = np.column_stack([x, np.ones(len(x))])
    w, ridge = np.zeros(x.shape[1]), np.r_[np.full(x.shape[1] - 1, 1 / c), 0]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ w))
        w = w - np.linalg.solve((x.T * (s * p * (1 - p))) @ x + np.diag(ridge), x.T @ (s * (p - y)) + ridge * w)
    return w


def test_grid_fits_equal_single_fits(spark, monkeypatch):
    rows, names = grid_rows(spark)
    grid = [(c, fold, w) for c in (0.01, 1.0, 100.0) for fold in (0, 1, 2, 3, 4) for w in (False, True)]
    passes = []
    monkeypatch.setattr(logistic, "block_sum", lambda *a: passes.append(1) or blocks.block_sum(*a))
    fits = logistic.fit_logistics(rows, "label", grid, fold="fold", weight="weight")
    assert len(fits) == 30 and all(f.converged for f in fits) and len(passes) < 20
    pdf = rows.filter("label is not null").toPandas()
    for (c, fold, weighted), fit in zip(grid, fits):
        own = pdf[pdf["fold"] != fold]
        s = own["weight"].to_numpy() if weighted else np.ones(len(own))
        want = newton(own[names].to_numpy(), own["label"].to_numpy(), s, c)
        assert np.allclose([*fit.coefficients, fit.intercept], want, rtol=1e-6, atol=1e-8)


def test_wide_tables_take_first_order_steps(spark, monkeypatch):
    rows, names = grid_rows(spark)
    by_curvature = logistic.fit_logistics(rows, "label", [(1.0, None, False), (50.0, None, True)], weight="weight")
    monkeypatch.setattr(logistic, "NEWTON_FEATURES", 2)
    by_gradient = logistic.fit_logistics(rows, "label", [(1.0, None, False), (50.0, None, True)], weight="weight")
    for a, b in zip(by_curvature, by_gradient):
        assert b.converged and np.allclose([*a.coefficients, a.intercept], [*b.coefficients, b.intercept], atol=1e-4)


def test_fits_say_when_they_fail(spark, monkeypatch):
    rows, _ = grid_rows(spark, 200)
    one_class = rows.withColumn("label", F.lit(1))
    assert not models.logistic_regression(one_class, "label").converged
    with pytest.raises(ValueError, match="no row"):
        models.logistic_regression(rows.limit(0), "label")
    holes = features.assemble(spark.createDataFrame([(1, None), (0, 2.0)], "label int, a double"), ["a"], invalid="keep")
    with pytest.raises(ValueError, match="missing"):
        models.logistic_regression(holes, "label")
    monkeypatch.setattr(logistic, "PASSES", 2)
    out = models.cross_validate(rows, "label", 5, [1.0], weight="weight").collect()
    assert len(out) == 2 and not any(r.converged for r in out) and all(r.passes == 2 for r in out)


def test_search_areas_are_exact(spark):
    rows, names = grid_rows(spark, 900)
    out = {(r.c, r.weighted): r for r in models.cross_validate(rows, "label", 5, [0.1, 10.0], weight="weight").collect()}
    pdf = rows.filter("label is not null").toPandas()
    assert len(out) == 4 and all(r.converged for r in out.values())
    for (c, weighted), r in out.items():
        areas = []
        for fold in range(5):
            own, test = pdf[pdf["fold"] != fold], pdf[pdf["fold"] == fold]
            s = own["weight"].to_numpy() if weighted else np.ones(len(own))
            w = newton(own[names].to_numpy(), own["label"].to_numpy(), s, c)
            areas.append(brute_auc(test["label"].to_numpy(), test[names].to_numpy() @ w[:-1]))
        assert r.auc == pytest.approx(np.mean(areas), abs=1e-9)


def test_areas_by_group(spark):
    rng = np.random.default_rng(4)
    rows = [(int(g), int(rng.integers(0, 2)), float(rng.integers(0, 9)) / 8) for g in (1, 2, 3) for _ in range(300)] + [(4, 1, 0.5), (None, 1, 0.1)]
    df = spark.createDataFrame(rows, "g int, y int, s double")
    got = {r.g: r.auc for r in metrics.roc_auc_by(df, "g", "y", "s").collect()}
    for g in (1, 2, 3):
        own = [r for r in rows if r[0] == g]
        assert got[g] == pytest.approx(brute_auc(np.array([r[1] for r in own]), np.array([r[2] for r in own])))
    assert got[4] is None and set(got) == {1, 2, 3, 4}


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return np.mean((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :]))


def test_auc_ties_and_monotone_maps(table):
    scored = table.withColumn("s", F.round(F.col("a"), 1))
    pdf = local(scored)
    want = brute_auc(pdf["label"].to_numpy(), pdf["s"].to_numpy())
    assert metrics.roc_auc(scored, "label", "s").first().auc == pytest.approx(want)
    assert metrics.roc_auc(scored.withColumn("s", F.exp("s")), "label", "s").first().auc == pytest.approx(want)
    assert metrics.roc_auc(scored, "label", "s", invert=True).first().auc == pytest.approx(1 - want)


def test_auc_with_a_hot_score_and_one_class(spark):
    df = spark.range(9_000).select(
        (F.col("id") % 5 == 0).cast("int").alias("y"),
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") / 9_000).alias("s"),
    )
    pdf = df.toPandas()
    assert metrics.roc_auc(df, "y", "s").first().auc == pytest.approx(brute_auc(pdf["y"].to_numpy(), pdf["s"].to_numpy()))
    assert metrics.roc_auc(df.withColumn("y", F.lit(1)), "y", "s").first().auc is None


def test_published_counts(spark):
    cells = spark.createDataFrame(
        [("svm", 9276, 385, 222, 117), ("forest", 9232, 429, 268, 71)], "model string, tn long, fp long, fn long, tp long"
    )
    got = {r.model: r for r in metrics.misclassification_cost(metrics.rates(cells)).collect()}
    assert [round(got["svm"][k], 3) for k in ("precision", "recall", "f1")] == [0.233, 0.345, 0.278]
    assert [round(got["forest"][k], 3) for k in ("precision", "recall", "f1")] == [0.142, 0.209, 0.169]
    assert (got["svm"].cost, got["forest"].cost) == (2605.0, 3109.0)


def test_zero_division_gives_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    assert tuple(metrics.binary_metrics(df, "y", "p").first()) == (1.0, 0.0, 0.0, 0.0)


def test_hull_against_brute_force(spark):
    rng = np.random.default_rng(5)
    xy = rng.normal(size=(300, 2)).round(2)
    rows = [("a", float(x), float(y)) for x, y in xy] + [("line", float(i), float(i)) for i in range(5)]
    df = spark.createDataFrame(rows, "c string, x double, y double").repartition(6)
    got = clustering.cluster_hulls(df, "c", "x", "y").orderBy("c", "corner").collect()
    assert {r.c for r in got} == {"a"}
    corners = np.array([[r.x, r.y] for r in got])
    nxt = np.roll(corners, -1, axis=0)
    side = nxt - corners
    # every point lies on the inner side of every edge, and every corner is a point
    for p in xy:
        assert np.all(side[:, 0] * (p[1] - corners[:, 1]) - side[:, 1] * (p[0] - corners[:, 0]) >= -1e-9)
    assert {tuple(c) for c in corners} <= {tuple(p) for p in xy}


def test_clusters_of_separate_blobs(spark):
    rng = np.random.default_rng(2)
    xy = np.vstack([rng.normal(c, 0.3, (100, 2)) for c in ((0, 0), (10, 0), (0, 10))])
    df = spark.createDataFrame([(float(x), float(y)) for x, y in xy], "x double, y double")
    points = clustering.feature_table(df, ["x", "y"])
    elbow = {r.k: r.cost for r in clustering.kmeans_elbow(points, range(2, 5)).collect()}
    assert elbow[2] > 10 * elbow[3]
    fit = clustering.kmeans_fit(points, ["x", "y"], 3)
    assert clustering.silhouette(fit.points).first().grade == "strong"
    centers = sorted((round(r.x), round(r.y)) for r in fit.original_centers().collect())
    assert centers == [(0, 0), (0, 10), (10, 0)]
    profile = clustering.cluster_profile(fit.points, "cluster", ["x", "y"], "x").collect()
    assert sorted(r.size for r in profile) == [100, 100, 100] and {r["rank"] for r in profile} == {1, 2, 3}


@pytest.fixture(scope="module")
def readings(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(2_000, 3))
    x[:20] += 8
    rows = [(i, *map(float, r), int(i < 20)) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, planted int").repartition(4)


def test_isolation_forest_ranks_planted_rows_first(readings):
    out = anomaly.score_isolation_forest(readings, ["id"], ["a", "b", "c"], trees=60)
    assert out.filter("pred = -1").count() == 100
    worst = out.orderBy("score").limit(20).collect()
    assert sum(r.planted for r in worst) >= 18
    low, high = out.agg(F.min("score"), F.max("score")).first()
    assert -1 <= low < high < 0
    assert anomaly.evaluate_anomaly(out, "planted", "pred", "score").first().auc > 0.98
    assert anomaly.expected_path(256) == pytest.approx(10.2448, abs=1e-3)


def test_one_class_machine_flags_about_nu(readings):
    out = anomaly.score_one_class_machine(readings, ["a", "b", "c"], nu=0.05)
    assert out.filter("pred = -1").count() == 100
    assert out.filter("pred = -1 and planted = 1").count() >= 15
    assert out.orderBy("score").first().planted == 1


def test_one_class_machine_comes_close_to_the_best(readings):
    machine = anomaly.one_class_machine(readings, ["a", "b", "c"], nu=0.05)
    x = readings.select("a", "b", "c").toPandas().to_numpy()
    phi = np.sqrt(2 / len(machine.shift)) * np.cos(x @ machine.omega + machine.shift)
    w = phi.mean(0)
    for _ in range(3_000):  # many small steps towards the lowest 5 %
        gap = w - phi[np.argpartition(phi @ w, 100)[:100]].mean(0)
        w = w - np.clip(w @ gap / (gap @ gap), 0, 1) * gap
    assert machine.weights @ machine.weights == pytest.approx(w @ w, rel=0.02)


def exact_machine(x, nu, gamma, rounds=60_000):
    """The dual with the full kernel matrix, weight moved between two rows at a time."""
    kernel = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(2))
    n, cap = len(x), 1 / (nu * len(x))
    alpha = np.full(n, 1 / n)
    slope = kernel @ alpha
    for _ in range(rounds):
        up, down = int(np.where(alpha < cap, slope, np.inf).argmin()), int(np.where(alpha > 0, slope, -np.inf).argmax())
        if slope[down] - slope[up] < 1e-9:
            break
        step = min(cap - alpha[up], alpha[down], (slope[down] - slope[up]) / (2 - 2 * kernel[up, down]))
        alpha[up] += step
        alpha[down] -= step
        slope += step * (kernel[up] - kernel[down])
    return slope


def ranks(values):
    return np.argsort(np.argsort(values))


def test_one_class_machine_orders_rows_as_the_exact_kernel(spark):
    rng = np.random.default_rng(12)
    x = np.concatenate([rng.normal(size=(380, 3)), rng.normal(scale=4, size=(20, 3))])
    rows = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "i int, a double, b double, c double").repartition(3)
    machine = anomaly.one_class_machine(rows, ["a", "b", "c"], nu=0.1, features=2048, tolerance=1e-4)
    assert machine.converged and machine.gap <= 1e-4 and machine.steps < 60
    scores = [r.score for r in machine.margin(rows).orderBy("i").collect()]
    exact = exact_machine(x, 0.1, 1 / (3 * x.var()))
    assert np.corrcoef(ranks(scores), ranks(exact))[0, 1] > 0.95
    assert len(set(np.argsort(scores)[:20]) & set(np.argsort(exact)[:20])) >= 17


def test_one_class_machine_reports_its_gap(readings, monkeypatch):
    cols = ["a", "b", "c"]
    done = anomaly.one_class_machine(readings, cols)
    assert done.converged and 0 <= done.gap <= anomaly.TOLERANCE and done.steps < 40
    monkeypatch.setattr(anomaly, "STEPS", 3)
    early = anomaly.one_class_machine(readings, cols)
    assert not early.converged and early.steps == 3 and early.gap > anomaly.TOLERANCE
    # The bound holds: no mix is shorter than the present one by more than the gap.
    best, now = done.weights @ done.weights, early.weights @ early.weights
    assert now * (1 - early.gap) <= best <= now
    with pytest.raises(ValueError, match="no row"):
        anomaly.one_class_machine(readings.limit(0), cols)


def test_one_class_machine_in_single_precision(spark, monkeypatch):
    """Large tables are fitted on rounded cosines of packed rows; path and scores stay, also far from zero."""
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=(5_900, 3)), rng.normal(scale=5, size=(100, 3))]) + [2000.0, -40.0, 0.0]
    rows = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "i int, a double, b double, c double").repartition(3)
    exact = anomaly.one_class_machine(rows, ["a", "b", "c"])
    monkeypatch.setattr(anomaly, "SINGLE_FROM", 0)
    rounded = anomaly.one_class_machine(rows, ["a", "b", "c"])
    assert rounded.steps == exact.steps and rounded.converged and rounded.gap == pytest.approx(exact.gap, abs=1e-6)
    assert np.allclose(rounded.weights, exact.weights, atol=1e-7)
    few = x[:1000]
    phi = np.concatenate([part.copy() for _, part in exact.cosines(few)])
    assert np.allclose(phi, np.cos(few @ exact.omega + exact.shift), rtol=0, atol=1e-12)


def test_packed_rows(spark):
    df = spark.range(5_000).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("b")).repartition(3)
    matrix = lambda batch: np.column_stack([v.to_numpy(zero_copy_only=False) for v in batch.columns])
    table = blocks.packed(df, matrix)
    assert table.count() < 100
    moments = lambda batches: sum((np.r_[len(x), x.sum(0)] for x in (blocks.unpacked(b, 2) for b in batches)), np.zeros(3))
    assert blocks.block_sum(table, moments, 3).tolist() == [5_000, 12_497_500, 24_995_000]
    assert blocks.block_sum(blocks.packed(df.limit(0), matrix), moments, 3).tolist() == [0, 0, 0]


def test_strangers_are_counted_without_one_task(spark, monkeypatch):
    """Strange rows among the lowest scores, with ties at the cut and rows without a score."""
    count = closed_forms._strangers_first
    monkeypatch.setattr(DataFrame, "limit", None)
    for scores, found in (([1, 2, 3, 4], 2), ([1, 3, 2, 4], 1), ([5, 5, 5, 9], 1), ([None, 7, 1, 2], 1), ([9, 8, None, 1], 0)):
        rows = [(int(i < 2), None if s is None else float(s)) for i, s in enumerate(scores)]
        got = count(spark.createDataFrame(rows, "strange int, score double")).collect()
        assert [(r.strange, r.found) for r in got] == [(2, found)], scores


def test_slices_are_found_by_halving(spark):
    """Any number of cut points in a column, fewer than said too; nothing is at or below an unknown value."""
    for n in (0, 1, 2, 3, 7, 8, 31):
        cuts = [float(i) for i in range(0, 2 * n, 2)]
        rows = spark.range(-2, 2 * n + 2).select((F.col("id") / 1.0).alias("v"), F.array(*map(F.lit, cuts)).cast("array<double>").alias("cuts"))
        got = {r.v: r.s for r in rows.select("v", ordering.slice_of(F.col("v"), F.col("cuts"), n + 2).alias("s")).collect()}
        assert got == {v: sum(x <= v for x in cuts) for v in got}
    plan = rows.select(ordering.slice_of(F.col("v"), F.col("cuts"), 31))._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(" not in plan  # the number of comparisons does not grow with the partitions


def test_logistic_passes_read_packed_rows(spark, monkeypatch):
    rows, _ = grid_rows(spark, 700)
    seen = []
    real = blocks.block_sum
    monkeypatch.setattr(logistic, "block_sum", lambda df, *a: seen.append(df.count()) or real(df, *a))
    assert logistic.fit_logistics(rows, "label", [(1.0, None, False)])[0].converged
    assert seen and max(seen) <= 20  # some 70 rows to a value


def test_outlines_of_many_parts(spark, monkeypatch):
    """Rounds over small groups give the outline of all points; a circle, which no round can reduce, ends too."""
    rng = np.random.default_rng(3)
    blob = rng.normal(size=(4000, 2))
    turn = np.arange(300) * 2 * np.pi / 300
    circle = np.column_stack([np.cos(turn), np.sin(turn)]) * 50
    rows = [("blob", *map(float, p)) for p in blob] + [("circle", *map(float, p)) for p in circle]
    rows += [(None, 1e9, 1e9), ("blob", None, 1e9), ("line", 0.0, 0.0), ("line", 1.0, 1.0), ("line", 2.0, 2.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(200)
    seen = []
    monkeypatch.setattr(clustering, "GROUP_POINTS", 60)
    monkeypatch.setattr(clustering, "materialize", lambda d: seen.append(1) or lineage.materialize(d))
    out = {}
    for r in clustering.cluster_hulls(df, "g", "x", "y").orderBy("g", "corner").collect():
        out.setdefault(r.g, []).append((r.x, r.y))
    assert len(seen) > 2 and set(out) == {"blob", "circle"}
    assert np.allclose(out["blob"], clustering.hull_points(blob)) and np.allclose(out["circle"], clustering.hull_points(circle))


def test_shared_passes_are_as_good_as_single_fits(spark, monkeypatch):
    from pyspark.ml.clustering import KMeans

    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(c, 1, (300, 3)) for c in (0, 6, 12, 1000)])
    rows = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "i int, a double, b double, c double").repartition(4)
    points = features.assemble(rows, ["a", "b", "c"])
    passes = []
    monkeypatch.setattr(clustering, "block_sum", lambda *a: passes.append(1) or blocks.block_sum(*a))
    fits = clustering.kmeans_grid(points, range(1, 8))
    assert all(f.converged for f in fits) and len(passes) == max(f.passes for f in fits) < 60
    assert fits[0].cost == pytest.approx(((x - x.mean(0)) ** 2).sum()) and np.allclose(fits[0].centres, x.mean(0))
    for f in fits[1:]:
        single = KMeans(k=f.k, seed=42).fit(points).summary.trainingCost
        assert f.cost <= 1.02 * single
        nearest = ((x[:, None] - f.centres[None]) ** 2).sum(2)
        assert f.cost == pytest.approx(nearest.min(1).sum(), rel=1e-9)
    costs = [f.cost for f in fits]
    assert costs == sorted(costs, reverse=True)


def test_clusters_of_few_rows(spark):
    same = features.assemble(spark.createDataFrame([(1.0, 2.0)] * 5, "a double, b double"), ["a", "b"])
    fit = clustering.kmeans_grid(same, [3])[0]
    assert fit.cost == 0 and fit.converged and np.allclose(fit.centres, [[1, 2]])
    with pytest.raises(ValueError, match="no rows"):
        clustering.kmeans_grid(same.limit(0), [2])


def test_shortest_mix():
    square = np.array([[1.0, 1.0], [3.0, -1.0], [5.0, 5.0]])
    assert np.allclose(anomaly.shortest_mix(square), [1.0, 1.0])
    assert np.allclose(anomaly.shortest_mix(np.array([[1.0, 2.0], [1.0, -2.0]])), [1.0, 0.0])


def test_alert_counts_add_up(readings):
    levelled = anomaly.alert_levels(readings, "a")
    rows = {r.level: r for r in anomaly.alert_summary(levelled, "planted").collect()}
    assert sum(r.n for r in rows.values()) == 2_000
    assert (rows["Critical"].n, rows["Caution"].n) == (200, 300)
    sweep = anomaly.threshold_sweep(readings, "planted", "a").orderBy("percent").collect()
    assert [round(r.flagged) for r in sweep] == [20, 18, 16, 14, 12, 10, 8, 6, 4, 2]


def test_additive_forecast_follows_trend_and_waves(spark):
    day = F.col("id")
    df = spark.range(900).select(
        F.date_add(F.lit("2018-01-01").cast("date"), day.cast("int")).alias("d"),
        (100 + 0.1 * day + 10 * F.sin(day * 2 * 3.141592653589793 / 365.25) + F.when(day % 7 == 0, 7.0).otherwise(0.0)).alias("y"),
    )
    model = forecast.additive_forecast(df, "d", "y")
    rows = model.predict(90).orderBy("ds").collect()
    assert len(rows) == 990 and all(r.yhat_lower < r.yhat < r.yhat_upper for r in rows)
    for i in (905, 950, 985):
        truth = 100 + 0.1 * i + 10 * np.sin(i * 2 * np.pi / 365.25) + (7 if i % 7 == 0 else 0)
        assert rows[i].yhat == pytest.approx(truth, abs=6)
    parts = model.components(0).orderBy("ds").collect()
    assert parts[10].trend + parts[10].weekly + parts[10].yearly == pytest.approx(rows[10].yhat)
