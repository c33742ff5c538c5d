"""Regression and classification, from training to importance tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.numeric import as_flag
from millrace.operators.features import Preparation, assemble
from millrace.operators.forest import Forest, grow_forest
from millrace.operators.logistic import LogisticFit, fit_logistics, held_out_scores
from millrace.operators.metrics import roc_auc_by
from millrace.operators.quantiles import exact_quantiles
from millrace.operators.sizing import broadcast_if_small


@dataclass
class LinearFit:
    """Coefficients by name, in the units of the inputs."""

    names: list[str]
    weights: list[float]
    intercept: float

    def predict(self, df: DataFrame, out: str = "predicted") -> DataFrame:
        """Plain column arithmetic, so scoring stays in generated code."""
        total: Column = F.lit(self.intercept)
        for name, weight in zip(self.names, self.weights):
            total = total + F.lit(weight) * F.col(name)
        return df.withColumn(out, total)

    def coefficients(self, df: DataFrame) -> DataFrame:
        """(term, coefficient), the intercept included, largest first."""
        rows = [*zip(self.names, self.weights), ("intercept", self.intercept)]
        return df.sparkSession.createDataFrame(rows, "term string, coefficient double").orderBy(F.desc("coefficient"))


def linear_regression(train: DataFrame, y: str, xs: Sequence[str]) -> LinearFit:
    """Ordinary least squares by normal equations: one pass, one small matrix on the driver."""
    return ridge_regression(train, y, xs, 0.0)


def ridge_regression(train: DataFrame, y: str, xs: Sequence[str], alpha: float) -> LinearFit:
    """min ||y - Xw||^2 + alpha ||w||^2 with a free intercept."""
    s = train.dropna(subset=[y, *xs]).agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(y).alias("std")).first()
    rows = assemble(train.dropna(subset=[y, *xs]), xs).select("features", F.col(y).cast("double").alias("label"))
    # MLlib divides the penalty by the deviation of the label
    penalty = alpha * (s["std"] or 1.0) / s["n"] if alpha else 0.0
    model = LinearRegression(
        solver="normal", regParam=penalty, elasticNetParam=0.0, standardization=False
    ).fit(rows)
    return LinearFit(list(xs), [float(w) for w in model.coefficients], float(model.intercept))


def prediction_table(fit: LinearFit, df: DataFrame, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., actual, predicted, error), rounded to 2 digits."""
    scored = fit.predict(df)
    return scored.select(
        *keys,
        F.round(y, 2).alias("actual"),
        F.round("predicted", 2).alias("predicted"),
        F.round(F.col(y) - F.col("predicted"), 2).alias("error"),
    )


def logistic_regression(
    train: DataFrame, y: str, features: str = "features", c: float = 1.0, weight: str | None = None
) -> LogisticFit:
    """L2-penalised logistic regression; `c` is the inverse penalty on the summed loss.

    Newton steps, each one pass; the fit tells whether it converged.
    """
    return fit_logistics(train, y, [(c, None, weight is not None)], features, weight=weight)[0]


def random_forest(
    train: DataFrame, y: str, features: str = "features", trees: int = 300, depth: int = 8,
    weight: str | None = None, seed: int = 42,
) -> Forest:
    """Random forest; the weight column carries balanced class weights."""
    return grow_forest(train, y, features, trees, depth, weight, seed)


def predict_proba(model: LogisticFit | Forest, df: DataFrame, out: str = "p") -> DataFrame:
    """Rows with the probability of class 1."""
    return df.withColumn(out, model.probability())


def predict_class(df: DataFrame, p: str = "p", cut: float = 0.5, out: str = "pred") -> DataFrame:
    """1 where the probability reaches the cut."""
    return df.withColumn(out, as_flag(F.col(p) >= cut))


def feature_importance(model, prep: Preparation | Sequence[str], df: DataFrame) -> DataFrame:
    """(feature, weight): signed coefficients, or importances of a forest, by feature name."""
    names = prep.names if isinstance(prep, Preparation) else list(prep)
    values = model.coefficients if hasattr(model, "coefficients") else model.featureImportances
    rows = [(name, float(v)) for name, v in zip(names, values.toArray())]
    return df.sparkSession.createDataFrame(rows, "feature string, weight double").orderBy(
        F.desc(F.abs("weight")), "feature"
    )


def strongest_features(importance: DataFrame, k: int = 10) -> DataFrame:
    """(feature, weight, side): the k largest positive and k largest negative weights."""
    # one row per model input is ranked here
    up = importance.filter("weight > 0").orderBy(F.desc("weight"), "feature").limit(k)
    down = importance.filter("weight < 0").orderBy("weight", "feature").limit(k)
    return up.withColumn("side", F.lit("raises")).unionByName(down.withColumn("side", F.lit("lowers")))


def stratified_folds(df: DataFrame, label: str, hashed: Column, k: int) -> DataFrame:
    """Column `fold` in 0..k-1 with equal class shares in every fold; null where the label is null."""
    keyed = df.withColumn("__hash", hashed)
    cuts = exact_quantiles(keyed, ["__hash"], [i / k for i in range(1, k)], [label])
    cuts = cuts.groupBy(label).agg(F.collect_list("value").alias("__cuts"))  # k - 1 numbers per class
    marked = keyed.join(broadcast_if_small(cuts), label, "left")
    passed = F.size(F.filter("__cuts", lambda x: x <= F.col("__hash")))
    return marked.withColumn("fold", F.when(F.col("__cuts").isNotNull(), passed.cast("int"))).drop("__hash", "__cuts")


def cross_validate(
    folded: DataFrame, y: str, k: int, cs: Sequence[float], features: str = "features", weight: str | None = None
) -> DataFrame:
    """(c, weighted, auc, converged, passes): mean exact area under the curve over the folds, best first.

    The grid is every inverse penalty, without and, if `weight` names a column, also with
    row weights. All folds and grid points are fitted together, each pass over the table
    serves all models that are still open, and one job scores every row under the models
    that did not see it. `converged` holds if all fits of a grid point did. Rows without a
    label take no part; a fold with one class only has no area and is left out of the mean.
    """
    points = [(float(c), w) for w in ([False, True] if weight else [False]) for c in cs]
    grid = [(c, i, w) for c, w in points for i in range(k)]
    fits = fit_logistics(folded, y, grid, features, "fold", weight)
    found = roc_auc_by(held_out_scores(folded, y, fits), "model", y="y", score="p").collect()
    areas = {r["model"]: r["auc"] for r in found}
    rows = []
    for n, (c, w) in enumerate(points):
        own = range(n * k, n * k + k)
        measured = [areas[m] for m in own if areas.get(m) is not None]
        auc = sum(measured) / len(measured) if measured else None
        rows.append((c, w, auc, all(fits[m].converged for m in own), max(fits[m].passes for m in own)))
    schema = "c double, weighted boolean, auc double, converged boolean, passes int"
    return folded.sparkSession.createDataFrame(rows, schema).orderBy(F.desc("auc"), "c", "weighted")
