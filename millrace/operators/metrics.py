"""Evaluation of classifiers, regressions and scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordering import order_cuts, running_totals, running_totals_by
from millrace.operators.profiling import histogram


def _or_zero(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num, den), F.lit(0.0))


def confusion(df: DataFrame, y: str, pred: str) -> DataFrame:
    """One row: tn, fp, fn, tp of 0/1 columns."""
    truth, said = F.col(y) == 1, F.col(pred) == 1
    return df.agg(
        F.count_if(~truth & ~said).alias("tn"),
        F.count_if(~truth & said).alias("fp"),
        F.count_if(truth & ~said).alias("fn"),
        F.count_if(truth & said).alias("tp"),
    )


def rates(cells: DataFrame) -> DataFrame:
    """accuracy, precision, recall and f1 from tn, fp, fn, tp; 0 where a ratio has no cases."""
    tn, fp, fn, tp = (F.col(x).cast("double") for x in ("tn", "fp", "fn", "tp"))
    return cells.withColumns(
        {
            "accuracy": _or_zero(tp + tn, tp + tn + fp + fn),
            "precision": _or_zero(tp, tp + fp),
            "recall": _or_zero(tp, tp + fn),
            "f1": _or_zero(2 * tp, 2 * tp + fp + fn),
        }
    )


def binary_metrics(df: DataFrame, y: str, pred: str) -> DataFrame:
    return rates(confusion(df, y, pred)).select("accuracy", "precision", "recall", "f1")


def class_report(df: DataFrame, y: str, pred: str) -> DataFrame:
    """(label, precision, recall, f1, support) per class plus 'macro avg' and 'weighted avg'."""
    cells = df.groupBy(F.col(y).cast("string").alias("y"), F.col(pred).cast("string").alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # each cell counts once for its true class and once for its predicted class
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(F.col("y").alias("label"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("said")),
                F.struct(F.col("p").alias("label"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("said")),
            )
        ).alias("side"),
        F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("hit"),
    )
    per_class = (
        sides.groupBy(F.col("side.label").alias("label"))
        .agg(
            F.sum("side.actual").alias("support"),
            F.sum("side.said").alias("said"),
            (F.sum("hit") / 2).alias("hit"),
        )
        .select(
            "label",
            _or_zero(F.col("hit"), F.col("said")).alias("precision"),
            _or_zero(F.col("hit"), F.col("support")).alias("recall"),
            _or_zero(2 * F.col("hit"), F.col("said") + F.col("support")).alias("f1"),
            "support",
        )
    )
    scores = ("precision", "recall", "f1")
    macro = per_class.agg(
        F.lit("macro avg").alias("label"), *[F.avg(x).alias(x) for x in scores], F.sum("support").alias("support")
    )
    weighted = per_class.agg(
        F.lit("weighted avg").alias("label"),
        *[(F.sum(F.col(x) * F.col("support")) / F.sum("support")).alias(x) for x in scores],
        F.sum("support").alias("support"),
    )
    return per_class.unionByName(macro).unionByName(weighted)


def score_totals(df: DataFrame, y: str, score: str, invert: bool = False) -> DataFrame:
    """(score, pos, neg, pos_upto, neg_upto, pos_all, neg_all) per distinct score.

    Equal scores merge before the shuffle; the running sums never meet in one task.
    """
    s = -F.col(score) if invert else F.col(score)
    scored = df.select(s.cast("double").alias("score"), (F.col(y) == 1).alias("hit")).filter(
        F.col("score").isNotNull() & F.col("hit").isNotNull()
    )
    counts = scored.groupBy("score").agg(
        F.count_if("hit").alias("pos"), F.count_if(~F.col("hit")).alias("neg")
    )
    return running_totals(counts, "score", ["pos", "neg"], order_cuts(scored, "score"))


def roc_auc(df: DataFrame, y: str, score: str, invert: bool = False) -> DataFrame:
    """One row: area under the ROC curve; tied scores count half. Null with a single class."""
    totals = score_totals(df, y, score, invert)
    below = (F.col("neg_upto") - F.col("neg")).cast("double")
    area = F.sum(F.col("pos") * (below + 0.5 * F.col("neg")))
    pairs = F.max("pos_all").cast("double") * F.max("neg_all")
    return totals.agg(F.try_divide(area, pairs).alias("auc"))


def roc_auc_by(df: DataFrame, by: str, y: str, score: str) -> DataFrame:
    """(by, auc): exact area per group, all groups in one job; null for a group of a single class."""
    scored = df.select(by, F.col(score).cast("double").alias("score"), (F.col(y) == 1).alias("hit")).dropna()
    counts = scored.groupBy(by, "score").agg(F.count_if("hit").alias("pos"), F.count_if(~F.col("hit")).alias("neg"))
    totals = running_totals_by(counts, by, "score", ["pos", "neg"])
    below = (F.col("neg_upto") - F.col("neg")).cast("double")
    area = F.sum(F.col("pos") * (below + 0.5 * F.col("neg")))
    pairs = F.max("pos_all").cast("double") * F.max("neg_all")
    return totals.groupBy(by).agg(F.try_divide(area, pairs).alias("auc"))


def roc_points(df: DataFrame, y: str, score: str, invert: bool = False) -> DataFrame:
    """(cut, fpr, tpr) for every distinct score used as `score >= cut`."""
    totals = score_totals(df, y, score, invert)
    tp = F.col("pos_all") - F.col("pos_upto") + F.col("pos")
    fp = F.col("neg_all") - F.col("neg_upto") + F.col("neg")
    return totals.select(
        F.col("score").alias("cut"),
        F.try_divide(fp, F.col("neg_all")).alias("fpr"),
        F.try_divide(tp, F.col("pos_all")).alias("tpr"),
    )


def pr_points(df: DataFrame, y: str, score: str, invert: bool = False) -> DataFrame:
    """(cut, precision, recall) for every distinct score used as `score >= cut`."""
    totals = score_totals(df, y, score, invert)
    tp = F.col("pos_all") - F.col("pos_upto") + F.col("pos")
    fp = F.col("neg_all") - F.col("neg_upto") + F.col("neg")
    return totals.select(
        F.col("score").alias("cut"),
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, F.col("pos_all")).alias("recall"),
    )


def regression_metrics(
    df: DataFrame, y: str, pred: str, lower: str | None = None, upper: str | None = None
) -> DataFrame:
    """One row: r2, rmse, mae, mape (percent, rows with y = 0 left out) and interval coverage if limits are given."""
    error = F.col(y) - F.col(pred)
    measures = [
        (1 - F.try_divide(F.sum(error * error), F.var_pop(y) * F.count(y))).alias("r2"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.avg(F.abs(F.try_divide(error, F.col(y)))) * 100.0).alias("mape"),
    ]
    if lower and upper:
        inside = (F.col(y) >= F.col(lower)) & (F.col(y) <= F.col(upper))
        measures.append((F.avg(inside.cast("int")) * 100.0).alias("coverage"))
    return df.dropna(subset=[y, pred]).agg(*measures)


def compare_models(rows: dict[str, DataFrame], digits: int = 4) -> DataFrame:
    """One row per model from one-row metric frames, rounded."""
    named = [
        frame.select(F.lit(name).alias("model"), *[F.round(c, digits).alias(c) for c in frame.columns])
        for name, frame in rows.items()
    ]
    return reduce(DataFrame.unionByName, named)


def majority_baseline(df: DataFrame, y: str) -> DataFrame:
    """One row: most frequent class (lowest on ties) and the accuracy of always saying it."""
    counts = df.dropna(subset=[y]).groupBy(F.col(y).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.min_by("label", F.struct(-F.col("n"), F.col("label"))).alias("label"),
        (F.max("n") / F.sum("n")).alias("accuracy"),
    )


def probability_histogram(df: DataFrame, p: str, y: str, bins: int = 25) -> DataFrame:
    """Counts of predicted probability per true class."""
    return histogram(df, p, bins, [y])


def misclassification_cost(cells: DataFrame, fn_cost: float = 10.0, fp_cost: float = 1.0) -> DataFrame:
    """Confusion rows with cost = fn_cost * fn + fp_cost * fp."""
    return cells.withColumn("cost", fn_cost * F.col("fn") + fp_cost * F.col("fp"))
