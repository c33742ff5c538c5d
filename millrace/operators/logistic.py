"""Many logistic regressions fitted together: one pass over the table per Newton step for all of them."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.blocks import block_sum, matrix, packed, unpacked
from millrace.operators.lineage import materialize

#: Newton steps gather a square of this many numbers per model; wider tables take first-order steps.
NEWTON_FEATURES = 200
#: A model is done when a full step would lower its loss by less than this share.
TOLERANCE = 1e-12
#: Passes after which the fit ends; what has not converged says so.
PASSES = 60
#: Remembered steps of the first-order method.
MEMORY = 10
#: Numbers of the rows that a pass holds in the processor's cache together.
CHUNK = 10_000


@dataclass
class LogisticFit:
    """Coefficients of one model, how it was fitted and whether the fit came to its end."""

    c: float
    held_out: int | None
    weighted: bool
    features: str
    coefficients: DenseVector
    intercept: float
    loss: float
    passes: int
    converged: bool

    def probability(self) -> Column:
        x = vector_to_array(F.col(self.features))
        weights = F.array(*[F.lit(float(w)) for w in self.coefficients])
        margin = F.aggregate(F.zip_with(x, weights, lambda a, b: a * b), F.lit(self.intercept), lambda s, v: s + v)
        return 1.0 / (1.0 + F.exp(-margin))


@dataclass
class _Search:
    """One model on its way: where it stands, where it was sent, what it has learnt."""

    c: float
    held_out: int | None
    weighted: bool
    at: np.ndarray
    trial: np.ndarray
    way: np.ndarray | None = None
    slope: float = 0.0
    share: float = 1.0
    loss: float = math.inf
    grad: np.ndarray | None = None
    passes: int = 0
    state: str = "open"
    steps: list = field(default_factory=list)

    def learn(self, loss: float, grad: np.ndarray, hessian: np.ndarray | None) -> None:
        """Takes the trial if it lowers the loss enough, else half the way; then sets out again."""
        self.passes += 1
        w = np.r_[self.trial[:-1], 0.0]
        loss, grad = loss + w @ w / (2 * self.c), grad + w / self.c
        if not np.isfinite(loss):
            self.state = "failed"
            return
        # Differences below the digits of the loss count as none.
        if self.way is not None and loss > self.loss + 1e-4 * self.share * self.slope + 1e-13 * abs(self.loss):
            self.share /= 2
            if self.share < 1e-10:
                self.state = "failed"
            self.trial = self.at + self.share * self.way
            return
        if self.grad is not None:
            self.steps = [*self.steps, (self.trial - self.at, grad - self.grad)][-MEMORY:]
        self.at, self.loss, self.grad = self.trial, loss, grad
        if hessian is not None:
            full = hessian + np.diag(np.r_[np.full(len(w) - 1, 1 / self.c), 1e-300])
            self.way = -np.linalg.lstsq(full, grad, rcond=None)[0]
        else:
            self.way = -self._two_loops(grad)
        self.slope = float(grad @ self.way)
        if -self.slope <= TOLERANCE * max(abs(loss), 1e-300):
            self.state = "converged"
        self.share = 1.0
        self.trial = self.at + self.way
        if self.state == "converged" and hessian is not None:
            self.at = self.trial  # the last step squares what error is left

    def _two_loops(self, grad: np.ndarray) -> np.ndarray:
        """The gradient under the curvature that the last steps have shown."""
        used = [(s, g, 1 / (s @ g)) for s, g in self.steps if s @ g > 0]
        if not used:
            return grad / max(np.linalg.norm(grad), 1e-300)
        q, taken = grad.copy(), []
        for s, g, r in reversed(used):
            a = r * (s @ q)
            q -= a * g
            taken.append(a)
        s, g, _ = used[-1]
        q *= (s @ g) / (g @ g)
        for (s, g, r), a in zip(used, reversed(taken)):
            q += (a - r * (g @ q)) * s
        return q


def _prepared(df: DataFrame, y: str, features: str, fold: str | None, weight: str | None) -> DataFrame:
    """x, y, w, fold of the rows with a label, written once for all passes."""
    rows = df.filter(F.col(y).isNotNull()).select(
        vector_to_array(F.col(features)).alias("x"), F.col(y).cast("double").alias("y"),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
        (F.col(fold).cast("int") if fold else F.lit(-1)).alias("fold"),
    )
    return materialize(rows.filter("fold is not null"), spread=True)


def _numbers(batch: pa.RecordBatch) -> np.ndarray:
    """x, a one for the intercept, y, w and fold of every row."""
    x = matrix(batch.column(0))
    return np.column_stack([x, np.ones(len(x)), *(batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))])


def _pass(rows: DataFrame, searches: list[_Search], size: int, newton: bool) -> list[tuple]:
    """(loss, gradient, curvature) of every model at its trial, all summed in one pass over packed rows."""
    each = 1 + size + (size * size if newton else 0)
    plan = [(s.held_out, s.weighted, s.trial) for s in searches]

    places = np.column_stack([at for _, _, at in plan])

    def block(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((len(plan), each))
        step = max(1, CHUNK // size)
        for batch in batches:
            table = unpacked(batch, size + 3)
            for i in range(0, len(table), step):
                add(total, table[i : i + step])
        return total.ravel()

    def add(total: np.ndarray, table: np.ndarray) -> None:
        x = np.ascontiguousarray(table[:, :size])
        y, w, fold = np.ascontiguousarray(table[:, size:].T)
        shares = {key: (w if key[1] else 1.0) * (1.0 if key[0] is None else fold != key[0]) * np.ones(len(y)) for key in {p[:2] for p in plan}}
        margin = np.ascontiguousarray((x @ places).T)
        small = np.exp(-np.abs(margin))
        p = np.where(margin >= 0, 1.0, small) / (1.0 + small)
        loss = np.maximum(margin, 0.0) + np.log1p(small) - y * margin
        bend = p * (1.0 - p)
        for k, (held_out, weighted, _) in enumerate(plan):
            weight = shares[held_out, weighted]
            total[k, 0] += weight @ loss[k]
            total[k, 1 : 1 + size] += (weight * (p[k] - y)) @ x
            if newton:
                total[k, 1 + size :] += (x.T @ (x * (weight * bend[k])[:, None])).ravel()

    sums = block_sum(rows, block, len(plan) * each).reshape(len(plan), each)
    return [(s[0], s[1 : 1 + size], s[1 + size :].reshape(size, size) if newton else None) for s in sums]


def fit_logistics(
    df: DataFrame,
    y: str,
    grid: Sequence[tuple[float, int | None, bool]],
    features: str = "features",
    fold: str | None = None,
    weight: str | None = None,
) -> list[LogisticFit]:
    """One L2-penalised model per (c, fold held out or None, weighted) of the grid, in that order.

    `c` is the inverse penalty on the summed loss, the intercept has none. All models that
    are still open are evaluated in the same pass over the table: loss, gradient and, up to
    NEWTON_FEATURES features, curvature; wider tables take limited-memory steps from
    gradients alone. A model that has converged leaves the passes. Rows without a label or
    fold take no part; a training part with one class only has no finite intercept, which
    shows as not converged. Features must not be missing.
    """
    rows = _prepared(df, y, features, fold, weight)
    seen = rows.agg(F.max(F.size("x")).alias("size"), F.max(F.exists("x", lambda v: v.isNull() | F.isnan(v))).alias("holes")).first()
    if seen["size"] is None:
        raise ValueError("no row with a label to fit on")
    if seen["holes"]:
        raise ValueError("missing values in the features")
    size = seen["size"] + 1
    rows = packed(rows, _numbers)
    newton = size <= NEWTON_FEATURES + 1
    searches = [_Search(float(c), held_out, weighted, np.zeros(size), np.zeros(size)) for c, held_out, weighted in grid]
    limit = PASSES if newton else 10 * PASSES
    for _ in range(limit):
        going = [s for s in searches if s.state == "open"]
        if not going:
            break
        for s, found in zip(going, _pass(rows, going, size, newton)):
            s.learn(*found)
    return [
        LogisticFit(s.c, s.held_out, s.weighted, features, Vectors.dense(s.at[:-1]), float(s.at[-1]), s.loss, s.passes, s.state == "converged")
        for s in searches
    ]


def held_out_scores(df: DataFrame, y: str, fits: Sequence[LogisticFit], fold: str = "fold") -> DataFrame:
    """(model, y, p): every labelled row under each model that did not see its fold; one pass for all.

    `model` is the model's place in `fits`.
    """
    features = fits[0].features
    plan = [(f.held_out, np.r_[f.coefficients.toArray(), f.intercept]) for f in fits]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(0))
            folds = batch.column(2).to_numpy(zero_copy_only=False)
            for k, (held_out, at) in enumerate(plan):
                own = np.flatnonzero(folds == held_out)
                if len(own):
                    p = 0.5 * (1 + np.tanh((x[own] @ at[:-1] + at[-1]) / 2))
                    columns = [pa.array(np.full(len(own), k, np.int32)), batch.column(1).take(pa.array(own)), pa.array(p)]
                    yield pa.RecordBatch.from_arrays(columns, ["model", "y", "p"])

    known = df.filter(F.col(y).isNotNull() & F.col(fold).isNotNull())
    rows = known.select(vector_to_array(F.col(features)).alias("x"), F.col(y).cast("double").alias("y"), F.col(fold).cast("int").alias("fold"))
    return rows.mapInArrow(score, "model int, y double, p double")
