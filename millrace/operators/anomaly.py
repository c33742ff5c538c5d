"""Anomaly scores (isolation forest, one-class machine), alerts and their evaluation."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.numeric import as_flag
from millrace.operators import metrics
from millrace.operators.blocks import block_sum, packed, unpacked
from millrace.operators.lineage import materialize
from millrace.operators.quantiles import quantile_values
from millrace.operators.sizing import unpivot_row

# --- isolation forest ------------------------------------------------------

SAMPLE = 256
DEPTH = 8  # log2(SAMPLE)
EULER = 0.5772156649015329


def expected_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of a failed search among n values."""
    n = np.asarray(n, float)
    safe = np.maximum(n, 2.0001)
    deep = 2.0 * (np.log(safe - 1.0) + EULER) - 2.0 * (safe - 1.0) / safe
    return np.where(n > 2, deep, np.where(n == 2, 1.0, 0.0))


def tree_samples(df: DataFrame, ids: Sequence[str], cols: Sequence[str], trees: int, seed: int) -> DataFrame:
    """(tree, draw, cols...): about 300 rows per tree, drawn by a hash of the row key.

    Every row joins every tree with the same chance, 300 / rows, at any table size. The
    trees a row joins are found by geometric steps from one to the next, so a row of a
    large table mostly costs one hash. `ids` must name a row: rows that share one are
    drawn together.
    """
    chance = 300 / max(df.count(), 300)

    def step(i: Column) -> Column:
        if chance >= 1:
            return F.lit(1).cast("long")
        u = (F.pmod(F.xxhash64(F.lit(seed), i, *ids), F.lit(1 << 40)) + 0.5) / float(1 << 40)
        return F.floor(F.log(u) / F.lit(math.log1p(-chance))) + 1

    def onwards(state: Column, i: Column) -> Column:
        at = state["at"] + step(i)
        return F.struct(at.alias("at"), F.when(at < trees, F.concat(state["trees"], F.array(at))).otherwise(state["trees"]).alias("trees"))

    some = df.select(*ids, *cols).filter(step(F.lit(0)) <= trees)
    start = F.struct(F.lit(-1).cast("long").alias("at"), F.array().cast("array<bigint>").alias("trees"))
    joined = F.aggregate(F.sequence(F.lit(0), F.lit(trees - 1)), start, onwards)["trees"]
    return some.select(*ids, *cols, F.explode(joined).alias("tree")).select(
        F.col("tree").cast("int"),
        F.xxhash64(F.lit(seed + 3), "tree", *ids).alias("draw"),
        *[F.col(c).cast("double").alias(c) for c in cols],
    )


def grow_tree(x: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, cut, path length) of a full binary layout; closed nodes send all rows left."""
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    feature, cut, path = np.zeros(inner, np.int32), np.full(inner, np.inf), np.zeros(leaves)
    work = [(0, 0, x)]
    while work:
        node, depth, rows = work.pop()
        low, high = (rows.min(0), rows.max(0)) if len(rows) else (np.zeros(x.shape[1]),) * 2
        open_cols = np.flatnonzero(high > low)
        if depth == DEPTH or len(open_cols) == 0:
            leaf = node
            for _ in range(DEPTH - depth):
                leaf = 2 * leaf + 1
            path[leaf - inner] = depth + expected_path(len(rows))
            continue
        j = rng.choice(open_cols)
        at = rng.uniform(low[j], high[j])
        feature[node], cut[node] = j, at
        right = rows[:, j] >= at
        work.append((2 * node + 1, depth + 1, rows[~right]))
        work.append((2 * node + 2, depth + 1, rows[right]))
    return feature, cut, path


@dataclass
class IsolationForest:
    """Node tables of all trees (200 trees: about 4 MB) and the decision offset."""

    cols: list[str]
    feature: np.ndarray
    cut: np.ndarray
    path: np.ndarray
    sample: float

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        """Add the score, in [-1, 0); lower is stranger."""
        nodes = df.sparkSession.sparkContext.broadcast((self.feature, self.cut, self.path))
        usual = float(expected_path(self.sample))
        inner = self.feature.shape[1]

        def rate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            feature, cut, path = nodes.value
            for batch in batches:
                x = np.ascontiguousarray(batch.to_numpy(float).T)
                row = np.arange(x.shape[1])
                total = np.zeros(x.shape[1])
                for f, c, p in zip(feature, cut, path):
                    at = np.zeros(x.shape[1], np.int64)
                    for _ in range(DEPTH):
                        at = 2 * at + 1 + (x[f[at], row] >= c[at])
                    total += p[at - inner]
                score = -np.exp2(-total / len(path) / usual)
                yield pd.Series(np.where(np.isnan(x).any(0), np.nan, score))

        udf = F.pandas_udf(rate, T.DoubleType())
        return df.withColumn(out, F.nanvl(udf(F.struct(*[F.col(c).cast("double") for c in self.cols])), F.lit(None)))


def isolation_forest(df: DataFrame, ids: Sequence[str], cols: Sequence[str], trees: int = 200, seed: int = 42) -> IsolationForest:
    """Grow the trees in parallel, one group of at most a few hundred rows per tree."""
    cols = list(cols)
    samples = tree_samples(df.dropna(subset=cols), ids, cols, trees, seed)

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        tree = int(rows["tree"].iloc[0])
        x = rows.sort_values("draw")[cols].to_numpy(float)[:SAMPLE]
        feature, cut, path = grow_tree(x, np.random.default_rng([seed, tree]))
        return pd.DataFrame(
            {"tree": [tree], "size": [len(x)], "feature": [feature.tolist()], "cut": [cut.tolist()], "path": [path.tolist()]}
        )

    schema = "tree int, size int, feature array<int>, cut array<double>, path array<double>"
    grown = samples.groupBy("tree").applyInPandas(grow, schema).orderBy("tree").collect()  # one row per tree
    return IsolationForest(
        cols,
        np.array([r["feature"] for r in grown], np.int32),
        np.array([r["cut"] for r in grown], float),
        np.array([r["path"] for r in grown], float),
        float(np.mean([r["size"] for r in grown])),
    )


def decide(scored: DataFrame, score: str = "score", contamination: float = 0.05) -> DataFrame:
    """Add `decision` (score minus its contamination quantile) and `pred` (-1 strange, 1 normal)."""
    cut = quantile_values(scored, [score], {"cut": contamination})[f"{score}_cut"]
    decided = scored.withColumn("decision", F.col(score) - F.lit(cut))
    return decided.withColumn("pred", F.when(F.col("decision") < 0, -1).otherwise(1))


def score_isolation_forest(
    df: DataFrame, ids: Sequence[str], cols: Sequence[str], trees: int = 200, contamination: float = 0.05, seed: int = 42
) -> DataFrame:
    """Fit, score and decide.

    The rows are written once for the count, the draw and the scoring; the scores once
    for the offset and the result.
    """
    rows = materialize(df, spread=True)
    scored = materialize(isolation_forest(rows, ids, cols, trees, seed).score(rows))
    return decide(scored, "score", contamination)


# --- one-class machine -----------------------------------------------------


#: Stop when the squared length is proven to be within this share of the best.
TOLERANCE = 1e-3
#: Steps after which the fit ends with whatever gap is left; the machine carries the gap.
STEPS = 200
#: Margins around the nu quantile are sorted into so many bins in a pass.
BINS = 16
#: No vector of cosine features is longer.
LONGEST = math.sqrt(2.0)
#: Rows whose features are made, read and dropped together, so that they stay in the processor's cache.
CHUNK = 128
#: Tables of so many rows are fitted on cosines in single precision, as averages over their rows lose its rounding.
SINGLE_FROM = 200_000
#: cos(2 pi t) for |t| <= 1/2 as a polynomial in t^2, to 14 digits.
COSINE = np.polynomial.Chebyshev.interpolate(lambda u: np.cos(2 * np.pi * np.sqrt(u)), 10, [0.0, 0.25]).convert(kind=np.polynomial.Polynomial).coef


def cosine_of_turns(turns: np.ndarray, work: np.ndarray, out: np.ndarray) -> np.ndarray:
    """cos(2 pi turns); `turns` and `work` are used up."""
    turns -= np.rint(turns, out=work)
    square = np.square(turns, out=turns)
    out.fill(COSINE[-1])
    for c in COSINE[-2::-1]:
        out *= square
        out += c
    return out


@dataclass
class OneClassMachine:
    """One-class support machine on random cosine features.

    `gap` bounds the share by which the squared length of `weights` exceeds the least one;
    `converged` tells whether it came under the tolerance, `steps` in how many passes.
    """

    cols: list[str]
    omega: np.ndarray
    shift: np.ndarray
    weights: np.ndarray
    gap: float = math.inf
    steps: int = 0
    converged: bool = False

    def features(self, x: np.ndarray) -> np.ndarray:
        return math.sqrt(2.0 / len(self.shift)) * np.cos(x @ self.omega + self.shift)

    def cosines(self, x: np.ndarray, middle: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """Features before their common factor, a few rows at a time, with the place of the first.

        The next rows overwrite them. With the `middle` of the rows they are made in single
        precision: only what a row differs from it is rounded.
        """
        waves = np.vstack([self.omega, self.shift])
        x = np.column_stack([x, np.ones(len(x))])
        if middle is not None:
            waves[-1] = np.remainder(self.shift + middle @ self.omega, 2 * np.pi)
            x[:, :-1] -= middle
            x, waves = x.astype(np.float32), waves.astype(np.float32)
            out = np.empty((CHUNK, len(self.shift)), np.float32)
        else:
            waves /= 2 * np.pi
            turns, work, out = np.empty((3, CHUNK, len(self.shift)))
        for i in range(0, len(x), CHUNK):
            n = min(CHUNK, len(x) - i)
            if middle is not None:
                np.matmul(x[i : i + n], waves, out=out[:n])
                yield i, np.cos(out[:n], out=out[:n])
            else:
                np.matmul(x[i : i + n], waves, out=turns[:n])
                yield i, cosine_of_turns(turns[:n], work[:n], out[:n])

    def margin(self, df: DataFrame, out: str = "score") -> DataFrame:
        """Add w·phi(x); low values lie outside the usual region."""
        weights = math.sqrt(2.0 / len(self.shift)) * self.weights

        def rate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for batch in batches:
                score = np.empty(len(batch))
                for i, phi in self.cosines(np.ascontiguousarray(batch.to_numpy(float))):
                    score[i : i + len(phi)] = phi @ weights
                yield pd.Series(score)

        udf = F.pandas_udf(rate, T.DoubleType())
        return df.withColumn(out, udf(F.struct(*[F.col(c).cast("double") for c in self.cols])))


def _columns(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])


def _binned_features(
    df: DataFrame, machine: OneClassMachine, edges: np.ndarray, middle: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Rows and sum of phi per bin of the margin, in one pass: (counts, sums).

    Bin 0 lies below the first edge; rows above the last edge are in no bin and not summed.
    One number per bin and feature comes back, however large the table is. With the `middle`
    of the rows, `df` holds them packed and features are made in single precision.
    """
    bins = len(edges)

    width = len(machine.shift) + 1
    factor = math.sqrt(2.0 / len(machine.shift))
    kind = np.float64 if middle is None else np.float32
    weights = machine.weights if middle is None else (factor * machine.weights).astype(kind)

    def block(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((bins, width))
        for batch in batches:
            if middle is None:
                add(total, machine.features(_columns(batch)))
                continue
            for _, phi in machine.cosines(unpacked(batch, len(machine.cols)), middle):
                add(total, phi)
        if middle is not None:
            total[:, 1:] *= factor
        return total.ravel()

    def add(total: np.ndarray, phi: np.ndarray) -> None:
        bin_ = np.searchsorted(edges, (phi @ weights).astype(float), side="right")
        inside = np.flatnonzero(bin_ < bins)
        total[:, 0] += np.bincount(bin_[inside], minlength=bins)
        own = (bin_[inside] == np.arange(bins)[:, None]).astype(kind)
        total[:, 1:] += own @ (phi if len(inside) == len(phi) else phi[inside])

    total = block_sum(df, block, bins * width).reshape(bins, width)
    return total[:, 0].astype(np.int64), total[:, 1:]


def _shortest_shares(atoms: np.ndarray, share: np.ndarray, rounds: int) -> np.ndarray:
    gram = atoms @ atoms.T
    share = share.copy()
    for _ in range(rounds):
        slope = gram @ share
        best, worst = int(np.argmin(slope)), int(np.argmax(np.where(share > 0, slope, -np.inf)))
        bend = gram[best, best] + gram[worst, worst] - 2 * gram[best, worst]
        if slope[worst] - slope[best] < 1e-12 or bend <= 0:
            break
        moved = min(share[worst], (slope[worst] - slope[best]) / bend)
        share[best] += moved
        share[worst] -= moved
    return share


def shortest_mix(atoms: np.ndarray, rounds: int = 5_000) -> np.ndarray:
    """Shortest weighted average of a few vectors, moving weight from the worst to the best."""
    return _shortest_shares(atoms, np.full(len(atoms), 1.0 / len(atoms)), rounds) @ atoms


def one_class_machine(
    df: DataFrame, cols: Sequence[str], nu: float = 0.05, features: int = 256, seed: int = 42, tolerance: float = TOLERANCE
) -> OneClassMachine:
    """Fit on scaled columns with an RBF kernel of width 1 / (d * variance).

    The dual asks for the shortest average of phi in which no row weighs more than
    1 / (nu n). Each step is one pass: margins under the present weights are sorted into
    bins, the nu share of rows with the lowest ones is averaged, a share of the bin that
    the quantile falls into included, and the weights become the shortest mix of the
    averages found so far. The lower edge of that bin proves how short any average can
    be, so the gap is a bound and not an estimate. A margin moves by no more than
    the weights do, so the bins of the next pass hold the next quantile for certain and
    close in on it. Rows with a missing value are left out; a table without rows has no machine.
    Tables of SINGLE_FROM rows or more are packed and take their passes in single precision,
    whose rounding is far below the tolerance; scores are always in double precision.
    """
    cols = list(cols)
    table = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    cells = F.explode(F.array(*cols)).alias("x")
    variance = table.select(cells).agg(F.var_pop("x")).first()[0] or 1.0
    seen = table.agg(F.count(F.lit(1)), *[F.avg(c) for c in cols]).first()
    if not seen[0]:
        raise ValueError("no row without missing values to fit on")
    middle = np.array(seen[1:], float) if seen[0] >= SINGLE_FROM else None
    if middle is not None:
        table = packed(table, _columns)
    rng = np.random.default_rng(seed)
    omega = rng.normal(0.0, math.sqrt(2.0 / (len(cols) * variance)), (len(cols), features))
    shift = rng.uniform(0.0, 2.0 * math.pi, features)

    machine = OneClassMachine(cols, omega, shift, np.zeros(features))
    counts, sums = _binned_features(table, machine, np.array([math.inf]), middle)
    mass = nu * counts[0]
    machine.weights = sums[0] / counts[0]
    atoms, share = machine.weights[None, :], np.array([1.0])
    reach = LONGEST * float(np.linalg.norm(machine.weights))
    low, high = -reach, reach
    while machine.steps < STEPS:
        pad = 1e-9 + 1e-9 * max(abs(low), abs(high))  # rounding
        edges = np.linspace(low - pad, high + pad, BINS + 1)
        counts, sums = _binned_features(table, machine, edges, middle)
        machine.steps += 1
        upto = np.cumsum(counts)
        at = min(int(np.searchsorted(upto, mass)), BINS)  # the quantile lies in this bin
        rest = mass - (upto[at - 1] if at else 0)
        whole = sums[:at].sum(0)
        lowest = (whole + rest / max(counts[at], 1) * sums[at]) / mass
        length = float(machine.weights @ machine.weights)
        bound = float(machine.weights @ whole + rest * edges[max(at - 1, 0)]) / mass
        machine.gap = (length - bound) / length if length else 0.0
        machine.converged = machine.gap <= tolerance
        if machine.converged:
            break
        atoms, share = np.vstack([atoms, lowest]), np.append(share, 0.0)
        share = _shortest_shares(atoms, share, 20_000)
        atoms, share = atoms[share > 0], share[share > 0]
        moved = LONGEST * float(np.linalg.norm(share @ atoms - machine.weights))
        machine.weights = share @ atoms
        low, high = edges[max(at - 1, 0)] - moved, edges[min(at, BINS)] + moved
    return machine


def score_one_class_machine(df: DataFrame, cols: Sequence[str], nu: float = 0.05, seed: int = 42) -> DataFrame:
    """Fit, score and decide: about a `nu` share of the rows is marked -1, cut at the exact quantile of the scores."""
    rows = materialize(df.dropna(subset=list(cols)), spread=True)
    scored = materialize(one_class_machine(rows, cols, nu, seed=seed).margin(rows))
    return decide(scored, "score", nu)


# --- evaluation and alerts -------------------------------------------------


def evaluate_anomaly(df: DataFrame, label: str, pred: str, score: str) -> DataFrame:
    """One row: tn, fp, fn, tp, precision, recall, f1 and auc; pred is -1/1, low scores are strange."""
    marked = df.withColumn("__hit", as_flag(F.col(pred) == -1))
    cells = metrics.rates(metrics.confusion(marked, label, "__hit"))
    auc = metrics.roc_auc(df, label, score, invert=True).scalar()
    return cells.select("tn", "fp", "fn", "tp", "precision", "recall", "f1").withColumn("auc", auc)


def level_of(score: Column, critical: Column, caution: Column) -> Column:
    return (
        F.when(score <= critical, "Critical").when(score <= caution, "Caution").when(score.isNotNull(), "Normal")
    )


def alert_levels(df: DataFrame, score: str, critical: float = 0.10, caution: float = 0.25) -> DataFrame:
    """Add `level` from the two score quantiles of the whole table."""
    q = quantile_values(df, [score], {"critical": critical, "caution": caution})
    cuts = [F.lit(q[f"{score}_{name}"]) for name in ("critical", "caution")]
    return df.withColumn("level", level_of(F.col(score), *cuts))


def alert_summary(levelled: DataFrame, label: str) -> DataFrame:
    """(level, n, failures, failure_share): share is the percent of all failures in the level."""
    counts = levelled.groupBy("level").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("failures")
    )
    total = levelled.agg(F.sum(F.col(label).cast("bigint"))).scalar()
    return counts.withColumn("failure_share", F.try_divide(F.col("failures") * 100.0, total))


def threshold_sweep(df: DataFrame, label: str, score: str, percents: Sequence[int] = tuple(range(80, 99, 2))) -> DataFrame:
    """(percent, cut, captured, flagged): failures caught and readings marked at each percentile.

    All cuts come from one ranking pass and all counts from one aggregate.
    """
    q = quantile_values(df, [score], {str(p): 1 - p / 100 for p in percents})
    cuts = {p: F.lit(q[f"{score}_{p}"]) for p in percents}
    hit = F.col(label) == 1
    row = df.agg(
        F.count_if(hit).alias("positives"),
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(hit & (F.col(score) <= cut)).alias(f"hit{p}") for p, cut in cuts.items()],
        *[F.count_if(F.col(score) <= cut).alias(f"n{p}") for p, cut in cuts.items()],
    )
    return unpivot_row(
        row,
        [
            F.struct(
                F.lit(p).alias("percent"),
                cut.alias("cut"),
                F.coalesce(F.try_divide(F.col(f"hit{p}") * 100.0, F.col("positives")), F.lit(0.0)).alias("captured"),
                F.try_divide(F.col(f"n{p}") * 100.0, F.col("rows")).alias("flagged"),
            )
            for p, cut in cuts.items()
        ],
    )


def score_timeline(df: DataFrame, key: str, label: str, score: str) -> DataFrame:
    """(key, score, level, label) in key order: the table behind the alert chart."""
    return alert_levels(df.select(key, score, label), score).orderBy(key)
