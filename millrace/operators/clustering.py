"""K-means with elbow, silhouette, profiles and outlines."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.numeric import SILHOUETTE_BANDS, grade
from millrace.operators.blocks import block_sum, matrix
from millrace.operators.features import assemble, inverse_minmax, minmax_scale
from millrace.operators.lineage import materialize
from millrace.operators.sizing import broadcast_if_small


def feature_table(df: DataFrame, cols: Sequence[str], scaled: bool = True) -> DataFrame:
    """Rows with a vector of the columns, stretched to [0, 1] unless told not to.

    Written once, because every later step passes over it again and again.
    """
    present = df.dropna(subset=list(cols))
    inputs = [f"__f_{c}" for c in cols]
    copied = present.withColumns({f: F.col(c).cast("double") for f, c in zip(inputs, cols)})
    wide = minmax_scale(copied, inputs) if scaled else copied
    return materialize(assemble(wide, inputs).drop(*inputs))


#: Rows that starting centres are chosen from, about; every later step reads all rows.
SEED_ROWS = 20_000
#: Starts tried on those rows for each number of clusters.
STARTS = 4
#: A fit ends when a step lowers its cost by no more than this share.
TOLERANCE = 1e-9
#: Passes after which fits end anyway; what has not converged says so.
PASSES = 100


@dataclass
class Centres:
    """One fit of k clusters: its centres, cost, and whether it came to its end in `passes`."""

    k: int
    centres: np.ndarray
    cost: float
    passes: int
    converged: bool


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centre and squared distance to it."""
    far = (centres * centres).sum(1) - 2 * x @ centres.T
    at = far.argmin(1)
    return at, ((x - centres[at]) ** 2).sum(1)


def _start(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Centres drawn one by one with the squared distance to those before, the best of a few draws refined on x."""
    best, least = x[:1], np.inf
    for _ in range(STARTS):
        centres = x[rng.integers(len(x))][None]
        distance = ((x - centres[0]) ** 2).sum(1)
        while len(centres) < k and distance.sum() > 0:
            new = x[rng.choice(len(x), p=distance / distance.sum())]
            centres = np.vstack([centres, new])
            distance = np.minimum(distance, ((x - new) ** 2).sum(1))
        for _ in range(20):
            at, _ = _nearest(x, centres)
            counts = np.bincount(at, minlength=len(centres))
            sums = np.zeros_like(centres)
            np.add.at(sums, at, x)
            centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
        cost = _nearest(x, centres)[1].sum()
        if cost < least:
            best, least = centres, cost
    return best


def kmeans_grid(points: DataFrame, ks: Iterable[int], seed: int = 42, features: str = "features") -> list[Centres]:
    """One fit per number of clusters, all moved on by the same passes over the table.

    Starting centres come from about SEED_ROWS rows. In a pass every task assigns its rows to
    the nearest centre of each fit that is still open and returns counts, sums and costs,
    which meet by position. A fit ends when its cost stands still; a centre without rows
    stays where it is. With fewer different rows than k there are fewer centres.
    """
    rows = points.select(vector_to_array(F.col(features)).alias("x"))
    n = rows.count()
    if not n:
        raise ValueError("no rows to cluster")
    some = rows.filter(F.rand(seed) < min(1.0, SEED_ROWS / n)).toArrow() if n > SEED_ROWS else rows.toArrow()
    sample = matrix(some.column("x").combine_chunks())
    middle = sample.mean(0)  # distances are taken from here, which keeps their digits
    rng = np.random.default_rng(seed)
    fits = [Centres(k, _start(sample - middle, k, rng), np.inf, 0, False) for k in ks]
    width = len(middle)

    while going := [f for f in fits if not f.converged and f.passes < PASSES]:
        plan = [f.centres for f in going]
        sizes = [len(c) * (width + 1) + 1 for c in plan]

        def block(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            counts, sums = [np.zeros(len(c)) for c in plan], [np.zeros((len(c), width)) for c in plan]
            costs = np.zeros(len(plan))
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = matrix(batch.column(0)) - middle
                for i, centres in enumerate(plan):
                    at, distance = _nearest(x, centres)
                    costs[i] += distance.sum()
                    counts[i] += np.bincount(at, minlength=len(centres))
                    order = np.argsort(at, kind="stable")
                    found, first = np.unique(at[order], return_index=True)
                    sums[i][found] += np.add.reduceat(x[order], first, axis=0)
            return np.concatenate([np.r_[c, s.ravel(), [cost]] for c, s, cost in zip(counts, sums, costs)])

        total = block_sum(rows, block, sum(sizes))
        for f, found in zip(going, np.split(total, np.cumsum(sizes)[:-1])):
            counts, sums, cost = found[: len(f.centres)], found[len(f.centres) : -1].reshape(-1, width), float(found[-1])
            f.passes += 1
            f.converged = f.cost - cost <= TOLERANCE * cost
            f.cost = cost
            if not f.converged:
                f.centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], f.centres)
    for f in fits:
        f.centres = f.centres + middle
    return fits


def kmeans_elbow(points: DataFrame, ks: Iterable[int] = range(2, 11), seed: int = 42) -> DataFrame:
    """(k, cost): within-cluster squared distance for each k, all fitted together."""
    rows = [(f.k, f.cost) for f in kmeans_grid(points, ks, seed)]
    return points.sparkSession.createDataFrame(rows, "k int, cost double")


#: Corners of one cluster that a task reduces at a time, about.
GROUP_POINTS = 100_000


@dataclass
class Clusters:
    """Fitted clusters and the points with their `cluster`."""

    centers: list[list[float]]
    points: DataFrame
    cols: list[str]
    scaled: bool

    def original_centers(self) -> DataFrame:
        """(cluster, one column per input) in the units of the inputs."""
        spark = self.points.sparkSession
        schema = "cluster int, " + ", ".join(f"`{c}` double" for c in self.cols)
        frame = spark.createDataFrame([(i, *c) for i, c in enumerate(self.centers)], schema)
        return inverse_minmax(frame, self.cols, self.points) if self.scaled else frame


def kmeans_fit(points: DataFrame, cols: Sequence[str], k: int, seed: int = 42, scaled: bool = True) -> Clusters:
    model = KMeans(k=k, seed=seed, predictionCol="cluster").fit(points)
    centers = [[float(x) for x in c] for c in model.clusterCenters()]
    return Clusters(centers, model.transform(points), list(cols), scaled)


def silhouette(points: DataFrame, cluster: str = "cluster") -> DataFrame:
    """One row: squared-distance silhouette (linear in the rows) and its grade."""
    value = ClusteringEvaluator(predictionCol=cluster, metricName="silhouette").evaluate(points)
    row = points.sparkSession.createDataFrame([(float(value),)], "silhouette double")
    return row.withColumn("grade", grade("silhouette", SILHOUETTE_BANDS, "none"))


def cluster_profile(df: DataFrame, cluster: str, cols: Sequence[str], rank_by: str) -> DataFrame:
    """(cluster, size, mean of each column, rank): rank 1 is the lowest mean of `rank_by`."""
    means = df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("size"), *[F.avg(c).alias(f"avg_{c}") for c in cols]
    )
    # one row per cluster is left here
    order = Window.partitionBy(F.lit(0)).orderBy(f"avg_{rank_by}", cluster)
    return means.withColumn("rank", F.row_number().over(order))


def hull_points(xy: np.ndarray) -> np.ndarray:
    """Corners of the convex outline, counter-clockwise, by a sorted sweep."""
    unique = np.unique(xy, axis=0)
    if len(unique) < 3:
        return unique

    def sweep(points: np.ndarray) -> list[np.ndarray]:
        chain: list[np.ndarray] = []
        for p in points:
            while len(chain) > 1:
                (ax, ay), (bx, by) = chain[-2], chain[-1]
                if (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax) > 0:
                    break
                chain.pop()
            chain.append(p)
        return chain[:-1]

    return np.array(sweep(unique) + sweep(unique[::-1]))


def cluster_hulls(df: DataFrame, cluster: str, x: str, y: str) -> DataFrame:
    """(cluster, corner, x, y): convex outline of every cluster with at least three corners.

    Each task first reduces its own rows to the corners of their outline, so only a few
    points per task and cluster travel, however many rows a cluster holds. Where the corners
    of a cluster are still more than GROUP_POINTS, they are dealt into groups of about half
    that size and each group is reduced again, round by round, so the last group is small
    too; only corners that no round can drop, those of the outline itself, may be more.
    Rows without a cluster or a coordinate are left out.
    """
    kind = dict(df.dtypes)[cluster]
    points = df.select(cluster, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[object, np.ndarray] = {}
        for batch in batches:
            for label, rows in batch.groupby(cluster):
                xy = rows[["x", "y"]].to_numpy()
                kept[label] = hull_points(np.vstack([kept[label], xy]) if label in kept else xy)
        for label, xy in kept.items():
            yield pd.DataFrame({cluster: label, "x": xy[:, 0], "y": xy[:, 1]})

    def outline(rows: pd.DataFrame) -> pd.DataFrame:
        xy = hull_points(rows[["x", "y"]].to_numpy())
        if len(xy) < 3:
            xy = xy[:0]
        return pd.DataFrame(
            {cluster: rows[cluster].iloc[0], "corner": np.arange(len(xy), dtype="int32"), "x": xy[:, 0], "y": xy[:, 1]}
        )

    def reduce(rows: pd.DataFrame) -> pd.DataFrame:
        xy = hull_points(rows[["x", "y"]].to_numpy())
        return pd.DataFrame({cluster: rows[cluster].iloc[0], "x": xy[:, 0], "y": xy[:, 1]})

    corners = f"`{cluster}` {kind}, x double, y double"
    partial = materialize(points.mapInPandas(local, corners))
    before = None
    while True:
        sizes = partial.groupBy(cluster).agg(F.count(F.lit(1)).alias("__n"))
        most = sizes.agg(F.max("__n")).first()[0] or 0
        if most <= GROUP_POINTS or most == before:
            break
        groups = F.ceil(2 * F.col("__n") / GROUP_POINTS)
        dealt = partial.join(broadcast_if_small(sizes), cluster).withColumn("__group", F.pmod(F.xxhash64("x", "y"), groups))
        partial = materialize(dealt.drop("__n").groupBy(cluster, "__group").applyInPandas(reduce, corners))
        before = most
    return partial.groupBy(cluster).applyInPandas(outline, f"`{cluster}` {kind}, corner int, x double, y double")
