"""Random forests grown level by level: one pass over binned rows for a level of many trees."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.blocks import long_sum, matrix
from millrace.operators.lineage import materialize

#: A column is cut into at most so many bins.
BINS = 32
#: Rows of one stored block at most; its draws follow from its number.
BLOCK_ROWS = 10_000
#: Rows that are worked on together: long enough for cheap steps, short enough for the cache.
TOGETHER = 60_000
#: Bits that their tests have, at most.
TEST_BITS = 2**27
#: Levels in which the rows of each node are a mask.
MASKED = 9
#: Numbers that a pass sums, about; a level of more trees takes several passes.
PASS_NUMBERS = 2_000_000
#: From so many rows on, those with equal bins, label and weight are counted and stored once.
GROUP_FROM = 1_000_000
#: Rows that one stored row can stand for; other numbers are sums of these.
SIZES = np.array([*range(1, 32), *(32 << i for i in range(11))])


def _poisson(mean: int) -> np.ndarray:
    """Share of each count of a Poisson draw, in 65,536 parts."""
    counts = np.arange(int(mean + 8 * math.sqrt(mean) + 16))
    logs = counts * math.log(mean) - np.r_[0, np.cumsum(np.log(counts[1:]))] - mean
    upto = np.rint(np.cumsum(np.exp(logs)) * 65536).astype(int)
    return np.repeat(counts, np.diff(np.r_[0, upto])).astype(np.uint16)


#: Draws of one row.
DRAWS = _poisson(1)


@lru_cache(1)
def _draws() -> np.ndarray:
    """Draws of stored rows by number of their size and 16 random bits: as often as its rows come up together."""
    return np.concatenate([_poisson(int(n)) for n in SIZES])


@dataclass
class Forest:
    """Trees in heap order: `feature` (-1 at a leaf), `cut` (bins above it go right) and class shares of every node."""

    features: str
    cuts: list[np.ndarray]
    feature: np.ndarray
    cut: np.ndarray
    share: np.ndarray
    featureImportances: DenseVector

    def probability(self) -> Column:
        """Mean share of class 1 in the leaves that a row falls into."""
        levels, ends = _depth(self.feature), _ends(self.feature, self.share[:, :, 1])
        pairs, which = _asked(self.feature, self.cut, levels)
        cuts, most = self.cuts, _together(pairs)

        def rate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            held, rows = [], 0
            for batch in batches:
                held.append(batch)
                rows += len(batch)
                if rows >= most:
                    yield from scores(held)
                    held, rows = [], 0
            yield from scores(held)

        def scores(batches: list[pa.Array]) -> Iterator[pa.Array]:
            full = [matrix(b) for b in batches if len(b)]
            p = np.zeros(sum(map(len, full)))
            if full:
                bins = _binned(np.concatenate(full), cuts)
                tests = _tests(np.ascontiguousarray(bins.T), pairs)
                for own, end in zip(which, ends):
                    p += end.take(_places(tests, own, levels, len(p)))
            for part in np.split(p / len(ends), np.cumsum([len(b) for b in batches])[:-1]) if batches else ():
                yield pa.array(part)

        return F.arrow_udf(rate, T.DoubleType())(vector_to_array(F.col(self.features)))


def _binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """The number of cuts below each value; missing ones lie above all."""
    return np.column_stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)]).astype(np.uint8)


def _depth(feature: np.ndarray) -> int:
    return int(math.log2(feature.shape[1] + 1)) - 1


def _asked(feature: np.ndarray, cut: np.ndarray, levels: int) -> tuple[list[tuple[int, int]], np.ndarray]:
    """The different (feature, cut) that nodes above a level ask for, and by tree and node the number of its own.

    A leaf has the number after the last, a test that no row passes.
    """
    f, c = (v[:, : 2**levels - 1].astype(int) for v in (feature, cut))
    codes = np.where(f >= 0, f * BINS + c, -1)
    known = np.unique(codes[codes >= 0])
    return [divmod(int(k), BINS) for k in known], np.where(codes >= 0, np.searchsorted(known, codes), len(known))


def _tests(columns: np.ndarray, pairs: list[tuple[int, int]]) -> np.ndarray:
    """A bit per row for each (feature, cut): whether its bin lies above; 64 rows to a word."""
    n = columns.shape[1]
    bits = np.zeros((len(pairs) + 1, -(-n // 64) * 8), np.uint8)
    for own, (f, c) in zip(bits, pairs):
        own[: -(-n // 8)] = np.packbits(columns[f] > c, bitorder="little")
    return bits.view(np.uint64)


def _together(pairs: list) -> int:
    return min(TOGETHER, TEST_BITS // (len(pairs) + 1))


def _places(tests: np.ndarray, which: np.ndarray, levels: int, n: int) -> np.ndarray:
    """Where in a level each row arrives, from left to right; below a leaf it keeps to the left.

    The rows of a node are a mask of bits, so a step down costs few operations on words. All
    left children come before all right ones, so that a mask is cut in place. Where nodes are
    many, each row looks up its own test.
    """
    place, masked = np.zeros(n, np.min_scalar_type(2**levels - 1)), min(levels, MASKED)
    masks, order = np.empty((2**masked, tests.shape[1]), np.uint64), np.zeros(1, int)
    masks[0] = ~np.uint64(0)
    for k in range(masked):
        here, right = masks[: 2**k], masks[2**k : 2 ** (k + 1)]
        tests.take(which[2**k - 1 + order], 0, right, "clip")
        right &= here
        place += place
        place |= np.unpackbits(np.bitwise_or.reduce(right, axis=0).view(np.uint8), count=n, bitorder="little")
        if k + 1 < masked:
            here ^= right
            order = np.r_[2 * order, 2 * order + 1]
    row = np.arange(n)
    for k in range(masked, levels):
        at = which[2**k - 1 + place.astype(int)]
        place += place
        place |= tests.view(np.uint8)[at, row >> 3] >> (row & 7).astype(np.uint8) & 1
    return place


def _alive(feature: np.ndarray, level: int) -> np.ndarray:
    """By tree and node of a level: whether all nodes above it were cut."""
    alive = np.ones((len(feature), 1), bool)
    for k in range(level):
        alive = np.repeat(alive & (feature[:, 2**k - 1 : 2 ** (k + 1) - 1] >= 0), 2, 1)
    return alive


def _ends(feature: np.ndarray, share: np.ndarray) -> np.ndarray:
    """By tree and place in the last level: the share of the node, or of the leaf above it."""
    ends = share[:, :1]
    for k in range(_depth(feature)):
        cut = np.repeat(feature[:, 2**k - 1 : 2 ** (k + 1) - 1] >= 0, 2, 1)
        ends = np.where(cut, share[:, 2 ** (k + 1) - 1 : 2 ** (k + 2) - 1], np.repeat(ends, 2, 1))
    return np.ascontiguousarray(ends)


def _cut_points(rows: DataFrame, width: int) -> list[np.ndarray]:
    """Up to BINS - 1 cuts per feature, between its least and greatest value and the quantiles."""
    marks = [i / (BINS - 1) for i in range(1, BINS - 1)]
    asked = []
    for j in range(width):
        v = F.get("x", F.lit(j))
        v = F.when(~F.isnan(v), v)
        asked.append(F.concat(F.array(F.min(v), F.max(v)), F.percentile_approx(v, marks, 10_000)))
    found = rows.agg(*[a.alias(f"c{j}") for j, a in enumerate(asked)]).first()
    values = [np.unique(np.array([v for v in (c or []) if v is not None], float)) for c in found]
    return [(v[1:] + v[:-1]) / 2 for v in values]


def _blocks(rows: DataFrame, cuts: list[np.ndarray], group: bool = False) -> DataFrame:
    """(block, bins, label, weight): the rows, binned, BLOCK_ROWS to a value, written once for all passes.

    With `group`, rows that the trees cannot tell apart are one stored row each, or a few:
    what n of them add to a sum is their weight times a Poisson draw with mean n. The column
    `size` has the number in SIZES of the rows that a stored one stands for.
    """
    width = len(cuts)
    keys = [f"k{i}" for i in range(-(-width // 8))]

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bins = np.zeros((batch.num_rows, 8 * len(keys)), np.uint8)
            bins[:, :width] = _binned(matrix(batch.column(0)), cuts)
            y, w = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            if not ((y >= 0) & (y == np.floor(y)) & (y < 100) & np.isfinite(w)).all():
                raise ValueError("labels must be 0, 1, ... and weights known")
            cells = [*(pa.array(k) for k in bins.view(np.int64).T), pa.array(y.astype(np.int16)), pa.array(w)]
            yield pa.RecordBatch.from_arrays(cells, [*keys, "y", "w"])

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            if not batch.num_rows:
                continue
            *words, y, w = (c.to_numpy(zero_copy_only=False) for c in batch.columns[: len(keys) + 2])
            cells = [np.column_stack(words).view(np.uint8)[:, :width], y.astype(np.uint8), w]
            if group:
                own, size = _sized(batch.column(len(keys) + 2).to_numpy())
                cells = [*(c[own] for c in cells), size]
            for i in range(0, len(cells[0]), BLOCK_ROWS):
                values = [pa.array([c[i : i + BLOCK_ROWS].tobytes()], pa.binary()) for c in cells]
                yield pa.RecordBatch.from_arrays([pa.array([number]), *values], ["block", "bins", "label", "weight", "size"][: len(cells) + 1])
                number += 1

    made = "block long, bins binary, label binary, weight binary"
    if not group:
        return materialize(rows.mapInArrow(lambda batches: block(binned(batches)), made), spread=True)
    single = rows.mapInArrow(binned, ", ".join(f"{k} long" for k in keys) + ", y short, w double")
    cells = single.groupBy(*keys, "y", "w").agg(F.count(F.lit(1)).alias("n"))
    # In an order of their own, so that a rerun deals the same draws.
    blocks = cells.sortWithinPartitions(*keys, "y", "w").mapInArrow(block, made + ", size binary")
    return materialize(blocks.repartition(rows.sparkSession.sparkContext.defaultParallelism))


def _sized(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stored rows for groups of so many rows: the place of the group, and the number of a size, smaller sizes first."""
    own, size = [], []
    for number, many in enumerate(SIZES.tolist()):
        if many < 32:
            at = np.flatnonzero(n % 32 == many)
        elif many < SIZES[-1]:
            at = np.flatnonzero(n & many)
        else:
            at = np.repeat(np.arange(len(n)), n // many)
        own.append(at)
        size.append(np.full(len(at), number, np.uint8))
    return np.concatenate(own), np.concatenate(size)


def _level_sums(
    blocks: DataFrame, trees: range, level: int, feature: np.ndarray, cut: np.ndarray, chosen: np.ndarray, classes: int, seed: int
) -> np.ndarray:
    """Weights by tree, node of the level, chosen feature, bin and class, in one pass.

    A row counts in a tree as often as it was drawn for it. Rows in a leaf above the level count nowhere.
    """
    nodes, tried, cells = 2**level, chosen.shape[2], BINS * classes
    own = slice(trees.start, trees.stop)
    pairs, which = _asked(feature[own], cut[own], level)
    alive = _alive(feature[own], level)
    step = max(1, _together(pairs) // BLOCK_ROWS)
    grown = [(t, w, a, np.ascontiguousarray(chosen[t].T)) for t, w, a in zip(trees, which, alive)]

    def block(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((len(grown), tried, nodes, cells))
        for batch in batches:
            for i in range(0, batch.num_rows, step):
                add(total, batch.slice(i, step).to_pylist())
        return total.ravel()

    def add(total: np.ndarray, rows: list[dict]) -> None:
        y, w = (np.concatenate([np.frombuffer(r[c], kind) for r in rows]) for c, kind in (("label", np.uint8), ("weight", float)))
        size = np.concatenate([np.frombuffer(r.get("size", bytes(len(r["label"]))), np.uint8) for r in rows])
        ends = np.cumsum([len(r["label"]) for r in rows])
        x = np.concatenate([np.frombuffer(r["bins"], np.uint8).reshape(len(r["label"]), -1) for r in rows])
        x = np.ascontiguousarray(x.T)
        table, first = _draws(), size.astype(np.int64) << 16
        n, codes = len(y), (x.astype(np.min_scalar_type(cells - 1)) * np.uint8(classes) + y).ravel()
        tests, wide, narrow, long = _tests(x, pairs), np.empty(n, np.int64), np.empty_like(codes, shape=n), np.empty(n, np.int64)
        for sums, (t, asked, own_alive, features) in zip(total, grown):
            draw = table.take(first + np.concatenate([_uniform(seed, t, r["block"], len(r["label"])) for r in rows]))
            place, counts = _places(tests, asked, level, n), draw > 0
            if not own_alive.all():
                counts &= own_alive.take(place)
            some = np.flatnonzero(counts)
            weight, place = w.take(some) * draw.take(some), place.take(some).astype(np.int64)
            start, upto = place * cells, some.searchsorted(ends).tolist()
            parts = [slice(i, j) for i, j in zip([0, *upto], upto)]  # summed block by block: sums round alike however blocks meet
            at, short, code = wide[: len(some)], narrow[: len(some)], long[: len(some)]
            for own_sums, column in zip(sums, features * n):
                column.take(place, 0, at, "clip")
                at += some
                codes.take(at, 0, short, "clip")
                np.add(start, short, code)
                for part in parts:
                    own_sums += np.bincount(code[part], weight[part], nodes * cells).reshape(nodes, cells)

    sums = long_sum(blocks, block, alive.size * tried * cells).reshape(len(grown), tried, nodes, BINS, classes)
    return np.ascontiguousarray(sums.swapaxes(1, 2))


def _uniform(seed: int, tree: int, block: int, n: int) -> np.ndarray:
    """What a generator of this seed gives as its first n numbers of 16 bits."""
    return np.random.PCG64([seed, tree, block]).random_raw(-(-n // 4)).view(np.uint16)[:n]


def _best_cuts(sums: np.ndarray) -> tuple[np.ndarray, ...]:
    """(place among the chosen, bin, gain, class weights left and right) of the cut that lowers Gini impurity most, per tree and node.

    The gain is weighted; it is 0 where no cut lowers the impurity.
    """
    left = sums.cumsum(3)
    right = left[:, :, :, -1:] - left
    under, over, whole = left.sum(-1), right.sum(-1), left[:, :, :, -1:].sum(-1)
    purity = lambda c, n: np.divide((c**2).sum(-1), n, out=np.zeros_like(n), where=n > 0)
    gain = purity(left, under) + purity(right, over) - purity(left[:, :, :, -1:], whole)
    least = 1e-9 * whole
    gain = np.where((under > least) & (over > least) & (gain > 1e-12 * whole), gain, 0.0)
    flat = gain.reshape(*gain.shape[:2], -1)
    best = flat.argmax(-1)
    tree, node = np.ogrid[: len(sums), : sums.shape[1]]
    j, b = best // BINS, best % BINS
    return j, b, flat[tree, node, best], left[tree, node, j, b], right[tree, node, j, b]


def grow_forest(df: DataFrame, y: str, features: str, trees: int, depth: int, weight: str | None = None, seed: int = 42) -> Forest:
    """Trees on Poisson draws of the rows; each node tries a root of the features, drawn anew, and takes the best cut.

    All trees of a level share a pass, or several where its sums would be long. Only sums
    reach the driver, PASS_NUMBERS a pass, however many rows there are. Labels are 0, 1, ...
    """
    rows = df.select(
        vector_to_array(F.col(features)).alias("x"), F.col(y).cast("double").alias("y"),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
    )
    width, last, count = rows.agg(F.max(F.size("x")), F.max("y"), F.count(F.lit(1))).first()
    if width is None:
        raise ValueError("no row to fit on")
    cuts, classes = _cut_points(rows, width), max(int(last or 0) + 1, 2)
    blocks = _blocks(rows, cuts, count >= GROUP_FROM)
    size = 2 ** (depth + 1) - 1
    tried = math.ceil(math.sqrt(width))
    feature, cut = np.full((trees, size), -1, np.int16), np.zeros((trees, size), np.uint8)
    share, gains = np.zeros((trees, size, classes)), np.zeros((trees, width))
    for level in range(depth):
        nodes, first = 2**level, 2**level - 1
        chosen = np.random.default_rng([seed, level]).random((trees, nodes, width)).argsort(-1)[:, :, :tried]
        group = max(1, PASS_NUMBERS // (nodes * tried * BINS * classes))
        found = False
        for start in range(0, trees, group):
            own = range(start, min(start + group, trees))
            j, b, gain, left, right = _best_cuts(sums := _level_sums(blocks, own, level, feature, cut, chosen, classes, seed))
            if level == 0:
                share[own.start : own.stop, 0] = _shares(sums[:, 0, 0].sum(1))
            t, n = np.nonzero(gain > 0)
            found |= len(t) > 0
            at, to = t + start, n + first
            feature[at, to], cut[at, to] = chosen[at, n, j[t, n]], b[t, n]
            share[at, 2 * to + 1], share[at, 2 * to + 2] = _shares(left[t, n]), _shares(right[t, n])
            np.add.at(gains, (at, feature[at, to]), gain[t, n])
        if not found:
            break
    gains /= np.maximum(gains.sum(1, keepdims=True), 1e-300)
    importance = gains.sum(0) / max(gains.sum(), 1e-300)
    return Forest(features, cuts, feature, cut, share, Vectors.dense(importance))


def _shares(weights: np.ndarray) -> np.ndarray:
    return weights / np.maximum(weights.sum(-1, keepdims=True), 1e-300)
