"""Least squares with sparse and Gaussian priors on a Gram matrix, and draws of future trend changes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: A solution is accepted when no coordinate misses its optimality condition by more than this share of the penalty.
TOLERANCE = 1e-6
#: Steps after which the search ends with whatever gap is left; the gap is returned.
STEPS = 10_000
#: Least noise, in units of the largest value.
LEAST_NOISE = 1e-5
#: Prior scale of the noise (fixed value of the model).
NOISE_SCALE = 0.5


@dataclass
class Sparse:
    weights: np.ndarray
    gap: float
    steps: int


def sparse_ridge(gram: np.ndarray, target: np.ndarray, ridge: np.ndarray, lasso: np.ndarray, start: np.ndarray) -> Sparse:
    """Minimises w'Gw/2 - w't + sum(ridge * w^2)/2 + sum(lasso * |w|).

    Weights without a lasso penalty are eliminated exactly. Of the others, the one that
    misses its optimality condition most joins those in use; these are solved for together,
    up to where the sum is least on the way there, and a weight that reaches zero on the way
    leaves. Every step lowers the sum, so the search ends. `gap` is the worst violation of the
    optimality conditions, relative to the penalty.
    """
    sparse = lasso > 0
    full = gram + np.diag(ridge)
    free, across = full[np.ix_(~sparse, ~sparse)], full[np.ix_(~sparse, sparse)]
    solved = np.linalg.solve(free, np.c_[across, target[~sparse]])
    q = full[np.ix_(sparse, sparse)] - across.T @ solved[:, :-1]
    c = target[sparse] - across.T @ solved[:, -1]
    penalty, z = lasso[sparse], start[sparse].copy()
    seen = np.diag(q) > 1e-12  # a hinge after the last day changes nothing
    z[~seen] = 0.0
    sign = np.sign(z)

    def objective(x):
        return x @ q @ x / 2 - c @ x + penalty @ np.abs(x)

    def missed(x):
        g = c - q @ x
        wrong = np.where(x != 0, np.abs(g - penalty * np.sign(x)), np.maximum(np.abs(g) - penalty, 0.0)) / penalty
        return g, np.where(seen, wrong, 0.0)

    steps = 0
    while steps < STEPS:
        g, wrong = missed(z)
        if wrong.max(initial=0.0) <= TOLERANCE:
            break
        if wrong[z != 0].max(initial=0.0) <= TOLERANCE:
            j = int(wrong.argmax())
            sign[j] = np.sign(g[j])
        used = np.flatnonzero(sign)
        exact = np.zeros_like(z)
        exact[used] = np.linalg.lstsq(q[np.ix_(used, used)], c[used] - penalty[used] * sign[used], rcond=None)[0]
        # The sum is a parabola between the places where a weight crosses zero.
        turns = np.flatnonzero(z * exact < 0)
        share = z[turns] / (z[turns] - exact[turns])
        best, least = exact, objective(exact)
        for k, a in zip(turns.tolist(), share.tolist()):
            trial = z + a * (exact - z)
            trial[k] = 0.0
            if (value := objective(trial)) < least:
                best, least = trial, value
        steps += 1
        if least >= objective(z) and (best != z).any() and wrong[z != 0].max(initial=0.0) <= TOLERANCE * 10:
            # The sum has no digits left to gain; the conditions may still have some.
            if missed(best)[1].max(initial=0.0) >= wrong.max():
                break
        z, sign = best, np.sign(best)
    weights = np.empty(len(target))
    weights[sparse] = z
    weights[~sparse] = solved[:, -1] - solved[:, :-1] @ z
    return Sparse(weights, float(missed(z)[1].max(initial=0.0)), steps)


def fit(gram: np.ndarray, n: int, prior: np.ndarray, laplace: np.ndarray) -> tuple[np.ndarray, float, float, int]:
    """(weights, noise, gap, steps) of the most likely weights and noise, from the sums of (terms, y)(terms, y)'.

    `prior` holds the Gaussian scale of each weight (infinite: none), `laplace` the scale of
    the sparse ones and 0 for all others.
    """
    g, t, yy = gram[:-1, :-1], gram[:-1, -1], gram[-1, -1]
    gaussian = np.where(laplace > 0, 0.0, 1.0 / prior**2)
    lasso = np.where(laplace > 0, 1.0 / np.where(laplace > 0, laplace, 1.0), 0.0)
    weights, steps = np.zeros(len(t)), 0
    noise = max(np.sqrt(yy / n), LEAST_NOISE)
    for _ in range(200):
        found = sparse_ridge(g, t, gaussian * noise**2, lasso * noise**2, weights)
        weights, steps = found.weights, steps + found.steps
        rss = max(float(yy - 2 * weights @ t + weights @ g @ weights), 0.0)
        # Where n log s + rss / 2s^2 + s^2 / 2 NOISE_SCALE^2 is least.
        k = 1 / NOISE_SCALE**2
        new = max(np.sqrt((np.sqrt(n * n + 4 * k * rss) - n) / (2 * k)), LEAST_NOISE)
        done = abs(new - noise) <= 1e-9 * noise
        noise = new
        if done:
            break
    return weights, float(noise), found.gap, steps


def future_band(changes: np.ndarray, noise: float, span: int, horizon: int, seed: int, paths: int, level: float):
    """(low, high): quantiles of trend change plus noise, for each of `horizon` days after the history.

    Changes come as often as the candidate changepoints of the history, `changes` among
    `span` days, and are as large as those found, with Laplace sizes.
    """
    rng = np.random.default_rng(seed)
    count = rng.poisson(len(changes) * horizon / span, paths)
    path = np.repeat(np.arange(paths), count)
    at = rng.uniform(0, horizon, len(path))
    size = rng.laplace(0.0, np.abs(changes).mean() + 1e-8, len(path)) if len(changes) else np.empty(0)
    slope, moved = np.zeros((paths, horizon + 1)), np.zeros((paths, horizon + 1))
    day = np.ceil(at).astype(int)
    np.add.at(slope, (path, day), size)
    np.add.at(moved, (path, day), size * at)
    ahead = np.arange(horizon + 1)
    drift = (ahead * slope.cumsum(1) - moved.cumsum(1))[:, 1:] / span
    outcome = drift + noise * rng.standard_normal(drift.shape)
    tail = (1 - level) / 2
    return np.quantile(outcome, [tail, 1 - tail], axis=0)
