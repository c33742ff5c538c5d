"""Exact Gaussian likelihood of ARMA series on NumPy, used inside Spark tasks.

A fit sees one series. Given the few values and innovations before its first period, the
innovations follow by a recursion; those few are integrated out, so the likelihood is exact
and its cost grows with the length of the series, not with its cube. Missing periods (NaN)
are integrated out in the same way: they add nothing and shift nothing. Mean and variance
have closed forms, which leaves at most four coefficients to search.
"""

from __future__ import annotations

import numpy as np


def coefficients(raw: np.ndarray) -> np.ndarray:
    """Unbounded numbers to coefficients of a stationary polynomial, by partial autocorrelations."""
    out = np.empty(0)
    for partial in np.tanh(raw):
        out = np.append(out - partial * out[::-1], partial)
    return out


def psi_weights(ar: np.ndarray, ma: np.ndarray, n: int) -> np.ndarray:
    psi = np.zeros(n)
    for j in range(n):
        psi[j] = 1.0 if j == 0 else (ma[j - 1] if j <= len(ma) else 0.0)
        psi[j] += sum(ar[i] * psi[j - 1 - i] for i in range(min(len(ar), j)))
    return psi


def autocovariance(ar: np.ndarray, ma: np.ndarray, n: int) -> np.ndarray:
    """Autocovariances 0..n-1 for unit innovations."""
    p, q = len(ar), len(ma)
    theta = np.append(1.0, ma)
    psi = psi_weights(ar, ma, q + 1)
    shock = np.array([theta[k:] @ psi[: q + 1 - k] for k in range(q + 1)])
    shock = np.append(shock, np.zeros(max(n, p + 1)))
    system = np.eye(p + 1)
    for k in range(p + 1):
        for i in range(p):
            system[k, abs(k - 1 - i)] -= ar[i]
    gamma = np.zeros(max(n, p + 1))
    gamma[: p + 1] = np.linalg.solve(system, shock[: p + 1])
    if not p:
        return shock[:n]
    values, weights, pushes = gamma[: p + 1].tolist(), ar.tolist(), shock.tolist()
    for k in range(p + 1, n):
        values.append(sum(f * values[k - 1 - i] for i, f in enumerate(weights)) + pushes[k])
    return np.array(values[:n])


#: Periods that the recursion takes at a time.
BLOCK = 64


def recursive_filter(ma: np.ndarray, x: np.ndarray) -> np.ndarray:
    """e with e[t] = x[t] - ma[0] e[t-1] - ma[1] e[t-2] - ..., zero before the start; for every column of x.

    Inside a block the answer is a product with the impulse response; only what the last few
    values of a block leave to the next one goes from block to block.
    """
    q, (n, width) = len(ma), x.shape
    if not q or not n:
        return x.copy()
    step = max(min(BLOCK, n), q)
    response = np.zeros(step)
    left = np.zeros((step, q))  # what the q values before a block, latest first, leave to it
    for k in range(step):
        response[k] = (k == 0) - sum(ma[j] * response[k - 1 - j] for j in range(min(q, k)))
        for j in range(q):
            left[k] -= ma[j] * (left[k - 1 - j] if k - 1 - j >= 0 else np.eye(q)[j - k])
    lag = np.arange(step)[:, None] - np.arange(step)[None, :]
    blocks = -(-n // step)
    padded = np.zeros((blocks * step, width))
    padded[:n] = x
    out = np.where(lag >= 0, response[lag], 0.0) @ padded.reshape(blocks, step, width)
    for b in range(1, blocks):
        out[b] += left @ out[b - 1, -1 : -q - 1 : -1]
    return out.reshape(-1, width)[:n]


def _innovations(columns: np.ndarray, ar: np.ndarray, ma: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, omega): innovations of each column after zeros, and their response to what came before.

    Before the first period lie p values and q innovations, with covariance `omega` for unit
    innovations; innovations are a + b @ those.
    """
    p, q, (n, width) = len(ar), len(ma), columns.shape
    pushed = np.zeros((n, width + p + q))
    pushed[:, :width] = columns
    for i in range(min(p, n)):
        pushed[i + 1 :, :width] -= ar[i] * columns[: n - i - 1]
    for k in range(p):
        m = min(p - k, n)
        pushed[:m, width + k] = -ar[k : k + m]
    for k in range(q):
        m = min(q - k, n)
        pushed[:m, width + p + k] = -ma[k : k + m]
    filtered = recursive_filter(ma, pushed)
    omega = np.eye(p + q)
    if p:
        gamma, psi = autocovariance(ar, ma, p), psi_weights(ar, ma, max(q, 1))
        i = np.arange(p)
        omega[:p, :p] = gamma[np.abs(i[:, None] - i[None, :])]
        for a in range(p):
            for b in range(a, q):
                omega[a, p + b] = omega[p + b, a] = psi[b - a]
    return filtered[:, :width], filtered[:, width:], omega


def _moments(columns: np.ndarray, ar: np.ndarray, ma: np.ndarray):
    """(products, log determinant, a, b, gain): the columns' products under the inverse covariance, start integrated out."""
    a, b, omega = _innovations(columns, ar, ma)
    inner = np.eye(len(omega)) + b.T @ b @ omega
    gain = omega @ np.linalg.inv(inner) if len(omega) else omega
    cross = b.T @ a
    sign, logdet = np.linalg.slogdet(inner) if len(omega) else (1.0, 0.0)
    if sign <= 0:
        raise np.linalg.LinAlgError("no finite likelihood")
    return a.T @ a - cross.T @ gain @ cross, logdet, a, b, gain


def profile(
    w: np.ndarray, ar: np.ndarray, ma: np.ndarray, with_mean: bool, gaps: np.ndarray | None = None
) -> tuple[float, float, float]:
    """(log-likelihood, mean, innovation variance) with mean and variance at their optimum.

    `gaps` has a column per missing value: where it enters `w`, which holds any number there.
    """
    k = 0 if gaps is None else gaps.shape[1]
    n = len(w) - k
    columns = np.column_stack([*([] if gaps is None else [gaps]), np.ones(len(w)), w])
    s, logdet, *_ = _moments(columns, ar, ma)
    if k:  # the missing values are integrated out
        root = np.linalg.cholesky(s[:k, :k])
        logdet += 2 * float(np.log(np.diag(root)).sum())
        s = s[k:, k:] - s[k:, :k] @ np.linalg.solve(s[:k, :k], s[:k, k:])
    mean = float(s[0, 1] / s[0, 0]) if with_mean else 0.0
    sigma2 = float(s[1, 1] - 2 * mean * s[0, 1] + mean * mean * s[0, 0]) / n
    if not sigma2 > 0:
        raise np.linalg.LinAlgError("no variation")
    return -0.5 * n * (np.log(2 * np.pi * sigma2) + 1) - 0.5 * logdet, mean, sigma2


def differenced(values: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """(filled, w, gaps): values with any number for NaN, their d-th differences, and where each missing one enters them.

    Missing values at either end are left out.
    """
    values = np.asarray(values, float)
    known = np.flatnonzero(~np.isnan(values))
    if not len(known):
        raise np.linalg.LinAlgError("no value")
    values = values[known[0] : known[-1] + 1]
    missing = np.isnan(values)
    if not missing.any():
        return values, np.diff(values, d) if d else values, None
    at = np.arange(len(values))
    filled = np.where(missing, np.interp(at, at[~missing], values[~missing]), values)
    gaps = np.zeros((len(values), int(missing.sum())))
    gaps[np.flatnonzero(missing), np.arange(gaps.shape[1])] = 1.0
    return filled, np.diff(filled, d) if d else filled, np.diff(gaps, d, axis=0) if d else gaps


def simplex_search(f, start: np.ndarray, steps: int = 400, tol: float = 1e-8) -> np.ndarray:
    """Downhill simplex minimum of f."""
    d = len(start)
    points = np.vstack([start, start + 0.4 * np.eye(d)])
    values = np.array([f(x) for x in points])
    for _ in range(steps):
        rank = np.argsort(values)
        points, values = points[rank], values[rank]
        if values[-1] - values[0] < tol:
            break
        centre = points[:-1].mean(axis=0)
        away = centre - points[-1]
        trial = centre + away
        score = f(trial)
        if score < values[0]:
            further = centre + 2 * away
            far = f(further)
            trial, score = (further, far) if far < score else (trial, score)
        elif score >= values[-2]:
            trial = centre + (0.5 if score < values[-1] else -0.5) * away
            score = f(trial)
            if score >= values[-1]:
                points[1:] = points[0] + 0.5 * (points[1:] - points[0])
                values[1:] = [f(x) for x in points[1:]]
                continue
        points[-1], values[-1] = trial, score
    return points[np.argmin(values)]


def fit(values: np.ndarray, p: int, d: int, q: int) -> dict:
    """Best ARIMA(p, d, q); a constant only without differencing. NaN stands for a missing period."""
    _, w, gaps = differenced(values, d)
    n = len(w) - (0 if gaps is None else gaps.shape[1])
    if n < p + q + 2:
        raise np.linalg.LinAlgError("too few values for this order")
    if np.ptp(w) == 0:
        raise np.linalg.LinAlgError("no variation")
    scale = float(np.std(w)) or 1.0
    w = w / scale

    def split(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return coefficients(x[:p]), -coefficients(x[p:])

    def loss(x: np.ndarray) -> float:
        try:
            value = -profile(w, *split(np.clip(x, -6, 6)), d == 0, gaps)[0]
        except np.linalg.LinAlgError:
            return 1e12
        return value if np.isfinite(value) else 1e12

    best = np.zeros(p + q)
    if p + q:
        starts = [np.append(np.full(p, a), np.full(q, b)) for a in (-0.4, 0.0, 0.4) for b in (-0.4, 0.0, 0.4)]
        # a second search from the first optimum escapes a collapsed simplex
        first = simplex_search(loss, min(starts, key=loss))
        best = np.clip(simplex_search(loss, first), -6, 6)
    ar, ma = split(best)
    loglik, mean, sigma2 = profile(w, ar, ma, d == 0, gaps)
    loglik -= n * np.log(scale)
    k = p + q + 1 + (d == 0)
    return {"ar": ar, "ma": ma, "mean": mean * scale, "sigma2": sigma2 * scale**2, "loglik": loglik, "aic": 2 * k - 2 * loglik}


def forecast(values: np.ndarray, d: int, model: dict, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean, standard error) of the next values after the last known one."""
    ar, ma = model["ar"], model["ma"]
    filled, w, gaps = differenced(values, d)
    w = w - model["mean"]
    k = 0 if gaps is None else gaps.shape[1]
    s, _, a, b, gain = _moments(np.column_stack([*([] if gaps is None else [gaps]), w]), ar, ma)
    innovations = a[:, -1]
    if k:
        # The best guess of each missing value, in the levels and in the differences.
        off = np.linalg.solve(s[:k, :k], s[:k, k])
        innovations, w = innovations - a[:, :k] @ off, w - gaps @ off
        filled = filled.copy()
        levels = np.asarray(values, float)
        levels = levels[np.flatnonzero(~np.isnan(levels))[0] :][: len(filled)]
        filled[np.flatnonzero(np.isnan(levels))] -= off
    before = -gain @ (b.T @ innovations)
    past = np.r_[before[: len(ar)][::-1], w].tolist()
    shocks = np.r_[before[len(ar) :][::-1], innovations + b @ before].tolist()
    for _ in range(steps):
        past.append(sum(f * past[-1 - i] for i, f in enumerate(ar)) + sum(f * shocks[-1 - i] for i, f in enumerate(ma)))
        shocks.append(0.0)
    mean = np.array(past[-steps:]) + model["mean"] if steps else np.empty(0)
    psi = psi_weights(ar, ma, steps)
    for level in range(d - 1, -1, -1):  # sum up once per difference taken
        mean = np.diff(filled, level)[-1] + np.cumsum(mean)
        psi = np.cumsum(psi)
    return mean, np.sqrt(model["sigma2"] * np.cumsum(psi**2))


def unit_root(values: np.ndarray, max_lags: int | None = None) -> tuple[float, int, int]:
    """(t statistic, lags, rows used) of the unit-root regression with a constant, lags by AIC.

    Raises LinAlgError where there is no such statistic: fewer than four values, or no variation.
    """
    y = np.asarray(values, float)
    y = y[~np.isnan(y)]
    n = len(y)
    if n < 4:
        raise np.linalg.LinAlgError("fewer than 4 values")
    if np.ptp(y) == 0 or np.ptp(np.diff(y)) == 0:
        raise np.linalg.LinAlgError("no variation")
    # The statistic knows no unit; in units of money the normal equations lose their digits.
    y = (y - y.mean()) / y.std()
    most = max(min(int(np.ceil(12 * (n / 100) ** 0.25)), n // 2 - 2), 0)
    most = most if max_lags is None else min(most, max_lags)
    dy = np.diff(y)

    def regress(lags: int, skip: int) -> tuple[float, float, int]:
        rows = np.arange(skip, len(dy))
        x = np.column_stack([np.ones(len(rows)), y[rows], *[dy[rows - i] for i in range(1, lags + 1)]])
        target = dy[rows]
        beta, *_ = np.linalg.lstsq(x, target, rcond=None)
        rss = float(((target - x @ beta) ** 2).sum())
        m, k = x.shape
        aic = m * (np.log(2 * np.pi * rss / m) + 1) + 2 * k
        error = np.sqrt(rss / (m - k) * np.linalg.pinv(x.T @ x)[1, 1])
        return beta[1] / error, aic, m

    best = min(range(most + 1), key=lambda lags: regress(lags, most)[1])
    tau, _, used = regress(best, best)
    if not np.isfinite(tau):
        raise np.linalg.LinAlgError("no residual variation")
    return float(tau), best, used
