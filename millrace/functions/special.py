"""Distribution functions on NumPy arrays, for use on small aggregated tables."""

from __future__ import annotations

import math

import numpy as np


def _each(f, x) -> np.ndarray:
    return np.asarray(np.frompyfunc(f, 1, 1)(np.asarray(x, float)), float)


def normal_cdf(x) -> np.ndarray:
    return 0.5 * (1.0 + _each(math.erf, np.asarray(x, float) / math.sqrt(2.0)))


def incomplete_beta(a, b, x, steps: int = 300) -> np.ndarray:
    """Regularised incomplete beta by its continued fraction, evaluated from the tail inwards."""
    a, b, x = np.broadcast_arrays(*(np.asarray(v, float) for v in (a, b, x)))
    swap = x > (a + 1.0) / (a + b + 2.0)
    p, q, z = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1.0 - x, x)
    tail = np.ones_like(z)
    for m in range(steps, 0, -1):
        even = m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m))
        odd = -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))
        tail = 1.0 + even / (1.0 + odd / tail)
    first = -(p + q) * z / (p + 1.0)
    fraction = 1.0 / (1.0 + first / tail)
    with np.errstate(divide="ignore", invalid="ignore"):
        front = np.exp(
            _each(math.lgamma, p + q) - _each(math.lgamma, p) - _each(math.lgamma, q) + p * np.log(z) + q * np.log1p(-z)
        ) / p
        value = np.where(z <= 0, 0.0, np.where(z >= 1, 1.0, front * fraction))
    return np.where(swap, 1.0 - value, value)


def t_two_sided(t, dof) -> np.ndarray:
    """Two-sided p-value of a t statistic."""
    t, dof = np.asarray(t, float), np.asarray(dof, float)
    return incomplete_beta(dof / 2.0, 0.5, dof / (dof + t * t))


# Response-surface coefficients for a regression with a constant.
UNIT_ROOT_SMALL = (2.1659, 1.4412, 0.038269)
UNIT_ROOT_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)
UNIT_ROOT_SPLIT = -1.61
UNIT_ROOT_RANGE = (-18.83, 2.74)


def unit_root_p(tau: float) -> float:
    """Approximate p-value of a unit-root t statistic (constant, one series)."""
    low, high = UNIT_ROOT_RANGE
    if tau < low:
        return 0.0
    if tau > high:
        return 1.0
    coef = UNIT_ROOT_SMALL if tau <= UNIT_ROOT_SPLIT else UNIT_ROOT_LARGE
    return float(normal_cdf(np.polynomial.polynomial.polyval(tau, coef)))
