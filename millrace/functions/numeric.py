"""Column rules for numbers: labels, bins, ratios, flags, grades."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tenure bins in months, right-closed.
TENURE_EDGES = (-1, 6, 12, 24, 48, 72)
TENURE_LABELS = ("0-6m", "7-12m", "13-24m", "25-48m", "49-72m")

# Grade bands, best first, as (lower or upper limit, label).
RECALL_BANDS = ((0.95, "excellent"), (0.90, "acceptable"))
MAPE_BANDS = ((10.0, "excellent"), (15.0, "good"), (25.0, "moderate"))
SILHOUETTE_BANDS = ((0.7, "strong"), (0.5, "reasonable"), (0.2, "weak"))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_flag(condition: Column) -> Column:
    """0/1 from a condition; unknown counts as 0."""
    return F.when(condition, 1).otherwise(0)


def binary_label(c: Column | str, positive: object) -> Column:
    return as_flag(_col(c) == F.lit(positive))


def bin_column(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins (edge, next edge]; outside values become null."""
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per pair of neighbouring edges is needed")
    value = _col(c)
    inside = value > edges[0]
    out = None
    for upper, label in zip(edges[1:], labels):
        test = inside & (value <= upper)
        out = F.when(test, label) if out is None else out.when(test, label)
    return out


def count_matching(cols: Sequence[Column | str], value: object) -> Column:
    """How many of the columns equal `value` in this row."""
    total = F.lit(0)
    for c in cols:
        total = total + as_flag(_col(c) == F.lit(value))
    return total


def safe_ratio(num: Column | str, den: Column | str, default: Column | str) -> Column:
    """num / den where den is positive, `default` elsewhere."""
    return F.when(_col(den) > 0, _col(num) / _col(den)).otherwise(_col(default))


def money_sum(c: Column | str, scale: int = 2) -> Column:
    """Sum in decimal, so the result does not depend on the order of the rows."""
    return F.sum(_col(c).cast(f"decimal(18,{scale})")).cast("double")


def clamp(c: Column | str, low: Column, high: Column) -> Column:
    value = _col(c)
    return F.when(value.isNotNull(), F.least(F.greatest(value, low), high))


def grade(c: Column | str, bands: Sequence[tuple[float, str]], otherwise: str, rising: bool = True) -> Column:
    """Label of the first band reached: value >= limit when rising, value < limit when falling."""
    value = _col(c)
    out = None
    for limit, label in bands:
        test = value >= limit if rising else value < limit
        out = F.when(test, label) if out is None else out.when(test, label)
    return F.when(value.isNotNull(), out.otherwise(otherwise))


def risk_bands(p: Column | str) -> Column:
    """High above 60 %, medium from 30 % to 60 %, low below."""
    value = _col(p)
    return F.when(value > 0.60, "high").when(value >= 0.30, "medium").when(value < 0.30, "low")


def lookup(c: Column | str, mapping: Mapping[object, object]) -> Column:
    """Value for each key of a small fixed mapping; unknown keys give null."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), _col(c))
