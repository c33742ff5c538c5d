"""Column rules for dates. Timestamps carry no zone, as in the sources."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted layouts, tried in order.
MONTH_FIRST = ("M/d/yyyy", "yyyy-M-d", "d/M/yyyy")
ISO_THEN_DAY_FIRST = (
    "yyyy-M-d H:m:s",
    "d/M/yyyy H:m",
    "yyyy-M-d",
    "d/M/yyyy",
    "M/d/yyyy",
    "M/d/yyyy H:m",
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# What each layout letter may stand for.
_PARTS = {
    "yyyy": r"\d{4}",
    "M": r"(0?[1-9]|1[0-2])",
    "d": r"(0?[1-9]|[12]\d|3[01])",
    "H": r"([01]?\d|2[0-3])",
    "m": r"[0-5]?\d",
    "s": r"[0-5]?\d",
}


def layout_shape(layout: str) -> str:
    """Regular expression of the texts a layout can read."""
    return "^" + re.sub("yyyy|[MdHms]", lambda part: _PARTS[part.group()], layout) + "$"


def _attempt(c: Column, layout: str) -> Column:
    # a failed parse costs an exception per row, so texts of another shape are not tried
    return F.when(c.rlike(layout_shape(layout)), F.try_to_timestamp(c, F.lit(layout)))


def parse_timestamp(
    c: Column | str, formats: Sequence[str] = MONTH_FIRST, fallback: bool = True
) -> Column:
    """First layout that fits wins; text that fits none becomes null.

    Layouts are made of yyyy, M, d, H, m, s (one or two digits) and separators.
    """
    attempts = [_attempt(_col(c), layout) for layout in formats]
    if fallback:
        attempts.append(_col(c).try_cast("timestamp"))
    return F.coalesce(*attempts).cast("timestamp_ntz")


def parse_date(c: Column | str, layout: str = "M/d/yyyy") -> Column:
    """Date in one layout; anything else becomes null."""
    return _attempt(_col(c), layout).cast("date")


def day(c: Column | str) -> Column:
    return _col(c).cast("date")


def month_start(c: Column | str) -> Column:
    return F.trunc(_col(c), "month")


def month_number(c: Column | str) -> Column:
    return F.month(_col(c))


def year_number(c: Column | str) -> Column:
    return F.year(_col(c))
