"""Column rules for dirty text. Every function takes and returns a Column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Markers that stand for "no value" in the raw files.
SENTINELS = ("UNKNOWN", "ERROR", "NULL", "NONE", "NAN")

# Province spellings that lose their accent in the raw files.
ACCENT_FIXES = {"Limon": "Limón", "San Jose": "San José"}

# Fixed value: characters kept by the scrub.
SCRUB_KEEP = r"a-zA-Z0-9\s\-.,"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_text(c: Column | str, sentinels: Sequence[str] = SENTINELS) -> Column:
    """Trim, collapse blanks, lower; blank or marker text becomes null."""
    text = F.regexp_replace(F.trim(_col(c).cast("string")), r"\s+", " ")
    keep = (text != "") & ~F.upper(text).isin(*sentinels)
    return F.when(keep, F.lower(text))


def parse_number(c: Column | str) -> Column:
    """Number out of decorated text: decimal comma accepted, other symbols dropped."""
    digits = F.regexp_replace(F.replace(normalize_text(c), F.lit(","), F.lit(".")), r"[^0-9.\-]+", "")
    return digits.try_cast("double")


def plain_number(c: Column | str) -> Column:
    """True where the raw text is a plain decimal number."""
    return _col(c).rlike(r"^-?[0-9]+(\.[0-9]+)?$")


def unparseable(c: Column | str) -> Column:
    """True where text is present but is not a number (blank text included)."""
    return _col(c).isNotNull() & F.trim(_col(c)).try_cast("double").isNull()


def scrub(c: Column | str, keep: str = SCRUB_KEEP) -> Column:
    """Remove every character outside `keep`, then trim."""
    return F.trim(F.regexp_replace(_col(c), f"[^{keep}]", ""))


def normalize_category(c: Column | str, fixes: Mapping[str, str] = ACCENT_FIXES) -> Column:
    """Title-case label with known spellings repaired.

    `initcap` starts a word after a blank only: an inner quote does not.
    """
    text = F.initcap(F.trim(_col(c)))
    for wrong, right in fixes.items():
        text = F.replace(text, F.lit(wrong), F.lit(right))
    return text


def parse_magnitude(c: Column | str, unit: str = "million") -> Column:
    """'290.4 million' -> 290.4."""
    return F.trim(F.replace(_col(c), F.lit(unit), F.lit(""))).try_cast("double")


def parse_range_or_concat(c: Column | str, unit: str = "million") -> Column:
    """Middle of 'a–b million', first of 'a million' + 'b million', else the plain value.

    The range test comes first; it falls through when either end is not a number.
    """
    text = F.trim(_col(c))
    ends = F.split(F.replace(text, F.lit(unit), F.lit("")), "[–-]")
    left, right = (F.trim(F.get(ends, F.lit(i))).try_cast("double") for i in (0, 1))
    first = F.trim(F.substring_index(text, unit, 1)).try_cast("double")
    return F.coalesce((left + right) / 2, first)


def split_key(c: Column | str, part: int, sep: str = "|") -> Column:
    """One part of a composite key (0-based)."""
    return F.split_part(_col(c), F.lit(sep), F.lit(part + 1))
