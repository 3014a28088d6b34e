"""Order-independent sums and averages.

Adding binary doubles gives a result that depends on the order of the rows, and so on the
partitioning; a rounded average can then flip by one unit in the last place from run to run.  Amounts
here are whole cents, so they are summed as whole numbers and divided once at the end: the same
answer for every partitioning, and half-up rounding of the true quotient.

Whole cents are added up in two 64-bit sums, of millions of cents and of what is left, which is fast
and does not overflow before some 1e9 amounts of 9e13.  All other finite amounts below 1e17 are added
as decimals with ten digits.  Only what is larger still, NaN and infinity goes through doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketloom.functions.base import as_col

CENTS_LIMIT = 2.0**53 / 100  # up to here every whole cent is a double of its own
DECIMAL_LIMIT = 1e17  # up to here a decimal(27,10) holds an amount
BLOCK = 1_000_000  # cents that are counted as one in the upper sum
PARTS = ("blocks", "cents", "loose", "odd", "paid")


def _is_whole_cents(x: Column) -> Column:
    return (F.abs(x) < CENTS_LIMIT) & (F.rint(x * 100) / 100 == x)


def money_parts(amount: Column | str, prefix: str = "") -> list[Column]:
    """Additive aggregates of an amount: exact cents in two sums, leftovers, and the count.

    They merge by plain ``sum``, so a pre-aggregated frame can be rolled up
    further with ``money_rollup`` without losing exactness.
    """
    x = as_col(amount)
    whole, fits = _is_whole_cents(x), F.abs(x) < DECIMAL_LIMIT
    cents = F.rint(x * 100).cast("bigint")
    return [
        F.sum(F.when(whole, F.floor(F.rint(x * 100) / BLOCK))).alias(f"{prefix}blocks"),
        F.sum(F.when(whole, F.pmod(cents, F.lit(BLOCK)))).alias(f"{prefix}cents"),
        F.sum(F.when(~whole & fits, x.cast("decimal(27,10)"))).alias(f"{prefix}loose"),
        F.sum(F.when(~whole & ~fits, x.cast("double"))).alias(f"{prefix}odd"),
        F.count(x).alias(f"{prefix}paid"),
    ]


def money_rollup(prefix: str = "") -> list[Column]:
    return [F.sum(f"{prefix}{part}").alias(f"{prefix}{part}") for part in PARTS]


def _whole_cents(prefix: str) -> Column:
    """The exact cents as a decimal; NULL when there were none."""
    blocks, cents = (F.col(f"{prefix}{part}").cast("decimal(19,0)") for part in ("blocks", "cents"))
    return blocks * F.lit(BLOCK).cast("decimal(7,0)") + cents


def _mixed(prefix: str) -> Column:
    """Sum in currency units, as a double, of everything; for groups with leftovers only."""
    nothing = F.lit(0).cast("decimal(38,10)")
    exact = F.coalesce(_whole_cents(prefix) / 100, nothing) + F.coalesce(F.col(f"{prefix}loose"), nothing)
    return exact.cast("double") + F.coalesce(f"{prefix}odd", F.lit(0.0))


def _all_whole(prefix: str) -> Column:
    return F.col(f"{prefix}loose").isNull() & F.col(f"{prefix}odd").isNull()


def money_total(prefix: str = "") -> Column:
    """Sum in currency units, two digits; NULL when there was no amount at all."""
    whole = _whole_cents(prefix).cast("double") / 100
    return F.when(_all_whole(prefix), whole).otherwise(F.round(_mixed(prefix), 2))


def money_average(prefix: str = "") -> Column:
    paid = F.nullif(F.col(f"{prefix}paid"), F.lit(0))
    exact = F.round(_whole_cents(prefix).cast("double") / paid) / 100
    return F.when(_all_whole(prefix), exact).otherwise(F.round(_mixed(prefix) / paid, 2))


def rounded(x: Column, digits: int) -> Column:
    """Half away from zero at so many digits, by scaling: every engine agrees on it."""
    return F.round(x * 10**digits) / 10**digits


def ratio(numerator: Column | str, denominator: Column | str, digits: int) -> Column:
    """``numerator / denominator`` of two whole numbers, rounded half up; NULL over zero."""
    scale = 10**digits
    scaled = (as_col(numerator) * scale).cast("double")
    return F.round(scaled / F.nullif(as_col(denominator), F.lit(0))) / scale


def percent(part: Column | str, whole: Column | str, digits: int = 1) -> Column:
    return ratio(as_col(part) * 100, whole, digits)
