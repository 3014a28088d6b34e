"""Small helpers shared by the column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ladder(steps, default) -> Column:
    """First value whose condition holds; ``default`` where none does (or all are NULL)."""
    (condition, value), *rest = steps
    chain = F.when(condition, value)
    for condition, value in rest:
        chain = chain.when(condition, value)
    return chain.otherwise(default)
