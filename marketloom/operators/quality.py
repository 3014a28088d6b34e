"""Data-quality predicates and audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def has_all(columns: Sequence[str]) -> Column:
    """True where every listed column is present."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def has_any(columns: Sequence[str]) -> Column:
    """True where at least one listed column is present."""
    return F.coalesce(*columns).isNotNull()


def drop_all_null(df: DataFrame, value_columns: Sequence[str]) -> DataFrame:
    """Drop rows in which all value columns are NULL; audit columns do not count."""
    return df.dropna("all", subset=list(value_columns))


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(has_all(columns))


def drop_report(df: DataFrame, table: str, required: Sequence[str]) -> DataFrame:
    """Rows before and after the required-field rule, in one aggregate."""
    kept = F.count_if(has_all(required))
    rows = F.count(F.lit(1))
    return df.agg(rows.alias("rows_before"), kept.alias("rows_kept")).select(
        F.lit(table).alias("table_name"),
        "rows_before",
        "rows_kept",
        (F.col("rows_before") - F.col("rows_kept")).alias("rows_dropped"),
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of all given tables as one frame, hence one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)
