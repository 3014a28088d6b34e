"""Global rank without moving all rows, or all distinct values, to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Leading binary digits of a value that make its range, and further digits of each narrower range.
LEADING, FURTHER = 8, (14, 14)


def _ranges(value: Column) -> list[Column]:
    """Whole numbers that rise with the value: its power of two with the leading binary digits, then
    further digits of the rest.

    There are at most a few hundred thousand first numbers and 2^14 of each further one, however many
    values there are; what shares all of them differs in the last 16 digits of a double only.
    """
    size, sign = F.abs(value.cast("double")), F.when(value < 0, -1).otherwise(1)
    size = F.coalesce(size, F.lit(0.0))
    power = F.floor(F.log2(F.when((size > 0) & (size < float("inf")), size).otherwise(1.0)))
    rest = F.greatest(size / F.pow(F.lit(2.0), power) - 1, F.lit(0.0))
    top = F.least(F.floor(rest * 2**LEADING), F.lit(2**LEADING - 1))
    whole = F.when(size < float("inf"), (power + 1100) * 2**LEADING + top).otherwise(2**20)
    first = F.when(F.isnan(size), 2**21).when(size == 0, 0).otherwise(sign * whole)
    numbers = [F.when(value.isNotNull(), first)]
    rest = rest * 2**LEADING - top
    for digits in FURTHER:
        place = F.least(F.floor(rest * 2**digits), F.lit(2**digits - 1))
        numbers.append(F.when((size > 0) & (size < float("inf")), sign * place).otherwise(0))
        rest = rest * 2**digits - place
    return [n.cast("long") for n in numbers]


def _higher(*within: str) -> Window:
    """Rows above in the order of the column named last, inside the ones before it."""
    *group, order = within
    window = Window.partitionBy(*group) if group else Window
    return window.orderBy(F.col(order).desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)


def _above(*within: str) -> Column:
    return F.coalesce(F.sum("_rows").over(_higher(*within)), F.lit(0))


def rank_by_level(df: DataFrame, value: str, into: str, few_levels: bool = False) -> DataFrame:
    """``rank()`` over all rows, highest value first, NULL last; ties share a rank.

    A window without partitions would pull every row into one task.  Instead rows are counted per
    distinct value, and each row looks up how many rows are above its value.  With ``few_levels`` the
    caller states that the distinct values are bounded (rounded ratings), and one small window adds the
    counts up.  Otherwise they are added up in steps: over coarse ranges of values, whose number is
    bounded, over narrower ranges inside each, and over the values inside the narrowest; no window
    holds more than 2^16 values of one range, wherever the values crowd.  All joins are left to Spark.
    """
    counted = F.count(F.lit(1)).alias("_rows")
    levels = df.groupBy(F.col(value).alias("_level")).agg(counted)
    if few_levels:
        ranked = levels.select("_level", (_above("_level") + 1).cast("int").alias(into))
        return df.join(ranked, F.col(value).eqNullSafe(F.col("_level")), "left").drop("_level")

    names = ["_range0", "_range1", "_range2"]
    levels = levels.select("_level", "_rows", *[c.alias(n) for c, n in zip(_ranges(F.col("_level")), names)])
    ranked = levels.withColumn("_above", _above(*names, "_level"))
    for depth in range(len(names), 0, -1):
        within = names[:depth]
        ranges = levels.groupBy(*within).agg(F.sum("_rows").alias("_rows"))
        ranges = ranges.select(*[F.col(n).alias(f"_same{n}") for n in within], _above(*within).alias("_before"))
        same = [F.col(n).eqNullSafe(F.col(f"_same{n}")) for n in within]
        ranked = ranked.join(ranges, same).withColumn("_above", F.col("_above") + F.col("_before"))
        ranked = ranked.select("_level", "_above", *names)
    ranked = ranked.select("_level", (F.col("_above") + 1).cast("int").alias(into))
    return df.join(ranked, F.col(value).eqNullSafe(F.col("_level")), "left").drop("_level")
