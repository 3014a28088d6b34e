"""One row per key: the most recently ingested one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame,
    key: Sequence[str],
    recency: str = "ingestion_date",
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the newest row of each key.

    Rows of one load carry the same timestamp, so recency alone leaves ties;
    they are broken by all remaining columns in ascending order (NULL first).
    Rows that still tie are identical, hence the result is the same for every
    input order and partitioning.

    The rank-and-keep-first form lets Spark cut each key to one row per map
    task before the shuffle (``WindowGroupLimit``), so a key with a third of
    all rows costs its reducer one row per map task.
    """
    ties = [c for c in df.columns if c not in (*key, recency)] if tie_break is None else tie_break
    newest_first = Window.partitionBy(*key).orderBy(
        F.col(recency).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in ties]
    )
    return df.withColumn("_age", F.row_number().over(newest_first)).where("_age = 1").drop("_age")
