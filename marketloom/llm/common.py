"""What several operators share: components of a graph and gapless numbers, both without a hot task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from marketloom.sources.scratch import discard, scratch_path, stored


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def other_columns(df: DataFrame, *names: str) -> list[str]:
    """The columns of ``df`` that are called like none of ``names``, in upper or lower case."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def _pointers_to_roots(spark, parent: DataFrame, path: str) -> tuple[DataFrame, str]:
    """Follow (u, p) pointers until each p is a root, halving the way in every round."""
    while True:
        seen, next_path = Observation(), scratch_path(spark, "pointers")
        above = parent.select(F.col("u").alias("p"), F.col("p").alias("above"))
        jumped = (
            parent.join(above, "p", "left")
            .select("u", F.coalesce("above", "p").alias("p"), F.col("above").isNotNull().alias("moved"))
            .observe(seen, F.count_if("moved").alias("moved"))
            .select("u", "p")
        )
        parent = stored(jumped, path=next_path)
        discard(spark, path)
        path = next_path
        if not seen.get["moved"]:
            return parent, path


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that is not the smallest of its component.

    ``a`` and ``b`` are columns of one orderable type; NULL ends and loops are left out.  Every
    node points to its smallest neighbour, pointers are followed to their roots, and edges are
    carried over to the roots until none is left.  Each round at least halves the nodes that have
    edges.  Minima are combined before the shuffle, and joins have unique keys on one side, so
    adaptive execution can split the other side where a node has very many edges.  All rounds are
    tables in the shared folder; nothing goes through the driver.
    """
    spark = edges.sparkSession
    u, v = F.greatest(a, b), F.least(a, b)
    left = edges.where(F.col(a) != F.col(b)).select(u.alias("u"), v.alias("v")).distinct()
    edge_path, labels = scratch_path(spark, "edges"), None
    left = stored(left, path=edge_path)
    while not left.isEmpty():
        path = scratch_path(spark, "pointers")
        parent = stored(left.groupBy("u").agg(F.min("v").alias("p")), path=path)
        parent, _ = _pointers_to_roots(spark, parent, path)
        of_u = parent.select("u", F.col("p").alias("pu"))
        of_v = parent.select(F.col("u").alias("v"), F.col("p").alias("pv"))
        moved = (
            left.join(of_u, "u")
            .join(of_v, "v", "left")
            .select("pu", F.coalesce("pv", "v").alias("pv"))
            .where("pu <> pv")
            .select(F.greatest("pu", "pv").alias("u"), F.least("pu", "pv").alias("v"))
            .distinct()
        )
        next_path = scratch_path(spark, "edges")
        left = stored(moved, path=next_path)
        discard(spark, edge_path)
        edge_path = next_path
        step = parent.select(F.col("u").alias("node"), F.col("p").alias("root"))
        if labels is None:
            labels = step
        else:
            onward = step.select(F.col("node").alias("root"), F.col("root").alias("onward"))
            labels = (
                labels.join(onward, "root", "left")
                .select("node", F.coalesce("onward", "root").alias("root"))
                .unionByName(step)
            )
    if labels is None:
        return left.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stored(labels, "components")


def gapless_numbers(
    df: DataFrame, group: Sequence[str], spread: Sequence[str], into: str, bucket_rows: int = 50_000
) -> DataFrame:
    """Number the rows of every group from 0 without gaps, in the order of a hash of ``spread``.

    A group of any size is cut into buckets by that hash, so that a bucket holds about
    ``bucket_rows`` rows; rows are numbered in their bucket, and what the earlier buckets of the
    group hold is added.  ``df`` should be a stored table: it is read three times, twice without its
    other columns.  Groups are not NULL, and their number is bounded by a parameter of the caller
    (shards, lengths up to the capacity): their sizes are broadcast.  Rows that are equal in ``spread`` share a bucket; repeated
    rows are numbered in any order.
    """
    bucket, order = free_name(df, "_bucket"), free_name(df, "_order")
    before, at = free_name(df, "_before"), free_name(df, "_at")
    sizes = df.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / bucket_rows).alias(at))
    hashed = (
        df.withColumn(order, F.xxhash64(*spread))
        .join(F.broadcast(sizes), list(group))
        .withColumn(bucket, F.pmod(F.col(order), F.col(at)))
        .drop(at)
    )
    earlier = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        hashed.groupBy(*group, bucket)
        .agg(F.count(F.lit(1)).alias(at))
        .select(*group, bucket, F.coalesce(F.sum(at).over(earlier), F.lit(0)).alias(before))
    )
    here = Window.partitionBy(*group, bucket).orderBy(order, *spread)
    return (
        hashed.withColumn(at, F.row_number().over(here).cast("long") - 1)
        .join(starts, [*group, bucket])
        .withColumn(into, F.col(before) + F.col(at))
        .drop(bucket, order, before, at)
    )


def utf8_bytes(text: Column) -> Column:
    """Length in UTF-8 bytes, 0 for NULL."""
    return F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long"))
