"""Sharding by a k-d tree over document metadata.

Every document has a coordinate from 0 to 1023 in each metadata dimension.  A node with more than one
leaf is split along the dimension in which its documents spread widest, at the weighted median (or the
quantile that belongs to the leaves on either side), and so on until every node is one shard.  All
nodes of a level are split together: three aggregations find the boundary coordinate, and inside it the
boundary among hashes, so that weights are equal up to a document even if a third of all rows share
every coordinate.  The tables with a row per node are joined as Spark sees fit by their size.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.common import free_name, gapless_numbers
from marketloom.sources.scratch import discard, scratch_path, stored

COORDINATES = 1024
TIES = 4096


_NUMERIC = ("byte", "short", "integer", "long", "float", "double")


def _coordinates(stored_rows: DataFrame, dims: int) -> list[Column]:
    """0 for NULL or NaN; numbers by their place in the range of all, other values by a hash.

    ``stored_rows`` holds the dimensions as ``d0``, ``d1``, ...; their ranges are read from there.
    """
    numeric = [f"d{i}" for i in range(dims) if stored_rows.schema[f"d{i}"].dataType.typeName() in _NUMERIC]
    clean = {n: F.when(~F.isnan(F.col(n).cast("double")), F.col(n).cast("double")) for n in numeric}
    ranges = {}
    if numeric:
        ends = [f(clean[n]).alias(f"{k}{n}") for n in numeric for k, f in (("low", F.min), ("high", F.max))]
        row = stored_rows.agg(*ends).first()
        ranges = {n: (row[f"low{n}"], row[f"high{n}"]) for n in numeric}
    out = []
    for name in (f"d{i}" for i in range(dims)):
        column = F.col(name)
        if name not in ranges:
            place = 1 + F.pmod(F.xxhash64(column), F.lit(COORDINATES - 1))
            out.append(F.when(column.isNull(), 0).otherwise(place).cast("int"))
            continue
        low, high = ranges[name]
        value = column.cast("double")
        if low is None or high == low or math.isinf(high) or math.isinf(low):
            place = F.lit(1)
        else:
            place = 1 + F.floor((value - low) / F.lit(float(high - low)) * (COORDINATES - 2))
        out.append(F.when(column.isNull() | F.isnan(value), 0).otherwise(place).cast("int"))
    return out


def _boundary(weights: DataFrame, by: str, keep: list[str]) -> DataFrame:
    """Per node the first value of ``by`` at which the weight so far reaches the target.

    ``weights`` has one row per node and value: at most COORDINATES or TIES rows per node.
    """
    so_far = Window.partitionBy("node").orderBy(by)
    reached = weights.withColumn("upto", F.col("below") + F.sum("w").over(so_far)).withColumn(
        "before", F.col("upto") - F.col("w")
    )
    last = Window.partitionBy("node").orderBy(F.col(by).desc())
    return (
        reached.withColumn("back", F.row_number().over(last))
        .where((F.col("upto") >= F.col("target")) | (F.col("back") == 1))
        .groupBy("node", *keep, "target")
        .agg(F.min_by(F.struct(by, "before", "upto"), by).alias("at"))
        .select("node", *keep, "target", f"at.{by}", F.col("at.before").alias("below"), F.col("at.upto").alias("upto"))
    )


def _splits(rows: DataFrame, dims: int) -> DataFrame:
    """(node, dim, c, t1, t2): what lies below (c, t1, t2) along ``dim`` goes to the left.

    Each of the three boundaries is a stored table of one row per node, so a level's plans do not
    contain each other.
    """
    open_rows = rows.where("leaves > 1")
    axes = F.posexplode(F.array(*[f"c{i}" for i in range(dims)])).alias("dim", "c")
    weights = open_rows.select("node", "leaves", "w", axes).groupBy("node", "leaves", "dim", "c").agg(F.sum("w").alias("w"))
    widest = (
        weights.groupBy("node", "dim")
        .agg((F.max("c") - F.min("c")).alias("width"))
        .groupBy("node")
        .agg(F.max(F.struct("width", (-F.col("dim")).alias("back"))).alias("best"))
        .select("node", (-F.col("best.back")).alias("dim"))
    )
    total = Window.partitionBy("node")
    share = F.floor(F.col("leaves") / 2) / F.col("leaves")
    along = (
        weights.join(widest, ["node", "dim"])
        .withColumn("target", F.sum("w").over(total) * share)
        .withColumn("below", F.lit(0).cast("long"))
    )
    first = stored(_boundary(along, "c", ["dim"]), "boundary")
    chosen = F.element_at(F.array(*[f"c{i}" for i in range(dims)]), F.col("dim") + 1)

    def inside(found: DataFrame, tie: str, fixed: list[str]) -> DataFrame:
        here = open_rows.join(found.drop("upto"), "node").where(chosen == F.col("c"))
        for f in fixed:
            here = here.where(F.col(f) == F.col(f"cut_{f}"))
        names = ["dim", "c", *[f"cut_{f}" for f in fixed]]
        return here.groupBy("node", *names, "target", "below", tie).agg(F.sum("w").alias("w"))

    second = stored(_boundary(inside(first, "t1", []), "t1", ["dim", "c"]).withColumnRenamed("t1", "cut_t1"), "boundary")
    third = _boundary(inside(second, "t2", ["t1"]), "t2", ["dim", "c", "cut_t1"])
    # the boundary value itself goes to the side that leaves the weights closer to the target
    nearer = F.col("upto") - F.col("target") <= F.col("target") - F.col("below")
    return third.select("node", "dim", "c", "cut_t1", (F.col("t2") + nearer.cast("int")).alias("cut_t2"))


def _descend(rows: DataFrame, splits: DataFrame, dims: int) -> DataFrame:
    chosen = F.element_at(F.array(*[f"c{i}" for i in range(dims)]), F.col("dim") + 1)
    mine, cut = F.struct(chosen, "t1", "t2"), F.struct("c", "cut_t1", "cut_t2")
    left_leaves = F.floor(F.col("leaves") / 2).cast("int")
    left = mine < cut
    return (
        rows.join(splits, "node", "left")
        .withColumn("left_leaves", left_leaves)
        .withColumn("go", F.when(F.col("dim").isNull(), 0).when(left, 1).otherwise(2))
        .withColumn("node", F.when(F.col("go") == 2, F.col("node") + F.col("left_leaves")).otherwise(F.col("node")))
        .withColumn(
            "leaves",
            F.when(F.col("go") == 1, F.col("left_leaves"))
            .when(F.col("go") == 2, F.col("leaves") - F.col("left_leaves"))
            .otherwise(F.col("leaves")),
        )
        .drop("dim", "c", "cut_t1", "cut_t2", "left_leaves", "go")
    )


def kd_shards(
    df: DataFrame,
    size: Column,
    dimensions: Mapping[str, Column],
    together: Column,
    shards: int | None = None,
    target_bytes: int | None = None,
) -> DataFrame:
    """All columns of ``df`` with ``shard`` (from 0) and ``slot`` (gapless from 0 in its shard).

    ``size`` is the weight of a row, ``dimensions`` its metadata, ``together`` what should stay side by
    side among rows with equal coordinates.  Give the number of shards, or the bytes that one should
    have.  Shards get nearly the same weight.  NULL metadata has a coordinate of its own, repeated rows
    are sharded one by one, and an empty table gives an empty result.  Columns of ``df`` that are
    called ``shard`` or ``slot`` are replaced.  The frame is stored once and joined again once, by
    row number; each level reads and writes coordinates and weights only.
    """
    df = df.drop("shard", "slot")
    spark, names = df.sparkSession, list(df.columns)
    payload = free_name(df, "_row_of_df")
    dims = len(dimensions)
    base = stored(
        df.select(
            F.struct(*[F.col(f"`{c}`") for c in names]).alias(payload),
            F.coalesce(size.cast("long"), F.lit(0).cast("long")).alias("w"),
            *[d.alias(f"d{i}") for i, d in enumerate(dimensions.values())],
            F.pmod(F.xxhash64(together), F.lit(TIES)).cast("int").alias("t1"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-rows",
    )
    if shards is None:
        total = base.agg(F.sum("w")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    path = scratch_path(spark, "level")
    narrow = base.select(
        "row", "w", *[c.alias(f"c{i}") for i, c in enumerate(_coordinates(base, dims))], "t1",
        F.pmod(F.xxhash64("row"), F.lit(TIES)).cast("int").alias("t2"),
        F.lit(0).alias("node"), F.lit(shards).cast("int").alias("leaves"),
    )
    rows = stored(narrow, path=path)
    for level in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        splits = stored(_splits(rows, dims), f"splits-{level}")
        next_path = scratch_path(spark, "level")
        rows = stored(_descend(rows, splits, dims).select(*narrow.columns), path=next_path)
        discard(spark, path)
        path = next_path
    numbered = gapless_numbers(rows.select("row", F.col("node").alias("shard")), ["shard"], ["row"], "slot")
    whole = numbered.join(base.select("row", payload), "row")
    return whole.select(*[F.col(f"{payload}.`{c}`").alias(c) for c in names], "shard", "slot")
