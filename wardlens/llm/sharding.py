"""Longest-processing-time sharding of groups that must stay together."""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlens.functions.scalar import quoted
from wardlens.llm.common import without
from wardlens.session import durable


def schedule(sizes: Iterable[tuple[object, int]], shards: int) -> dict[object, int]:
    """Each item, largest first (ties by its key), goes to the least-loaded shard, the first of equals."""
    heap = [(0, s) for s in range(shards)]
    placed = {}
    for key, size in sorted(sizes, key=lambda x: (-x[1], str(x[0]))):
        load, shard = heapq.heappop(heap)
        placed[key] = shard
        heapq.heappush(heap, (load + size, shard))
    return placed


def assign(df: DataFrame, group: str, size: str, shards: int, *, shard: str = "shard",
           fine: int = 1000, bundles: int = 500) -> DataFrame:
    """Add the shard of each row; rows of one ``group`` value stay together and sizes come out near equal.

    Groups of at least a ``fine``-th of a shard's fair share are scheduled one
    by one: there are at most ``shards * fine`` of them. Smaller groups are
    bundled by hash into ``shards * bundles`` bundles of near equal size, and a
    bundle is scheduled as one item. Both counts are parameters and do not grow
    with the table, so the heap runs over a bounded list whatever the data, and
    the list travels back as a broadcast of bounded size. The largest group
    bounds how equal the shards can be. Null is a group of its own; null sizes
    count 0; ties are settled by the group's value; an empty table stays empty.
    """
    g = F.xxhash64(quoted(group).isNull(), quoted(group))
    keyed = df.select(*[quoted(c) for c in without(df, shard, "__bundle")]).withColumn(
        "__bundle", F.pmod(g, F.lit(shards * bundles)))
    sums = durable(keyed.groupBy(quoted(group).alias("g"), "__bundle")
                   .agg(F.sum(F.coalesce(quoted(size), F.lit(0))).alias("size")), "shard-groups")
    total = sums.agg(F.sum("size").alias("n")).first()["n"] or 0
    least = max(1, -(-total // (shards * fine)))
    large = sums.where(F.col("size") >= least).select("g", "size").collect()
    small = sums.where(F.col("size") < least).groupBy("__bundle").agg(F.sum("size").alias("size")).collect()
    items = [(("g", r["g"]), r["size"]) for r in large] + [(("b", r["__bundle"]), r["size"]) for r in small]
    placed = schedule(items, shards)
    spark = df.sparkSession
    kind = sums.schema["g"].dataType.simpleString()
    groups = spark.createDataFrame([(k, s) for (t, k), s in placed.items() if t == "g"], f"__g {kind}, __of_group int")
    bags = spark.createDataFrame([(k, s) for (t, k), s in placed.items() if t == "b"], "__b long, __of_bundle int")
    return (keyed.join(F.broadcast(groups), quoted(group).eqNullSafe(F.col("__g")), "left")
            .join(F.broadcast(bags), F.col("__bundle") == F.col("__b"), "left")
            .withColumn(shard, F.coalesce("__of_group", "__of_bundle"))
            .drop("__bundle", "__g", "__of_group", "__b", "__of_bundle"))


def number_rows(df: DataFrame, shard: str, order: list[str], slot: str = "slot",
                rows_per_task: int = 500_000) -> DataFrame:
    """Add a gapless number from 0 inside each shard.

    A shard's rows are dealt by hash into runs of about ``rows_per_task``; the
    runs' counts give each its first number, so no task sorts a whole shard.
    Rows equal in ``order`` are interchangeable.
    """
    runs = max(1, -(-df.count() // rows_per_task))
    keyed = df.withColumn("__run", F.pmod(F.xxhash64(*[quoted(c) for c in order]), F.lit(runs)))
    counts = keyed.groupBy(quoted(shard).alias("__shard"), F.col("__run").alias("__at")).agg(F.count(F.lit(1)).alias("n"))
    first = counts.withColumn("__first", F.sum("n").over(Window.partitionBy("__shard").orderBy("__at")) - F.col("n")).drop("n")
    inside = Window.partitionBy(quoted(shard), "__run").orderBy(*[quoted(c) for c in order])
    return (keyed.withColumn(slot, F.row_number().over(inside).cast("long") - 1)
            .join(first, (quoted(shard) == F.col("__shard")) & (F.col("__run") == F.col("__at")))
            .withColumn(slot, F.col(slot) + F.col("__first")).drop("__run", "__shard", "__at", "__first"))
