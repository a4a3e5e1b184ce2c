"""Keep-first de-duplication and duplicate counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardlens.functions.scalar import quoted

_RANK = "__rank"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The earliest row of every key; ``order`` must be total within a key.

    Filtering ``row_number() = 1`` plans as a group limit before the shuffle,
    so a map task ships at most one row per key and a hot key costs no more
    than one row per task. Null keys form one group.
    """
    window = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(*[quoted(c) for c in order])
    return (df.withColumn(_RANK, F.row_number().over(window))
            .where(F.col(_RANK) == 1).drop(_RANK))


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, rows a keep-first de-duplication removes."""
    per_key = df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"))
    return (per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                        F.count(F.lit(1)).alias("distinct_keys"))
            .withColumn("removed", F.col("rows") - F.col("distinct_keys")))
