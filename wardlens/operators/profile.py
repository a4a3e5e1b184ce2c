"""Whole-table profiles: one aggregation pass each, one small result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.functions.scalar import quoted


def missing_profile(df: DataFrame) -> DataFrame:
    """Null count and share of every column, in long form."""
    nulls = [F.count_if(quoted(c).isNull()).alias(c) for c in df.columns]
    one_row = df.agg(F.count(F.lit(1)).alias("__rows"), *nulls)
    return (one_row.unpivot(["__rows"], [quoted(c) for c in df.columns], "column", "nulls")
            .select("column", "nulls", (F.col("nulls") / F.col("__rows")).alias("null_share")))


def columns_with_nulls(df: DataFrame, columns: list[str]) -> list[str]:
    """Which of the columns hold any null: one pass, one row to the driver."""
    if not columns:
        return []
    row = df.agg(*[F.coalesce(F.bool_or(quoted(c).isNull()), F.lit(False)).alias(c)
                   for c in columns]).first()
    return [c for c in columns if row[c]]


def target_balance(df: DataFrame, target: str) -> DataFrame:
    """Rows, positives, negatives and the positive percentage of a 0/1 target."""
    y = quoted(target)
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_if(y == 1).alias("positives"),
                  F.count_if(y == 0).alias("negatives"),
                  (F.avg(y) * 100).alias("positive_pct"))


def frame_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def class_counts(df: DataFrame, target: str) -> DataFrame:
    return df.groupBy(quoted(target).alias("value")).agg(F.count(F.lit(1)).alias("rows"))


def positive_rate_pct(df: DataFrame, target: str) -> DataFrame:
    return df.agg((F.avg(quoted(target)) * 100).alias("positive_rate_pct"))
