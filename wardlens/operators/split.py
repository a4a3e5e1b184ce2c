"""Chronological holdout split and class weighting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.functions.scalar import exact_literal, lexicographic_le, quoted
from wardlens.operators.order import rows_at_ranks

TRAIN, TEST = "train", "test"


def train_size(rows: int, test_fraction: float) -> int:
    return int(rows * (1 - test_fraction))


def early_rows(df: DataFrame, order: Sequence[str], test_fraction: float = 0.20,
               dense: bool = False) -> Column:
    """Condition that holds on the first rows of the total order.

    Only the cut is looked up; the condition is a plain comparison that a scan
    can use to skip data. ``dense`` says that the single order column should
    count 1..N; where that is confirmed the cut is arithmetic, else, as after a
    filter, it is looked up like any other.
    """
    if dense and (n := _dense_size(df, quoted(order[0]))) is not None:
        return quoted(order[0]) <= F.lit(train_size(n, test_fraction))
    n, found = rows_at_ranks(df, order, lambda n: _cut_ranks(n, test_fraction))
    return _before_cut(df, order, found, train_size(n, test_fraction))


def temporal_split(df: DataFrame, order: Sequence[str], test_fraction: float = 0.20,
                   dense: bool = False, name: str = "split") -> DataFrame:
    """Label the first rows of the total order ``train`` and the last ``test``."""
    early = early_rows(df, order, test_fraction, dense)
    return df.withColumn(name, F.when(early, F.lit(TRAIN)).otherwise(F.lit(TEST)))


def temporal_halves(df: DataFrame, order: Sequence[str], test_fraction: float = 0.20,
                    dense: bool = False) -> tuple[DataFrame, DataFrame]:
    """The training and the test rows as two filters that reach the scan."""
    early = early_rows(df, order, test_fraction, dense)
    return df.where(early), df.where(~early)


def _dense_size(df: DataFrame, x: Column) -> int | None:
    """N if the integer column holds each of 1..N once, else None; exact at any size.

    Where count and ends fit, distinct values are counted as the bits of one
    bitmap per 32,768 numbers. Bitmaps fold on the map side, so what moves is
    an eighth of a byte per number and task that holds its neighbourhood.
    """
    if not isinstance(df.select(x).schema[0].dataType, T.IntegralType):
        return None
    ends = df.agg(F.count(F.lit(1)).alias("rows"), F.count(x).alias("n"), F.min(x).alias("low"), F.max(x).alias("high")).first()
    n = ends["rows"]
    if n == 0:
        return 0
    if ends["n"] != n or ends["low"] != 1 or ends["high"] != n:
        return None
    at = x.cast("long")
    bitmaps = df.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    return n if bitmaps.agg(F.sum(F.bitmap_count("bits")).alias("n")).first()["n"] == n else None


def _cut_ranks(n: int, test_fraction: float) -> list[int]:
    last = train_size(n, test_fraction)
    return [1, last, last + 1, n]


def _before_cut(df: DataFrame, order: Sequence[str], found: dict[int, Row], last: int) -> Column:
    edges = [found[r] for r in sorted(found)]
    if any(v is None for row in edges for v in row):
        raise ValueError(f"order columns {list(order)} hold nulls")
    if last not in found:
        return F.lit(False)
    cut = found[last]
    if found.get(last + 1) == cut:
        raise ValueError(f"order columns {list(order)} tie at the cut; add a tie-break column")
    bound = [exact_literal(cut[c], df.schema[c].dataType) for c in order]
    return lexicographic_le([quoted(c) for c in order], bound)


def split_summary(df: DataFrame, target: str, features: int, name: str = "split") -> DataFrame:
    """Rows and positive rate per split, and the feature count."""
    return (df.groupBy(quoted(name).alias("split"))
            .agg(F.count(F.lit(1)).alias("rows"), F.avg(quoted(target)).alias("positive_rate"))
            .withColumn("features", F.lit(features)))


def feature_names(df: DataFrame, excluded: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in set(excluded)]


def class_ratio(df: DataFrame, target: str) -> DataFrame:
    """Negatives per positive, with the positive count floored at one."""
    y = quoted(target)
    return (df.agg(F.count_if(y == 1).alias("positives"), F.count_if(y == 0).alias("negatives"))
            .withColumn("ratio", F.col("negatives") / F.greatest(F.col("positives"), F.lit(1))))


def positive_weight(df: DataFrame, target: str, name: str = "weight") -> DataFrame:
    """Weight positives by the class ratio and negatives by one."""
    ratio = class_ratio(df, target).first()["ratio"]
    return df.withColumn(name, F.when(quoted(target) == 1, F.lit(float(ratio))).otherwise(F.lit(1.0)))


def balanced_weight(df: DataFrame, target: str, name: str = "weight") -> DataFrame:
    """Weight each class by rows / (classes * rows of the class); null has no weight.

    The table of classes joins the rows, so any number of classes will do.
    """
    sizes = (df.where(quoted(target).isNotNull()).groupBy(quoted(target).alias("__class"))
             .agg(F.count(F.lit(1)).alias("__rows")))
    whole = sizes.agg(F.sum("__rows").alias("rows"), F.count(F.lit(1)).alias("classes")).first()
    weights = sizes.select("__class", (F.lit(whole["rows"]) / (F.lit(whole["classes"]) * F.col("__rows"))).alias("__value"))
    rest = [quoted(c) for c in df.columns if c != name]
    return (df.join(weights, quoted(target) == F.col("__class"), "left")
            .select(*rest, F.col("__value").alias(name)))
