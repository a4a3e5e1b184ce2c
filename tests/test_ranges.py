"""Ranges that overlap much, and odd keys of ranges."""

import pytest
from pyspark.sql import functions as F

from wardlens.operators.ranges import label_ranges


@pytest.mark.parametrize("count", [1, 7, 70_000])
def test_wide_overlapping_ranges_meet_no_pairs(spark, plan_of, count):
    ranges = spark.range(3000).select((F.col("id") * -1.0).alias("low"), (F.lit(count / 2) + F.col("id")).alias("high"),
                                      (F.lit(3000) - F.col("id")).alias("position"), F.col("id").alias("label"))
    df = spark.range(count).select("id", F.col("id").cast("double").alias("v"))
    out = label_ranges(df, "v", ranges, default="none")
    assert "__low" not in plan_of(out)  # numbers and ranges are joined on equal keys alone
    wrong = out.where(F.col("label") != F.when(F.col("v") <= count / 2 + 2999, F.lit("2999")).otherwise("none"))
    assert out.count() == count and wrong.count() == 0


def test_ranges_with_equal_null_and_unsigned_keys(spark):
    ranges = spark.createDataFrame([(0.0, 1.0, 5, "b"), (0.0, 1.0, 5, "a"), (2.0, 3.0, None, "n"), (2.0, 3.0, 1, "m"),
                                    (-0.0, 0.0, 9, "zero"), (4.0, 5.0, 1, None), (4.0, 5.0, 2, "late")],
                                   "low double, high double, position int, label string")
    df = spark.createDataFrame([(0, 0.0), (1, -0.0), (2, 0.5), (3, 2.5), (4, 4.5), (5, 9.0), (6, None)], "id int, v double")
    got = {r["id"]: r["label"] for r in label_ranges(df, "v", ranges, default="none").collect()}
    assert got == {0: "a", 1: "a", 2: "a", 3: "n", 4: "none", 5: "none", 6: "none"}
