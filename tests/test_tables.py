"""Ordering, dedup, encoding, imputation and splitting."""

import itertools
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardlens.operators import impute, split
from wardlens.operators.dedup import duplicate_count, first_per_key
from wardlens.operators.encode import OneHot, OneHotModel, binary_target
from wardlens.operators.impute import MedianImputer, exact_medians
from wardlens.operators.order import ordered_index, rows_at_ranks, running_totals
from wardlens.operators.profile import frame_shape, missing_profile, target_balance
from wardlens.session import scratch_root


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one leading order value."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(50))).alias("k"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10**9)).alias("t"), "id")


@pytest.mark.parametrize("slices", [1, 4, 17])
def test_index_equals_the_global_order(spark, skewed, slices):
    out = ordered_index(skewed, ["k", "t", "id"], "idx", slices).collect()
    want = sorted((r["k"], r["t"], r["id"]) for r in skewed.collect())
    assert sorted((r["idx"], (r["k"], r["t"], r["id"])) for r in out) == list(enumerate(want, 1))


def test_hot_leading_value_spreads_over_slices(spark, skewed):
    ranged = skewed.repartitionByRange(8, "k", "t", "id")
    sizes = [r["count"] for r in ranged.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(sizes) < 1000


def test_index_of_nothing(spark):
    assert ordered_index(spark.range(0), ["id"], "idx").count() == 0


def test_rows_at_ranks(spark, skewed):
    want = sorted((r["k"], r["t"], r["id"]) for r in skewed.collect())
    n, found = rows_at_ranks(skewed, ["k", "t", "id"], lambda n: [0, 1, n // 2, n, n + 1], 5)
    assert n == 3000
    assert {r: tuple(v) for r, v in found.items()} == {r: want[r - 1] for r in (1, 1500, 3000)}


@pytest.mark.parametrize("slices", [1, 4, 17])
def test_running_totals_per_group(spark, slices):
    rows = [(g, v, (v * 7) % 5) for g, size in ((None, 40), ("a", 300), ("b", 3)) for v in range(size)]
    df = spark.createDataFrame(rows, "g string, v int, x long")
    out = running_totals(df, ["g"], [F.col("v").desc()], {"x": ("upto", "all")}, slices).collect()
    assert len(out) == len(rows)
    for g in (None, "a", "b"):
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: -r[1])
        totals = itertools.accumulate(r[2] for r in mine)
        got = sorted((r for r in out if r["g"] == g), key=lambda r: -r["v"])
        assert [r["upto"] for r in got] == list(totals)
        assert {r["all"] for r in got} == {sum(r[2] for r in mine)}


def test_first_per_key_is_the_ordered_first(spark, plan_of):
    rows = [(1, 30), (1, 10), (2, 5), (None, 9), (None, 8), (1, 20)]
    df = spark.createDataFrame(rows, "p int, e int")
    out = first_per_key(df, ["p"], ["e"])
    assert sorted(map(tuple, out.collect()), key=str) == [(1, 10), (2, 5), (None, 8)]
    assert "WindowGroupLimit" in plan_of(out)


def test_first_per_hot_key_ships_one_row_per_task(spark, plan_of):
    df = spark.range(20000).select(F.when(F.col("id") % 3 != 0, 1).otherwise(F.col("id")).alias("p"), "id")
    out = first_per_key(df, ["p"], ["id"])
    assert out.count() == 6668 and out.where("p = 1").first()["id"] == 1
    plan = plan_of(out)
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_duplicate_count_counts_the_null_group(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "p int")
    assert tuple(duplicate_count(df, ["p"]).first()) == (5, 3, 2)


def test_one_hot(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("c", 4), ("B", 5)], "c string, n int")
    model = OneHot().fit(df)
    assert model.vocabulary == {"c": ["B", "a", "b", "c"]}
    out = model.transform(df)
    assert out.columns == ["n", "c_a", "c_b", "c_c"]
    got = {r["n"]: (r["c_a"], r["c_b"], r["c_c"]) for r in out.collect()}
    assert got == {1: (0, 1, 0), 2: (1, 0, 0), 3: (0, 0, 0), 4: (0, 0, 1), 5: (0, 0, 0)}
    assert out.select(F.max(F.col("c_a") + F.col("c_b") + F.col("c_c"))).first()[0] <= 1


def test_one_hot_unseen_value_and_all_null(spark):
    assert OneHotModel({"c": ["a", "b"]}).transform(
        spark.createDataFrame([("z",)], "c string")).first()["c_b"] == 0
    nulls = spark.createDataFrame([(None, 1)], "c string, n int")
    assert OneHot().fit(nulls).transform(nulls).columns == ["n"]


def test_one_hot_refuses_more_categories_than_a_schema_holds(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("free_text"))
    with pytest.raises(ValueError, match="free_text"):
        OneHot(max_categories=20).fit(df)


@pytest.mark.parametrize("kind", ["int", "long"])
def test_dense_orders_beyond_the_square_root(spark, kind):
    """60,000 ints, whose squares overflow; a column with repeats is not dense, nor is one with a hole."""
    df = spark.range(1, 60_001).select(F.col("id").cast(kind).alias("o"))
    assert split._dense_size(df, F.col("o")) == 60_000
    late = split.temporal_split(df, ["o"], dense=True).where("split = 'test'").agg(F.min("o"), F.count("o")).first()
    assert tuple(late) == (48_001, 12_000)
    swapped = df.withColumn("o", F.when(F.col("o") == 7, 8).otherwise(F.col("o")).cast(kind))
    assert split._dense_size(swapped, F.col("o")) is None


@pytest.mark.parametrize("values", [[1, 3, 3, 4, 4, 6, 6, 9, 9], [1, 2, 2, 4], [0, 1, 2], [1, 2, None], [2, 1, 4 * 10**9], [1.0, 2.0]])
def test_not_dense(spark, values):
    kind = "double" if isinstance(values[0], float) else "long"
    assert split._dense_size(spark.createDataFrame([(v,) for v in values], f"o {kind}"), F.col("o")) is None


def test_split_of_large_numbers(spark):
    """Order values near four thousand million are cut by rank."""
    df = spark.range(4 * 10**9, 4 * 10**9 + 1000).toDF("o")
    assert split.temporal_split(df, ["o"], dense=True).where("split = 'test'").agg(F.min("o")).first()[0] == 4 * 10**9 + 800


def test_exact_medians(spark):
    data = {"odd": [3, 1, 2], "even": [10, 1, 2, 3], "one": [5], "copies": [4] * 9 + [1],
            "neg": list(np.random.default_rng(0).normal(size=501))}
    rows = [tuple(float(v[i]) if i < len(v) else None for v in data.values()) for i in range(501)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in data))
    got = {r["column"]: r["median"] for r in exact_medians(df, list(data)).collect()}
    for c, v in data.items():
        assert got[c] == pytest.approx(float(np.median(v)), abs=1e-15)


@pytest.mark.parametrize("keep", [2, 10_000])
def test_exact_medians_narrow_until_exact(spark, monkeypatch, keep):
    """Ties, even halves, lone middles between heavy ends, NaN and infinities, with brackets of any size."""
    monkeypatch.setattr(impute, "KEEP", keep)
    rng = np.random.default_rng(3)
    n = 4001
    data = {"normal": rng.normal(size=n), "few": rng.integers(0, 3, n), "halves": np.repeat([1.0, 2.0], 2000),
            "ends": np.concatenate([np.zeros(1990), np.ones(1990), np.linspace(0.4, 0.6, 20)]), "one": [7.0] * n,
            "skewed": rng.lognormal(0, 6, n), "even": rng.normal(size=n - 1), "mostly_nan": [float("nan")] * 3000 + [1.0] * 900,
            "some_nan": [float("nan")] * 30 + list(rng.random(3000)), "far": [-np.inf] * 2001 + [np.inf] * 2000, "none": []}
    rows = [tuple(float(v[i]) if i < len(v) else None for v in data.values()) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in data)).repartition(3)
    got = {r["column"]: r["median"] for r in exact_medians(df, list(data)).collect()}
    assert "none" not in got
    for c, v in data.items():
        if len(v):
            v = np.sort(v)  # NaN last
            want = (v[(len(v) - 1) // 2] + v[len(v) // 2]) / 2
            assert got[c] == want or math.isnan(want) and math.isnan(got[c]), c


def test_medians_shuffle_no_column(spark, plan_of):
    df = spark.range(1000).select((F.col("id") % 97).cast("double").alias("x"))
    assert "rangepartitioning" not in plan_of(exact_medians(df, ["x"]))


def test_imputer_keeps_an_empty_column_null(spark):
    df = spark.createDataFrame([(1, None, None), (None, None, 2), (4, None, 3)], "a int, b double, c int")
    out = MedianImputer().fit(df).transform(df).collect()
    assert [r["a"] for r in out] == [1.0, 2.5, 4.0] and all(r["b"] is None for r in out)
    assert [r["c"] for r in out] == [2.5, 2.0, 3.0]


def test_profiles(spark):
    df = spark.createDataFrame([(1, None), (0, "x"), (None, None)], "y int, s string")
    got = {r["column"]: (r["nulls"], r["null_share"]) for r in missing_profile(df).collect()}
    assert got == {"y": (1, 1 / 3), "s": (2, 2 / 3)}
    assert tuple(target_balance(df, "y").first()) == (3, 1, 1, 50.0)
    assert tuple(frame_shape(df).first()) == (3, 2)


def test_target(spark):
    df = spark.createDataFrame([("<30",), (">30",), ("NO",), (None,)], "readmitted string")
    assert [r[0] for r in binary_target(df).collect()] == [1, 0, 0, 0]


@pytest.mark.parametrize("n", [0, 1, 5, 99, 100])
def test_split_sizes(spark, n):
    df = spark.range(1, n + 1).toDF("o")
    for dense in (True, False):
        out = split.temporal_split(df, ["o"], dense=dense).collect()
        train = [r["o"] for r in out if r["split"] == "train"]
        test = [r["o"] for r in out if r["split"] == "test"]
        assert len(train) == int(n * 0.8) and len(train) + len(test) == n
        assert not train or not test or max(train) < min(test)


@settings(max_examples=8, deadline=None)
@given(st.integers(1, 60), st.floats(0.05, 0.95))
def test_split_cuts_a_composite_order(spark, n, fraction):
    df = spark.range(n).select((F.col("id") % 3).alias("a"), F.col("id").alias("b"))
    out = split.temporal_split(df, ["a", "b"], fraction).collect()
    train = sorted((r["a"], r["b"]) for r in out if r["split"] == "train")
    assert train == sorted((i % 3, i) for i in range(n))[:int(n * (1 - fraction))]


def test_split_needs_a_total_order(spark):
    with pytest.raises(ValueError, match="tie"):
        split.temporal_split(spark.range(10).select(F.lit(1).alias("a")), ["a"])
    with pytest.raises(ValueError, match="nulls"):
        split.temporal_split(spark.createDataFrame([(1,), (None,), (3,)], "a int"), ["a"])


def test_split_reads_timestamps_without_zone(spark, medium):
    events = spark.read.parquet(f"{medium}/events.parquet")
    out = split.temporal_split(events, ["ts", "event_id"]).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in out} == {"train": 8000, "test": 2000}


def test_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "y int")
    assert tuple(split.class_ratio(df, "y").first()) == (2, 6, 3.0)
    assert split.class_ratio(df.where("y = 0"), "y").first()["ratio"] == 6.0
    got = {r["y"]: r["weight"] for r in split.balanced_weight(df, "y").collect()}
    assert got == {0: 8 / 12, 1: 8 / 4}
    assert {r["y"]: r["weight"] for r in split.positive_weight(df, "y").collect()} == {0: 1.0, 1: 3.0}


def test_scratch_follows_the_session_setting(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_split_of_a_gapped_order_cuts_by_position(spark):
    df = spark.range(1, 101).toDF("o").where("o > 50")
    assert split.early_rows(df, ["o"], dense=True) is not None
    counts = split.temporal_split(df, ["o"], dense=True).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in counts} == {"train": 40, "test": 10}


def test_balanced_weight_of_many_classes(spark):
    df = spark.range(30_000).select((F.col("id") % 15_000).alias("y"))
    assert {r["w"] for r in split.balanced_weight(df, "y", "w").select("w").distinct().collect()} == {1.0}
    mixed = spark.createDataFrame([(1,), (1,), (1,), (0,), (None,)], "y int")
    got = {r["y"]: r["weight"] for r in split.balanced_weight(mixed, "y").collect()}
    assert got == {1: pytest.approx(4 / 6), 0: 2.0, None: None}


def test_running_totals_need_one_shuffle_of_the_rows(spark, plan_of):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 1000).alias("x"), F.lit(1).alias("n"))
    out = running_totals(df, ["g"], [F.col("x")], {"n": ("upto", "all")}, slices=5)
    rows = sorted((r["g"], r["x"], r["upto"], r["all"]) for r in out.collect())
    for g in range(3):
        mine = [r for r in rows if r[0] == g]
        assert [r[2] for r in mine] == list(range(1, len(mine) + 1)) and {r[3] for r in mine} == {len(mine)}
    assert "Window" not in plan_of(out).split("BroadcastExchange")[0]
