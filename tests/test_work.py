"""How work is dealt: tasks, threads and blocks."""

import threading
from types import SimpleNamespace

import numpy as np
from pyspark.sql import functions as F

from bindings import modelling
from wardlens.operators import models, search, trees
from wardlens.session import durable, side_by_side, spread


def test_tasks_follow_the_work_of_a_row(spark):
    cores = spark.sparkContext.defaultParallelism
    table = durable(spark.range(0, 1000, 1, 1), "spread")
    assert spread(table, 1).rdd.getNumPartitions() == table.rdd.getNumPartitions()
    wide = spread(table, 2_000_000)
    assert [len(p) > 0 for p in wide.rdd.glom().collect()] == [True] * max(cores, 100)
    assert spread(table, 8_000).rdd.getNumPartitions() == min(cores, 4)


def test_attribution_rows_are_dealt_over_the_cores(spark):
    leaf = trees.Tree(*[np.array(a) for a in ([-1], [0.0], [-1], [-1], [0.5], [4.0])])
    rows = spark.range(0, 50, 1, 1).select("id", F.array(F.col("id").cast("double")).alias("features"))
    out = trees.shapley_values(rows, trees.Forest((leaf,), (1.0,)))
    assert out.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert sorted((r["id"], r["phi"], r["base"]) for r in out.collect()) == [(i, [0.0], 1.0) for i in range(50)]


def test_structure_fits_run_side_by_side(spark, monkeypatch):
    both = threading.Barrier(2, timeout=20)  # one fit after the other would break it
    leaf = SimpleNamespace(cover=np.array([100.0]), left=np.array([-1]))

    def fitted(session, sf_dir, preset):
        both.wait()
        return SimpleNamespace(ensemble=preset), None, None

    monkeypatch.setattr(modelling, "fitted_boosted", fitted)
    monkeypatch.setattr(modelling, "read_forest", lambda preset: SimpleNamespace(
        trees=[leaf] * preset.max_depth, weights=(1.0, preset.learning_rate)))
    got = {r["preset"]: r["trees"] for r in modelling.q_boosted_structure(spark, "nowhere").collect()}
    assert got == {"a": models.BOOSTED_A.max_depth, "b": models.BOOSTED_B.max_depth}


def test_fits_side_by_side_share_the_cores(spark, monkeypatch, tmp_path):
    """A trial's table has no more tasks than its part of the cores, and all its rows."""
    cores, seen = spark.sparkContext.defaultParallelism, []
    rows = spark.range(40).select("id", (F.col("id") % 2).cast("int").alias("y"), F.col("id").cast("double").alias("x"), F.lit(1.0).alias("w"))
    monkeypatch.setattr(search, "training_vectors", lambda *args: durable(rows.repartition(2 * cores), "vectors").repartition(2 * cores))
    real = search.fit_boosted

    def fit(*args, vectors):
        seen.append((vectors.rdd.getNumPartitions(), sorted(r["id"] for r in vectors.collect())))
        return real(*args)

    monkeypatch.setattr(search, "fit_boosted", fit)
    trials = search.sample_trials(spark.range(2).toDF("trial"), {**search.SPACES["lgb"], "n_estimators": search.IntRange(1, 2), "max_depth": search.IntRange(1, 2)})
    out = search.run_trials(trials, rows, rows, ["x"], "y", "w", "id", ledger=str(tmp_path / "l")).collect()
    assert len(out) == 2 and seen == [(-(-cores // 2), list(range(40)))] * 2


def test_large_tables_keep_their_tasks(spark):
    table = spark.range(0, 1000, 1, 8)
    assert side_by_side(table, 1, 8 * spark.sparkContext.defaultParallelism).rdd.getNumPartitions() == 1
    assert side_by_side(table, 20_000, 10_000).rdd.getNumPartitions() == 4
    assert side_by_side(table, 10 ** 9, 10_000).rdd.getNumPartitions() == 8
