"""Ensembles grown by one job against MLlib's own."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler

from wardlens.operators import boosting
from wardlens.session import durable

NAMES = [f"c{i}" for i in range(9)]
EXACT = ["treeID", "id", "rawCount", "leftChild", "rightChild", "featureIndex", "threshold"]


def vectors(spark, rows, parts=1, seed=3):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=rows), rng.integers(0, 5, rows), rng.integers(0, 2, rows), rng.integers(0, 40, rows),
                         np.ones(rows), rng.random(rows) < 0.05, rng.integers(0, 3, rows)]).astype(float)
    x = np.column_stack([x, 1 - x[:, 2], x[:, 1]])  # columns that split alike: ties
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=rows) > 1.8).astype(float)
    df = spark.createDataFrame([(float(t), 1.7 if t else 1.0, *map(float, r)) for r, t in zip(x, y)],
                               "label double, w double, " + ", ".join(f"{c} double" for c in NAMES))
    made = VectorAssembler(inputCols=NAMES, outputCol="features").transform(df).select("features", "label", "w")
    # Read by one task per file.
    return durable(made.coalesce(1), "v") if parts == 1 else durable(made.repartition(parts), "v").repartition(parts)


def nodes(spark, model, path):
    model.write().overwrite().save(str(path))
    return (spark.read.parquet(f"{path}/data").selectExpr("treeID", "nodeData.*")
            .selectExpr("* EXCEPT (split)", "split.featureIndex", "try_element_at(split.leftCategoriesOrThreshold, 1) AS threshold")
            .orderBy("treeID", "id").toPandas())


CASES = {
    "leaf size": (1500, dict(maxIter=5, maxDepth=7, subsamplingRate=0.8, featureSubsetStrategy="0.8", minInstancesPerNode=20)),
    "pure leaves": (300, dict(maxIter=4, maxDepth=9, subsamplingRate=0.7, featureSubsetStrategy="0.6")),
    "all rows and features": (300, dict(maxIter=4, maxDepth=3)),
    "one leaf": (60, dict(maxIter=3, maxDepth=2, minInstancesPerNode=50)),
}


@pytest.mark.parametrize("case", CASES)
def test_ensemble_is_mllibs(spark, tmp_path, case):
    """Node by node and bit by bit: the draws, the features of a node, the sums and the ties."""
    rows, settings = CASES[case]
    table, booster = vectors(spark, rows), GBTClassifier(weightCol="w", seed=42, stepSize=0.1, **settings)
    want, got = booster.fit(table), boosting.fit_trees(booster, table)
    assert nodes(spark, got, tmp_path / "a").to_json() == nodes(spark, want, tmp_path / "b").to_json()
    assert got.treeWeights == want.treeWeights and got.uid == want.uid
    assert {p.name: v for p, v in got.extractParamMap().items()} == {p.name: v for p, v in want.extractParamMap().items()}
    assert got.transform(table).collect() == want.transform(table).collect()


@pytest.mark.parametrize("shortened", [False, True])
def test_tasks_grow_one_ensemble_together(spark, tmp_path, monkeypatch, shortened):
    """Three tasks that exchange sums, with and without sums that follow from a sibling's, grow MLlib's splits."""
    monkeypatch.setattr(boosting, "TASK_CELLS", 1)
    monkeypatch.setattr(boosting, "EXACT_ROWS", 0 if shortened else 10 ** 9)
    monkeypatch.setattr(boosting, "LARGE", 100)
    table = vectors(spark, 2500, 3)
    booster = GBTClassifier(weightCol="w", seed=7, maxIter=4, maxDepth=4, subsamplingRate=0.8, featureSubsetStrategy="0.5", minInstancesPerNode=30)
    want, got = nodes(spark, booster.fit(table), tmp_path / "a"), nodes(spark, boosting.fit_trees(booster, table), tmp_path / "b")
    if not shortened:
        assert (want[EXACT].fillna(0) == got[EXACT].fillna(0)).all(axis=None)
    # Columns that split alike may stand for each other, and then leaves may change places.
    for tree in range(4):
        a, b = (np.sort(t[(t["treeID"] == tree) & (t["leftChild"] < 0)]["prediction"]) for t in (want, got))
        np.testing.assert_allclose(a, b, rtol=1e-9, atol=1e-12)


def test_a_fit_is_a_few_jobs(spark):
    table, context = vectors(spark, 200), spark.sparkContext
    context.setJobGroup("a fit of 30 rounds", "")
    try:
        boosting.fit_trees(GBTClassifier(weightCol="w", seed=1, maxIter=30, maxDepth=4), table)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(context.statusTracker().getJobIdsForGroup("a fit of 30 rounds")) < 25


def test_draws_do_not_depend_on_where_rows_are(spark):
    random = spark._jvm.org.apache.spark.util.random.XORShiftRandom(47)
    want = np.array([random.nextDouble() for _ in range(2500)]) < 0.3
    for starts in ([0, 1024, 2048], [2048, 0, 1024]):
        start = np.array(starts)
        rows = np.minimum(1024, 2500 - start)
        got = boosting.Draws(np.full(3, 4), start, rows)(42, 0.3)
        assert (got == np.concatenate([want[s:s + n] for s, n in zip(start, rows)])).all()


def test_nodes_beyond_the_memory_wait(spark, tmp_path):
    """A pass takes no more nodes than MLlib's, which decides the features of those after it."""
    table = vectors(spark, 800)
    booster = GBTClassifier(weightCol="w", seed=5, maxIter=2, maxDepth=11, featureSubsetStrategy="0.5", maxMemoryInMB=0)
    assert nodes(spark, boosting.fit_trees(booster, table), tmp_path / "a").to_json() == nodes(spark, booster.fit(table), tmp_path / "b").to_json()
