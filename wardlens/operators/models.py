"""Distributed fits: the scaled logistic baseline and the boosted-tree presets."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import (
    GBTClassificationModel, GBTClassifier, LogisticRegression,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardlens.functions.scalar import quoted
from wardlens.operators.boosting import fit_trees
from wardlens.operators.metrics import average_precision, with_prediction
from wardlens.operators.scale import StandardScale
from wardlens.operators.trees import Forest, read_forest, staged_margins
from wardlens.session import concurrently, durable, ensure_checkpoint_dir, spread

_SCALED = "__scaled"


def assembler(names: Sequence[str], output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(names), outputCol=output, handleInvalid="error")


def assemble(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Feature vector in the order of ``names``; a null feature is an error."""
    return assembler(names).transform(df)


def training_vectors(train: DataFrame, stages: Sequence[Transformer], label: str,
                     weight: str) -> DataFrame:
    """Features, label and weight as a written table.

    Iterative fits submit hundreds of jobs. From the written table each of them
    ships a short plan and reads three columns, and a lost executor costs a
    re-read instead of the whole preparation. The rebalance gives files of the
    advisory size, so a small table does not pay for many tasks in every job.
    """
    vectors = train
    for stage in stages:
        vectors = stage.transform(vectors)
    return durable(vectors.select("features", quoted(label).cast("double").alias(label),
                                  quoted(weight)).hint("rebalance"), "vectors")


def fit_logistic(train: DataFrame, names: Sequence[str], label: str, weight: str,
                 c: float = 0.1, max_iter: int = 1000) -> PipelineModel:
    """L2-penalised logistic regression on scaled features, intercept free.

    With inverse strength ``c`` the summed loss is weighted against half the
    squared norm; the fit here averages the loss, hence ``1 / (c * weights)``.
    """
    scaling = StandardScale(list(names)).fit(train)
    total = train.agg(F.sum(quoted(weight)).alias("w")).first()["w"]
    fit = LogisticRegression(featuresCol="features", labelCol=label, weightCol=weight,
                             regParam=1.0 / (c * total), elasticNetParam=0.0,
                             standardization=False, maxIter=max_iter, tol=1e-9)
    stages = [scaling.stage(_SCALED), assembler([n + _SCALED for n in names])]
    return PipelineModel([*stages, fit.fit(training_vectors(train, stages, label, weight))])


@dataclass(frozen=True)
class BoostPreset:
    rounds: int = 500
    learning_rate: float = 0.05
    max_depth: int = 6
    row_fraction: float = 0.8
    column_fraction: float = 0.8
    min_rows: int = 1
    patience: int | None = None
    seed: int = 42


# The two boosted-tree settings. The second one was tuned for a
# leaf-wise grower with at most 63 leaves of at least 20 rows; these trees grow
# level by level and have no leaf cap, so only the leaf size carries over.
BOOSTED_A = BoostPreset(max_depth=6, patience=30)
BOOSTED_B = BoostPreset(max_depth=8, min_rows=20)


@dataclass(frozen=True)
class BoostedModel:
    """A fitted ensemble and how many of its rounds to use."""

    pipeline: PipelineModel
    rounds: int

    @property
    def ensemble(self) -> GBTClassificationModel:
        return self.pipeline.stages[-1]

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``proba``; an early-stopped model scores with its first trees, like any other in the JVM."""
        scored = first_trees(self.ensemble, self.rounds).transform(self.pipeline.stages[0].transform(df))
        return (scored.withColumn("proba", vector_to_array("probability")[1])
                .drop("features", "rawPrediction", "probability", "prediction"))


def first_trees(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """An ensemble of the first trees of another, with its settings."""
    if rounds >= model.getNumTrees:
        return model
    whole = model._java_obj
    jvm, gateway = SparkSession.active()._jvm, SparkSession.active().sparkContext._gateway
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(jvm.double, rounds)
    for i, (tree, weight) in enumerate(zip(whole.trees()[:rounds], whole.treeWeights()[:rounds])):
        trees[i], weights[i] = tree, weight
    head = jvm.org.apache.spark.ml.classification.GBTClassificationModel(f"{model.uid}_{rounds}", trees, weights)
    settings = whole.extractParamMap()
    return GBTClassificationModel(head.copy(settings))


def save_model(model: PipelineModel | BoostedModel, path: str) -> None:
    """Persist a fitted model, replacing what is there."""
    boosted = isinstance(model, BoostedModel)
    (model.pipeline if boosted else model).write().overwrite().save(f"{path}/pipeline")
    rounds = F.lit(model.rounds if boosted else None).cast("int").alias("rounds")
    SparkSession.active().range(1).select(rounds).write.mode("overwrite").parquet(f"{path}/rounds")


def load_model(path: str) -> PipelineModel | BoostedModel:
    rounds = SparkSession.active().read.schema("rounds int").parquet(f"{path}/rounds").first()["rounds"]
    pipeline = PipelineModel.load(f"{path}/pipeline")
    return pipeline if rounds is None else BoostedModel(pipeline, rounds)


def fit_boosted(train: DataFrame, names: Sequence[str], label: str, weight: str,
                preset: BoostPreset, evaluation: DataFrame | None = None,
                vectors: DataFrame | None = None) -> BoostedModel:
    """Boosted trees; with patience, keep the best round on the evaluation rows.

    ``vectors`` are the written training vectors when several fits share them.
    """
    ensure_checkpoint_dir(train.sparkSession)
    booster = GBTClassifier(
        featuresCol="features", labelCol=label, weightCol=weight, maxIter=preset.rounds,
        stepSize=preset.learning_rate, maxDepth=preset.max_depth,
        subsamplingRate=preset.row_fraction, featureSubsetStrategy=str(preset.column_fraction),
        minInstancesPerNode=preset.min_rows, seed=preset.seed)
    stage = assembler(names)
    if vectors is None:
        vectors = training_vectors(train, [stage], label, weight)
    model = BoostedModel(PipelineModel([stage, fit_trees(booster, vectors)]), preset.rounds)
    if preset.patience is None or evaluation is None:
        return model
    curve = (round_curve(model, evaluation, label, preset.patience)
             .withColumn("model", F.lit("boosted")))
    best = early_stop_round(curve, "round", "auprc", preset.patience, ["model"]).first()
    return replace(model, rounds=best["best_round"])


def round_curve(model: BoostedModel, evaluation: DataFrame, label: str, patience: int | None = None,
                block: int = 50) -> DataFrame:
    """Average precision after each boosting round, 1-based.

    Rounds are scored in blocks, each from the margins the block before left
    behind, so a row is spread over ``block`` rounds at a time. With
    ``patience`` the curve ends with the block in which that many rounds have
    passed without gain: later rounds cannot change where to stop. Without it
    the blocks' curves do not wait for each other.
    """
    forest = read_forest(model.ensemble)
    vectors = model.pipeline.stages[0].transform(evaluation).select(
        quoted(label).alias("label"), vector_to_array("features").alias("features"), F.lit(0.0).alias("before"))
    now, parts, values, later = spread(durable(vectors, "curve"), block * 50), [], [], []
    for start in range(0, len(forest.trees), block):
        piece = Forest(forest.trees[start:start + block], forest.weights[start:start + block])
        staged = durable(staged_margins(now.withColumn("kept", F.col("features")), piece), "curve")
        long = staged.select("label", F.posexplode("margins").alias("at", "margin"), "before").select(
            "label", (F.col("at") + start + 1).alias("round"), (F.col("margin") + F.col("before")).alias("margin"))

        def curve(long=long):
            return durable(average_precision(long, "label", "margin", ["round"]), "curve-part")

        if patience is None:
            later.append(curve)
        else:
            parts.append(curve())
            values += [r["auprc"] for r in parts[-1].orderBy("round").collect()]  # one number per round
            if len(values) - 1 - int(np.argmax(values)) >= patience:
                break
        now = staged.select("label", F.col("kept").alias("features"),
                            (F.element_at("margins", -1) + F.col("before")).alias("before"))
    parts += concurrently(evaluation.sparkSession, later, 4)
    return reduce(DataFrame.unionByName, parts)


def early_stop_round(curve: DataFrame, round_col: str, metric: str, patience: int,
                     by: Sequence[str]) -> DataFrame:
    """Best round before the first stretch of ``patience`` rounds without gain.

    A gain is a strictly higher metric than every earlier round. Rounds per
    group are few (boosting rounds), the groups are spread by the window.
    """
    keys = [quoted(c) for c in by]
    earlier = Window.partitionBy(*keys).orderBy(quoted(round_col)).rowsBetween(
        Window.unboundedPreceding, -1)
    value, at = quoted(metric), quoted(round_col)
    steps = (curve.select(*keys, at.alias("__at"), value.alias("__value"),
                          F.row_number().over(Window.partitionBy(*keys).orderBy(at)).alias("__nth"),
                          F.max(value).over(earlier).alias("__best")))
    gain = F.col("__best").isNull() | (F.col("__value") > F.col("__best"))
    upto = (Window.partitionBy(*keys).orderBy("__nth")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    marked = steps.withColumn("__gain", F.max(F.when(gain, F.col("__nth"))).over(upto))
    stopped = F.col("__nth") - F.col("__gain") >= patience
    ends = marked.withColumn("__stopped", F.max(stopped.cast("int")).over(upto))
    live = ends.where("__stopped = 0")
    top = F.max(F.when(F.col("__nth") == F.col("__gain"),
                       F.struct("__nth", F.col("__at").alias("round"),
                                F.col("__value").alias("value"))))
    return (live.groupBy(*keys).agg(top.alias("top"))
            .select(*keys, F.col("top.round").alias("best_round"),
                    F.col("top.value").alias("best_value")))


def score(model, df: DataFrame, key: str, label: str, threshold: float = 0.5) -> DataFrame:
    """(id, label, proba, pred) for any fitted model of this module."""
    wanted = [quoted(key).alias("id"), quoted(label).cast("int").alias("label")]
    out = model.transform(df)
    if "proba" not in out.columns:
        out = out.withColumn("proba", vector_to_array("probability")[1])
    return with_prediction(out.select(*wanted, "proba"), "proba", threshold)
