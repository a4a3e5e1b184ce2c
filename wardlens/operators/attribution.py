"""Attribution tables from per-row feature contributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.functions.scalar import quoted
from wardlens.operators.models import BoostedModel
from wardlens.operators.trees import Forest, read_forest, shapley_values


def tree_shap(model: BoostedModel, df: DataFrame, key: str) -> DataFrame:
    """(id, features, phi, base): ``base + sum(phi)`` is the row's log-odds."""
    vectors = model.pipeline.stages[0].transform(df).select(quoted(key).alias("id"), "features")
    whole = read_forest(model.ensemble)
    used = Forest(whole.trees[:model.rounds], whole.weights[:model.rounds])
    return shapley_values(vectors, used)


def attribution_long(shap: DataFrame, names: Sequence[str]) -> DataFrame:
    """(id, feature, value, phi), one row per feature."""
    labels = F.array(*[F.lit(n) for n in names])
    each = F.arrays_zip(labels.alias("feature"), F.col("features").alias("value"), F.col("phi"))
    return shap.select("id", F.inline(each).alias("feature", "value", "phi"))


def mean_abs_importance(phi: DataFrame, top: int | None = 10) -> DataFrame:
    """Mean absolute contribution per feature, largest first.

    Contributions fold to one row per feature on the map side.
    """
    ranked = (phi.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi"))
              .orderBy(F.desc("mean_abs_phi"), "feature"))
    return ranked if top is None else ranked.limit(top)


def beeswarm_points(phi: DataFrame, top: int = 10) -> DataFrame:
    """(id, feature, value, phi) of the ``top`` features; ``top`` rows are broadcast."""
    names = mean_abs_importance(phi, top).select("feature")
    return phi.join(F.broadcast(names), "feature", "left_semi").select("id", "feature", "value", "phi")
