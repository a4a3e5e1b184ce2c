"""Random hyper-parameter search over a table of trials."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.functions.scalar import quoted
from wardlens.operators.metrics import average_precision
from wardlens.operators.models import (
    BoostPreset, assembler, fit_boosted, score, training_vectors,
)
from wardlens.session import concurrently, exists, scratch_path, side_by_side

_UNIT = float(1 << 52)


def hashed_unit(seed: int, *parts: Column) -> Column:
    """Uniform in [0, 1) from 13 digits of a digest, so it does not depend on partitioning.

    The digest is of the seed and the parts as text, joined by bars, which any
    SQL engine can repeat.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(_UNIT)


@dataclass(frozen=True)
class IntRange:
    low: int
    high: int
    step: int = 1

    def draw(self, u: Column) -> Column:
        count = (self.high - self.low) // self.step + 1
        return (F.lit(self.low) + F.lit(self.step) * F.floor(u * count)).cast("int")


@dataclass(frozen=True)
class FloatRange:
    low: float
    high: float
    log: bool = False

    def draw(self, u: Column) -> Column:
        if self.log:
            low, high = F.log(F.lit(self.low)), F.log(F.lit(self.high))
            return F.exp(low + u * (high - low))
        return F.lit(self.low) + u * F.lit(self.high - self.low)


Space = Mapping[str, IntRange | FloatRange]

# The two search spaces, but for the leaf count (15 to 255) and
# the least child weight (1 to 10): these trees grow level by level and know
# neither, so drawing them would give trials that differ in name alone.
_SHARED = {"n_estimators": IntRange(100, 1000, 100), "learning_rate": FloatRange(1e-3, 0.2, log=True)}
_FRACTIONS = {"subsample": FloatRange(0.5, 1.0), "colsample_bytree": FloatRange(0.5, 1.0)}
SPACES: dict[str, Space] = {
    "lgb": {**_SHARED, "max_depth": IntRange(3, 12), "min_child_samples": IntRange(5, 100),
            **_FRACTIONS},
    "xgb": {**_SHARED, "max_depth": IntRange(3, 10), **_FRACTIONS},
}


def sample_trials(trials: DataFrame, space: Space, seed: int = 42, key: str = "trial") -> DataFrame:
    """One random configuration per trial row, as ``params_*`` columns."""
    return trials.select(quoted(key), *[
        spec.draw(hashed_unit(seed, quoted(key), F.lit(name))).alias(f"params_{name}")
        for name, spec in space.items()])


def preset_of(params: Mapping[str, object]) -> BoostPreset:
    """Boosting settings of one trial."""
    leaf = params.get("params_min_child_samples") or 1
    return BoostPreset(rounds=params["params_n_estimators"],
                       learning_rate=params["params_learning_rate"],
                       max_depth=params["params_max_depth"],
                       row_fraction=params["params_subsample"],
                       column_fraction=params["params_colsample_bytree"], min_rows=int(leaf))


_DIGEST = "digest"
_LEDGER = f"value double, {_DIGEST} string"


def digests(trials: DataFrame, study: str, trial: str = "trial") -> DataFrame:
    """Add the digest of each trial's settings within a study; the trial's number does not count."""
    settings = F.to_json(F.struct(*[quoted(c) for c in sorted(trials.columns) if c != trial]))
    return trials.withColumn(_DIGEST, F.sha2(F.concat_ws("|", F.lit(study), settings).cast("binary"), 256))


def read_ledger(trials: DataFrame, ledger: str) -> DataFrame:
    """(value, digest) of the finished trials; none where no trial has finished."""
    spark = trials.sparkSession
    if not exists(spark, ledger):
        return spark.createDataFrame([], _LEDGER)
    return spark.read.schema(_LEDGER).option("basePath", ledger).parquet(f"{ledger}/{_DIGEST}=*").dropDuplicates([_DIGEST])


def run_trials(trials: DataFrame, train: DataFrame, holdout: DataFrame, names: Sequence[str],
               label: str, weight: str, key: str, parallelism: int = 8,
               trial: str = "trial", ledger: str | None = None, study: str = "") -> DataFrame:
    """Fit every trial on ``train`` and add its average precision on ``holdout``.

    Each finished trial is written at once to the ledger, a Parquet table with
    one folder per digest of the trial's settings, and a left-anti join with
    the ledger says which trials are left. So a search whose session was lost
    goes on where it stopped, more trials can be added to an old search, and
    trials of equal settings are fitted once. ``study`` names what else the
    value depends on, above all the tables; the feature names and the columns
    count by themselves. Without a ledger's path it lies in the scratch folder
    of the application.

    The trial table is small by nature (one model fit per row). Fits are
    distributed jobs on one shared table of vectors; ``parallelism`` of them
    submit their jobs at the same time, each with its part of the cores. Which
    rows a round draws follows the table's partitions, so it differs between
    clusters.
    """
    spark = train.sparkSession
    ledger = ledger or scratch_path(spark, "ledger")
    marked = digests(trials, "|".join([study, label, weight, key, *names]), trial)
    done = read_ledger(trials, ledger)
    left = [r.asDict() for r in marked.join(done, _DIGEST, "left_anti").dropDuplicates([_DIGEST]).orderBy(quoted(trial)).collect()]

    def fit(params: dict) -> None:
        model = fit_boosted(train, names, label, weight, preset_of(params), vectors=vectors)
        value = average_precision(score(model, holdout, key, label)).first()["auprc"]
        (spark.range(1).select(F.lit(value).cast("double").alias("value")).coalesce(1)
         .write.mode("overwrite").parquet(f"{ledger}/{_DIGEST}={params[_DIGEST]}"))

    if left:
        vectors = side_by_side(training_vectors(train, [assembler(names)], label, weight),
                               len(names), min(parallelism, len(left)))
        # The costliest first, so that no long fit is left alone at the end.
        left.sort(key=lambda p: -p["params_n_estimators"] * p["params_max_depth"])
        concurrently(spark, [lambda p=p: fit(p) for p in left], parallelism)
    return marked.join(read_ledger(trials, ledger), _DIGEST).drop(_DIGEST).orderBy(quoted(trial))


def best_trial(trials: DataFrame, trial: str = "trial") -> DataFrame:
    """The trial with the highest value; the lowest id wins a tie."""
    return trials.orderBy(F.desc("value"), quoted(trial)).limit(1)
