"""Fit the baseline and the boosted models, score them and choose the best."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from wardlens.functions import codes
from wardlens.functions.scalar import quoted
from wardlens.operators import metrics
from wardlens.operators.attribution import (
    attribution_long, beeswarm_points, mean_abs_importance, tree_shap,
)
from wardlens.operators.models import (
    BOOSTED_A, BOOSTED_B, BoostPreset, assembler, fit_boosted, fit_logistic, save_model, score,
    training_vectors,
)
from wardlens.operators.search import SPACES, Space, best_trial, run_trials, sample_trials
from wardlens.operators.smote import smote_oversample
from wardlens.operators.split import (
    balanced_weight, class_ratio, feature_names, temporal_halves,
)
from wardlens.session import concurrently, durable, side_by_side
from wardlens.sources.contract import require
from wardlens.sources.tables import write_results, write_stage, write_trials

LOGISTIC = "logistic"
DEFAULT_PRESETS = {"boosted_a": BOOSTED_A, "boosted_b": BOOSTED_B}
WEIGHT = "__weight"


@dataclass
class TrainReport:
    models: dict = field(default_factory=dict)
    scored: DataFrame | None = None
    results: DataFrame | None = None
    curve: DataFrame | None = None
    precision: dict[str, float] = field(default_factory=dict)
    classification: DataFrame | None = None
    base_rate: DataFrame | None = None
    attributions: dict[str, DataFrame] = field(default_factory=dict)
    best: Row | None = None


def _halves(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return temporal_halves(df, [codes.ORDER], dense=True)


def _weighted(df: DataFrame, ratio: float) -> DataFrame:
    return df.withColumn(WEIGHT, F.when(quoted(codes.TARGET) == 1, F.lit(ratio)).otherwise(F.lit(1.0)))


def train_all(featured: DataFrame, presets: Mapping[str, BoostPreset] = DEFAULT_PRESETS,
              use_smote: bool = False, eval_on: str = "validation",
              ratio_before_smote: bool = False, attribute: bool = True,
              max_iter: int = 1000, out: str | None = None) -> TrainReport:
    """Chronological split, three fits, metrics, attributions, best model.

    ``featured`` should be a stage table: it is read once per fit and pass. The
    fits submit their jobs at the same time, each from its own scheduler pool;
    a boosted fit has as many tasks as its part of the cores.
    Early stopping watches the last fifth of the training rows, so the test
    rows stay unseen; ``eval_on="test"`` watches the test rows instead.
    ``ratio_before_smote`` keeps the class weight of the rows before
    oversampling, which then counts the imbalance twice.
    """
    require(featured, [codes.TARGET, codes.ORDER], nonempty=True)
    names = feature_names(featured, [codes.TARGET, codes.ORDER])
    train, test = _halves(featured)

    def prepared(rows: DataFrame) -> DataFrame:
        ratio = class_ratio(rows, codes.TARGET).first()["ratio"] if ratio_before_smote else None
        if use_smote:
            rows = durable(smote_oversample(rows, names, codes.TARGET, codes.ORDER), "smote")
        if ratio is None:
            ratio = class_ratio(rows, codes.TARGET).first()["ratio"]
        return _weighted(rows, float(ratio))

    whole = prepared(train)
    report = TrainReport()

    def logistic():
        balanced = balanced_weight(whole, codes.TARGET, "__balanced")
        return fit_logistic(balanced, names, codes.TARGET, "__balanced", max_iter=max_iter)

    def boosted(preset: BoostPreset):
        rows, watched = whole, test
        if preset.patience is not None and eval_on == "validation":
            early, watched = _halves(train)
            rows = prepared(early)
        vectors = training_vectors(rows, [assembler(names)], codes.TARGET, WEIGHT)
        return fit_boosted(rows, names, codes.TARGET, WEIGHT, preset, watched,
                           side_by_side(vectors, len(names), len(presets) + 1))

    fits = {**{name: lambda p=preset: boosted(p) for name, preset in presets.items()}, LOGISTIC: logistic}
    fitted = dict(zip(fits, concurrently(featured.sparkSession, list(fits.values()))))
    report.models = {name: fitted[name] for name in (LOGISTIC, *presets)}
    report.scored = durable(reduce(DataFrame.unionByName, [
        score(m, test, codes.ORDER, codes.TARGET).withColumn("model", F.lit(name))
        for name, m in report.models.items()]), "scored")
    report.results = metrics.results_summary(report.scored)
    report.curve = metrics.pr_curve(report.scored, by=["model"])
    report.classification = metrics.classification_report(report.scored, by=["model"])
    report.base_rate = metrics.base_rate(report.scored, by=["model"])
    for name in presets:
        mine = report.scored.where(F.col("model") == name)
        report.precision[name] = metrics.precision_at_k(mine).first()["precision_at_k"]
        if attribute:
            report.attributions[name] = attribution_long(
                tree_shap(report.models[name], test, codes.ORDER), names)
    ranking = report.results.collect()
    places = {name: i for i, name in enumerate(report.models)}
    report.best = min(ranking, key=lambda r: (-r["auprc"], places[r["model"]]), default=None)
    if out:
        save_report(report, out)
    return report


def save_report(report: TrainReport, out: str) -> None:
    """Models, rounded results, curve points and attribution tables under one folder."""
    for name, model in report.models.items():
        save_model(model, f"{out}/models/{name}")
    write_results(report.results, f"{out}/results")
    write_stage(report.curve, f"{out}/pr_curve")
    write_stage(report.classification, f"{out}/classification")
    write_stage(report.base_rate, f"{out}/base_rate")
    for name, phi in report.attributions.items():
        phi = durable(phi, "phi")
        write_stage(mean_abs_importance(phi), f"{out}/importance/{name}")
        write_stage(beeswarm_points(phi), f"{out}/beeswarm/{name}")


def tune(featured: DataFrame, model: str = "lgb", n_trials: int = 20, seed: int = 42,
         space: Space | None = None, parallelism: int = 8, out: str | None = None,
         eval_on: str = "validation", ledger: str | None = None, study: str = ""):
    """Random search on a stage table: (trials, best row).

    Trials fit on the first four fifths of the training rows and are scored on
    the last fifth, so the test rows stay unseen; ``eval_on="test"`` fits on all
    training rows and scores on the test rows.
    """
    names = feature_names(featured, [codes.TARGET, codes.ORDER])
    train, holdout = _halves(featured)
    if eval_on == "validation":
        train, holdout = _halves(train)
    ratio = class_ratio(train, codes.TARGET).first()["ratio"]
    ids = featured.sparkSession.range(n_trials).toDF("trial")
    trials = run_trials(sample_trials(ids, space or SPACES[model], seed),
                        _weighted(train, float(ratio)), holdout, names, codes.TARGET, WEIGHT,
                        codes.ORDER, parallelism, ledger=ledger, study=f"{study}|{model}|{eval_on}")
    if out:
        write_trials(trials, f"{out}/trials_{model}")
    return trials, best_trial(trials).first()
