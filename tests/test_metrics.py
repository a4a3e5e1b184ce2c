"""Ranking and threshold metrics against NumPy, plus their invariances."""

import numpy as np
import pytest

from wardlens.operators import metrics


def numpy_average_precision(y, s):
    total, best = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        picked = y[s >= t]
        recall = picked.sum() / y.sum()
        total += (recall - best) * picked.mean()
        best = recall
    return total


def numpy_roc_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    wins = (pos[:, None] > neg[None]).sum() + 0.5 * (pos[:, None] == neg[None]).sum()
    return wins / (len(pos) * len(neg))


def table(spark, y, s, model="m"):
    rows = [(int(i), int(a), float(b), model) for i, (a, b) in enumerate(zip(y, s))]
    return metrics.with_prediction(
        spark.createDataFrame(rows, "id int, label int, proba double, model string"))


@pytest.fixture(scope="module")
def tied():
    rng = np.random.default_rng(3)
    y = (rng.random(600) < 0.2).astype(int)
    s = np.where(rng.random(600) < 0.33, 0.5, np.round(rng.random(600) * 0.6 + y * 0.3, 2))
    return y, s


def test_ranking_metrics_with_a_hot_score(spark, tied):
    y, s = tied
    row = metrics.ranking_metrics(metrics.score_steps(table(spark, y, s))).first()
    assert row["auprc"] == pytest.approx(numpy_average_precision(y, s), abs=1e-12)
    assert row["auroc"] == pytest.approx(numpy_roc_auc(y, s), abs=1e-12)


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_partition_and_order_do_not_matter(spark, tied, partitions):
    y, s = tied
    df = table(spark, y, s).repartition(partitions, "label")
    got = metrics.average_precision(df).first()["auprc"]
    assert got == pytest.approx(numpy_average_precision(y, s), abs=1e-12)


def test_monotone_change_of_scores_does_not_matter(spark, tied):
    y, s = tied
    a = metrics.ranking_metrics(metrics.score_steps(table(spark, y, s))).first()
    b = metrics.ranking_metrics(metrics.score_steps(table(spark, y, np.exp(3 * s)))).first()
    assert a["auprc"] == pytest.approx(b["auprc"], abs=1e-12)
    assert a["auroc"] == pytest.approx(b["auroc"], abs=1e-12)


def test_groups_are_scored_apart(spark, tied):
    y, s = tied
    both = table(spark, y, s, "a").unionByName(table(spark, y, -s, "b"))
    got = {r["model"]: r["auprc"] for r in metrics.average_precision(both, by=["model"]).collect()}
    assert got["a"] == pytest.approx(numpy_average_precision(y, s), abs=1e-12)
    assert got["b"] == pytest.approx(numpy_average_precision(y, -s), abs=1e-12)


def test_pr_curve_points(spark, tied):
    y, s = tied
    points = metrics.pr_curve(table(spark, y, s)).collect()
    assert len(points) == len(set(s)) + 1
    closing = [p for p in points if p["threshold"] is None]
    assert [(p["precision"], p["recall"]) for p in closing] == [(1.0, 0.0)]
    for p in points:
        if p["threshold"] is not None:
            picked = y[s >= p["threshold"]]
            assert p["precision"] == pytest.approx(picked.mean())
            assert p["recall"] == pytest.approx(picked.sum() / y.sum())


def test_threshold_metrics(spark, tied):
    y, s = tied
    df = table(spark, y, s)
    pred = (s >= 0.5).astype(int)
    tp, fp, fn = ((y & pred).sum(), ((1 - y) & pred).sum(), (y & (1 - pred)).sum())
    assert tuple(metrics.confusion_counts(df).first())[:3] == (tp, fp, fn)
    assert metrics.f1_binary(df).first()["f1"] == pytest.approx(2 * tp / (2 * tp + fp + fn))
    report = {r["row"]: r for r in metrics.classification_report(df).collect()}
    assert set(report) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert report["accuracy"]["f1"] == pytest.approx((y == pred).mean())
    assert report["1"]["precision"] == pytest.approx(tp / (tp + fp))
    assert report["macro avg"]["recall"] == pytest.approx((report["0"]["recall"] + report["1"]["recall"]) / 2)
    assert report["weighted avg"]["support"] == 600


def test_undefined_is_zero(spark):
    none = table(spark, [0, 0], [0.1, 0.2])
    assert metrics.f1_binary(none).first()["f1"] == 0.0
    assert metrics.average_precision(none).first()["auprc"] == 0.0
    assert metrics.roc_auc(none).first()["auroc"] is None
    assert {r["row"] for r in metrics.classification_report(none).collect()} == {
        "0", "accuracy", "macro avg", "weighted avg"}


def test_precision_at_k(spark):
    df = table(spark, [1, 0, 1, 0], [0.9, 0.8, 0.8, 0.1])
    assert metrics.precision_at_k(df, 2).first()[0] == 0.5  # the tie goes to the lower id
    assert metrics.precision_at_k(df, 100).first()[0] == 0.5


def test_best_model_first_wins(spark):
    df = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.1)], "model string, auprc double")
    assert metrics.best_model(df).first()["model"] == "a"


def test_no_python_and_no_lone_task_in_metric_plans(spark, tied, plan_of):
    y, s = tied
    df = table(spark, y, s)
    for out in (metrics.confusion_counts(df), metrics.pr_curve(df), metrics.average_precision(df)):
        plan = plan_of(out)
        assert "Python" not in plan and "ArrowEval" not in plan
        for below in plan.split("Window")[1:]:  # only the totals per slice meet in one task, never the rows
            assert "Exchange SinglePartition" not in below.split("Scan")[0] or "HashAggregate(keys=[__slice" in below
    top = metrics.precision_at_k(df)
    assert "TakeOrderedAndProject" in plan_of(top)
