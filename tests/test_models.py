"""Fits, early stopping, attribution, neighbours and oversampling."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardlens.operators import attribution, models, neighbours, search
from wardlens.operators.neighbours import nearest_neighbours
from wardlens.operators.scale import StandardScale
from wardlens.operators.smote import smote_oversample
from wardlens.operators.split import balanced_weight, positive_weight
from wardlens.operators.trees import Forest, Tree, read_forest, tree_paths, tree_values, path_shapley

NAMES = ["a", "b-c", "d", "e"]


@pytest.fixture(scope="module")
def arrays():
    rng = np.random.default_rng(11)
    x = np.column_stack([rng.normal(size=400), rng.integers(0, 4, 400), rng.random(400) * 10, np.ones(400)])
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=400) > 1.8).astype(int)
    return x, y


@pytest.fixture(scope="module")
def table(spark, arrays):
    x, y = arrays
    rows = [(i, int(t), *map(float, r)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, label int, " + ", ".join(f"`{n}` double" for n in NAMES))


def test_scaling_uses_the_population_deviation(spark, table, arrays):
    x, _ = arrays
    out = StandardScale(NAMES).fit(table).transform(table).orderBy("id").collect()
    sd = np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1.0)
    np.testing.assert_allclose([[r[n] for n in NAMES] for r in out], (x - x.mean(axis=0)) / sd, atol=1e-12)


def test_scaling_skips_nulls(spark):
    df = spark.createDataFrame([(1.0, 2), (None, 4), (3.0, 9)], "p double, q int")
    out = StandardScale(["p", "q"]).fit(df)
    assert out.moments["p"] == (2.0, 1.0) and out.moments["q"][0] == 5.0


def test_logistic_matches_newton(spark, table, arrays):
    x, y = arrays
    sd = np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1.0)
    z = np.column_stack([(x - x.mean(axis=0)) / sd, np.ones(len(x))])
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    penalty = np.diag([10.0] * 4 + [0.0])  # 1 / C with C = 0.1, intercept free
    beta = np.zeros(5)
    for _ in range(60):
        p = 1 / (1 + np.exp(-z @ beta))
        gradient = z.T @ (w * (p - y)) + penalty @ beta
        beta -= np.linalg.solve(z.T @ (z * (w * p * (1 - p))[:, None]) + penalty, gradient)
    model = models.fit_logistic(balanced_weight(table, "label"), NAMES, "label", "weight")
    fit = model.stages[-1]
    np.testing.assert_allclose([*fit.coefficients.toArray(), fit.intercept], beta, atol=1e-6)


def test_scores_survive_a_reload(spark, table, tmp_path):
    for model in (models.fit_logistic(balanced_weight(table, "label"), NAMES, "label", "weight", max_iter=5),
                  models.fit_boosted(positive_weight(table, "label"), NAMES, "label", "weight",
                                     models.BoostPreset(rounds=4, max_depth=2, patience=1), table)):
        models.save_model(model, f"{tmp_path}/m")
        again = models.load_model(f"{tmp_path}/m")
        a, b = (sorted(map(tuple, models.score(m, table, "id", "label").collect())) for m in (model, again))
        assert a == b


@pytest.fixture(scope="module")
def boosted(spark, table):
    return models.fit_boosted(positive_weight(table, "label"), NAMES, "label", "weight",
                              models.BoostPreset(rounds=5, max_depth=3, learning_rate=0.3))


def test_first_rounds_equal_a_shorter_fit(spark, table, boosted):
    short = models.fit_boosted(positive_weight(table, "label"), NAMES, "label", "weight",
                               models.BoostPreset(rounds=3, max_depth=3, learning_rate=0.3))
    cut = models.BoostedModel(boosted.pipeline, 3)
    a, b = ({r["id"]: r["proba"] for r in models.score(m, table, "id", "label").collect()} for m in (short, cut))
    assert a.keys() == b.keys() and all(abs(a[i] - b[i]) < 1e-9 for i in a)


def test_boosting_beats_the_base_rate(spark, table, boosted):
    curve = models.round_curve(boosted, table, "label").orderBy("round").collect()
    assert [r["round"] for r in curve] == [1, 2, 3, 4, 5]
    assert curve[-1]["auprc"] > table.agg(F.avg("label")).first()[0] * 1.3


@pytest.mark.parametrize("metric, patience, want", [
    ([0.1, 0.2, 0.2, 0.2, 0.9], 2, (2, 0.2)), ([0.1, 0.2, 0.2, 0.2, 0.9], 3, (5, 0.9)),
    ([0.5], 3, (1, 0.5)), ([0.5, 0.4, 0.3], 1, (1, 0.5)), ([0.1, 0.2, 0.3], 1, (3, 0.3)),
    ([0.3, 0.3, 0.3, 0.4], 2, (1, 0.3)), ([0.3, 0.3, 0.4, 0.4, 0.4, 0.5], 2, (3, 0.4))])
def test_early_stop(spark, metric, patience, want):
    rows = [(g, i + 1, v) for g in "xy" for i, v in enumerate(metric)]
    curve = spark.createDataFrame(rows, "model string, round int, auprc double")
    out = models.early_stop_round(curve, "round", "auprc", patience, ["model"]).collect()
    assert sorted(map(tuple, out)) == [(g, *want) for g in "xy"]


def expected_value(tree, x, known, at=0):
    """Path-dependent conditional expectation by plain recursion."""
    if tree.left[at] < 0:
        return tree.value[at]
    if tree.feature[at] in known:
        child = tree.left[at] if x[tree.feature[at]] <= tree.threshold[at] else tree.right[at]
        return expected_value(tree, x, known, child)
    return sum(tree.cover[c] / tree.cover[at] * expected_value(tree, x, known, c)
               for c in (tree.left[at], tree.right[at]))


def brute_shapley(tree, x, width):
    phi = np.zeros(width)
    for i in range(width):
        others = [f for f in range(width) if f != i]
        for size in range(width):
            for known in itertools.combinations(others, size):
                share = math.factorial(size) * math.factorial(width - size - 1) / math.factorial(width)
                phi[i] += share * (expected_value(tree, x, {*known, i}) - expected_value(tree, x, set(known)))
    return phi


def test_shapley_values_match_enumeration(spark, table, arrays, boosted):
    x, _ = arrays
    for tree in read_forest(boosted.ensemble).trees:
        phi = np.zeros((12, 4))
        base = path_shapley(tree_paths(tree), x[:12], phi, 1.0)
        np.testing.assert_allclose(phi, [brute_shapley(tree, r, 4) for r in x[:12]], atol=1e-12)
        np.testing.assert_allclose(base + phi.sum(axis=1), tree_values(tree, x[:12]), atol=1e-12)


def test_shapley_of_a_lone_leaf():
    leaf = Tree(*[np.array([v]) for v in (-1, 0.0, -1, -1, 2.5, 10.0)])
    phi = np.zeros((3, 2))
    assert path_shapley(tree_paths(leaf), np.ones((3, 2)), phi, 2.0) == 5.0 and not phi.any()
    assert Forest((leaf,), (1.0,)).trees[0] is leaf


def test_attributions_add_up_to_the_log_odds(spark, table, boosted):
    shap = attribution.tree_shap(boosted, table, "id").collect()
    odds = {r["id"]: math.log(r["proba"] / (1 - r["proba"]))
            for r in models.score(boosted, table, "id", "label").collect()}
    assert len(shap) == 400
    assert max(abs(r["base"] + sum(r["phi"]) - odds[r["id"]]) for r in shap) < 1e-9


def test_importance_and_beeswarm(spark):
    rows = [(i, f, 1.0, v) for i in range(4) for f, v in (("p", 0.1), ("q", -0.9), ("r", 0.5))]
    phi = spark.createDataFrame(rows, "id int, feature string, value double, phi double")
    top = attribution.mean_abs_importance(phi, 2).collect()
    assert [r["feature"] for r in top] == ["q", "r"] and top[0]["mean_abs_phi"] == pytest.approx(0.9)
    swarm = attribution.beeswarm_points(phi, 2).collect()
    assert len(swarm) == 8 and {r["feature"] for r in swarm} == {"q", "r"}


def brute_neighbours(ids, x, k):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    return {ids[i]: [(j_id, round(dist, 9)) for dist, j_id in
                     sorted((d[i, j], ids[j]) for j in range(len(x)) if j != i)[:k]] for i in range(len(x))}


CASES = {
    "uniform": (lambda r: r.random((150, 4)), None, 4096),
    "hot copies": (lambda r: np.r_[np.zeros((60, 3)), r.integers(0, 3, (60, 3)), r.random((30, 3))], 7, 13),
    "small blocks": (lambda r: r.normal(size=(200, 2)), 5, 17),
    "fewer than k": (lambda r: r.random((3, 2)), None, 10),
    "all equal": (lambda r: np.ones((9, 2)), None, 10),
    "alone": (lambda r: np.ones((1, 2)), None, 10),
}
CELLED = {
    "many inner cells": (lambda r: r.normal(size=(300, 3)), 4, 4096, 6),
    "inner cells in small blocks": (lambda r: r.normal(size=(200, 2)), 2, 7, 3),
    "one hot region": (lambda r: np.r_[r.normal(size=(150, 3)), r.normal(size=(10, 3)) + 1000], 3, 50, 5),
    "every row a cell": (lambda r: r.integers(0, 4, (80, 3)), 3, 11, 1),
}


@pytest.mark.parametrize("case", CASES)
def test_neighbours_are_exact(spark, case):
    make, pivots, block = CASES[case]
    rng = np.random.default_rng(5)
    x = make(rng).astype(float)
    ids = [int(i) for i in rng.permutation(len(x)) + 100]
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in zip(ids, x)], "id long, vec array<double>")
    got = {i: [] for i in ids}
    for r in nearest_neighbours(df, 5, pivots, block).orderBy("id", "rank").collect():
        got[r["id"]].append((r["neighbour"], round(r["distance"], 9)))
    assert got == brute_neighbours(ids, x, 5)


@pytest.mark.parametrize("case", CELLED)
def test_neighbours_are_exact_across_inner_cells(spark, case):
    make, pivots, block, cell_rows = CELLED[case]
    x = make(np.random.default_rng(6)).astype(float)
    ids = list(range(len(x)))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in zip(ids, x)], "id long, vec array<double>")
    got = {i: [] for i in ids}
    for r in nearest_neighbours(df, 5, pivots, block, cell_rows).orderBy("id", "rank").collect():
        got[r["id"]].append((r["neighbour"], round(r["distance"], 9)))
    assert got == brute_neighbours(ids, x, 5)


@pytest.mark.parametrize("shape", ["plane", "no clusters", "clusters"])
def test_approximate_neighbours_reach_the_wanted_recall(spark, monkeypatch, shape):
    """Recall of 0.9 with and without structure, and not by visiting every region where there is some."""
    rng, n = np.random.default_rng(7), 1200
    x = {"plane": rng.normal(size=(n, 2)), "no clusters": rng.normal(size=(n, 12)),
         "clusters": rng.normal(size=(n, 12)) * 0.1 + rng.normal(size=(30, 12))[rng.integers(0, 30, n)]}[shape]
    probed, real = [], neighbours._probes
    monkeypatch.setattr(neighbours, "_probes", lambda *args: probed.append(real(*args)) or probed[-1])
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, vec array<double>")
    near = {(r["id"], r["neighbour"]) for r in nearest_neighbours(df, 5, 30, cell_rows=10, approximate=True).collect()}
    true = {(i, j) for i, v in brute_neighbours(list(range(n)), x, 5).items() for j, _ in v}
    assert len(true) == 5 * n and 0.98 * 5 * n <= len(near) <= 5 * n and len(near & true) / len(true) >= 0.9
    assert probed[0] < 30 and (shape == "no clusters" or probed[0] <= 10)


@pytest.fixture(scope="module")
def imbalanced(spark):
    rng = np.random.default_rng(9)
    x = np.r_[rng.normal(size=(90, 2)), rng.normal(size=(20, 2)) + 4]
    rows = [(i, int(i >= 90), float(a), float(b)) for i, (a, b) in enumerate(x)]
    return spark.createDataFrame(rows, "id long, y int, `p-q` double, r double"), x[90:]


def test_oversampling_balances_between_neighbours(spark, imbalanced):
    df, minority = imbalanced
    out = smote_oversample(df, ["p-q", "r"], "y", "id").collect()
    assert sum(r["y"] for r in out) == 90 and len(out) == 180
    assert sorted(r["id"] for r in out if not r["synthetic"]) == list(range(110))
    near = {i: [j for j, _ in v] for i, v in brute_neighbours(list(range(20)), minority, 5).items()}
    segments = [(minority[i], minority[j]) for i in near for j in near[i]]
    for r in out:
        if r["synthetic"]:
            p = np.array([r["p-q"], r["r"]])
            gap = min(abs(np.linalg.norm(p - a) + np.linalg.norm(p - b) - np.linalg.norm(a - b)) for a, b in segments)
            assert gap < 1e-9


def test_oversampling_does_not_depend_on_partitions(spark, imbalanced):
    df, _ = imbalanced
    runs = [sorted((r["p-q"], r["r"]) for r in smote_oversample(d, ["p-q", "r"], "y", "id").collect())
            for d in (df.coalesce(1), df.repartition(7, "r"))]
    assert runs[0] == runs[1]


def test_oversampling_needs_more_rows_than_neighbours(spark, imbalanced):
    df, _ = imbalanced
    with pytest.raises(ValueError, match="minority"):
        smote_oversample(df.where("id < 95"), ["p-q", "r"], "y", "id")


def test_trials_keep_to_their_space(spark):
    for name, space in search.SPACES.items():
        rows = search.sample_trials(spark.range(500).toDF("trial"), space).collect()
        for p, spec in space.items():
            values = [r[f"params_{p}"] for r in rows]
            assert min(values) >= spec.low and max(values) <= spec.high
            if isinstance(spec, search.IntRange):
                assert all((v - spec.low) % spec.step == 0 for v in values)
                assert len(set(values)) > 4
        again = search.sample_trials(spark.range(500).repartition(5).toDF("trial"), space).collect()
        assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    rates = [r["params_learning_rate"] for r in rows]
    assert np.median(np.log(rates)) == pytest.approx((math.log(1e-3) + math.log(0.2)) / 2, abs=0.5)


def test_best_trial_lowest_id_wins(spark):
    df = spark.createDataFrame([(3, 0.5), (1, 0.5), (2, 0.4)], "trial int, value double")
    assert search.best_trial(df).first()["trial"] == 1


def test_clustered_rows_visit_few_cells(spark, monkeypatch):
    from wardlens.operators import neighbours

    rng = np.random.default_rng(8)
    centres = rng.normal(scale=100, size=(12, 6))
    points = np.concatenate([c + rng.normal(size=(40, 6)) for c in centres])
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, vec array<double>")
    seen, durable = {}, neighbours.durable

    def watched(frame, label):
        out = durable(frame, label)
        seen[label] = out
        return out

    monkeypatch.setattr(neighbours, "durable", watched)
    got = neighbours.nearest_neighbours(df, 5, pivots=24).collect()
    assert "vec" not in seen["visits"].columns
    assert seen["visits"].count() < 0.25 * 24 * len(points)
    distance = np.linalg.norm(points[:, None] - points, axis=2)
    np.fill_diagonal(distance, np.inf)
    for r in got:
        assert r["distance"] == pytest.approx(np.sort(distance[r["id"]])[r["rank"] - 1])
