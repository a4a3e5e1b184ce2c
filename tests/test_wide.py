"""Range joins, large vocabularies, CSV line breaks, truncated ensembles, the ledger of trials."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from wardlens.operators import models, search
from wardlens.operators.encode import OneHot, SparseOneHot
from wardlens.operators.ranges import label_ranges
from wardlens.operators.trees import margins_at, read_forest
from wardlens.sources.encounters import scan_encounters

RANGES = "low double, high double, position int, label string"


def test_ranges_by_brute_force(spark, plan_of):
    rng = np.random.default_rng(8)
    low = np.concatenate([rng.uniform(-500, 500, 900), rng.integers(-20, 20, 300), [-1e300, 0.0, 5.0, np.nan, 1e-9]])
    width = np.concatenate([2.0 ** rng.integers(-12, 11, 900), rng.integers(-1, 3, 300), [2e300, 0.0, np.inf, 1.0, 1e-9]])
    ranges = [(float(a), float(a + w), int(k), f"r{k}") for k, (a, w) in enumerate(zip(low, width))] + [(None, 1.0, -5, "x")]
    values = [*map(float, rng.uniform(-600, 600, 400)), *map(float, range(-25, 25)), *[3.0] * 300, None, float("nan"), 1e299, float("inf"), 1.5e-9]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v double").withColumn("label", F.lit("old"))
    out = label_ranges(df, "v", spark.createDataFrame(ranges, RANGES), default="none")
    got = {r["id"]: r["label"] for r in out.collect()}
    for i, v in enumerate(values):
        fit = [(k, name) for a, b, k, name in ranges if v is not None and a is not None and np.isfinite(b) and a <= v <= b]
        assert got[i] == (min(fit)[1] if fit else "none"), v
    assert len(got) == len(values) and "NestedLoop" not in plan_of(out) and "Cartesian" not in plan_of(out)
    none = label_ranges(df, "v", spark.createDataFrame([], RANGES), default="none")
    assert {r["label"] for r in none.collect()} == {"none"}


@pytest.mark.parametrize("drop_first", [True, False])
def test_sparse_vectors_equal_the_wide_form(spark, drop_first):
    rows = [(1, "b", "x"), (2, "a", None), (3, None, "ß"), (4, "c", "y"), (5, "B", "x"), (6, "a", "x")]
    df = spark.createDataFrame(rows, "id int, p string, q string")
    wide = OneHot(["p", "q"], drop_first).fit(df).transform(df).orderBy("id")
    model = SparseOneHot(["p", "q"], drop_first).fit(df)
    dense = model.transform(df).select("id", vector_to_array("features").alias("f")).orderBy("id")
    assert [r["f"] for r in dense.collect()] == [list(map(float, r[1:])) for r in wide.collect()]
    ones = {r["id"]: r["indices"] for r in model.indices(df).collect()}
    assert ones == {r[0]: [k for k, v in enumerate(r[1:]) if v] for r in wide.collect()}
    unseen = spark.createDataFrame([(1, "zz", None)], "id int, p string, q string")
    assert model.indices(unseen).first()["indices"] == []
    empty = SparseOneHot(["p"], drop_first).fit(df.limit(0))
    assert empty.width == 0 and empty.indices(df).where(F.size("indices") > 0).count() == 0


def test_a_million_categories(spark):
    df = spark.range(1_000_000).select("id", F.format_string("c%07d", "id").alias("c"), (F.col("id") % 3).cast("string").alias("d"))
    model = SparseOneHot(["c", "d"]).fit(df)
    assert model.width == 999_999 + 2
    some = df.where("id IN (0, 1, 777777, 999999)")
    got = {r["id"]: r["indices"] for r in model.indices(some).collect()}
    assert got == {0: [], 1: [0, 999_999], 777_777: [777_776], 999_999: [999_998]}
    vector = model.transform(some.where("id = 1")).first()["features"]
    assert vector.size == 1_000_001 and vector.indices.tolist() == [0, 999_999]


def test_csv_values_with_line_breaks(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('encounter_id,patient_nbr,"age",note\n1,2,?,"two\nlines, ""quoted"""\n3,4,[10-20),plain\n')
    rows = scan_encounters(spark, str(path), multiline=True).orderBy("encounter_id").collect()
    assert [tuple(r) for r in rows] == [(1, 2, None, 'two\nlines, "quoted"'), (3, 4, "[10-20)", "plain")]
    with pytest.raises(Exception):
        scan_encounters(spark, str(path)).collect()


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 3))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=300) * 0.5 > 0.3).astype(int)
    return spark.createDataFrame([(i, int(t), 1.0, *map(float, r)) for i, (r, t) in enumerate(zip(x, y))],
                                 "id long, label int, weight double, a double, b double, c double")


def test_truncated_ensemble_scores_in_the_jvm(spark, table, plan_of):
    whole = models.fit_boosted(table, ["a", "b", "c"], "label", "weight", models.BoostPreset(rounds=8, max_depth=3, min_rows=5))
    for rounds in (1, 3, 8):
        head = models.BoostedModel(whole.pipeline, rounds)
        scored = models.score(head, table, "id", "label")
        assert "MapInPandas" not in plan_of(scored) and "MapInArrow" not in plan_of(scored)
        vectors = whole.pipeline.stages[0].transform(table).select("id", "features")
        margins = {r["id"]: r["margin"] for r in margins_at(vectors, read_forest(whole.ensemble), rounds).collect()}
        for r in scored.collect():
            assert r["proba"] == pytest.approx(1 / (1 + np.exp(-2 * margins[r["id"]])), abs=1e-12)


SPACE = {"n_estimators": search.IntRange(1, 3), "learning_rate": search.FloatRange(0.05, 0.2), "max_depth": search.IntRange(1, 2),
         "subsample": search.FloatRange(0.6, 1.0), "colsample_bytree": search.FloatRange(0.6, 1.0)}


def test_a_search_goes_on_where_it_stopped(spark, table, tmp_path, monkeypatch):
    """A session lost after three of six trials leaves three to fit; equal settings are fitted once."""
    fits, real = [], search.fit_boosted

    def counted(*args, **settings):
        if limit and len(fits) >= limit[0]:
            raise ConnectionError("the session is lost")
        fits.append(args[4])
        return real(*args, **settings)

    monkeypatch.setattr(search, "fit_boosted", counted)
    trials = search.sample_trials(spark.range(6).toDF("trial"), SPACE)

    def run(which=trials, study="s"):
        return search.run_trials(which, table, table, ["a", "b", "c"], "label", "weight", "id", 1, ledger=f"{tmp_path}/l", study=study)

    limit = [3]
    with pytest.raises(ConnectionError):
        run()
    limit, before = [], len(fits)
    assert before == 3
    first = run().collect()
    assert len(fits) == 6 and [r["trial"] for r in first] == list(range(6)) and all(0 <= r["value"] <= 1 for r in first)
    assert run().collect() == first and len(fits) == 6
    again = trials.withColumn("trial", F.col("trial") + 100)
    assert [r["value"] for r in run(trials.union(again)).collect()] == [r["value"] for r in first] * 2 and len(fits) == 6
    run(study="other").collect()
    assert len(fits) == 12
