"""Compositions, sources and sinks, contracts, and the shape of the plans."""

import inspect

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from bindings import modelling
from bindings.check import compare, connect
from bindings.encounters import encounters, raw_encounters
from wardlens import session
from wardlens.functions import codes
from wardlens.operators.features import derive_features
from wardlens.operators.models import BoostPreset, load_model, score
from wardlens.operators.search import FloatRange, IntRange
from wardlens.operators.split import feature_names, temporal_halves, temporal_split
from wardlens.plans import train
from wardlens.plans.prepare import (
    COMPAT, Prepare, code_columns, code_values, first_encounters, run_features, run_prepare,
    run_preprocess,
)
from wardlens.plans.train import train_all, tune
from wardlens.sources.contract import ContractError, contract_report, require
from wardlens.sources.encounters import scan_encounters
from wardlens.sources.tables import read_results_ranked, write_results, write_trials

FAST = ["first_per_key", "duplicate_count", "missing_profile", "icd9_category", "encode_medications",
        "median_impute", "feature_encounters", "temporal_split_events", "classification_report",
        "pr_curve", "results_summary", "early_stop_round", "write_trials"]
SPACE = {"n_estimators": IntRange(2, 3), "learning_rate": FloatRange(0.05, 0.2, log=True),
         "max_depth": IntRange(2, 3), "min_child_weight": IntRange(1, 10),
         "subsample": FloatRange(0.5, 1.0), "colsample_bytree": FloatRange(0.5, 1.0)}


@pytest.fixture(scope="module")
def first(spark, small):
    return first_encounters(encounters(spark, small))


@pytest.fixture(scope="module")
def featured(spark, small, first, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stage") / "featured")
    Prepare().fit(first).featured(first).write.parquet(path)
    return spark.read.parquet(path)


def test_entry_has_a_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns == ["split", "rows", "positive_rate", "features"]
    assert sorted(r["split"] for r in df.collect()) == ["test", "train"]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", FAST)
def test_query_equals_its_sql(spark, medium, name):
    verdict = compare(spark, connect(medium), medium, entry.queries()[name], entry.oracle_sql()[name])
    assert verdict.startswith("ok") and "TYPES" not in verdict, verdict


def test_narrow_stages_have_no_shuffle_and_no_python(spark, small, plan_of):
    raw = encounters(spark, small)
    for df in (code_columns(raw), derive_features(code_columns(raw))):
        plan = plan_of(df)
        assert "Exchange" not in plan and "Python" not in plan and "ArrowEval" not in plan


def test_dedup_trims_before_its_only_shuffle(spark, small, plan_of):
    from wardlens.operators.dedup import first_per_key
    plan = plan_of(first_per_key(code_values(encounters(spark, small)), ["patient_nbr"], ["encounter_id"]))
    assert plan.count("Exchange") == 1 and plan.count("WindowGroupLimit") == 2


def test_only_needed_columns_are_read(spark, featured, plan_of):
    plan = plan_of(featured.where(F.col("is_elderly") == 1).select("encounter_order"))
    assert "ReadSchema: struct<encounter_order:bigint,is_elderly:tinyint>" in plan
    assert "EqualTo(is_elderly,1)" in plan


def test_halves_are_pushed_filters(spark, featured, plan_of):
    train, test = temporal_halves(featured, ["encounter_order"], dense=True)
    assert "LessThanOrEqual(encounter_order" in plan_of(train.select("age"))
    assert "GreaterThan(encounter_order" in plan_of(test.select("age"))
    assert "Exchange" not in plan_of(train.select("age"))
    assert (train.count(), test.count()) == (120, 30)


def test_modes(spark, first):
    full = Prepare().fit(first).featured(first)
    shipped = Prepare(COMPAT).fit(first).featured(first)
    extra = {"has_primary_diabetes_diag", "has_any_diabetes_diag", "comorbidity_count"}
    assert set(full.columns) - set(shipped.columns) == extra
    assert not any(t == "string" for _, t in full.dtypes)
    assert not full.where(F.greatest(*[F.col(f"`{c}`").isNull().cast("int") for c in full.columns]) == 1).count()


def test_absent_optional_columns_are_skipped(spark):
    df = spark.createDataFrame([(3, 50)], "time_in_hospital int, num_lab_procedures int")
    out = derive_features(df)
    assert set(out.columns) - set(df.columns) == {
        "total_medications", "num_changed_medications", "num_lab_procedures_per_day", "admission_complexity"}
    row = out.first()
    assert (row["total_medications"], row["num_lab_procedures_per_day"], row["admission_complexity"]) == (0, 16.667, 5.0)


def test_diagnosis_count_column_is_a_parameter(spark):
    df = spark.createDataFrame([(10, 7)], "num_lab_procedures int, number_diagnoses int")
    assert derive_features(df).first()["admission_complexity"] == 1.0
    assert derive_features(df, "number_diagnoses").first()["admission_complexity"] == 8.0


def test_from_csv_through_every_stage(spark, small, tmp_path):
    raw = f"{tmp_path}/raw.csv"
    raw_encounters(spark, small).write.option("header", True).csv(raw)
    cleaned = run_preprocess(spark, raw, f"{tmp_path}/cleaned")
    featured = run_features(spark, f"{tmp_path}/cleaned", f"{tmp_path}/featured")
    assert cleaned.count() == featured.count() == 150
    full = run_prepare(spark, raw, f"{tmp_path}/full")
    assert "comorbidity_count" in full.columns and "comorbidity_count" not in featured.columns
    held_out = run_prepare(spark, raw, f"{tmp_path}/held_out", fit_on="train")
    assert held_out.count() == 150 and set(held_out.columns) <= set(full.columns)


def test_scan_reads_tokens_and_types(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("encounter_id,time_in_hospital,age,A1Cresult,odd name\n"
                    "5,3,[0-10),None,?\n6,?,[10-20),>7, ?\n7,abc,,Norm,x\n")
    df = scan_encounters(spark, str(path))
    assert dict(df.dtypes) == {"encounter_id": "bigint", "time_in_hospital": "int", "age": "string",
                               "A1Cresult": "string", "odd name": "string"}
    assert [tuple(r) for r in df.orderBy("encounter_id").collect()] == [
        (5, 3, "[0-10)", None, None), (6, None, "[10-20)", ">7", " ?"), (7, None, None, "Norm", "x")]


def test_contracts(spark, first):
    with pytest.raises(ContractError, match="patient_nbr"):
        first_encounters(spark.createDataFrame([(1,)], "encounter_id long"))
    with pytest.raises(ContractError, match="no rows"):
        require(first.limit(0), ["age"], nonempty=True)
    with pytest.raises(ContractError, match=codes.ORDER):
        train_all(first.drop(codes.ORDER))
    rows = {r["column"]: (r["required"], r["present"]) for r in
            contract_report(first, ["age", "nope"], ["race"]).collect()}
    assert rows == {"age": (True, True), "nope": (True, False), "race": (False, True)}


def test_results_round_and_rank(spark, tmp_path):
    df = spark.createDataFrame([("a", 0.12344, 0.6, 0.1), ("b", 0.5, 0.62345, 0.2)],
                               "model string, auprc double, auroc double, f1 double")
    write_results(df, f"{tmp_path}/r")
    assert [(r["model"], r["auprc"], r["auroc"]) for r in read_results_ranked(spark, f"{tmp_path}/r").collect()] == [
        ("b", 0.5, 0.6235), ("a", 0.1234, 0.6)]


def test_trial_csv_flattens_parameters(spark, tmp_path):
    df = spark.sql("SELECT 1 AS trial, named_struct('depth', 3, 'rate', 0.5D) AS params, 0.25D AS value")
    write_trials(df, f"{tmp_path}/t")
    assert spark.read.option("header", True).csv(f"{tmp_path}/t").columns == [
        "trial", "params_depth", "params_rate", "value"]


def test_train_all(spark, featured, tmp_path):
    presets = {"boosted_a": BoostPreset(rounds=4, max_depth=2, patience=2),
               "boosted_b": BoostPreset(rounds=3, max_depth=3)}
    report = train_all(featured, presets, max_iter=30, out=str(tmp_path))
    results = {r["model"]: r for r in report.results.collect()}
    assert set(results) == {"logistic", "boosted_a", "boosted_b"}
    assert report.best["auprc"] == max(r["auprc"] for r in results.values())
    assert report.scored.count() == 3 * 30 and set(report.precision) == set(presets)
    names = feature_names(featured, [codes.TARGET, codes.ORDER])
    assert report.attributions["boosted_b"].count() == 30 * len(names)
    ranked = read_results_ranked(spark, f"{tmp_path}/results").collect()
    assert [r["auprc"] for r in ranked] == sorted((r["auprc"] for r in ranked), reverse=True)
    test = temporal_split(featured, [codes.ORDER], dense=True).where("split = 'test'")
    for name, model in report.models.items():
        again = score(load_model(f"{tmp_path}/models/{name}"), test, codes.ORDER, codes.TARGET)
        fresh = score(model, test, codes.ORDER, codes.TARGET)
        assert sorted(map(tuple, again.collect())) == sorted(map(tuple, fresh.collect()))
    assert spark.read.parquet(f"{tmp_path}/importance/boosted_b").count() == 10


def test_train_all_fits_share_the_cores(spark, featured, monkeypatch):
    parts, fit, vectors = [], train.fit_boosted, train.training_vectors

    def spy(*args):
        parts.append(args[6].rdd.getNumPartitions())
        return fit(*args)

    monkeypatch.setattr(train, "training_vectors", lambda *args: session.durable(vectors(*args).repartition(64), "many"))
    monkeypatch.setattr(train, "fit_boosted", spy)
    presets = {"boosted_a": BoostPreset(rounds=2, max_depth=2), "boosted_b": BoostPreset(rounds=2, max_depth=2)}
    train_all(featured, presets, attribute=False, max_iter=5)
    share = -(-spark.sparkContext.defaultParallelism // 3)
    assert len(parts) == 2 and max(parts) <= share


def test_train_all_with_oversampling_and_test_watching(spark, featured):
    presets = {"boosted_a": BoostPreset(rounds=3, max_depth=2, patience=1)}
    for before in (False, True):
        report = train_all(featured, presets, use_smote=True, eval_on="test", ratio_before_smote=before,
                           attribute=False, max_iter=10)
        assert {r["model"] for r in report.results.collect()} == {"logistic", "boosted_a"}


def test_tuning(spark, featured, tmp_path):
    trials, best = tune(featured, "xgb", 2, space=SPACE, out=str(tmp_path))
    values = [r["value"] for r in trials.collect()]
    assert len(values) == 2 and best["value"] == max(values)
    assert spark.read.option("header", True).csv(f"{tmp_path}/trials_xgb").count() == 2


def _csv(folder, name, text):
    (folder / name).write_text(text)


def test_csv_scan_reads_doubled_quotes(spark, tmp_path):
    _csv(tmp_path, "a.csv", 'encounter_id,patient_nbr,note\n1,2,"A ""b"" c, d"\n3,4,?\n')
    rows = sorted(tuple(r) for r in scan_encounters(spark, str(tmp_path)).collect())
    assert rows == [(1, 2, 'A "b" c, d'), (3, 4, None)]


def test_csv_scan_refuses_another_header_order(spark, tmp_path):
    _csv(tmp_path, "a.csv", "encounter_id,patient_nbr\n1,2\n")
    _csv(tmp_path, "b.csv", "patient_nbr,encounter_id\n12,11\n")
    with pytest.raises(Exception, match="header|Header"):
        scan_encounters(spark, str(tmp_path)).collect()


def test_csv_scan_refuses_short_rows(spark, tmp_path):
    _csv(tmp_path, "a.csv", "encounter_id,patient_nbr,age\n1,2\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        scan_encounters(spark, str(tmp_path)).select("encounter_id").collect()


def test_release_removes_the_scratch_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "scratch_root", lambda spark: str(tmp_path))
    assert session.durable(spark.range(3), "r").count() == 3 and list(tmp_path.iterdir())
    session.release_scratch(spark)
    assert not list(tmp_path.iterdir())


@pytest.mark.parametrize("name, model", [("run_trials", "lgb"), ("run_trials_xgb", "xgb")])
def test_trials_query_runs_every_trial(spark, small, monkeypatch, name, model):
    """The registered searches run as many trials as the operator does by default, each with a ledger of its space."""
    asked = []

    def spy(*args, **settings):
        call = inspect.signature(tune).bind(*args, **settings)
        call.apply_defaults()
        asked.append((call.arguments["model"], call.arguments["n_trials"], call.arguments["ledger"].rsplit("-", 1)[1]))
        return spark.range(call.arguments["n_trials"]).toDF("trial"), None

    monkeypatch.setattr(modelling, "tune", spy)
    monkeypatch.setattr(modelling, "_FITTED", {})
    assert entry.queries()[name](spark, small).count() == 20 and asked == [(model, 20, model)]
