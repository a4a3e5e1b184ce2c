"""Scaling, oversampling, fits, attribution and search bound to the tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings import sqltext as S
from bindings.encounters import encounters, table
from bindings.evaluate import featured, rounded, train_only
from wardlens.functions import codes
from wardlens.operators import attribution, models, nodes, search
from wardlens.operators.neighbours import nearest_neighbours
from wardlens.operators.scale import StandardScale
from wardlens.operators.smote import smote_oversample
from wardlens.operators.split import (
    balanced_weight, feature_names, positive_weight, temporal_halves,
)
from wardlens.operators.trees import read_forest
from wardlens.plans.train import train_all, tune
from wardlens.session import concurrently, scratch_path, scratch_root
from wardlens.sources.tables import read_stage, write_trials

SCALED = ["num_lab_procedures", "num_medications", "time_in_hospital", "number_inpatient"]
_FITTED: dict[tuple, tuple] = {}
NOT_FEATURES = [codes.TARGET, codes.ORDER, "split", "weight"]


def halves(spark, sf_dir):
    df = featured(spark, sf_dir)
    return (*temporal_halves(df, [codes.ORDER], dense=True), feature_names(df, NOT_FEATURES))


def fitted_logistic(spark, sf_dir):
    train, test, names = halves(spark, sf_dir)
    train = balanced_weight(train, codes.TARGET)
    return models.fit_logistic(train, names, codes.TARGET, "weight"), train, test, names


def fitted_boosted(spark, sf_dir, preset):
    """A preset's fit on a table; the queries that ask for the same one share it."""
    fit = (spark.sparkContext.applicationId, sf_dir, preset)
    if fit not in _FITTED:
        train, test, names = halves(spark, sf_dir)
        train = positive_weight(train, codes.TARGET)
        _FITTED[fit] = (models.fit_boosted(train, names, codes.TARGET, "weight", preset, test), test, names)
    return _FITTED[fit]


def q_scale(spark, sf_dir) -> DataFrame:
    df = encounters(spark, sf_dir).select("encounter_id", *SCALED)
    return rounded(StandardScale(SCALED).fit(df).transform(df), *SCALED)


def q_logistic(spark, sf_dir) -> DataFrame:
    model, _, test, _ = fitted_logistic(spark, sf_dir)
    return models.score(model, test, codes.ORDER, codes.TARGET)


def q_logistic_optimum(spark, sf_dir) -> DataFrame:
    """Gradient of the penalised objective at the fit, per coefficient: zero at the optimum."""
    model, train, _, names = fitted_logistic(spark, sf_dir)
    fit = model.stages[-1]
    scored = models.score(model, train, codes.ORDER, codes.TARGET).select(F.col("id").alias(codes.ORDER), "proba")
    scaled = model.stages[0].transform(train).join(scored, codes.ORDER)
    pull = F.col("weight") * (F.col("proba") - F.col(codes.TARGET))
    sums = scaled.agg(F.sum(pull).alias("intercept"), F.sum("weight").alias("total"),
                      *[F.sum(pull * F.col(f"`{n}__scaled`")).alias(n) for n in names])
    slopes = {n: (F.col(f"`{n}`") + F.lit(float(b) * 10.0)) / F.col("total")
              for n, b in zip(names, fit.coefficients.toArray())}
    slopes["intercept"] = F.col("intercept") / F.col("total")
    one = sums.select(*[F.abs(F.round(e, 4)).alias(n) for n, e in slopes.items()])
    return one.unpivot([], [F.col(f"`{n}`") for n in slopes], "coefficient", "slope")


def q_boosted(preset):
    def run(spark, sf_dir) -> DataFrame:
        model, test, _ = fitted_boosted(spark, sf_dir, preset)
        return models.score(model, test, codes.ORDER, codes.TARGET)
    return run


def q_save_model(spark, sf_dir) -> DataFrame:
    """Scores of the fitted and of the reloaded model, compared row by row."""
    model, test, _ = fitted_boosted(spark, sf_dir, models.BOOSTED_A)
    path = scratch_path(spark, "model")
    models.save_model(model, path)
    before = models.score(model, test, codes.ORDER, codes.TARGET)
    after = models.score(models.load_model(path), test, codes.ORDER, codes.TARGET)
    return (before.join(after.select("id", F.col("proba").alias("again")), "id")
            .select(F.col("id").alias(codes.ORDER), (F.col("proba") == F.col("again")).alias("same")))


def q_early_stop(spark, sf_dir) -> DataFrame:
    """Per user, daily purchase counts as the curve: few rounds per group, many plateaus."""
    curve = (table(spark, sf_dir, "events")
             .groupBy("user_id", F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01")).alias("day"))
             .agg(F.count_if(F.col("event_type") == "purchase").alias("bought")))
    return models.early_stop_round(curve, "day", "bought", 5, ["user_id"])


def q_round_curve(spark, sf_dir) -> DataFrame:
    model, test, _ = fitted_boosted(spark, sf_dir, models.BOOSTED_B)
    return models.round_curve(model, test, codes.TARGET)


def trained(spark, sf_dir):
    """The whole report on a table; the queries that read it share it."""
    run = (spark.sparkContext.applicationId, sf_dir, "train_all")
    if run not in _FITTED:
        _FITTED[run] = train_all(featured(spark, sf_dir))
    return _FITTED[run]


def q_train_all(spark, sf_dir) -> DataFrame:
    return trained(spark, sf_dir).results


def q_train_all_metrics(spark, sf_dir) -> DataFrame:
    """Reported metrics against those that MLlib's evaluators find on the report's own scores."""
    report, out = trained(spark, sf_dir), []
    for r in report.results.collect():  # one row per model
        mine = report.scored.where(F.col("model") == r["model"]).select(
            F.col("label").cast("double").alias("label"), F.col("pred").cast("double").alias("prediction"),
            array_to_vector(F.array(1 - F.col("proba"), F.col("proba"))).alias("rawPrediction"))
        area = BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0).evaluate(mine)
        f1 = MulticlassClassificationEvaluator(metricName="fMeasureByLabel", metricLabel=1.0).evaluate(mine)
        # The report gives four places.
        out += [(r["model"], "auroc", abs(r["auroc"] - area) < 5.1e-5), (r["model"], "f1", abs(r["f1"] - f1) < 5.1e-5)]
    return spark.createDataFrame(out, "model string, metric string, same boolean")


def q_boosted_structure(spark, sf_dir) -> DataFrame:
    """Per preset: trees fitted, and whether all keep to its depth, leaf size and step."""
    out, presets = [], {"a": models.BOOSTED_A, "b": models.BOOSTED_B}
    # The costlier one first: the fits share no step, so their jobs run side by side.
    fits = concurrently(spark, [lambda p=p: fitted_boosted(spark, sf_dir, p)[0] for p in reversed(presets.values())])
    for (name, preset), model in zip(presets.items(), reversed(fits)):
        forest = read_forest(model.ensemble)
        out.append((name, len(forest.trees), max(map(_depth, forest.trees)) <= preset.max_depth,
                    min(round(float(t.cover[t.left < 0].min()), 6) for t in forest.trees) >= preset.min_rows,
                    set(forest.weights[1:]) == {preset.learning_rate}))
    return spark.createDataFrame(out, "preset string, trees int, depth_kept boolean, leaf_size_kept boolean, "
                                      "step_kept boolean")


def few_rounds(spark, sf_dir, preset, rounds, **settings):
    """A preset's fit cut to a few rounds, its node table, and the halves with their feature arrays."""
    train, test, names = halves(spark, sf_dir)
    train = positive_weight(train, codes.TARGET)
    model = models.fit_boosted(train, names, codes.TARGET, "weight", replace(preset, rounds=rounds, patience=None, **settings))

    def arrays(df):
        vectors = model.pipeline.stages[0].transform(df)
        return vectors.select(F.col(codes.ORDER).alias("id"), vector_to_array("features").alias("features"))

    return model, nodes.node_table(model.ensemble), train, test, names, arrays


def q_boosted_margins(preset):
    """Per test row: margin by joins with the node table against the model's own log-odds."""
    def run(spark, sf_dir) -> DataFrame:
        model, table_, _, test, _, arrays = few_rounds(spark, sf_dir, preset, 8)
        own = models.score(model, test, codes.ORDER, codes.TARGET).select(
            F.col("id").alias("of"), F.log(F.col("proba") / (1 - F.col("proba"))).alias("odds"))
        met = nodes.margins(arrays(test), table_).join(own, F.col("id") == F.col("of"))
        return met.select(F.col("id").alias(codes.ORDER), F.abs(F.round(2 * F.col("margin") - F.col("odds"), 6)).alias("gap"))
    return run


def q_boosted_leaves(preset):
    """Per training row: value of its leaf in the first tree against the weighted mean of the labels in that leaf."""
    def run(spark, sf_dir) -> DataFrame:
        _, table_, train, _, _, arrays = few_rounds(spark, sf_dir, preset, 1, row_fraction=1.0)
        placed = nodes.leaves_of(arrays(train), table_.where("tree = 0"))
        rows = placed.join(train.select(F.col(codes.ORDER).alias("of"), F.col(codes.TARGET).alias("y"), F.col("weight").alias("w")),
                           F.col("id") == F.col("of"))
        means = rows.groupBy(F.col("node").alias("leaf")).agg((F.sum(F.col("w") * (2 * F.col("y") - 1)) / F.sum("w")).alias("mean"))
        return rows.join(means, F.col("node") == F.col("leaf")).select(
            F.col("id").alias(codes.ORDER), F.abs(F.round(F.col("value") - F.col("mean"), 6)).alias("gap"))
    return run


def q_shap_coalitions(spark, sf_dir) -> DataFrame:
    """Per test row and feature: the operator's contribution against the sum over all coalitions."""
    model, table_, _, test, names, arrays = few_rounds(spark, sf_dir, models.BOOSTED_B, 4, max_depth=4)
    fast = attribution.attribution_long(attribution.tree_shap(model, test, codes.ORDER), names).select("id", "feature", "phi")
    slow = nodes.coalition_shapley(arrays(test), table_).select(
        F.col("id").alias("of"), F.element_at(F.array(*map(F.lit, names)), F.col("feature") + 1).alias("named"), F.col("phi").alias("again"))
    met = fast.join(slow, (F.col("id") == F.col("of")) & (F.col("feature") == F.col("named")), "left")
    return met.select(F.col("id").alias(codes.ORDER), "feature",
                      F.abs(F.round(F.col("phi") - F.coalesce("again", F.lit(0.0)), 6)).alias("gap"))


def _depth(tree) -> int:
    level, depth = [0], 0
    while True:
        level = [c for n in level if tree.left[n] >= 0 for c in (tree.left[n], tree.right[n])]
        if not level:
            return depth
        depth += 1


def minority_embeddings(spark, sf_dir) -> DataFrame:
    df = table(spark, sf_dir, "embeddings")
    sizes = df.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy("n", "label").first()
    return df.where(F.col("label") == sizes["label"]).select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))


def q_neighbours(spark, sf_dir) -> DataFrame:
    near = nearest_neighbours(minority_embeddings(spark, sf_dir), 5)
    return rounded(near.drop("neighbour_vec"), "distance")


def q_neighbours_all(spark, sf_dir) -> DataFrame:
    """The same search over every embedding, whatever its label."""
    points = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))
    return rounded(nearest_neighbours(points, 5).drop("neighbour_vec"), "distance")


def smote(spark, sf_dir) -> DataFrame:
    train = train_only(spark, sf_dir)
    names = feature_names(train, NOT_FEATURES)
    return smote_oversample(train, names, codes.TARGET, codes.ORDER)


def q_smote(spark, sf_dir) -> DataFrame:
    out = smote(spark, sf_dir)
    return rounded(out, *[c for c in out.columns if c not in (codes.TARGET, codes.ORDER, "synthetic")])


def q_smote_balance(spark, sf_dir) -> DataFrame:
    return (smote(spark, sf_dir).groupBy(codes.TARGET, "synthetic")
            .agg(F.count(F.lit(1)).alias("rows")))


def q_tree_shap(spark, sf_dir) -> DataFrame:
    model, test, names = fitted_boosted(spark, sf_dir, models.BOOSTED_B)
    return attribution.attribution_long(attribution.tree_shap(model, test, codes.ORDER), names)


def q_shap_additivity(spark, sf_dir) -> DataFrame:
    """Base plus contributions against the model's own log-odds, per row."""
    model, test, _ = fitted_boosted(spark, sf_dir, models.BOOSTED_B)
    total = F.col("base") + F.aggregate("phi", F.lit(0.0), lambda a, x: a + x)
    shap = attribution.tree_shap(model, test, codes.ORDER).select("id", total.alias("total"))
    own = models.score(model, test, codes.ORDER, codes.TARGET).select(
        "id", F.log(F.col("proba") / (1 - F.col("proba"))).alias("odds"))
    return shap.join(own, "id").select(F.col("id").alias(codes.ORDER),
                                       F.abs(F.round(F.col("total") - F.col("odds"), 6)).alias("gap"))


PHI = {"num_lab_procedures": "(num_lab_procedures - 60) * 0.01",
       "num_medications": "(num_medications - 20) * 0.02",
       "number_inpatient": "(number_inpatient - 2) * 0.5",
       "time_in_hospital": "(time_in_hospital - 7) * (num_procedures - 3) * 0.05"}


def phi_table(spark, sf_dir) -> DataFrame:
    df = encounters(spark, sf_dir)
    wide = df.select("encounter_id", F.array(*[F.struct(
        F.lit(n).alias("feature"), F.col(n).cast("double").alias("value"),
        F.expr(e).cast("double").alias("phi")) for n, e in PHI.items()]).alias("a"))
    return wide.select(F.col("encounter_id").alias("id"), F.inline("a"))


def trial_ids(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("trial"))


def q_sample_trials(model):
    floats = [f"params_{n}" for n, spec in search.SPACES[model].items() if isinstance(spec, search.FloatRange)]
    return lambda s, d: search.sample_trials(trial_ids(s, d), search.SPACES[model]).withColumns(
        {c: F.round(c, 9) for c in floats})


def q_trial_bounds(spark, sf_dir) -> DataFrame:
    """How many sampled trials keep to every bound and step of their space."""
    drawn = search.sample_trials(trial_ids(spark, sf_dir), search.SPACES["lgb"])
    inside = F.expr("params_n_estimators BETWEEN 100 AND 1000 AND params_n_estimators % 100 = 0 "
                    "AND params_learning_rate BETWEEN 0.001 AND 0.2 AND params_max_depth BETWEEN 3 AND 12 "
                    "AND params_min_child_samples BETWEEN 5 AND 100 "
                    "AND params_subsample BETWEEN 0.5 AND 1 AND params_colsample_bytree BETWEEN 0.5 AND 1")
    return drawn.agg(F.count(F.lit(1)).alias("trials"), F.count_if(inside).alias("inside"))


def _tuned(spark, sf_dir, model="lgb", **settings) -> DataFrame:
    """A search on a table; each application keeps a ledger per space, so a call that was cut off goes on."""
    run = (spark.sparkContext.applicationId, sf_dir, "tune", model, *settings.items())
    if run not in _FITTED:
        ledger = f"{scratch_root(spark)}/wardlens-{spark.sparkContext.applicationId}/ledger-{model}"
        _FITTED[run] = tune(featured(spark, sf_dir), model, ledger=ledger, study=sf_dir, **settings)[0]
    return _FITTED[run]


def q_run_trials(model):
    return lambda s, d: _tuned(s, d, model)


def q_run_trials_drawn(spark, sf_dir) -> DataFrame:
    """The configurations two trials ran with, as its SQL asks for, and whether each got a score in its range."""
    ran = _tuned(spark, sf_dir, n_trials=2)
    floats = [f"params_{n}" for n, spec in search.SPACES["lgb"].items() if isinstance(spec, search.FloatRange)]
    return (ran.withColumns({c: F.round(c, 9) for c in floats})
            .withColumn("scored", F.col("value").between(0, 1) & ~F.isnan("value")).drop("value"))


def priced_trials(spark, sf_dir) -> DataFrame:
    """Parts as a trial table with many ties: the value is the size, scaled."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("trial"), F.struct(F.col("p_brand").alias("brand"),
                                                    F.col("p_size").alias("size")).alias("params"),
        (F.col("p_size") / 50.0).alias("value"))


def q_write_trials(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "trials")
    write_trials(priced_trials(spark, sf_dir), path)
    return read_stage(spark, path, "trial bigint, params_brand string, params_size int, value double", "csv")


QUERIES = {
    "standard_scale": q_scale,
    "logistic_baseline": q_logistic,
    "logistic_optimum": q_logistic_optimum,
    "boosted_trees_a": q_boosted(models.BOOSTED_A),
    "boosted_trees_b": q_boosted(models.BOOSTED_B),
    "round_curve": q_round_curve,
    "early_stop_round": q_early_stop,
    "save_model": q_save_model,
    "train_all": q_train_all,
    "train_all_metrics": q_train_all_metrics,
    "boosted_structure": q_boosted_structure,
    "boosted_margins_a": q_boosted_margins(models.BOOSTED_A),
    "boosted_margins_b": q_boosted_margins(models.BOOSTED_B),
    "boosted_leaves_a": q_boosted_leaves(models.BOOSTED_A),
    "boosted_leaves_b": q_boosted_leaves(models.BOOSTED_B),
    "tree_shap_coalitions": q_shap_coalitions,
    "minority_neighbours": q_neighbours,
    "neighbours_embeddings": q_neighbours_all,
    "smote_oversample": q_smote,
    "smote_balance": q_smote_balance,
    "tree_shap": q_tree_shap,
    "tree_shap_additivity": q_shap_additivity,
    "mean_abs_importance": lambda s, d: rounded(
        attribution.mean_abs_importance(phi_table(s, d)), "mean_abs_phi"),
    "beeswarm_points": lambda s, d: rounded(attribution.beeswarm_points(phi_table(s, d), 2), "phi"),
    "sample_trials": q_sample_trials("lgb"),
    "sample_trials_xgb": q_sample_trials("xgb"),
    "sample_trials_bounds": q_trial_bounds,
    "run_trials": q_run_trials("lgb"),
    "run_trials_xgb": q_run_trials("xgb"),
    "run_trials_drawn": q_run_trials_drawn,
    "best_trial": lambda s, d: search.best_trial(priced_trials(s, d)).select("trial", "value"),
    "write_trials": q_write_trials,
}

_PHI_SQL = S.upto("enc", "") + ", phi AS (" + " UNION ALL ".join(
    f"SELECT encounter_id AS id, '{n}' AS feature, {n}::DOUBLE AS value, ({e})::DOUBLE AS phi FROM enc"
    for n, e in PHI.items()) + ")"
_RANK_SQL = ", ranked AS (SELECT feature, avg(abs(phi)) AS m FROM phi GROUP BY feature)"


def _neighbours_sql(where: str) -> str:
    return f"""WITH p AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings {where}),
 pairs AS (SELECT a.id, b.id AS neighbour, list_distance(a.v, b.v) AS d FROM p a JOIN p b ON a.id <> b.id),
 ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, neighbour) AS rk FROM pairs)
 SELECT id, rk::INTEGER AS rank, neighbour, round(d, 6) AS distance FROM ranked WHERE rk <= 5"""


def _unit_sql(key: str, name: str) -> str:
    """13 digits of a digest make the uniform number."""
    return f"(('0x' || substr(md5('42|' || {key} || '|{name}'), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)"


def _smote_sql() -> str:
    names = ["gender", "age", *S.PLAIN, "A1Cresult", "max_glu_serum", *S.DRUGS, "change", "diabetesMed", *S.FEATURES,
             *[f"{c}_{v}" for c in S.VOCABULARY for v in S.VOCABULARY[c][1:]]]
    vec = ", ".join(f"{S.q(n)}::DOUBLE" for n in names)
    real = ", ".join(f"round({S.q(n)}::DOUBLE, 6) AS {S.q(n)}" for n in names)
    made = ", ".join(f"round(a.v[{i}] + w.u * (b.v[{i}] - a.v[{i}]), 6)" for i in range(1, len(names) + 1))
    return S.upto("split", f""", tr AS (SELECT * FROM split WHERE split = 'train'),
 c AS (SELECT readmitted_lt30 AS y, count(*) AS n FROM tr GROUP BY 1),
 few AS (SELECT y, n, (SELECT max(n) FROM c) - n AS missing FROM c ORDER BY n, y LIMIT 1),
 p AS (SELECT encounter_order AS id, row_number() OVER (ORDER BY encounter_order) AS nth, [{vec}] AS v
   FROM tr WHERE readmitted_lt30 = (SELECT y FROM few)),
 near AS (SELECT a.nth, b.nth AS other, row_number() OVER (PARTITION BY a.nth ORDER BY list_distance(a.v, b.v), b.id) AS rk
   FROM p a JOIN p b ON a.id <> b.id QUALIFY rk <= 5),
 w AS (SELECT floor({_unit_sql('s', 'base')} * few.n)::BIGINT + 1 AS nth,
     floor({_unit_sql('s', 'neighbour')} * 5)::BIGINT + 1 AS rk, {_unit_sql('s', 'step')} AS u
   FROM few, range((SELECT missing FROM few)) AS r(s))
 SELECT encounter_order, readmitted_lt30, {real}, false AS synthetic FROM tr UNION ALL
 SELECT NULL, (SELECT y FROM few), {made}, true FROM w JOIN near USING (nth, rk) JOIN p a ON a.nth = near.nth
   JOIN p b ON b.nth = near.other""")


def _trials_sql(space: search.Space, source: str = "part", key: str = "p_partkey", more: str = "") -> str:
    """The drawn trials in SQL."""
    out = []
    for name, spec in space.items():
        u = _unit_sql(key, name)
        if isinstance(spec, search.IntRange):
            count = (spec.high - spec.low) // spec.step + 1
            out.append(f"({spec.low} + {spec.step} * floor({u} * {count}))::INTEGER AS params_{name}")
        elif spec.log:
            low, high = f"ln({spec.low}::DOUBLE)", f"ln({spec.high}::DOUBLE)"
            out.append(f"round(exp({low} + {u} * ({high} - {low})), 9) AS params_{name}")
        else:
            out.append(f"round({spec.low}::DOUBLE + {u} * {spec.high - spec.low}::DOUBLE, 9) AS params_{name}")
    return f"SELECT {key} AS trial, {', '.join(out)}{more} FROM {source}"


_SPLIT_TEST = S.upto("split", "SELECT encounter_order, {} FROM split WHERE split = 'test'")

ORACLES = {
    "standard_scale": S.upto("enc", "SELECT encounter_id, " + ", ".join(
        f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}" for c in SCALED) + " FROM enc"),
    "early_stop_round": """WITH c AS (SELECT user_id, date_diff('day', DATE '2024-01-01', ts::DATE)::INTEGER AS day,
        count(*) FILTER (event_type = 'purchase') AS v FROM events GROUP BY ALL),
      n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day) AS i,
        max(v) OVER (PARTITION BY user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM c),
      g AS (SELECT * FROM n WHERE m IS NULL OR v > m),
      h AS (SELECT *, lead(i) OVER (PARTITION BY user_id ORDER BY i) AS nxt FROM g),
      f AS (SELECT user_id, min(i) AS i FROM h WHERE nxt IS NULL OR nxt - i > 5 GROUP BY user_id)
      SELECT user_id, h.day AS best_round, h.v AS best_value FROM h JOIN f USING (user_id, i)""",
    "save_model": _SPLIT_TEST.format("true AS same"),
    "minority_neighbours": _neighbours_sql("WHERE label = (SELECT label FROM embeddings GROUP BY label "
                                           "ORDER BY count(*), label LIMIT 1)"),
    "neighbours_embeddings": _neighbours_sql(""),
    "smote_oversample": _smote_sql(),
    "train_all_metrics": "SELECT model, metric, true AS same FROM "
                         "(SELECT unnest(['logistic', 'boosted_a', 'boosted_b']) AS model), "
                         "(SELECT unnest(['auroc', 'f1']) AS metric)",
    "boosted_structure": "SELECT preset, 500 AS trees, true AS depth_kept, true AS leaf_size_kept, true AS step_kept "
                         "FROM (SELECT unnest(['a', 'b']) AS preset)",
    "run_trials_drawn": _trials_sql(search.SPACES["lgb"], "range(2) AS r(t)", "t", ", true AS scored"),
    "smote_balance": S.upto("split", """, c AS (SELECT readmitted_lt30 AS y, count(*) AS n FROM split WHERE split = 'train'
        GROUP BY 1) SELECT y AS readmitted_lt30, false AS synthetic, n AS rows FROM c UNION ALL
      SELECT y, true, (SELECT max(n) FROM c) - n FROM c WHERE n < (SELECT max(n) FROM c)"""),
    "tree_shap_additivity": _SPLIT_TEST.format("0.0::DOUBLE AS gap"),
    "mean_abs_importance": _PHI_SQL + _RANK_SQL + " SELECT feature, round(m, 6) AS mean_abs_phi FROM ranked "
                                                  "ORDER BY m DESC, feature LIMIT 10",
    "beeswarm_points": _PHI_SQL + _RANK_SQL + " SELECT id, feature, value, round(phi, 6) AS phi FROM phi WHERE feature IN "
                                              "(SELECT feature FROM ranked ORDER BY m DESC, feature LIMIT 2)",
    "sample_trials": _trials_sql(search.SPACES["lgb"]),
    "sample_trials_xgb": _trials_sql(search.SPACES["xgb"]),
    "sample_trials_bounds": "SELECT count(*) AS trials, count(*) AS inside FROM part",
    "best_trial": "SELECT p_partkey AS trial, p_size / 50.0::DOUBLE AS value FROM part "
                  "ORDER BY p_size DESC, p_partkey LIMIT 1",
    "write_trials": "SELECT p_partkey AS trial, p_brand AS params_brand, p_size AS params_size, "
                    "p_size / 50.0::DOUBLE AS value FROM part",
}
_FEATURES = ["gender", "age", *S.PLAIN, "A1Cresult", "max_glu_serum", *S.DRUGS, "change", "diabetesMed",
             *S.FEATURES, *[f"{c}_{v}" for c in S.VOCABULARY for v in S.VOCABULARY[c][1:]]]
ORACLES["logistic_optimum"] = S.upto("featured", " UNION ALL ".join(
    f"SELECT '{c}' AS coefficient, 0.0::DOUBLE AS slope" for c in ["intercept", *_FEATURES]))
for _preset in "ab":
    ORACLES[f"boosted_margins_{_preset}"] = _SPLIT_TEST.format("0.0::DOUBLE AS gap")
    ORACLES[f"boosted_leaves_{_preset}"] = S.upto(
        "split", "SELECT encounter_order, 0.0::DOUBLE AS gap FROM split WHERE split = 'train'")
ORACLES["tree_shap_coalitions"] = S.upto("split", "SELECT encounter_order, feature, 0.0::DOUBLE AS gap FROM split, (SELECT unnest(["
    + ", ".join(f"'{f}'" for f in _FEATURES) + "]) AS feature) WHERE split = 'test'")
