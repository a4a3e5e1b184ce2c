"""Splits, weights and metrics bound to the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings import sqltext as S
from bindings.clean import q_featured
from bindings.encounters import table
from wardlens.functions import codes
from wardlens.operators import metrics, split
from wardlens.operators.order import ordered_index
from wardlens.plans.prepare import FULL
from wardlens.session import durable, scratch_path
from wardlens.sources.tables import read_results_ranked, write_results

MODULI = {"model_a": 97, "model_b": 89, "model_c": 53}


def featured(spark, sf_dir) -> DataFrame:
    return durable(q_featured(FULL)(spark, sf_dir), "featured")


def split_encounters(spark, sf_dir) -> DataFrame:
    return split.temporal_split(featured(spark, sf_dir), [codes.ORDER], dense=True)


def split_events(spark, sf_dir) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", "ts", F.col("event_type").eqNullSafe("purchase").cast("int").alias("target"))
    return split.temporal_split(events, ["ts", "event_id"])


def scored(spark, sf_dir, modulus: int = 97) -> DataFrame:
    """Labels with a tie-heavy score computed from the document length."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    pairs = table(spark, sf_dir, "labels").join(docs, "doc_id")
    df = pairs.select(F.col("doc_id").alias("id"), F.col("toxic").alias("label"),
                      ((F.col("n_chars") % modulus) / float(modulus)).alias("proba"))
    return metrics.with_prediction(df)


def scored_models(spark, sf_dir) -> DataFrame:
    return reduce(DataFrame.unionByName,
                  [scored(spark, sf_dir, m).withColumn("model", F.lit(name))
                   for name, m in MODULI.items()])


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def train_only(spark, sf_dir) -> DataFrame:
    return split.temporal_halves(featured(spark, sf_dir), [codes.ORDER], dense=True)[0]


def q_results(spark, sf_dir) -> DataFrame:
    return metrics.results_summary(scored_models(spark, sf_dir))


def q_write_results(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "results")
    write_results(q_results(spark, sf_dir), path)
    return read_results_ranked(spark, path)


def q_ranked(spark, sf_dir) -> DataFrame:
    """Ranking read back, with each model's place made visible."""
    ranked = q_write_results(spark, sf_dir).withColumn("worse", -F.col("auprc"))
    return ordered_index(ranked, ["worse", "model"], "place").select("place", "model", "auprc")


QUERIES = {
    "temporal_split": lambda s, d: split_encounters(s, d).select(codes.ORDER, codes.TARGET, "split"),
    "temporal_split_events": lambda s, d: split_events(s, d).select("event_id", "split"),
    "split_summary": lambda s, d: rounded(split.split_summary(
        split_encounters(s, d), codes.TARGET, 60), "positive_rate"),
    "split_summary_events": lambda s, d: rounded(split.split_summary(
        split_events(s, d), "target", 1), "positive_rate"),
    "class_ratio": lambda s, d: rounded(split.class_ratio(train_only(s, d), codes.TARGET), "ratio"),
    "class_ratio_labels": lambda s, d: rounded(split.class_ratio(table(s, d, "labels"), "toxic"), "ratio"),
    "class_weights": lambda s, d: rounded(split.balanced_weight(
        table(s, d, "labels"), "toxic"), "weight").select("doc_id", "weight"),
    "class_weights_positive": lambda s, d: rounded(split.positive_weight(
        table(s, d, "labels"), "toxic"), "weight").select("doc_id", "weight"),
    "score_threshold": lambda s, d: scored(s, d).select("id", "proba", "pred"),
    "average_precision": lambda s, d: rounded(metrics.average_precision(scored(s, d)), "auprc"),
    "roc_auc": lambda s, d: rounded(metrics.roc_auc(scored(s, d)), "auroc"),
    "confusion_counts": lambda s, d: metrics.confusion_counts(scored(s, d)),
    "f1_binary": lambda s, d: rounded(metrics.f1_binary(scored(s, d)), "f1"),
    "classification_report": lambda s, d: rounded(metrics.classification_report(scored(s, d)),
                                                  "precision", "recall", "f1"),
    "pr_curve": lambda s, d: rounded(metrics.pr_curve(scored_models(s, d), by=["model"]),
                                     "threshold", "precision", "recall"),
    "base_rate": lambda s, d: rounded(metrics.base_rate(scored(s, d)), "base_rate"),
    "precision_at_k": lambda s, d: rounded(metrics.precision_at_k(scored(s, d)), "precision_at_k"),
    "results_summary": q_results,
    "write_results": q_write_results,
    "read_results_ranked": q_ranked,
    "best_model": lambda s, d: metrics.best_model(q_results(s, d)),
}

SCORED = {name: f"SELECT l.doc_id AS id, l.toxic AS label, (d.n_chars % {m})::DOUBLE / {m}.0 AS proba, "
                f"CASE WHEN (d.n_chars % {m})::DOUBLE / {m}.0 >= 0.5 THEN 1 ELSE 0 END AS pred, "
                f"'{name}' AS model FROM labels l JOIN documents d USING (doc_id)"
          for name, m in MODULI.items()}
_ONE = f"WITH scored AS ({SCORED['model_a']})"
_ALL = f"WITH scored AS ({' UNION ALL '.join(SCORED.values())})"
_STEPS = """, steps AS (SELECT model, proba, sum(label)::DOUBLE AS pos, count(*)::DOUBLE AS n
    FROM scored GROUP BY model, proba),
cum AS (SELECT *, sum(pos) OVER w AS pu, sum(n) OVER w AS nu, sum(pos) OVER (PARTITION BY model) AS pa
    FROM steps WINDOW w AS (PARTITION BY model ORDER BY proba DESC)),
rank AS (SELECT model, sum(pos * pu / nu) / sum(pos) AS auprc,
    sum((n - pos) * (pu - pos / 2)) / (sum(pos) * sum(n - pos)) AS auroc FROM cum GROUP BY model),
conf AS (SELECT model, count(*) FILTER (label = 1 AND pred = 1) AS tp, count(*) FILTER (label = 0 AND pred = 1) AS fp,
    count(*) FILTER (label = 1 AND pred = 0) AS fn, count(*) FILTER (label = 0 AND pred = 0) AS tn
    FROM scored GROUP BY model),
results AS (SELECT model, round(auprc, 4) AS auprc, round(auroc, 4) AS auroc,
    round(coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0.0)::DOUBLE, 4) AS f1 FROM rank JOIN conf USING (model))
"""
_REPORT = """, lines AS (
  SELECT '0' AS "row", tn AS hit, tn + fn AS predicted, tn + fp AS support FROM conf
  UNION ALL SELECT '1', tp, tp + fp, tp + fn FROM conf),
per AS (SELECT *, coalesce(hit::DOUBLE / nullif(predicted, 0), 0) AS precision,
  coalesce(hit::DOUBLE / nullif(support, 0), 0) AS recall,
  coalesce(2.0::DOUBLE * hit / nullif(predicted + support, 0), 0) AS f1 FROM lines WHERE predicted + support > 0),
every AS (SELECT "row", precision, recall, f1, support FROM per
  UNION ALL SELECT 'accuracy', NULL, NULL, (tp + tn)::DOUBLE / (tp + fp + fn + tn), tp + fp + fn + tn FROM conf
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::BIGINT FROM per
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), sum(support)::BIGINT FROM per)
SELECT "row", round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM every"""
_EVENTS = """WITH ranked AS (SELECT event_id, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS target,
  CASE WHEN row_number() OVER (ORDER BY ts, event_id) <= floor(count(*) OVER () * 0.8) THEN 'train' ELSE 'test' END
  AS split FROM events) """
_COUNTS = ("count(*) FILTER ({t} = 1) AS positives, count(*) FILTER ({t} = 0) AS negatives, "
           "round(count(*) FILTER ({t} = 0) / greatest(count(*) FILTER ({t} = 1), 1)::DOUBLE, 6) AS ratio")
_WEIGHTS = ("WITH c AS (SELECT toxic, count(*)::DOUBLE AS n FROM labels GROUP BY toxic), "
            "t AS (SELECT sum(n) AS total, count(*) AS k FROM c) "
            "SELECT doc_id, round(total / (k * n), 6) AS weight FROM labels JOIN c USING (toxic), t")

ORACLES = {
    "temporal_split": S.upto("split", "SELECT encounter_order, readmitted_lt30, split FROM split"),
    "temporal_split_events": _EVENTS + "SELECT event_id, split FROM ranked",
    "split_summary": S.upto("split", "SELECT split, count(*) AS rows, round(avg(readmitted_lt30), 6) AS positive_rate, "
                                     "60::INTEGER AS features FROM split GROUP BY split"),
    "split_summary_events": _EVENTS + "SELECT split, count(*) AS rows, round(avg(target), 6) AS positive_rate, "
                                      "1::INTEGER AS features FROM ranked GROUP BY split",
    "class_ratio": S.upto("split", f"SELECT {_COUNTS.format(t='readmitted_lt30')} FROM split WHERE split = 'train'"),
    "class_ratio_labels": f"SELECT {_COUNTS.format(t='toxic')} FROM labels",
    "class_weights": _WEIGHTS,
    "class_weights_positive": f"WITH r AS (SELECT {_COUNTS.format(t='toxic')} FROM labels) "
                              "SELECT doc_id, CASE WHEN toxic = 1 THEN ratio ELSE 1.0 END::DOUBLE AS weight FROM labels, r",
    "score_threshold": _ONE + " SELECT id, proba, pred FROM scored",
    "average_precision": _ONE + _STEPS + "SELECT round(auprc, 6) AS auprc FROM rank",
    "roc_auc": _ONE + _STEPS + "SELECT round(auroc, 6) AS auroc FROM rank",
    "confusion_counts": _ONE + _STEPS + "SELECT tp, fp, fn, tn FROM conf",
    "f1_binary": _ONE + _STEPS + "SELECT round(coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0.0)::DOUBLE, 6) AS f1 FROM conf",
    "classification_report": _ONE + _STEPS + _REPORT,
    "pr_curve": _ALL + _STEPS + """SELECT model, round(proba, 6) AS threshold, round(pu / nu, 6) AS precision,
      round(pu / pa, 6) AS recall FROM cum UNION ALL
      SELECT DISTINCT model, CAST(NULL AS DOUBLE), 1.0::DOUBLE, 0.0::DOUBLE FROM scored""",
    "base_rate": _ONE + " SELECT round(avg(label), 6) AS base_rate FROM scored",
    "precision_at_k": _ONE + " SELECT round(avg(label), 6) AS precision_at_k FROM "
                             "(SELECT label FROM scored ORDER BY proba DESC, id LIMIT 100)",
    "results_summary": _ALL + _STEPS + "SELECT * FROM results",
    "write_results": _ALL + _STEPS + "SELECT * FROM results",
    "read_results_ranked": _ALL + _STEPS + "SELECT row_number() OVER (ORDER BY auprc DESC, model) AS place, "
                                           "model, auprc FROM results",
    "best_model": _ALL + _STEPS + "SELECT * FROM results ORDER BY auprc DESC, model LIMIT 1",
}
