"""Exact ranking and threshold metrics over a scored table.

A scored table has a 0/1 label, a score and optionally grouping columns such
as the model or the boosting round. Rows first fold to one per distinct score
(map-side, so a score shared by a third of the table is no hot spot), then
running totals over the ordered scores give every curve exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.functions.scalar import quoted
from wardlens.operators.order import running_totals


def score_steps(scored: DataFrame, label: str = "label", score: str = "proba",
                by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score, best first: own, running and overall positives and rows."""
    per_score = (scored.groupBy(*[quoted(c) for c in by], quoted(score).alias("score"))
                 .agg(F.sum(quoted(label).cast("long")).alias("pos"),
                      F.count(F.lit(1)).alias("n")))
    return running_totals(per_score, by, [F.col("score").desc()],
                          {"pos": ("pos_upto", "pos_all"), "n": ("n_upto", "n_all")})


def _average_precision() -> Column:
    gained = F.sum(F.col("pos") * F.col("pos_upto") / F.col("n_upto"))
    return F.coalesce(F.try_divide(gained, F.sum("pos")), F.lit(0.0))


def _roc_area() -> Column:
    neg = F.col("n") - F.col("pos")
    wins = F.sum(neg * (F.col("pos_upto") - F.col("pos") / 2))
    return F.try_divide(wins, F.sum("pos").cast("double") * F.sum(neg))


def ranking_metrics(steps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Step-wise average precision and the tie-aware ROC area, per group."""
    return steps.groupBy(*[quoted(c) for c in by]).agg(
        _average_precision().alias("auprc"), _roc_area().alias("auroc"))


def average_precision(scored: DataFrame, label: str = "label", score: str = "proba",
                      by: Sequence[str] = ()) -> DataFrame:
    return ranking_metrics(score_steps(scored, label, score, by), by).drop("auroc")


def roc_auc(scored: DataFrame, label: str = "label", score: str = "proba",
            by: Sequence[str] = ()) -> DataFrame:
    return ranking_metrics(score_steps(scored, label, score, by), by).drop("auprc")


def pr_curve(scored: DataFrame, label: str = "label", score: str = "proba",
             by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall at each distinct threshold, and the closing point (1, 0)."""
    groups = [quoted(c) for c in by]
    steps = score_steps(scored, label, score, by)
    points = steps.select(*groups, F.col("score").alias("threshold"),
                          (F.col("pos_upto") / F.col("n_upto")).alias("precision"),
                          F.coalesce(F.try_divide(F.col("pos_upto"), F.col("pos_all")),
                                     F.lit(1.0)).alias("recall"))
    closing = (scored.groupBy(*groups).agg(F.count(F.lit(1)).alias("__n")).where("__n > 0")
               .select(*groups, F.lit(None).cast("double").alias("threshold"),
                       F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")))
    return points.unionByName(closing)


def with_prediction(scored: DataFrame, score: str = "proba", threshold: float = 0.5,
                    name: str = "pred") -> DataFrame:
    return scored.withColumn(name, (quoted(score) >= F.lit(threshold)).cast("int"))


def confusion_counts(scored: DataFrame, label: str = "label", pred: str = "pred",
                     by: Sequence[str] = ()) -> DataFrame:
    y, p = quoted(label), quoted(pred)
    return scored.groupBy(*[quoted(c) for c in by]).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))


def _ratio(top: Column, bottom: Column) -> Column:
    """Zero where the ratio is undefined."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def f1_binary(scored: DataFrame, label: str = "label", pred: str = "pred",
              by: Sequence[str] = ()) -> DataFrame:
    """F1 of the positive class."""
    tp = F.col("tp")
    return (confusion_counts(scored, label, pred, by)
            .select(*[quoted(c) for c in by],
                    _ratio(2 * tp, 2 * tp + F.col("fp") + F.col("fn")).alias("f1")))


def classification_report(scored: DataFrame, label: str = "label", pred: str = "pred",
                          by: Sequence[str] = ()) -> DataFrame:
    """Per-class precision, recall, F1 and support, then the three summary rows."""
    counts = confusion_counts(scored, label, pred, by)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def line(name, hit, predicted, support):
        precision, recall = _ratio(hit, predicted), _ratio(hit, support)
        return F.struct(F.lit(name).alias("row"), precision.alias("precision"),
                        recall.alias("recall"),
                        _ratio(2 * hit, predicted + support).alias("f1"),
                        support.alias("support"), predicted.alias("predicted"))

    both = counts.select("*", F.array(line("0", tn, tn + fn, tn + fp),
                                      line("1", tp, tp + fp, tp + fn)).alias("every"))
    classes = both.select("*", F.filter("every", lambda c: c["support"] + c["predicted"] > 0)
                          .alias("classes"))
    total = tp + fp + fn + tn

    def mean(field, weight):
        return F.aggregate("classes", F.lit(0.0), lambda acc, c: acc + c[field] * weight(c))

    def summary(name, weight):
        return F.struct(F.lit(name).alias("row"),
                        *[mean(f, weight).alias(f) for f in ("precision", "recall", "f1")],
                        total.alias("support"))

    none = F.lit(None).cast("double")
    per_class = F.transform("classes", lambda c: F.struct(
        c["row"].alias("row"), c["precision"].alias("precision"), c["recall"].alias("recall"),
        c["f1"].alias("f1"), c["support"].alias("support")))
    accuracy = F.struct(F.lit("accuracy").alias("row"), none.alias("precision"),
                        none.alias("recall"), _ratio(tp + tn, total).alias("f1"),
                        total.alias("support"))
    macro = summary("macro avg", lambda c: F.lit(1.0) / F.size("classes"))
    weighted = summary("weighted avg", lambda c: c["support"] / total)
    return (classes.where(total > 0)
            .select(*[quoted(c) for c in by], F.inline(F.concat(per_class, F.array(accuracy, macro, weighted)))))


def base_rate(scored: DataFrame, label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    return scored.groupBy(*[quoted(c) for c in by]).agg(F.avg(quoted(label)).alias("base_rate"))


def precision_at_k(scored: DataFrame, k: int = 100, label: str = "label", score: str = "proba",
                   tie: str = "id") -> DataFrame:
    """Positive share among the k best scores; all rows when there are fewer."""
    top = scored.select(quoted(label).alias("y"), quoted(score).alias("s"), quoted(tie).alias("t"))
    return top.orderBy(F.desc("s"), "t").limit(k).agg(F.avg("y").alias("precision_at_k"))


def results_summary(scored: DataFrame, label: str = "label", score: str = "proba",
                    pred: str = "pred", model: str = "model", digits: int = 4) -> DataFrame:
    """One rounded row of metrics per model, all models in one pass."""
    ranking = ranking_metrics(score_steps(scored, label, score, [model]), [model])
    return (ranking.join(f1_binary(scored, label, pred, [model]), model)
            .select(quoted(model).alias("model"),
                    *[F.round(c, digits).alias(c) for c in ("auprc", "auroc", "f1")]))


def best_model(results: DataFrame, tie: str = "model") -> DataFrame:
    """The row with the highest average precision; ``tie`` says which comes first."""
    return results.orderBy(F.desc("auprc"), quoted(tie)).limit(1)
