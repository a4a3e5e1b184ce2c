"""Quality by hierarchical empirical Bayes over document, path and host.

A logistic classifier on text statistics gives each document's evidence. Hosts
and paths inside hosts have beta posteriors over the share of good documents,
shrunk toward the global and the host's rate by prior strengths estimated from
the spread of the groups themselves. A document counts in its groups with its
label where labels may teach, else with the classifier's probability; its own
score leaves its own count out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.functions.scalar import quoted
from wardlens.llm.common import held_out
from wardlens.llm.labelled import fit_logistic, labelled_rows
from wardlens.llm.stats import shares, with_stats
from wardlens.session import durable

SAMPLE = 20_000


@dataclass(frozen=True)
class DocumentClassifier:
    """Weights over the features of ``stats.shares``, and the training rate of label 1."""

    weights: tuple[float, ...]
    intercept: float

    def probability(self) -> Column:
        margin = F.lit(self.intercept)
        for w, f in zip(self.weights, shares().values()):
            margin = margin + F.lit(w) * f
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality", bound: int = SAMPLE) -> DocumentClassifier:
    """Fit on at most ``bound`` labelled rows that are not held out."""
    rows = (labelled_rows(stats, labels, label, bound)
            .select(*[f.alias(n) for n, f in shares().items()], "label").limit(bound).toPandas().to_numpy(float))
    weights, intercept = fit_logistic(rows[:, :-1], rows[:, -1])
    return DocumentClassifier(tuple(weights.tolist()), intercept)


def _strength(groups: DataFrame, n: str, s: str, mean: Column, least: float = 1.0, most: float = 1e6) -> float:
    """Pseudo-count of the beta prior, by moments: spread between groups beyond what sampling explains."""
    rate = F.col(s) / F.col(n)
    row = (groups.where(F.col(n) > 0)
           .agg(F.sum(F.col(n) * (rate - mean) * (rate - mean)).alias("between"), F.sum(n).alias("n"),
                F.sum(mean * (1 - mean)).alias("within"), F.count(F.lit(1)).alias("groups"),
                F.sum(F.col(n) * mean * (1 - mean)).alias("unit")).first())
    if not row["n"] or row["groups"] < 2 or not row["unit"]:
        return most
    spread = (row["between"] - row["within"]) / row["unit"]  # variance of group rates over that of one draw
    return float(np.clip((1 - spread) / spread, least, most)) if spread > 0 else most


def with_site(df: DataFrame, url: str, host: str = "host", path: str = "path") -> DataFrame:
    """Add the host of a URL, in lower case without ``www.``, and the first part of its path; null where there is none."""
    where = F.try_parse_url(quoted(url), F.lit("HOST"))
    part = F.regexp_extract(F.try_parse_url(quoted(url), F.lit("PATH")), "^/([^/]+)/", 1)
    return df.withColumn(host, F.regexp_replace(F.lower(where), r"^www\.", "")).withColumn(path, F.nullif(part, F.lit("")))


def score(docs: DataFrame, labels: DataFrame, *, text: str = "text", host: str = "source", path: str = "lang",
          key: str = "doc_id", threshold: float = 0.5, bound: int = SAMPLE) -> DataFrame:
    """Per row: the key, ``held_out, document_score, host_rate, path_rate, score, kept``.

    Null hosts and paths are groups like any other; null and empty texts have
    statistics of 0, very long ones are read whole. Repeated rows each count.
    Without two label values the evidence is the label rate. An empty table
    gives an empty one. Columns beside those named are ignored. All labels that
    are not held out count in the groups; only the classifier is fitted on a
    bounded sample of them. Groups are aggregated before any shuffle of rows,
    so a hot host is a few partial sums.
    """
    stats = durable(with_stats(docs.select(quoted(key).alias(key), quoted(host).alias("host"),
                                           quoted(path).alias("path"), quoted(text).alias("text")), "text").drop("text"),
                    "quality-stats")
    own = stats.select(key, "host", "path", fit(stats.withColumnRenamed("host", "h"), labels, bound=bound)
                       .probability().alias("p"))
    known = (labels.where(quoted(key).isNotNull() & F.col("quality").isNotNull() & ~held_out(quoted(key)))
             .groupBy(quoted(key).alias("__key")).agg(F.max(F.col("quality").cast("double")).alias("__known")))
    own = (own.join(known, quoted(key) == F.col("__key"), "left")
           .withColumn("given", F.coalesce("__known", "p")).drop("__key", "__known"))
    paths = durable(own.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("given").alias("s")), "quality-paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"))
    all_rows = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_s").alias("s")).first()
    mean = (all_rows["s"] or 0.0) / (all_rows["n"] or 1)
    mean = min(max(mean, 1e-4), 1 - 1e-4)
    m = _strength(hosts, "host_n", "host_s", F.lit(mean))
    host_rate = (F.col("host_s") + m * mean) / (F.col("host_n") + m)
    nested = (paths.withColumnsRenamed({"host": "of_host", "path": "of_path"})
              .join(hosts.withColumn("host_rate", host_rate), F.col("of_host").eqNullSafe(F.col("host"))).drop("host"))
    k = _strength(nested, "n", "s", F.col("host_rate"))
    joined = own.join(nested, F.col("host").eqNullSafe(F.col("of_host")) & F.col("path").eqNullSafe(F.col("of_path")))
    path_rate = (F.col("s") - F.col("given") + F.lit(k) * F.col("host_rate")) / (F.col("n") - 1 + F.lit(k))

    def logit(x: Column) -> Column:
        bounded = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), x))
        return F.log(bounded / (1 - bounded))

    margin = logit(F.col("p")) + logit(F.col("path_rate")) - float(np.log(mean / (1 - mean)))
    return (joined.withColumn("path_rate", path_rate)
            .withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)))
            .select(key, held_out(quoted(key)).alias("held_out"), F.col("p").alias("document_score"), "host_rate",
                    "path_rate", "score", (F.col("score") >= threshold).alias("kept")))
