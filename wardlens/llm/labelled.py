"""Bounded samples of labelled rows, and a small logistic fit on one."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.functions.scalar import quoted
from wardlens.llm.common import held_out


def training_labels(labels: DataFrame, label: str, bound: int, key: str = "doc_id") -> DataFrame:
    """At most ``bound`` labelled keys, drawn by hash, none of them held out.

    A key labelled twice counts once, with its larger label; null keys and
    labels are left out. The bound makes the result safe to broadcast.
    """
    usable = (labels.select(quoted(key).alias(key), quoted(label).cast("double").alias("label"))
              .where(F.col(key).isNotNull() & F.col("label").isNotNull() & ~held_out(F.col(key)))
              .groupBy(key).agg(F.max("label").alias("label")))
    return usable.orderBy(F.xxhash64(F.col(key), F.lit(11)), key).limit(bound)


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, bound: int, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose key is in the sample, with ``label``."""
    sample = training_labels(labels, label, bound, key).withColumnRenamed(key, "__key")
    rest = docs.select(*[quoted(c) for c in docs.columns if c.lower() != "label"])
    return rest.join(F.broadcast(sample), quoted(key) == F.col("__key")).drop("__key")


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> tuple[np.ndarray, float]:
    """Weights and intercept by Newton steps on standardised features; ridge on the weights alone."""
    n, d = x.shape
    if n == 0 or y.min() == y.max():
        rate = (y.sum() + 0.5) / (n + 1) if n else 0.5
        return np.zeros(d), float(np.log(rate / (1 - rate)))
    mean, scale = x.mean(0), x.std(0)
    scale[scale == 0] = 1.0
    z = np.c_[(x - mean) / scale, np.ones(n)]
    w, penalty = np.zeros(d + 1), np.diag([ridge] * d + [1e-9])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + penalty @ w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, gradient)
        w -= np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    weights = w[:d] / scale
    return weights, float(w[d] - weights @ mean)
