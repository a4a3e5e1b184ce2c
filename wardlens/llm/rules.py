"""Learned decision lists over text statistics, by sequential covering.

A rule is a conjunction of thresholds. It is grown on two thirds of the
labelled rows by information gain, pruned on the rest, and kept while it is
precise there; rows it covers leave, and the next rule is learned. The list is
emitted as one ordered Spark conditional expression.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.functions.scalar import quoted
from wardlens.llm.common import without
from wardlens.llm.labelled import labelled_rows
from wardlens.llm.stats import shares, with_stats
from wardlens.session import durable

SAMPLE = 20_000
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


@dataclass(frozen=True)
class Condition:
    """``feature >= threshold`` if ``above``, else ``feature <= threshold``."""

    feature: str
    above: bool
    threshold: float

    def holds(self, x: np.ndarray, names: Sequence[str]) -> np.ndarray:
        column = x[:, names.index(self.feature)]
        return column >= self.threshold if self.above else column <= self.threshold

    def column(self, features: dict[str, Column]) -> Column:
        value = features[self.feature]
        return value >= F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def covered(rule: Rule, x: np.ndarray, names: Sequence[str]) -> np.ndarray:
    held = np.ones(len(x), bool)
    for c in rule:
        held &= c.holds(x, names)
    return held


def _best_condition(x: np.ndarray, bad: np.ndarray, names: Sequence[str]) -> tuple[float, Condition | None]:
    """The threshold with the largest gain: bad rows kept times the rise of their log share."""
    total_bad, n = bad.sum(), len(bad)
    base, best = np.log2(total_bad / n), (0.0, None)
    for j, name in enumerate(names):
        order = np.argsort(x[:, j], kind="stable")
        value, hits = x[order, j], np.cumsum(bad[order])
        cut = np.flatnonzero(value[1:] > value[:-1])
        if not len(cut):
            continue
        middle = (value[cut] + value[cut + 1]) / 2
        for above in (False, True):
            p = (total_bad - hits[cut]) if above else hits[cut]
            c = (n - cut - 1) if above else cut + 1
            gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / c) - base), 0.0)
            k = int(np.argmax(gain))
            if gain[k] > best[0] + 1e-12:
                best = (float(gain[k]), Condition(name, above, float(middle[k])))
    return best


def grow(x: np.ndarray, bad: np.ndarray, names: Sequence[str], longest: int = 4) -> Rule:
    rule: list[Condition] = []
    held = np.ones(len(x), bool)
    while len(rule) < longest and bad[held].any() and not bad[held].all():
        _, condition = _best_condition(x[held], bad[held], names)
        if condition is None:
            break
        rule.append(condition)
        held &= condition.holds(x, names)
    return tuple(rule)


def prune(rule: Rule, x: np.ndarray, bad: np.ndarray, names: Sequence[str]) -> Rule:
    """Drop last conditions while (bad - good) / covered on the pruning rows does not fall."""
    def worth(r: Rule) -> float:
        held = covered(r, x, names)
        n = held.sum()
        return (2 * bad[held].sum() - n) / n if n else -1.0

    best = rule
    for length in range(len(rule) - 1, 0, -1):
        if worth(rule[:length]) >= worth(best):
            best = rule[:length]
    return best


def learn(x: np.ndarray, bad: np.ndarray, names: Sequence[str], *, precision: float = 0.9, support: int = 4,
          most: int = 20) -> list[Rule]:
    """Rules for bad rows in the order learned; every third row prunes."""
    rules: list[Rule] = []
    left = np.ones(len(x), bool)
    pruning = np.arange(len(x)) % 3 == 2
    while len(rules) < most:
        g, p = left & ~pruning, left & pruning
        if bad[g].sum() < support or not p.any():
            break
        rule = prune(grow(x[g], bad[g], names), x[p], bad[p], names)
        held = covered(rule, x, names)
        checked = held & p
        if not rule or bad[held & left].sum() < support or (bad[checked].sum() + 1) / (checked.sum() + 1) < precision \
                or bad[held & left].mean() < precision:
            break
        rules.append(rule)
        left &= ~held
    return rules


def expression(rules: Sequence[Rule], features: dict[str, Column]) -> Column:
    """Number of the first rule that holds, from 1; 0 if none does."""
    if not rules:
        return F.lit(0)
    listed = None
    for i, rule in enumerate(rules, 1):
        holds = F.lit(True)
        for c in rule:
            holds = holds & c.column(features)
        listed = F.when(holds, F.lit(i)) if listed is None else listed.when(holds, F.lit(i))
    return listed.otherwise(F.lit(0))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality", bound: int = SAMPLE,
        precision: float = 0.9) -> list[Rule]:
    """Learn on at most ``bound`` labelled rows that are not held out and pass the base rules.

    Label 0 is bad. Rows are ordered by key, so the same rows give the same list.
    """
    names = list(shares())
    rows = (labelled_rows(stats, labels, label, bound).where(~base_failed())
            .select("doc_id", *[f.alias(n) for n, f in shares().items()], "label")
            .limit(bound).toPandas().sort_values(["doc_id", *names, "label"]))
    return learn(rows[names].to_numpy(float), rows["label"].to_numpy(float) == 0, names, precision=precision)


def judge(docs: DataFrame, labels: DataFrame, *, text: str = "text", bound: int = SAMPLE,
          precision: float = 0.9) -> DataFrame:
    """The rows of ``docs`` with the counts of ``stats``, ``base_failed``, ``rule`` and ``kept``.

    ``rule`` is the number of the learned rule that rejects the row, 0 if none.
    Null and empty texts have counts of 0 and fail the base rules; very long
    texts are read whole. An empty table stays empty. Without enough bad labels
    the list is empty. Rows are judged one by one, so ties and
    repeated rows need no rule; columns of the result's names are replaced. The
    statistics of the labelled sample are computed first, then those of all
    rows in the pass that judges them.
    """
    sample = durable(with_stats(labelled_rows(docs, labels, "quality", bound).select("doc_id", quoted(text).alias("text")),
                                "text").drop("text"), "rule-sample")
    rules = fit(sample, labels, bound=bound, precision=precision)
    counted = with_stats(docs.select(*[quoted(c) for c in without(docs, "base_failed", "rule", "kept")]), text)
    return (counted.withColumn("base_failed", base_failed())
            .withColumn("rule", F.when(F.col("base_failed"), F.lit(0)).otherwise(expression(rules, shares())))
            .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)))
