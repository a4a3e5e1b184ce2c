"""Zero-mean, unit-variance scaling with the population deviation."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.functions.scalar import quoted, sql_name

_CONSTANT = 1e-12  # a deviation this small against the mean is rounding


@dataclass(frozen=True)
class StandardScaleModel:
    moments: dict[str, tuple[float, float]]

    def expression(self, column: str) -> str:
        mean, scale = self.moments[column]
        return f"(CAST({sql_name(column)} AS DOUBLE) - ({mean!r}D)) / {scale!r}D"

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.expr(self.expression(c)) for c in self.moments})

    def stage(self, suffix: str) -> SQLTransformer:
        """The same scaling as a stock pipeline stage that can be saved."""
        scaled = ", ".join(f"{self.expression(c)} AS {sql_name(c + suffix)}"
                           for c in self.moments)
        return SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__")


@dataclass(frozen=True)
class StandardScale:
    """Moments of all columns from one vector aggregation.

    A vector summary stays one small expression however many columns there
    are. Only columns that hold nulls, which it cannot skip, take a second
    pass. A constant column is only centred.
    """

    columns: Sequence[str]

    def fit(self, df: DataFrame) -> StandardScaleModel:
        vectors = VectorAssembler(inputCols=list(self.columns), outputCol="__x",
                                  handleInvalid="keep").transform(df)
        row = vectors.select(Summarizer.metrics("mean", "variance", "count")
                             .summary(F.col("__x")).alias("s")).first()["s"]
        n = row["count"]
        moments = {}
        for c, mean, variance in zip(self.columns, row["mean"] if n else (), row["variance"] if n else ()):
            moments[c] = (float(mean), math.sqrt(variance * (n - 1) / n) if n > 1 else 0.0)
        gaps = [c for c in self.columns if math.isnan(moments.get(c, (math.nan, 0.0))[0])]
        moments.update(self._skipping_nulls(df, gaps))
        return StandardScaleModel({c: (m, s if s > abs(m) * _CONSTANT else 1.0)
                                   for c, (m, s) in moments.items() if m is not None})

    @staticmethod
    def _skipping_nulls(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple]:
        if not columns:
            return {}
        aggs = []
        for i, c in enumerate(columns):
            x = quoted(c).cast("double")
            aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
        row = df.agg(*aggs).first()
        return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)}
