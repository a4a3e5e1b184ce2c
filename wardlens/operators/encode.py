"""Code maps for encounter columns and drop-first one-hot encoding."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.functions import codes
from wardlens.functions.scalar import (
    code_number, equals_flag, icd9_category, is_supplement_code, map_codes, null_if_missing,
    quoted, sql_name, sql_text,
)
from wardlens.operators.order import ordered_index
from wardlens.session import durable


def null_tokens(df: DataFrame, tokens: Sequence[str] = codes.MISSING_TOKENS) -> DataFrame:
    """Turn missing-value tokens into nulls in every text column."""
    return df.select(*[null_if_missing(f.name, tokens).alias(f.name)
                       if isinstance(f.dataType, T.StringType) else quoted(f.name)
                       for f in df.schema])


def _lookups(df: DataFrame, columns: Sequence[str], mapping: dict, default=None,
             dtype: str = "double") -> dict[str, Column]:
    have = set(df.columns)
    return {c: map_codes(c, mapping, default, dtype) for c in columns if c in have}


def age_midpoint(df: DataFrame) -> dict[str, Column]:
    return _lookups(df, ["age"], codes.AGE_MIDPOINTS)


def gender_code(df: DataFrame) -> dict[str, Column]:
    return _lookups(df, ["gender"], codes.GENDER_CODES)


def flag_codes(df: DataFrame) -> dict[str, Column]:
    return _lookups(df, ["change", "diabetesMed"], codes.FLAG_CODES, 0, "tinyint")


def a1c_code(df: DataFrame) -> dict[str, Column]:
    return _lookups(df, ["A1Cresult"], codes.A1C_CODES, 0, "tinyint")


def glucose_code(df: DataFrame) -> dict[str, Column]:
    return _lookups(df, ["max_glu_serum"], codes.GLUCOSE_CODES, 0, "tinyint")


def dose_codes(df: DataFrame, drugs: Sequence[str] = codes.DRUG_COLUMNS) -> dict[str, Column]:
    return _lookups(df, drugs, codes.DOSE_CODES, 0, "tinyint")


ENCODERS = (age_midpoint, gender_code, flag_codes, a1c_code, glucose_code, dose_codes)


def encode(df: DataFrame, *encoders) -> DataFrame:
    """Replace coded columns in one projection; absent columns are skipped."""
    return df.withColumns({c: e for enc in encoders or ENCODERS for c, e in enc(df).items()})


def categorise_diagnoses(df: DataFrame, columns: Sequence[str] = codes.DIAGNOSIS_COLUMNS,
                         drop_source: bool = True) -> DataFrame:
    """Add ``<col>_cat`` for each diagnosis column present.

    Each code is parsed once, in a projection of its own.
    """
    present = [c for c in columns if c in df.columns]
    parsed = df.withColumns({f"__{k}_{c}": read(quoted(c)) for c in present
                             for k, read in (("v", is_supplement_code), ("n", code_number))})
    out = parsed.withColumns({f"{c}_cat": icd9_category(quoted(f"__v_{c}"), f"__n_{c}")
                              for c in present})
    helpers = [f"__{k}_{c}" for c in present for k in "vn"]
    return out.drop(*helpers, *(present if drop_source else ()))


def binary_target(df: DataFrame, source: str = "readmitted", positive: str = codes.EARLY_READMISSION,
                  name: str = codes.TARGET) -> DataFrame:
    """0/1 target: 1 where the source equals ``positive``; null counts as 0."""
    return df.withColumn(name, equals_flag(quoted(source), positive)).drop(source)


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


@dataclass(frozen=True)
class OneHotModel:
    """Fitted vocabulary: the output schema no longer depends on the data."""

    vocabulary: dict[str, list[str]]
    drop_first: bool = True

    def kept(self, column: str) -> list[str]:
        return self.vocabulary[column][1 if self.drop_first else 0:]

    def transform(self, df: DataFrame) -> DataFrame:
        """0/1 columns ``<col>_<category>`` after all other columns; null is all zeros."""
        rest = [sql_name(c) for c in df.columns if c not in self.vocabulary]
        dummies = [f"CAST({sql_name(c)} <=> {sql_text(v)} AS TINYINT) AS {sql_name(f'{c}_{v}')}"
                   for c in self.vocabulary for v in self.kept(c)]
        return df.selectExpr(*rest, *dummies)


@dataclass(frozen=True)
class OneHot:
    """Drop-first one-hot encoder; categories sort by code point.

    ``fit`` finds the distinct (column, value) pairs in one aggregation that
    combines on the map side, so any cardinality is safe on the executors. Each
    category becomes a column. ``max_categories`` is for callers who want an
    error past a number of their own; the vocabulary is never trimmed.
    """

    columns: Sequence[str] | None = None
    drop_first: bool = True
    max_categories: int | None = None

    def fit(self, df: DataFrame) -> OneHotModel:
        columns = list(self.columns) if self.columns is not None else text_columns(df)
        if not columns:
            return OneHotModel({}, self.drop_first)
        pairs = (df.unpivot([], [quoted(c).cast("string").alias(c) for c in columns],
                            "column", "value")
                 .where(F.col("value").isNotNull()).distinct())
        found = pairs.collect() if self.max_categories is None else pairs.limit(self.max_categories + 1).collect()
        vocabulary: dict[str, list[str]] = {c: [] for c in columns}
        for row in found:
            vocabulary[row["column"]].append(row["value"])
        if self.max_categories is not None and len(found) > self.max_categories:
            widest = max(columns, key=lambda c: len(vocabulary[c]))
            raise ValueError(f"more than {self.max_categories} categories to encode, "
                             f"most of them in {widest!r}")
        return OneHotModel({c: sorted(vs) for c, vs in vocabulary.items()}, self.drop_first)


@dataclass(frozen=True)
class SparseOneHotModel:
    """Vocabulary as a written table: ``column, value, place``, places counted within a column from 0."""

    vocabulary: DataFrame
    sizes: dict[str, int]  # categories of each column, dropped one included
    drop_first: bool = True

    @property
    def width(self) -> int:
        return sum(self._kept(c) for c in self.sizes)

    def _kept(self, column: str) -> int:
        return max(0, self.sizes[column] - (1 if self.drop_first else 0))

    def indices(self, df: DataFrame, name: str = "indices") -> DataFrame:
        """Replace the encoded columns by the ascending places of a row's ones; null and unseen values have none.

        One join per column with its part of the vocabulary, by value: small
        parts are broadcast by Spark's own size check, large ones shuffle.
        """
        out, first, places = df, 0, []
        for i, c in enumerate(self.sizes):
            part = (self.vocabulary.where(F.col("column") == c)
                    .select(F.col("value").alias(f"__value_{i}"), F.col("place").alias(f"__place_{i}")))
            out = out.join(part, quoted(c).cast("string") == F.col(f"__value_{i}"), "left")
            at = F.col(f"__place_{i}") - (1 if self.drop_first else 0)
            places.append(F.when(at >= 0, at + first))
            first += self._kept(c)
        rest = [quoted(c) for c in df.columns if c not in self.sizes and c != name]
        return out.select(*rest, F.array_compact(F.array(*places)).cast("array<int>").alias(name))

    def transform(self, df: DataFrame, name: str = "features") -> DataFrame:
        """Replace the encoded columns by a sparse vector, built by Spark's own encoder and assembler."""
        out, slots = df, []
        for i, c in enumerate(self.sizes):
            part = (self.vocabulary.where(F.col("column") == c)
                    .select(F.col("value").alias(f"__value_{i}"), F.col("place").alias(f"__place_{i}")))
            out = out.join(part, quoted(c).cast("string") == F.col(f"__value_{i}"), "left")
            at = F.col(f"__place_{i}") - (1 if self.drop_first else 0)
            # The last slot, which the encoder drops, stands for none.
            out = out.withColumn(f"__slot_{i}", F.when(at >= 0, at).otherwise(self._kept(c)).cast("double"))
            slots.append(f"__slot_{i}")
        rest = [quoted(c) for c in df.columns if c not in self.sizes and c != name]
        vectors = [f"{s}_vector" for s in slots]
        row = df.sparkSession.createDataFrame([tuple(float(self._kept(c)) for c in self.sizes)], slots)
        encoder = OneHotEncoder(inputCols=slots, outputCols=vectors, dropLast=True).fit(row)
        return VectorAssembler(inputCols=vectors, outputCol=name).transform(encoder.transform(out)).select(*rest, quoted(name))


@dataclass(frozen=True)
class SparseOneHot:
    """Drop-first one-hot encoding for vocabularies of any size: nothing of them reaches the driver but their sizes.

    Categories sort by code point, as in ``OneHot``, so both give the same
    columns in the same order.
    """

    columns: Sequence[str]
    drop_first: bool = True

    def fit(self, df: DataFrame) -> SparseOneHotModel:
        pairs = (df.unpivot([], [quoted(c).cast("string").alias(c) for c in self.columns], "column", "value")
                 .where(F.col("value").isNotNull()).distinct())
        placed = durable(ordered_index(pairs, ["column", "value"], "nth"), "vocabulary")
        starts = {r["column"]: (r["first"], r["n"]) for r in placed.groupBy("column").agg(
            F.min("nth").alias("first"), F.count(F.lit(1)).alias("n")).collect()}  # one row per encoded column
        sizes = {c: starts.get(c, (0, 0))[1] for c in self.columns}
        first = F.create_map(*[x for c, (at, _) in starts.items() for x in (F.lit(c), F.lit(at))]) if starts else None
        place = F.col("nth") - first[F.col("column")] if starts else F.lit(0)
        return SparseOneHotModel(placed.select("column", "value", place.cast("long").alias("place")), sizes, self.drop_first)
