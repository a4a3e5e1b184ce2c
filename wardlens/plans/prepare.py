"""Raw encounters to a model-ready table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from wardlens.functions import codes
from wardlens.operators import encode
from wardlens.operators.dedup import first_per_key
from wardlens.operators.features import derive_features
from wardlens.operators.impute import MedianImputer, MedianImputerModel
from wardlens.operators.order import ordered_index
from wardlens.operators.split import TRAIN, temporal_halves
from wardlens.session import concurrently
from wardlens.sources.contract import require
from wardlens.sources.encounters import REQUIRED, scan_encounters
from wardlens.sources.tables import write_stage

FULL, COMPAT = "full", "compat"
ALL_ROWS = "all"


def code_values(raw: DataFrame) -> DataFrame:
    """Target and code maps; ids stay for the dedup, diagnosis codes stay as text."""
    unused = [c for c in codes.DROPPED_COLUMNS if c not in codes.ID_COLUMNS]
    return raw.drop(*unused).transform(encode.binary_target).transform(encode.encode)


def code_columns(raw: DataFrame) -> DataFrame:
    """All row-wise encodings."""
    return raw.transform(code_values).transform(encode.categorise_diagnoses)


def first_encounters(raw: DataFrame, slices: int | None = None) -> DataFrame:
    """Coded first encounter of each patient with its dense ``encounter_order``.

    Code maps run before the shuffle, so tiny integers travel instead of text.
    An id that repeats within a patient is settled by the other columns.
    Diagnosis codes are shorter than their group names and slow to parse, so
    they are grouped after it, on the surviving rows only. The ordered write is
    the table every later fit pass reads.
    """
    require(raw, REQUIRED)
    coded = code_values(raw)
    ties = sorted(c for c in coded.columns if c not in ("patient_nbr", "encounter_id"))
    kept = first_per_key(coded, ["patient_nbr"], ["encounter_id", *ties])
    kept = encode.categorise_diagnoses(kept.drop("patient_nbr"))
    return ordered_index(kept, ["encounter_id"], codes.ORDER, slices).drop("encounter_id")


@dataclass(frozen=True)
class PreparedModel:
    """What was learned from the data: medians and category vocabulary."""

    mode: str
    diagnoses: str
    medians: MedianImputerModel
    onehot: encode.OneHotModel

    def clean(self, first: DataFrame) -> DataFrame:
        return self.medians.transform(self.onehot.transform(first))

    def featured(self, first: DataFrame) -> DataFrame:
        """``full``: features see the diagnosis groups, then text turns one-hot.

        ``compat``: text is one-hot first, so features that read diagnosis
        groups find none and are left out.
        """
        if self.mode == COMPAT:
            return derive_features(self.clean(first), self.diagnoses)
        filled = self.medians.transform(first)
        return self.onehot.transform(derive_features(filled, self.diagnoses))


@dataclass(frozen=True)
class Prepare:
    """Fit medians and vocabulary on ``first_encounters`` output.

    Fit on all rows to reproduce whole-table statistics, or on the training
    rows only to keep the holdout out of them.
    """

    mode: str = FULL
    diagnoses: str = "num_diagnoses"
    onehot: encode.OneHot = encode.OneHot()

    def fit(self, first: DataFrame) -> PreparedModel:
        medians, onehot = concurrently(first.sparkSession, [
            lambda: MedianImputer().fit(first), lambda: self.onehot.fit(first)])
        return PreparedModel(self.mode, self.diagnoses, medians, onehot)


def run_preprocess(spark: SparkSession, source: str, target: str) -> DataFrame:
    """CSV in, cleaned stage out."""
    first = first_encounters(require(scan_encounters(spark, source), REQUIRED, nonempty=True))
    write_stage(Prepare().fit(first).clean(first), target)
    return spark.read.parquet(target)


def run_features(spark: SparkSession, source: str, target: str,
                 diagnoses: str = "num_diagnoses") -> DataFrame:
    """Cleaned stage in, featured stage out; one narrow pass."""
    cleaned = require(spark.read.parquet(source), [codes.TARGET, codes.ORDER])
    write_stage(derive_features(cleaned, diagnoses), target)
    return spark.read.parquet(target)


def run_prepare(spark: SparkSession, source: str, target: str, mode: str = FULL,
                diagnoses: str = "num_diagnoses", fit_on: str = ALL_ROWS) -> DataFrame:
    """CSV in, featured stage out, in either mode.

    Medians and vocabulary come from all rows, or with ``fit_on="train"`` from
    the rows before the chronological cut only, so the test rows stay unseen.
    """
    first = first_encounters(require(scan_encounters(spark, source), REQUIRED, nonempty=True))
    learnt = temporal_halves(first, [codes.ORDER], dense=True)[0] if fit_on == TRAIN else first
    write_stage(Prepare(mode, diagnoses).fit(learnt).featured(first), target)
    return spark.read.parquet(target)
