"""Derived clinical features: narrow expressions, no shuffle, no Python UDF."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.functions import codes
from wardlens.functions.scalar import (
    at_least, count_where, equals_flag, flag, quoted, round_half_even,
)

DIABETES = "diabetes"


def _day_count(df: DataFrame, stay: str) -> Column:
    return at_least(quoted(stay), 1) if stay in df.columns else F.lit(1)


def per_day(amount: Column, days: Column) -> Column:
    return round_half_even(amount / days, 3)


def total_medications(drugs: Sequence[str]) -> Column:
    return count_where(drugs, "> 0")


def changed_medications(drugs: Sequence[str]) -> Column:
    return count_where(drugs, "= 2")


def any_equal(columns: Sequence[str], value: str) -> Column:
    return flag(reduce(lambda a, b: a | b, [quoted(c).eqNullSafe(F.lit(value)) for c in columns]))


def distinct_categories(columns: Sequence[str], ignored: str = codes.ICD9_DEFAULT) -> Column:
    values = F.array_compact(F.array(*[quoted(c) for c in columns]))
    return F.size(F.array_except(values, F.array(F.lit(ignored)))).cast("tinyint")


def complexity(terms: Sequence[Column]) -> Column:
    """Sum of the terms in the given order, from 0.0, to three places."""
    return round_half_even(reduce(lambda a, b: a + b, terms, F.lit(0.0)), 3)


def medication_features(df: DataFrame) -> dict[str, Column]:
    drugs = [c for c in codes.DRUG_COLUMNS if c in df.columns]
    new = {"total_medications": total_medications(drugs),
           "num_changed_medications": changed_medications(drugs)}
    if "insulin" in drugs:
        new["insulin_dose_changed"] = equals_flag(quoted("insulin"), 2)
    return new


def intensity_features(df: DataFrame, stay: str = "time_in_hospital") -> dict[str, Column]:
    days = _day_count(df, stay)
    return {f"{c}_per_day": per_day(quoted(c), days)
            for c in ("num_lab_procedures", "num_procedures") if c in df.columns}


def diagnosis_features(df: DataFrame) -> dict[str, Column]:
    groups = [f"{c}_cat" for c in codes.DIAGNOSIS_COLUMNS if f"{c}_cat" in df.columns]
    new = {}
    if "diag_1_cat" in groups:
        new["has_primary_diabetes_diag"] = equals_flag(quoted("diag_1_cat"), DIABETES)
    if groups:
        new["has_any_diabetes_diag"] = any_equal(groups, DIABETES)
        new["comorbidity_count"] = distinct_categories(groups)
    return new


def complexity_feature(df: DataFrame, diagnoses: str = "num_diagnoses") -> dict[str, Column]:
    weights = {"total_medications": None, "num_lab_procedures": 0.1, "comorbidity_count": 2,
               diagnoses: None}
    terms = [quoted(c) if w is None else quoted(c) * w
             for c, w in weights.items() if c in df.columns]
    return {"admission_complexity": complexity(terms)}


def flag_features(df: DataFrame, elderly_from: float = 65) -> dict[str, Column]:
    tests = {"is_elderly": ("age", lambda c: c >= elderly_from),
             "a1c_tested": ("A1Cresult", lambda c: c > 0),
             "glucose_tested": ("max_glu_serum", lambda c: c > 0)}
    return {name: flag(test(quoted(c))) for name, (c, test) in tests.items() if c in df.columns}


def interaction_features(df: DataFrame) -> dict[str, Column]:
    new = {}
    if {"age", "total_medications"} <= set(df.columns):
        new["age_x_num_medications"] = (quoted("age") * quoted("total_medications")).cast("int")
    visits = ["number_outpatient", "number_inpatient"]
    if set(visits) <= set(df.columns):
        visits += [c for c in ["number_emergency"] if c in df.columns]
        total = reduce(lambda a, b: a + b, [quoted(c).cast("int") for c in visits])
        new["prior_admissions"] = total.cast("smallint")
    return new


def derive_features(df: DataFrame, diagnoses: str = "num_diagnoses") -> DataFrame:
    """All derived features; a feature whose inputs are absent is left out.

    Two projections: the second reads counts the first one made.
    """
    counted = df.withColumns({**medication_features(df), **intensity_features(df),
                              **diagnosis_features(df)})
    return counted.withColumns({**complexity_feature(counted, diagnoses), **flag_features(counted),
                                **interaction_features(counted)})
