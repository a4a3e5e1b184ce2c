"""Checking SQL for the encounter stages, composed as a chain of CTEs."""

from __future__ import annotations

from bindings.encounters import COLUMNS, ENCOUNTERS_SQL
from wardlens.functions import codes

TEXT = ["race", "gender", "age", "weight", "payer_code", "medical_specialty", "diag_1", "diag_2",
        "diag_3", "A1Cresult", "max_glu_serum", "insulin", "metformin", "glipizide",
        "glyburide-metformin", "examide", "citoglipton", "change", "diabetesMed", "readmitted"]
DRUGS = ["insulin", "metformin", "glipizide", "glyburide-metformin"]
CHAPTERS = ["circulatory", "diabetes", "digestive", "external", "genitourinary", "injury",
            "musculoskeletal", "neoplasms", "other", "respiratory"]
# Categories that occur in the view, first one of each dropped by the encoder.
VOCABULARY = {
    "race": ["AfricanAmerican", "Asian", "Caucasian", "Hispanic", "Other"],
    "diag_1_cat": CHAPTERS,
    "diag_2_cat": ["circulatory", "diabetes", "digestive", "genitourinary", "injury",
                   "musculoskeletal", "other", "respiratory"],
    "diag_3_cat": ["circulatory", "digestive", "external", "genitourinary", "injury",
                   "musculoskeletal", "neoplasms", "other", "respiratory"],
}


def q(name: str) -> str:
    return f'"{name}"'


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def case_map(col: str, mapping: dict, default: str, kind: str) -> str:
    arms = " ".join(f"WHEN {q(col)} = {text(k)} THEN {v}" for k, v in mapping.items())
    return f"CAST(CASE {arms} ELSE {default} END AS {kind})"


def icd9_sql(col: str) -> str:
    code = f"upper(regexp_replace({q(col)}, '^\\s+|\\s+$', '', 'g'))"
    stem = f"split_part({code}, '.', 1)"
    number = (f"(CASE WHEN regexp_matches({stem}, '^[+-]?[0-9]+([eE][+-]?[0-9]+)?$') "
              f"THEN TRY_CAST({stem} AS DOUBLE) END)")
    arms = " ".join(f"WHEN {number} BETWEEN {lo} AND {hi} THEN '{name}'"
                    for name, (lo, hi) in codes.ICD9_RANGES.items())
    return (f"CASE WHEN {q(col)} IS NULL THEN 'other' "
            f"WHEN {code} LIKE 'V%' OR {code} LIKE 'E%' THEN 'external' {arms} ELSE 'other' END")


def _null_tokens() -> str:
    tokens = ", ".join(text(t) for t in codes.MISSING_TOKENS)
    cols = [f"CASE WHEN {q(c)} IN ({tokens}) THEN NULL ELSE {q(c)} END AS {q(c)}" if c in TEXT
            else q(c) for c in COLUMNS]
    return f"SELECT {', '.join(cols)} FROM raw"


AGE_SQL = case_map("age", codes.AGE_MIDPOINTS, "NULL", "DOUBLE")
GENDER_SQL = case_map("gender", codes.GENDER_CODES, "NULL", "DOUBLE")
FLAG_SQL = {c: case_map(c, codes.FLAG_CODES, "0", "TINYINT") for c in ("change", "diabetesMed")}
A1C_SQL = case_map("A1Cresult", codes.A1C_CODES, "0", "TINYINT")
GLUCOSE_SQL = case_map("max_glu_serum", codes.GLUCOSE_CODES, "0", "TINYINT")
DOSE_SQL = {c: case_map(c, codes.DOSE_CODES, "0", "TINYINT") for c in DRUGS}
TARGET_SQL = "CAST(CASE WHEN readmitted = '<30' THEN 1 ELSE 0 END AS TINYINT)"
PLAIN = ["time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications",
         "number_outpatient", "number_emergency", "number_inpatient", "num_diagnoses"]


def coded_select(order: str, source: str) -> str:
    cols = {"race": "race", "gender": GENDER_SQL, "age": AGE_SQL, **{c: c for c in PLAIN},
            "A1Cresult": A1C_SQL, "max_glu_serum": GLUCOSE_SQL, **DOSE_SQL, **FLAG_SQL,
            "readmitted_lt30": TARGET_SQL, order: f"CAST({order} AS BIGINT)",
            **{f"{c}_cat": icd9_sql(c) for c in codes.DIAGNOSIS_COLUMNS}}
    return "SELECT " + ", ".join(f"{e} AS {q(c)}" for c, e in cols.items()) + f" FROM {source}"


def half_even(expr: str) -> str:
    return f"round_even(({expr}) * 1000.0, 0) / 1000.0"


DAYS = "(CASE WHEN time_in_hospital < 1 THEN 1 ELSE time_in_hospital END)"
TOTAL_MEDS = " + ".join(f"coalesce(({q(c)} > 0)::INT, 0)" for c in DRUGS)
CHANGED_MEDS = " + ".join(f"coalesce(({q(c)} = 2)::INT, 0)" for c in DRUGS)
CATS = ["diag_1_cat", "diag_2_cat", "diag_3_cat"]
COMORBID = (f"len(list_filter(list_distinct([{', '.join(CATS)}]), lambda x: x <> 'other'))")
FEATURES = {
    "total_medications": f"CAST({TOTAL_MEDS} AS SMALLINT)",
    "num_changed_medications": f"CAST({CHANGED_MEDS} AS SMALLINT)",
    "insulin_dose_changed": "CAST(coalesce(insulin = 2, false) AS TINYINT)",
    "num_lab_procedures_per_day": half_even(f"num_lab_procedures::DOUBLE / {DAYS}"),
    "num_procedures_per_day": half_even(f"num_procedures::DOUBLE / {DAYS}"),
    "has_primary_diabetes_diag": "CAST(coalesce(diag_1_cat = 'diabetes', false) AS TINYINT)",
    "has_any_diabetes_diag": "CAST((" + " OR ".join(
        f"coalesce({c} = 'diabetes', false)" for c in CATS) + ") AS TINYINT)",
    "comorbidity_count": f"CAST({COMORBID} AS TINYINT)",
    "admission_complexity": half_even(
        f"0.0::DOUBLE + ({TOTAL_MEDS}) + num_lab_procedures * 0.1::DOUBLE + {COMORBID} * 2 + num_diagnoses"),
    "is_elderly": "CAST(coalesce(age >= 65, false) AS TINYINT)",
    "a1c_tested": "CAST(coalesce(\"A1Cresult\" > 0, false) AS TINYINT)",
    "glucose_tested": "CAST(coalesce(max_glu_serum > 0, false) AS TINYINT)",
    "age_x_num_medications": f"CAST(trunc(age * ({TOTAL_MEDS})) AS INTEGER)",
    "prior_admissions": "CAST(number_outpatient + number_inpatient + number_emergency AS SMALLINT)",
}
FEATURES_COMPAT = {k: v for k, v in FEATURES.items()
                   if k not in ("has_primary_diabetes_diag", "has_any_diabetes_diag", "comorbidity_count")}
FEATURES_COMPAT["admission_complexity"] = half_even(
    f"0.0::DOUBLE + ({TOTAL_MEDS}) + num_lab_procedures * 0.1::DOUBLE + num_diagnoses")


def dummies(columns=tuple(VOCABULARY)) -> str:
    return ", ".join(f"CAST(coalesce({q(c)} = {text(v)}, false) AS TINYINT) AS {q(c + '_' + v)}"
                     for c in columns for v in VOCABULARY[c][1:])


def feature_list(features: dict) -> str:
    return ", ".join(f"{e} AS {q(c)}" for c, e in features.items())


STAGES = {
    "raw": ENCOUNTERS_SQL,
    "enc": _null_tokens(),
    "firsts": "SELECT * FROM enc QUALIFY row_number() OVER (PARTITION BY patient_nbr ORDER BY encounter_id) = 1",
    "ordered": "SELECT *, row_number() OVER (ORDER BY encounter_id) AS encounter_order FROM firsts",
    "coded": coded_select("encounter_order", "ordered"),
    "medians": "SELECT median(age) AS m_age, median(gender) AS m_gender FROM coded",
    "filled": "SELECT coded.* REPLACE (coalesce(age, m_age) AS age, coalesce(gender, m_gender) AS gender) "
              "FROM coded, medians",
    "cleaned": f"SELECT * EXCLUDE ({', '.join(VOCABULARY)}), {dummies()} FROM filled",
    "features": f"SELECT *, {feature_list(FEATURES)} FROM filled",
    "featured": f"SELECT * EXCLUDE ({', '.join(VOCABULARY)}), {dummies()} FROM features",
    "split": "SELECT *, CASE WHEN encounter_order <= floor((SELECT count(*) FROM featured) * 0.8) "
             "THEN 'train' ELSE 'test' END AS split FROM featured",
}


def upto(stage: str, select: str) -> str:
    """``select`` after the CTEs of all stages up to ``stage``."""
    names = list(STAGES)
    chain = names[: names.index(stage) + 1]
    return "WITH " + ",\n".join(f"{n} AS ({STAGES[n]})" for n in chain) + "\n" + select
