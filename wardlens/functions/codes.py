"""Fixed values of the encounter domain (names, codes and code ranges)."""

from __future__ import annotations

# --- fixed values: these must stay as they are for results to agree -------

# Text tokens read as missing: the sentinel plus the usual CSV missing markers.
MISSING_TOKENS = (
    "?", "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Ten-year age brackets and their midpoints: [0-10) -> 5 ... [90-100) -> 95.
AGE_MIDPOINTS = {f"[{lo}-{lo + 10})": lo + 5 for lo in range(0, 100, 10)}

GENDER_CODES = {"Female": 1, "Male": 0}
FLAG_CODES = {"Yes": 1, "Ch": 1, "No": 0}
A1C_CODES = {"None": 0, "Norm": 1, ">7": 2, ">8": 3}
GLUCOSE_CODES = {"None": 0, "Norm": 1, ">200": 2, ">300": 3}
DOSE_CODES = {"No": 0, "Steady": 1, "Up": 2, "Down": 2}

DRUG_COLUMNS = (
    "metformin", "repaglinide", "nateglinide", "chlorpropamide", "glimepiride",
    "acetohexamide", "glipizide", "glyburide", "tolbutamide", "pioglitazone",
    "rosiglitazone", "acarbose", "miglitol", "troglitazone", "tolazamide",
    "insulin", "glyburide-metformin", "glipizide-metformin",
    "glimepiride-pioglitazone", "metformin-rosiglitazone",
    "metformin-pioglitazone",
)

# Closed ICD-9 chapter ranges on the integer part of a code.
ICD9_RANGES = {
    "neoplasms": (140, 239),
    "diabetes": (250, 250),
    "circulatory": (390, 459),
    "respiratory": (460, 519),
    "digestive": (520, 579),
    "genitourinary": (580, 629),
    "musculoskeletal": (710, 739),
    "injury": (800, 999),
}
ICD9_SUPPLEMENT = "external"
ICD9_DEFAULT = "other"

ID_COLUMNS = ("encounter_id", "patient_nbr")
CONSTANT_COLUMNS = ("examide", "citoglipton")
SPARSE_COLUMNS = ("weight", "payer_code", "medical_specialty")
DIAGNOSIS_COLUMNS = ("diag_1", "diag_2", "diag_3")

EARLY_READMISSION = "<30"
TARGET = "readmitted_lt30"
ORDER = "encounter_order"

# --- end of fixed values ---------------------------------------------------

DROPPED_COLUMNS = ID_COLUMNS + CONSTANT_COLUMNS + SPARSE_COLUMNS
