"""The raw encounter table: explicit schema, CSV scan, missing-value tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import types as T

from wardlens.functions import codes
from wardlens.functions.scalar import null_if_missing

_LONGS = ("encounter_id", "patient_nbr")
_COUNTS = (
    "admission_type_id", "discharge_disposition_id", "admission_source_id",
    "time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications",
    "number_outpatient", "number_emergency", "number_inpatient",
    "number_diagnoses", "num_diagnoses",
)


def column_type(name: str) -> T.DataType:
    """Type of a raw column by name; everything unknown stays text."""
    if name in _LONGS:
        return T.LongType()
    return T.IntegerType() if name in _COUNTS else T.StringType()


def csv_reader(reader: DataFrameReader, multiline: bool = False) -> DataFrameReader:
    """Options that fail on a differing header or a row of the wrong width instead of shifting values.

    To see a row's width all its columns are parsed, also those not asked for.
    """
    return reader.options(header=True, quote='"', escape='"', enforceSchema=False, mode="FAILFAST",
                          columnPruning=False, multiLine=multiline)


def scan_encounters(spark: SparkSession, path: str, columns: list[str] | None = None,
                    multiline: bool = False) -> DataFrame:
    """Read headed CSV files; missing-value tokens become null, numbers are cast.

    A doubled quote inside a quoted value is one quote. Every file must have
    the header of the first, and every row its width, else the read fails.
    ``multiline`` takes quoted values with line breaks in them. It costs the
    splitting of files: each is then read by one task as a whole, so it is for
    tables of many files of moderate size; without it such a value fails the
    read rather than shift values.

    Types follow from the column names, so no inference pass is needed. Give
    ``columns`` to skip even the one-line read of the header.
    """
    names = columns or spark.read.options(header=True, quote='"', escape='"', multiLine=multiline).csv(path).columns
    text = T.StructType([T.StructField(c, T.StringType()) for c in names])
    raw = csv_reader(spark.read.schema(text), multiline).csv(path)
    return raw.select(*[null_if_missing(c).try_cast(column_type(c)).alias(c)
                        for c in names])


REQUIRED = ("encounter_id", "patient_nbr", "age", "gender", "A1Cresult", "max_glu_serum",
            "readmitted")
OPTIONAL = (*codes.CONSTANT_COLUMNS, *codes.SPARSE_COLUMNS, *codes.DIAGNOSIS_COLUMNS,
            "change", "diabetesMed", *codes.DRUG_COLUMNS)
