"""Encounter-shaped view over the orders table.

The text runs unchanged in Spark and in the checking engine. On the Spark side
it only builds the input; the operators under test are DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardlens.operators.encode import null_tokens
from wardlens.session import tune

ENCOUNTERS_SQL = """
SELECT
  o_orderkey AS encounter_id,
  o_custkey AS patient_nbr,
  CASE WHEN o_custkey % 7 = 0 THEN 'AfricanAmerican' WHEN o_custkey % 7 = 1 THEN 'Asian'
       WHEN o_custkey % 7 IN (2, 3) THEN 'Caucasian' WHEN o_custkey % 7 = 4 THEN 'Hispanic'
       WHEN o_custkey % 7 = 5 THEN 'Other' ELSE '?' END AS race,
  CASE WHEN o_custkey % 23 = 0 THEN 'Unknown/Invalid' WHEN o_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  CASE WHEN (o_custkey * 3 + 1) % 11 = 10 THEN '?'
       ELSE '[' || CAST(10 * ((o_custkey * 3 + 1) % 11) AS STRING) || '-'
                || CAST(10 * ((o_custkey * 3 + 1) % 11) + 10 AS STRING) || ')' END AS age,
  '?' AS weight, '?' AS payer_code, o_orderpriority AS medical_specialty,
  CAST(o_orderkey % 15 AS INT) AS time_in_hospital,
  CAST(1 + (o_orderkey * 17) % 120 AS INT) AS num_lab_procedures,
  CAST(o_orderkey % 7 AS INT) AS num_procedures,
  CAST(1 + (o_orderkey * 5) % 40 AS INT) AS num_medications,
  CAST((o_orderkey * 3) % 4 AS INT) AS number_outpatient,
  CAST(o_orderkey % 3 AS INT) AS number_emergency,
  CAST((o_orderkey * 7) % 5 AS INT) AS number_inpatient,
  CAST(1 + o_orderkey % 9 AS INT) AS num_diagnoses,
  CASE WHEN o_orderkey % 10 = 0 THEN '250.83' WHEN o_orderkey % 10 = 1 THEN '428'
       WHEN o_orderkey % 10 = 2 THEN 'V57' WHEN o_orderkey % 10 = 3 THEN 'e909'
       WHEN o_orderkey % 10 = 4 THEN '?' WHEN o_orderkey % 10 = 5 THEN '.5'
       WHEN o_orderkey % 10 = 6 THEN CAST(380 + o_orderkey % 600 AS STRING)
       WHEN o_orderkey % 10 = 7 THEN CAST(140 + o_orderkey % 110 AS STRING) || '.1'
       WHEN o_orderkey % 10 = 8 THEN '400D' ELSE CAST(700 + o_orderkey % 300 AS STRING) END AS diag_1,
  CASE WHEN (o_orderkey * 3 + o_custkey) % 10 < 3 THEN '250'
       WHEN (o_orderkey * 3 + o_custkey) % 10 = 3 THEN '?'
       ELSE CAST(380 + (o_orderkey * 3 + o_custkey) % 620 AS STRING) END AS diag_2,
  CASE WHEN (o_orderkey + o_custkey * 7) % 10 < 2 THEN '?'
       WHEN (o_orderkey + o_custkey * 7) % 10 = 2 THEN 'V10'
       ELSE CAST(100 + (o_orderkey + o_custkey * 7) % 900 AS STRING) END AS diag_3,
  CASE WHEN o_orderkey % 5 = 0 THEN 'None' WHEN o_orderkey % 5 = 1 THEN 'Norm'
       WHEN o_orderkey % 5 = 2 THEN '>7' WHEN o_orderkey % 5 = 3 THEN '>8' ELSE '?' END AS `A1Cresult`,
  CASE WHEN o_custkey % 5 = 0 THEN 'None' WHEN o_custkey % 5 = 1 THEN 'Norm'
       WHEN o_custkey % 5 = 2 THEN '>200' WHEN o_custkey % 5 = 3 THEN '>300' ELSE '?' END AS max_glu_serum,
  CASE WHEN (o_orderkey + o_custkey) % 9 = 0 THEN 'Up' WHEN (o_orderkey + o_custkey) % 9 = 1 THEN 'Down'
       WHEN (o_orderkey + o_custkey) % 9 < 5 THEN 'Steady' ELSE 'No' END AS insulin,
  CASE WHEN (o_orderkey * 2 + o_custkey) % 9 = 0 THEN 'Up' WHEN (o_orderkey * 2 + o_custkey) % 9 < 3 THEN 'Steady'
       WHEN (o_orderkey * 2 + o_custkey) % 9 = 3 THEN '?' ELSE 'No' END AS metformin,
  CASE WHEN (o_orderkey * 4 + o_custkey) % 13 = 0 THEN 'Down' WHEN (o_orderkey * 4 + o_custkey) % 13 < 4 THEN 'Steady'
       ELSE 'No' END AS glipizide,
  CASE WHEN (o_orderkey * 5 + o_custkey) % 17 = 0 THEN 'Steady' ELSE 'No' END AS `glyburide-metformin`,
  'No' AS examide, 'No' AS citoglipton,
  CASE WHEN o_orderkey % 2 = 0 THEN 'Ch' ELSE 'No' END AS `change`,
  CASE WHEN o_orderkey % 4 = 0 THEN 'No' ELSE 'Yes' END AS `diabetesMed`,
  CASE WHEN o_orderkey % 13 = 0 OR ((o_orderkey * 7) % 5 >= 3 AND o_orderstatus = 'F') THEN '<30'
       WHEN o_orderstatus = 'O' THEN '>30' ELSE 'NO' END AS readmitted
FROM orders
"""

COLUMNS = [
    "encounter_id", "patient_nbr", "race", "gender", "age", "weight", "payer_code",
    "medical_specialty", "time_in_hospital", "num_lab_procedures", "num_procedures",
    "num_medications", "number_outpatient", "number_emergency", "number_inpatient",
    "num_diagnoses", "diag_1", "diag_2", "diag_3", "A1Cresult", "max_glu_serum", "insulin",
    "metformin", "glipizide", "glyburide-metformin", "examide", "citoglipton", "change",
    "diabetesMed", "readmitted",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encounters as a raw file would hold them, sentinels included."""
    return spark.sql(ENCOUNTERS_SQL.replace("FROM orders", "FROM {orders}"),
                     orders=table(spark, sf_dir, "orders"))


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encounters after missing-value tokens became nulls."""
    return null_tokens(raw_encounters(tune(spark), sf_dir))
