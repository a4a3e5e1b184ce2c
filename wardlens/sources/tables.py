"""Stage tables, result summaries and trial tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.functions.scalar import quoted
from wardlens.sources.encounters import csv_reader

RESULTS_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()), T.StructField("auprc", T.DoubleType()),
    T.StructField("auroc", T.DoubleType()), T.StructField("f1", T.DoubleType())])


def write_stage(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace the stage table at ``path``; Parquet keeps types, CSV keeps a header."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.options(header=True, quote='"', escape='"').csv(path)
    else:
        writer.format(fmt).save(path)


def read_stage(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str = "parquet") -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return csv_reader(reader).csv(path) if fmt == "csv" else reader.format(fmt).load(path)


def write_results(results: DataFrame, path: str, digits: int = 4) -> None:
    """Metrics rounded for the report, as JSON lines."""
    (results.select("model", *[F.round(c, digits).alias(c) for c in ("auprc", "auroc", "f1")])
     .write.mode("overwrite").json(path))


def read_results_ranked(spark: SparkSession, path: str) -> DataFrame:
    """Result rows, best average precision first, with the rank spelled out.

    One row per model, so a plain sort is all the ranking needs.
    """
    return spark.read.schema(RESULTS_SCHEMA).json(path).orderBy(F.desc("auprc"), "model")


def write_trials(trials: DataFrame, path: str) -> None:
    """Trial table as headed CSV; parameter structs become ``params_*`` columns."""
    flat = []
    for field in trials.schema:
        if isinstance(field.dataType, T.StructType):
            flat += [quoted(field.name).getField(n).alias(f"params_{n}") for n in field.dataType.names]
        else:
            flat.append(quoted(field.name))
    trials.select(*flat).write.mode("overwrite").options(header=True, quote='"', escape='"').csv(path)
