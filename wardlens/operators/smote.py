"""Synthetic minority oversampling as joins over hashed picks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.functions.scalar import quoted, sql_name
from wardlens.operators.neighbours import nearest_neighbours
from wardlens.operators.order import ordered_index
from wardlens.operators.search import hashed_unit


def class_sizes(df: DataFrame, label: str) -> dict:
    """Rows per class of a two-class label."""
    rows = (df.groupBy(quoted(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
            .limit(3).collect())
    if len(rows) != 2:
        raise ValueError(f"{label!r} must have exactly two classes")
    return {r["label"]: r["n"] for r in rows}


def minority_points(df: DataFrame, label: str, key: str, names: Sequence[str], minority) -> DataFrame:
    vec = F.expr(f"array({', '.join(f'CAST({sql_name(n)} AS DOUBLE)' for n in names)})")
    return df.where(quoted(label) == F.lit(minority)).select(quoted(key).alias("id"), vec.alias("vec"))


def smote_oversample(df: DataFrame, names: Sequence[str], label: str, key: str, k: int = 5,
                     seed: int = 42) -> DataFrame:
    """Real rows and, until the classes balance, points between minority rows.

    Synthetic row s takes a minority row, one of its k neighbours and a step in
    [0, 1), all hashed from (seed, s): the outcome does not depend on how the
    data is partitioned. ``synthetic`` tells the rows apart; their key is null.
    """
    sizes = class_sizes(df, label)
    minority = min(sizes, key=lambda c: (sizes[c], c))
    few, many = sizes[minority], max(sizes.values())
    real = df.selectExpr(sql_name(key), sql_name(label),
                         *[f"CAST({sql_name(n)} AS DOUBLE) AS {sql_name(n)}" for n in names],
                         "false AS synthetic")
    if many == few:
        return real
    if few <= k:
        raise ValueError(f"{few} minority rows cannot each have {k} neighbours")

    base = ordered_index(minority_points(df, label, key, names, minority), ["id"], "nth")
    pairs = (nearest_neighbours(base.select("id", "vec"), k)
             .join(base, "id").select("nth", "rank", "vec", "neighbour_vec"))

    def pick(what: str, count: int):
        return F.floor(hashed_unit(seed, F.col("s"), F.lit(what)) * count) + 1

    wanted = df.sparkSession.range(many - few).toDF("s").select(
        pick("base", few).alias("nth"), pick("neighbour", k).cast("int").alias("rank"),
        hashed_unit(seed, F.col("s"), F.lit("step")).alias("u"))
    made = wanted.join(pairs, ["nth", "rank"]).select(
        F.zip_with("vec", "neighbour_vec", lambda a, b: a + F.col("u") * (b - a)).alias("x"))
    typed = made.select("x", F.lit(None).cast(df.schema[key].dataType).alias("k"),
                        F.lit(minority).cast(df.schema[label].dataType).alias("y"))
    synthetic = typed.selectExpr(f"k AS {sql_name(key)}", f"y AS {sql_name(label)}",
                                 *[f"x[{i}] AS {sql_name(n)}" for i, n in enumerate(names)],
                                 "true AS synthetic")
    return real.unionByName(synthetic)
