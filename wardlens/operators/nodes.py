"""Tree ensembles as a table of nodes: rows are routed, and attributed, by joins with it.

An independent reading of a fitted ensemble, in DataFrame operations alone. It
serves to check what was fitted and to hand trees to other engines; scoring at
scale goes through the model itself.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.session import durable, scratch_path


def node_table(model: GBTClassificationModel) -> DataFrame:
    """``tree, node, feature, threshold, left, right, value, cover, weight``; leaves have -1 for children.

    Read from the model's saved form, so it is a table from the start; only
    the weights, one per tree, come from the driver.
    """
    spark = SparkSession.active()
    path = scratch_path(spark, "nodes")
    model.write().save(path)
    node = F.col("nodeData")
    weights = spark.createDataFrame(list(enumerate(map(float, model.treeWeights))), "of int, weight double")
    rows = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").cast("int").alias("tree"), node["id"].alias("node"), node["split"]["featureIndex"].alias("feature"),
        F.try_element_at(node["split"]["leftCategoriesOrThreshold"], F.lit(1)).alias("threshold"),
        node["leftChild"].alias("left"), node["rightChild"].alias("right"), node["prediction"].alias("value"),
        node["impurityStats"][0].alias("cover"))
    return durable(rows.join(weights, F.col("tree") == F.col("of")).drop("of"), "node-table")


def _depth(nodes: DataFrame) -> int:
    """Levels below the roots; nodes are numbered parent first, so the walk down needs no recursion."""
    level, depth = nodes.where("node = 0").select("tree", "left", "right"), 0
    while not (inner := level.where("left >= 0")).isEmpty():
        below = inner.select("tree", F.explode(F.array("left", "right")).alias("at"))
        level = durable(below.join(nodes.withColumnRenamed("tree", "of"), (F.col("tree") == F.col("of")) & (F.col("at") == F.col("node")))
                        .select("tree", "left", "right"), "level")
        depth += 1
    return depth


def leaves_of(rows: DataFrame, nodes: DataFrame, features: str = "features") -> DataFrame:
    """``id, tree, node, value, weight``: the leaf of every tree that a row of ``id, features`` (an array) falls into."""
    at = rows.select("id", features, F.lit(0).alias("at")).join(nodes, F.col("at") == F.col("node"))
    for _ in range(_depth(nodes)):
        goes = F.when(F.col("left") < 0, F.col("node")).when(
            F.col(features)[F.col("feature")] <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        step = at.select("id", features, F.col("tree").alias("of"), goes.alias("at"))
        at = step.join(nodes, (F.col("of") == F.col("tree")) & (F.col("at") == F.col("node")))
    return at.select("id", "tree", "node", "value", "weight")


def margins(rows: DataFrame, nodes: DataFrame, features: str = "features") -> DataFrame:
    """``id, margin``: the weighted sum of a row's leaves."""
    return leaves_of(rows, nodes, features).groupBy("id").agg(F.sum(F.col("weight") * F.col("value")).alias("margin"))


def leaf_slots(nodes: DataFrame) -> DataFrame:
    """``tree, leaf, value, weight, feature, low, high, share``: what a leaf asks of each feature on its path.

    A row follows where ``low < x <= high``; ``share`` is the part of the cover
    that follows where the feature is unknown.
    """
    own = nodes.select(F.col("tree").alias("of"), F.col("node").alias("at"), F.col("left").alias("l"), F.col("right").alias("r"),
                       F.col("feature").alias("f"), F.col("threshold").alias("t"), F.col("value").alias("v"),
                       F.col("cover").alias("c"), F.col("weight").alias("w"))
    kind = "array<struct<feature:int,low:double,high:double,share:double>>"
    at = own.where("at = 0").withColumn("path", F.array().cast(kind))
    done = []
    for _ in range(_depth(nodes) + 1):
        done.append(at.where("l < 0").select("of", "at", "v", "w", "path"))
        step = at.where("l >= 0").select(
            F.col("of").alias("tree"), F.col("f").alias("feature"), F.col("t").alias("cut"), F.col("c").alias("cover"), "path",
            F.explode(F.array(F.struct(F.col("l").alias("child"), F.lit(True).alias("is_left")),
                              F.struct(F.col("r").alias("child"), F.lit(False).alias("is_left")))).alias("go"))
        met = step.join(own, (F.col("tree") == F.col("of")) & (F.col("go.child") == F.col("at")))
        slot = F.struct(F.col("feature").cast("int").alias("feature"), F.when(~F.col("go.is_left"), F.col("cut")).otherwise(float("-inf")).alias("low"),
                        F.when(F.col("go.is_left"), F.col("cut")).otherwise(float("inf")).alias("high"),
                        (F.col("c") / F.col("cover")).alias("share"))
        at = durable(met.select(*own.columns, F.concat("path", F.array(slot)).cast(kind).alias("path")), "paths")
    leaves = done[0]
    for part in done[1:]:
        leaves = leaves.unionByName(part)
    steps = leaves.select(F.col("of").alias("tree"), F.col("at").alias("leaf"), F.col("v").alias("value"),
                          F.col("w").alias("weight"), F.explode("path").alias("s"))
    return steps.groupBy("tree", "leaf", "value", "weight", F.col("s.feature").alias("feature")).agg(
        F.max("s.low").alias("low"), F.min("s.high").alias("high"), F.product("s.share").alias("share"))


_PHI = """transform(slots, (s, i) -> struct(s.feature AS feature, 2 * weight * value * (s.o - s.z) * aggregate(
  sequence(0, shiftleft(1, size(slots)) - 1), 0D, (total, m) -> total + IF(shiftright(m, i) & 1 = 1, 0D,
    factorial(bit_count(m)) * factorial(size(slots) - bit_count(m) - 1) / factorial(size(slots))
    * aggregate(transform(slots, (t, j) -> IF(j = i, 1D, IF(shiftright(m, j) & 1 = 1, t.o, t.z))), 1D, (p, x) -> p * x))) AS phi))"""


def coalition_shapley(rows: DataFrame, nodes: DataFrame, features: str = "features") -> DataFrame:
    """``id, feature, phi``: log-odds Shapley values, summed over all coalitions of the features on a leaf's path.

    Exact by definition and exponential in a path's features: for ensembles of
    shallow trees. Features that no path of a row's trees holds have no row.
    """
    slots = leaf_slots(nodes)
    x = rows.select("id", F.posexplode(features).alias("at", "x"))
    follows = ((F.col("x") > F.col("low")) & (F.col("x") <= F.col("high"))).cast("double")
    met = (x.join(slots, F.col("at") == F.col("feature"))
           .groupBy("id", "tree", "leaf", "value", "weight")
           .agg(F.collect_list(F.struct("feature", follows.alias("o"), F.col("share").alias("z"))).alias("slots")))
    return (met.select("id", F.explode(F.expr(_PHI)).alias("p"))
            .groupBy("id", F.col("p.feature").alias("feature")).agg(F.sum("p.phi").alias("phi")))
