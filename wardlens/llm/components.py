"""Connected components of a table of undirected edges."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.session import durable


class Forest:
    """Union-find over hashable keys; the least key of a set is its root."""

    def __init__(self):
        self._parent: dict = {}

    def find(self, x):
        parent = self._parent
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent.get(x, x)
        return root

    def union(self, a, b) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self._parent[max(a, b)] = min(a, b)

    def links(self) -> list[tuple]:
        """Every key that is not a root, with its root."""
        return [(k, self.find(k)) for k in self._parent if self.find(k) != k]


def _contracted(edges: DataFrame, most: int = 200_000) -> DataFrame:
    """Each task's edges replaced by stars with the same components; ``most`` edges at a time."""
    kind = edges.schema["a"].dataType.simpleString()

    def run(batches):
        forest, held = Forest(), 0

        def out():
            links = forest.links()
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], arrow),
                                               pa.array([x[1] for x in links], arrow)], ["a", "b"])
        arrow = pa.binary()
        for batch in batches:
            arrow = batch.schema.field(0).type
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                forest.union(a, b)
            held += batch.num_rows
            if held >= most:
                yield out()
                forest, held = Forest(), 0
        if held:
            yield out()

    return edges.mapInArrow(run, f"a {kind}, b {kind}")


def components(edges: DataFrame, label: str) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b``; the root is the component's least node.

    Each task first contracts its edges to stars; then rounds of large and
    small stars run until nothing changes. A round is two joins with a
    pre-aggregated minimum, written to shared scratch. Self loops add no node
    but their own; null ends are left out.
    """
    given = edges.select("a", "b").where(F.col("a").isNotNull() & F.col("b").isNotNull())
    nodes = durable(given.select("a").union(given.select("b")).distinct().withColumnRenamed("a", "node"), f"{label}-nodes")
    now = durable(_contracted(given.where(F.col("a") != F.col("b"))).distinct(), f"{label}-stars")
    seen = _mark(now)
    while seen[0]:
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("of")).agg(F.least(F.min("b"), F.first("a")).alias("least"))
        large = (both.where(F.col("b") > F.col("a")).join(least, F.col("a") == F.col("of"))
                 .select(F.col("b").alias("a"), F.col("least").alias("b")).distinct())
        low = large.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("least"))
        small = (large.join(low, F.col("a") == F.col("of")))
        stars = (small.select(F.col("b").alias("a"), F.col("least").alias("b"))
                 .union(small.select("a", F.col("least").alias("b"))).where(F.col("a") != F.col("b")).distinct())
        now = durable(stars, f"{label}-stars")
        mark = _mark(now)
        if mark == seen:
            break
        seen = mark
    return (nodes.join(now.withColumnsRenamed({"a": "node", "b": "root"}), "node", "left")
            .select("node", F.coalesce("root", "node").alias("root")))


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]
