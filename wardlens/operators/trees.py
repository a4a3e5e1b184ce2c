"""Tree ensembles as arrays: margins per boosting round and Shapley values.

Each row is independent, so both are narrow: the ensemble is broadcast in blocks
of trees of a bounded size, and NumPy works through Arrow batches inside the
tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.session import scratch_path

BLOCK_NODES = 1_000_000  # about 50 MB of arrays in a broadcast
_TABLE_CELLS = 1 << 20  # numbers in the tables of a tree's leaves that are held at a time
_TABLE_ROWS = 1 << 14
_CHUNK_CELLS = 1 << 17  # a megabyte of doubles: the passes over a chunk stay in the cache


@dataclass(frozen=True)
class Tree:
    """One tree; children and features are -1 in leaves."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray


@dataclass(frozen=True)
class Forest:
    trees: tuple[Tree, ...]
    weights: tuple[float, ...]

    def head(self, rounds: int) -> Forest:
        return Forest(self.trees[:rounds], self.weights[:rounds])

    def blocks(self) -> list[Forest]:
        """Runs of trees with at most ``BLOCK_NODES`` nodes; a larger tree stands alone."""
        cuts, size = [0], 0
        for i, t in enumerate(self.trees):
            if size and size + len(t.value) > BLOCK_NODES:
                cuts.append(i)
                size = 0
            size += len(t.value)
        ends = [*cuts[1:], len(self.trees)]
        return [Forest(self.trees[a:b], self.weights[a:b]) for a, b in zip(cuts, ends)]


def read_forest(model: GBTClassificationModel) -> Forest:
    """Node arrays of a fitted ensemble, read from its saved form."""
    spark = SparkSession.active()
    path = scratch_path(spark, "forest")
    model.write().save(path)
    node = F.col("nodeData")
    rows = (spark.read.parquet(f"{path}/data")
            .select("treeID", node["id"].alias("id"), node["split"]["featureIndex"].alias("feature"),
                    F.try_element_at(node["split"]["leftCategoriesOrThreshold"], F.lit(1))
                    .alias("threshold"),
                    node["leftChild"].alias("left"), node["rightChild"].alias("right"),
                    node["prediction"].alias("value"), node["impurityStats"][0].alias("cover"))
            .toPandas().sort_values(["treeID", "id"]))
    trees = []
    for _, part in rows.groupby("treeID"):
        if (part["id"].to_numpy() != np.arange(len(part))).any():
            raise ValueError("node ids of a tree are not dense")
        trees.append(Tree(*[part[c].to_numpy() for c in
                            ("feature", "threshold", "left", "right", "value", "cover")]))
    return Forest(tuple(trees), tuple(model.treeWeights))


def tree_values(tree: Tree, x: np.ndarray) -> np.ndarray:
    """Leaf value each row of ``x`` falls into."""
    at = np.zeros(len(x), dtype=np.int64)
    rows = np.arange(len(x))
    while True:
        inner = tree.left[at] >= 0
        if not inner.any():
            return tree.value[at]
        goes_left = x[rows, np.maximum(tree.feature[at], 0)] <= tree.threshold[at]
        at = np.where(inner, np.where(goes_left, tree.left[at], tree.right[at]), at)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float)


def _with_array(df: DataFrame, name: str, kind: T.DataType, payloads: Sequence, step: Callable,
                finish: Callable, features: str = "features") -> DataFrame:
    """Add ``finish(acc)`` per row, where ``acc = step(payload, matrix, acc)`` runs over the blocks."""
    shared = [df.sparkSession.sparkContext.broadcast(p) for p in payloads]
    is_vector = not isinstance(df.schema[features].dataType, T.ArrayType)
    arrays = df.withColumn(features, vector_to_array(features)) if is_vector else df
    schema = T.StructType([*arrays.schema.fields, T.StructField(name, kind)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x, acc = _matrix(batch[features]), None
                for block in shared:
                    acc = step(block.value, x, acc)
                batch[name] = list(finish(acc))
                yield batch

    return arrays.mapInPandas(run, schema)


def _staged(forest: Forest, x: np.ndarray, before: np.ndarray | None) -> np.ndarray:
    steps = np.stack([w * tree_values(t, x) for t, w in zip(forest.trees, forest.weights)], axis=1)
    if before is None:
        return np.cumsum(steps, axis=1)
    return np.concatenate([before, np.cumsum(steps, axis=1) + before[:, -1:]], axis=1)


def _summed(forest: Forest, x: np.ndarray, before: np.ndarray | None) -> np.ndarray:
    total = sum(w * tree_values(t, x) for t, w in zip(forest.trees, forest.weights))
    return total if before is None else before + total


def staged_margins(vectors: DataFrame, forest: Forest) -> DataFrame:
    """Add ``margins``: the margin after each boosting round."""
    return _with_array(vectors, "margins", T.ArrayType(T.DoubleType()), forest.blocks(), _staged,
                       lambda acc: acc).drop("features")


def margins_at(vectors: DataFrame, forest: Forest, rounds: int, name: str = "margin") -> DataFrame:
    """Add the margin after the first ``rounds`` rounds; the features stay."""
    return _with_array(vectors, name, T.DoubleType(), forest.head(rounds).blocks(), _summed, lambda acc: acc)


@dataclass(frozen=True)
class Paths:
    """Root-to-leaf paths of a tree, one slot per distinct feature on the path.

    A row follows a slot when ``low < x[feature] <= high``; ``share`` is the
    cover fraction that follows it when the feature is unknown. Unused slots
    hold the whole line and share 1: players that change nothing.
    """

    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    value: np.ndarray


def tree_paths(tree: Tree) -> Paths:
    leaves = []
    stack = [(0, {})]
    while stack:
        at, slots = stack.pop()
        if tree.left[at] < 0:
            leaves.append((slots, tree.value[at]))
            continue
        f, cut = int(tree.feature[at]), tree.threshold[at]
        low, high, share = slots.get(f, (-np.inf, np.inf, 1.0))
        for child, bounds in ((tree.left[at], (low, min(high, cut))),
                              (tree.right[at], (max(low, cut), high))):
            follow = share * tree.cover[child] / tree.cover[at]
            stack.append((child, {**slots, f: (*bounds, follow)}))
    width = max(1, max(len(slots) for slots, _ in leaves))
    shape = (len(leaves), width)
    out = Paths(np.zeros(shape, int), np.full(shape, -np.inf), np.full(shape, np.inf),
                np.ones(shape), np.array([v for _, v in leaves]))
    for i, (slots, _) in enumerate(leaves):
        for j, (f, (low, high, share)) in enumerate(slots.items()):
            out.feature[i, j], out.low[i, j], out.high[i, j], out.share[i, j] = f, low, high, share
    return out


def path_shapley(paths: Paths, x: np.ndarray, phi: np.ndarray, weight: float) -> float:
    """Add ``weight`` times the tree's Shapley values to ``phi``; return its base value.

    For one leaf the value of feature i is ``v * (o_i - z_i)`` times the
    integral over t in [0, 1] of the product over the other slots of
    ``(1 - t) z_j + t o_j``, where z is the cover share and o whether the row
    follows. The integrand is a polynomial, so a short Gauss rule is exact.
    """
    width = paths.feature.shape[1]
    nodes, rule = np.polynomial.legendre.leggauss((width + 1) // 2)
    order = np.argsort(paths.feature, axis=None, kind="stable")
    ids = paths.feature.ravel()[order]
    starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    step = max(1, _CHUNK_CELLS // paths.feature.size)
    for lo in range(0, len(x), step):
        seen = x[lo:lo + step][:, paths.feature]
        follows = ((seen > paths.low) & (seen <= paths.high)).astype(float)
        integral = np.zeros_like(follows)
        for node, w in zip((nodes + 1) / 2, rule / 2):
            factor = (1 - node) * paths.share + node * follows
            integral += w * (factor.prod(axis=2, keepdims=True) / factor)
        part = (follows - paths.share) * integral * paths.value[:, None]
        flat = part.reshape(len(part), -1)[:, order]
        phi[lo:lo + step, ids[starts]] += weight * np.add.reduceat(flat, starts, axis=1)
    return weight * float((paths.share.prod(axis=1) * paths.value).sum())


def grid_of(paths: Sequence[Paths], features: int) -> list[np.ndarray]:
    """Per feature, all bounds that paths set to it, in order."""
    feature = np.concatenate([np.r_[p.feature.ravel(), p.feature.ravel()] for p in paths])
    bound = np.concatenate([np.r_[p.low.ravel(), p.high.ravel()] for p in paths])
    feature, bound = feature[np.isfinite(bound)], bound[np.isfinite(bound)]
    return [np.unique(bound[feature == f]) for f in range(features)]


def _leaf_tables(paths: Paths, used: np.ndarray) -> np.ndarray:
    """(slot, leaf, pattern): contribution of a slot to each leaf, per set of slots that a row follows.

    Bit j of a pattern says whether the row follows slot j. The product over
    all slots is built bit by bit; each slot's own factor is divided out.
    """
    leaves, width = paths.feature.shape
    nodes, rule = np.polynomial.legendre.leggauss((width + 1) // 2)
    t = (nodes + 1) / 2
    missing = np.where(used[:, :, None], (1 - t) * paths.share[:, :, None], 1.0)  # the factor of a slot that is not followed
    followed = np.where(used[:, :, None], missing + t, 1.0)
    product = np.ones((leaves, 1, len(t)))
    for j in range(width):
        product = np.concatenate([product * missing[:, None, j], product * followed[:, None, j]], axis=1)
    out = np.empty((width, leaves, 1 << width))
    scale = paths.value[:, None] * rule / 2
    for j in range(width):
        halves = product.reshape(leaves, -1, 2, 1 << j, len(t))
        into = out[j].reshape(leaves, -1, 2, 1 << j)
        for bit, factor in enumerate((missing, followed)):
            part = (bit - paths.share[:, j, None]) * scale / factor[:, j]
            into[:, :, bit] = np.einsum("lapq,lq->lap", halves[:, :, bit], part)
    return out


def table_shapley(paths: Paths, grid: Sequence[np.ndarray], codes: np.ndarray, phi: np.ndarray, weight: float) -> float:
    """As :func:`path_shapley`, for many rows: ``codes`` are their places between a feature's bounds, ``phi`` a line per feature.

    What a leaf contributes follows from which of its slots a row follows, so
    it is looked up in a table of all such patterns.
    """
    leaves, width = paths.feature.shape
    used = np.isfinite(paths.low) | np.isfinite(paths.high)
    kind = np.min_scalar_type((1 << width) - 1)
    patterns = np.zeros((codes.shape[1], leaves), kind)
    for f in np.unique(paths.feature[used]):
        leaf, slot = np.nonzero(used & (paths.feature == f))
        low, high = paths.low[leaf, slot], paths.high[leaf, slot]
        place = np.arange(len(grid[f]) + 1)[:, None]
        after = np.where(np.isfinite(low), np.searchsorted(grid[f], low) + 1, 0)
        upto = np.where(np.isfinite(high), np.searchsorted(grid[f], high), len(grid[f]))
        masks = np.zeros((len(place), leaves), kind)
        masks[:, leaf] = ((place >= after) & (place <= upto)).astype(kind) << slot.astype(kind)
        patterns += masks[codes[f]]
    patterns = np.ascontiguousarray(patterns.T)
    step, part = max(1, _TABLE_CELLS // (width << width)), np.empty(codes.shape[1])
    for low in range(0, leaves, step):
        some = slice(low, low + step)
        tables = weight * _leaf_tables(Paths(*[getattr(paths, c)[some] for c in ("feature", "low", "high", "share", "value")]), used[some])
        for i in range(tables.shape[1]):
            pattern = patterns[low + i].astype(np.intp)
            for j in np.flatnonzero(used[low + i]):
                np.take(tables[j, i], pattern, out=part, mode="clip")
                phi[paths.feature[low + i, j]] += part
    return weight * float((paths.share.prod(axis=1) * paths.value).sum())


def _shapley(block: tuple[list[tuple[Paths, float]], list[np.ndarray]], x: np.ndarray, before: np.ndarray | None) -> np.ndarray:
    """Per row: log-odds contribution of each feature, then the base value."""
    paths_of, grid = block
    phi, lines = np.zeros(x.shape), np.zeros(x.shape[::-1])
    codes, base = None, 0.0
    for paths, weight in paths_of:
        if len(x) < 2 << paths.feature.shape[1]:  # fewer rows than a table would have lines
            base += path_shapley(paths, x, phi, 2 * weight)
            continue
        if codes is None:
            codes = np.stack([np.searchsorted(g, x[:, f]) for f, g in enumerate(grid)])
        for low in range(0, len(x), _TABLE_ROWS):
            some = slice(low, low + _TABLE_ROWS)
            part = table_shapley(paths, grid, codes[:, some], lines[:, some], 2 * weight)
        base += part
    part = np.column_stack([phi + lines.T, np.full(len(x), base)])
    return part if before is None else before + part


def shapley_values(vectors: DataFrame, forest: Forest) -> DataFrame:
    """Add ``phi`` (log-odds contributions), ``base``; keep ``features`` as an array.

    A row costs milliseconds (every leaf of every tree) and holds some hundred
    bytes, so partitions cut by bytes would leave most cores idle: rows are
    dealt over all of them, once, as a task makes its tables for all its rows.
    """
    vectors = vectors.repartition(max(1, vectors.sparkSession.sparkContext.defaultParallelism))
    payloads = []
    for b in forest.blocks():
        paths = [tree_paths(t) for t in b.trees]
        width = 1 + max(int(p.feature.max()) for p in paths)
        payloads.append((list(zip(paths, b.weights)), grid_of(paths, width)))
    both = _with_array(vectors, "__phi", T.ArrayType(T.DoubleType()), payloads, _shapley, lambda acc: acc)
    return (both.withColumn("base", F.element_at("__phi", -1))
            .withColumn("phi", F.slice("__phi", 1, F.size("__phi") - 1)).drop("__phi"))
