"""Components of the links inside groups of any size, without a meeting of all pairs.

Where only the components count, a large group need not meet as a whole. It is
cut into blocks, and a few of its rows, the hubs, are in every block, so a crowd
of like rows is one component after a single pass. What the hubs leave apart
from the group's largest component then meets every row of the group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.llm.components import Forest, components
from wardlens.session import durable

HUBS = 64
_HELD_LINKS = 100_000


def runs(batches, keys: int) -> Iterator[list[pa.RecordBatch]]:
    """Runs of rows equal in the first ``keys`` columns, of rows sorted by them."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i) for i in range(keys)]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            codes = c.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            change[1:] |= codes[1:] != codes[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            value = tuple(c[a].as_py() for c in columns)
            if last is not None and value != last:
                yield held
                held = []
            held.append(batch.slice(a, b - a))
            last = value
    if held:
        yield held


def column(parts: Sequence[pa.RecordBatch], at: int | str) -> list:
    return [v for p in parts for v in p.column(at).to_pylist()]


def _pairs(links: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.binary()),
                                       pa.array([x[1] for x in links], pa.binary())], ["a", "b"])


def _found(cells: DataFrame, keys: Sequence[str], attach: Callable, order: Sequence[str], make: Callable) -> DataFrame:
    """Stars ``a, b`` of the links that ``make()`` finds in the rows of each cell."""
    whole = attach(cells.select("node", *keys))
    payload = [c for c in whole.columns if c not in keys]
    sorted_cells = whole.select(*keys, *payload).repartition(*keys).sortWithinPartitions(*keys, *order)

    def run(batches):
        find, forest, seen = make(), Forest(), 0
        for parts in runs(batches, len(keys)):
            if sum(p.num_rows for p in parts) < 2:
                continue
            for a, b in find(parts):
                forest.union(a, b)
                seen += 1
            if seen >= _HELD_LINKS:
                yield _pairs(forest.links())
                forest, seen = Forest(), 0
        yield _pairs(forest.links())

    return sorted_cells.mapInArrow(run, "a binary, b binary")


def _hash(seed: int) -> Column:
    return F.xxhash64("node", F.lit(seed))


def linked(rows: DataFrame, by: Sequence[str], attach: Callable, order: Sequence[str], make: Callable, label: str,
           large: bool = True) -> DataFrame:
    """``node, root`` of every row that a link joins to another one of its group.

    ``rows`` has the group in ``by``, ``node``, its group's ``n`` rows and the
    ``blocks`` to cut it into; ``attach`` joins what is compared, once rows are
    in cells. ``make()`` returns a function from a cell's rows, sorted by
    ``order``, to links that connect all rows that are alike in the cell. Two rows of a group that are alike get
    one root: either both are in the largest component of the first pass, or one
    of them meets all rows in the second. The work grows with the group, but for
    rows outside its largest component, which are sent to each of its blocks.
    ``large`` false says that no group has several blocks.
    """
    blocks = F.col("blocks").cast("int")
    own = F.pmod(_hash(1), blocks).cast("int")
    # A block holds as many hubs as rows of its own at most.
    hub = F.shiftrightunsigned(_hash(2), 11) / F.lit(float(1 << 53)) < F.least(F.lit(HUBS) / F.col("n"), 1 / blocks)
    where = F.when((blocks > 1) & hub, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(own))
    first = _found(rows.withColumn("x", F.explode(where)), [*by, "x"], attach, order, make)
    found = components(durable(first, f"{label}-links"), label)
    if not large:
        return found
    found = durable(found, f"{label}-found")
    roots = found.select(F.col("node").alias("__of"), F.col("root").alias("__root"))
    placed = (rows.where("blocks > 1").join(roots, F.col("node") == F.col("__of"), "left")
              .withColumn("__root", F.coalesce("__root", "node")).drop("__of"))
    rest = durable(
        placed.groupBy(*by, "__root").agg(F.count(F.lit(1)).alias("__n"))
        .groupBy(*[F.col(c).alias(f"__{c}") for c in by])
        .agg(F.max_by("__root", F.struct("__n", "__root")).alias("__top"), (F.sum("__n") - F.max("__n")).alias("__rest"))
        .where("__rest > 0"), f"{label}-rest")
    if rest.isEmpty():
        return found
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]
    met = placed.join(rest, same).withColumn("__blocks", F.ceil(F.col("__rest") * F.col("blocks") / F.col("n")).cast("int"))
    across = F.pmod(_hash(3), F.col("__blocks")).cast("int")
    as_any = F.transform(F.sequence(F.lit(0), F.col("__blocks") - 1), lambda j: F.struct(own.alias("x"), j.alias("y")))
    as_rest = F.transform(F.sequence(F.lit(0), blocks - 1), lambda i: F.struct(i.alias("x"), across.alias("y")))
    cells = F.when(F.col("__root") == F.col("__top"), as_any).otherwise(F.array_distinct(F.concat(as_any, as_rest)))
    second = _found(met.withColumn("__cell", F.explode(cells)).withColumns({"x": F.col("__cell.x"), "y": F.col("__cell.y")}),
                    [*by, "x", "y"], attach, order, make)
    more = durable(second, f"{label}-rest-links")
    return components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more), f"{label}-whole")
