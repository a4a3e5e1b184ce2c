"""Global order without a global task.

A window without ``partitionBy`` sends the whole table to one task. These
operators range-partition on the full order key instead, so equal leading
values still spread by the tie-break, write the sorted slices once, and add the
totals of the slices before.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wardlens.functions.scalar import quoted
from wardlens.session import durable

_POSITION = "__position"
_SLICE = "__slice"
_SLICE_BITS = 33  # monotonically_increasing_id keeps the row number in 33 bits


def _ranged(df: DataFrame, order: Sequence[Column], slices: int | None) -> DataFrame:
    """Sorted ranges; without a number adaptive execution fits their count to the data."""
    ranged = df.repartitionByRange(slices, *order) if slices else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def _slices(df: DataFrame, order: Sequence[Column], slices: int | None, label: str) -> DataFrame:
    ranged = _ranged(df, order, slices)
    return durable(ranged.withColumn(_POSITION, F.monotonically_increasing_id()), label)


def _slice_of(position: Column) -> Column:
    return F.shiftright(position, _SLICE_BITS).cast("int")


def _slice_starts(sliced: DataFrame) -> tuple[dict[int, int], int]:
    """Rows before each slice, and rows in all: one small row per slice."""
    sizes = (sliced.groupBy(_slice_of(F.col(_POSITION)).alias(_SLICE))
             .agg(F.count(F.lit(1)).alias("n")).collect())
    starts, seen = {}, 0
    for row in sorted(sizes, key=lambda r: r[_SLICE]):
        starts[row[_SLICE]] = seen
        seen += row["n"]
    return starts, seen


def ordered_index(df: DataFrame, order: Sequence[str], name: str,
                  slices: int | None = None) -> DataFrame:
    """Add the 1-based position of each row in the given total order.

    The position inside a slice comes from the sorted write itself, so adding
    the slice offset is a broadcast of one row per slice and no further shuffle.
    """
    sliced = _slices(df, [quoted(c) for c in order], slices, "ordered")
    starts, _ = _slice_starts(sliced)
    spark = df.sparkSession
    offsets = spark.createDataFrame(
        [(s, b) for s, b in starts.items()],
        T.StructType([T.StructField(_SLICE, T.IntegerType()), T.StructField("__before", T.LongType())]))
    within = F.col(_POSITION).bitwiseAND(F.lit((1 << _SLICE_BITS) - 1))
    return (sliced.withColumn(_SLICE, _slice_of(F.col(_POSITION)))
            .join(F.broadcast(offsets), _SLICE)
            .withColumn(name, F.col("__before") + within + 1)
            .drop(_SLICE, _POSITION, "__before"))


def rows_at_ranks(df: DataFrame, order: Sequence[str], ranks_of,
                  slices: int | None = None) -> tuple[int, dict[int, Row]]:
    """Row count and the order keys at a few ranks of the total order.

    ``ranks_of(n)`` names the wanted 1-based ranks. Only the order columns are
    shuffled; nothing else of the table moves.
    """
    keys = df.select(*[quoted(c) for c in order])
    sliced = _slices(keys, [quoted(c) for c in order], slices, "ranks")
    starts, total = _slice_starts(sliced)
    wanted = {}
    for rank in ranks_of(total):
        if 1 <= rank <= total:
            home = max((s for s, before in starts.items() if before < rank),
                       key=lambda s: (starts[s], s))
            wanted[(home << _SLICE_BITS) + rank - starts[home] - 1] = rank
    found = {}
    if wanted:
        for row in sliced.where(F.col(_POSITION).isin(*wanted)).collect():
            found[wanted[row[_POSITION]]] = Row(**{c: row[c] for c in order})
    return total, found


def running_totals(df: DataFrame, by: Sequence[str], order: Sequence[Column],
                   sums: Mapping[str, tuple[str, str]], slices: int | None = None) -> DataFrame:
    """Inclusive running and overall totals per group of ``by``.

    ``sums`` maps an input column to the names of its running and overall
    total. Rows must be unique on ``by`` plus ``order``: aggregate first, which
    also folds a hot key into one row per map task. A group may span many
    slices, so one group holding most of the table is still spread out. The
    sums inside a slice come from the sorting pass itself; the table of slice
    totals, one row per slice and group, gives the rest.
    """
    by_cols, names = [quoted(c) for c in by], list(sums)
    ranged = _ranged(df, [*by_cols, *order], slices)
    kinds = [T.LongType() if isinstance(df.schema[c].dataType, T.IntegralType) else T.DoubleType() for c in names]
    fields = [T.StructField(f"__inside_{i}", k) for i, k in enumerate(kinds)]
    schema = T.StructType([*df.schema.fields, T.StructField(_SLICE, T.IntegerType()), *fields])
    at_group, at_sum = [df.columns.index(c) for c in by], [df.columns.index(c) for c in names]
    types = ["int64" if isinstance(k, T.LongType) else "float64" for k in kinds]

    def accumulate(batches):
        part, last, carried = TaskContext.get().partitionId(), None, [0] * len(names)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            groups = [batch.column(i) for i in at_group]
            change = np.zeros(n, bool)
            for g in groups:
                code = g.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
                change[1:] |= code[1:] != code[:-1]
            first = tuple(g[0].as_py() for g in groups)
            change[0] = first != last
            last = tuple(g[n - 1].as_py() for g in groups)
            start = np.maximum.accumulate(np.where(change, np.arange(n), -1))
            columns = []
            for i, (c, kind) in enumerate(zip(at_sum, types)):
                values = pc.fill_null(batch.column(c).cast(kind), 0).to_numpy(zero_copy_only=False)
                total = np.cumsum(values)
                before = np.where(start >= 0, total[start] - values[start], -carried[i])
                columns.append(pa.array(total - before))
                carried[i] = columns[-1][n - 1].as_py()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int32)), *columns],
                [*batch.schema.names, _SLICE, *[f.name for f in fields]])

    sliced = durable(ranged.mapInArrow(accumulate, schema), "running")
    in_order = Window.partitionBy(*by_cols).orderBy(_SLICE)
    whole = Window.partitionBy(*by_cols)
    parts = sliced.groupBy(_SLICE, *by_cols).agg(*[F.sum(quoted(c)).cast(k).alias(f"__sum_{i}")
                                                   for i, (c, k) in enumerate(zip(names, kinds))])
    table = parts.select(F.col(_SLICE).alias("__at"), *[quoted(c).alias(f"__group_{j}") for j, c in enumerate(by)],
                         *[(F.sum(f"__sum_{i}").over(in_order) - F.col(f"__sum_{i}")).alias(f"__before_{i}")
                           for i in range(len(names))],
                         *[F.sum(f"__sum_{i}").over(whole).alias(f"__all_{i}") for i in range(len(names))])
    same = F.col(_SLICE) == F.col("__at")
    for j, c in enumerate(by_cols):
        same = same & c.eqNullSafe(F.col(f"__group_{j}"))
    out = sliced.join(table, same)
    for i, c in enumerate(names):
        running, overall = sums[c]
        out = (out.withColumn(running, F.col(f"__inside_{i}") + F.col(f"__before_{i}"))
               .withColumn(overall, F.col(f"__all_{i}")))
    return out.select(*[quoted(c) for c in df.columns],
                      *[quoted(t) for pair in sums.values() for t in pair])
