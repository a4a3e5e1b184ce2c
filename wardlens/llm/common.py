"""Helpers shared by the text operators: words, Arrow passes over texts, key ranges."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.functions.scalar import quoted
from wardlens.session import durable

WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 4 << 20


def without(df: DataFrame, *names: str) -> list[str]:
    """Columns of ``df`` but for ``names``, compared as Spark does: without case."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def word_count(text: Column) -> Column:
    """Number of words, runs of anything but ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows holding about ``limit`` bytes of text each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // limit
    starts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
    for a, b in zip(starts, starts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def map_text(df: DataFrame, text: str, make: Callable[[], Callable], fields: Sequence[T.StructField],
             limit: int = SLICE_BYTES) -> DataFrame:
    """Append columns computed from one text column in Arrow slices of bounded size.

    ``make()`` runs once per task and returns a function from a list of texts
    (or None) to one Arrow array per field. Input columns named like a field
    are replaced by it; the text column itself cannot be.
    """
    names = [f.name for f in fields]
    if text.lower() in {n.lower() for n in names}:
        raise ValueError(f"the text column {text!r} cannot be an output column")
    source = df.select(*[quoted(c) for c in without(df, *names)])
    at = [c.lower() for c in source.columns].index(text.lower())
    columns = [*source.columns, *names]

    def run(batches):
        work = make()
        for batch in batches:
            for part in slices(batch, at, limit):
                arrays = work(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, *arrays], columns)

    return source.mapInArrow(run, T.StructType([*source.schema.fields, *fields]))


def pair_bounds(df: DataFrame, key: str, parts: int) -> list[tuple]:
    """At most ``parts - 1`` ascending (key, tie) pairs that cut the rows of a table evenly, null keys last.

    For a numeric key and a tie that is spread over all longs, such as a hash.
    Quantiles of the key, null as its greatest value, give the keys; one that
    fills several parts, null included, is cut by ties at even distances.
    """
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.count(quoted(key)).alias("known"), F.percentile_approx(
        quoted(key), F.array(*[F.lit(i / parts) for i in range(parts + 1)]), F.lit(max(1000, 20 * parts))).alias("q")).first()
    if parts < 2 or not row["rows"]:
        return []
    ends = [i / parts * row["rows"] for i in range(1, parts)]
    keys = [row["q"][round(e / row["known"] * parts)] if e <= row["known"] and row["known"] else None for e in ends]
    bounds = []
    for value, n in Counter(keys).items():  # in order, since the keys ascend
        bounds += [(value, (1 << 64) * (j + 1) // (n + 1) - (1 << 63)) for j in range(n)]
    return bounds


def range_of(key: Column, tie: Column, bounds: Sequence[tuple]) -> Column:
    """Number of (key, tie) bounds that are not above a row's; null keys come last.

    Two scans over about the square root of the bounds each, so thousands of
    ranges stay cheap per row.
    """
    if not bounds:
        return F.lit(0)

    def place(k: Column, t: Column) -> Column:
        return F.struct(k.isNull().alias("m"), F.coalesce(k, F.lit(0)).cast("long").alias("k"), t.cast("long").alias("t"))

    step = max(1, int(len(bounds) ** 0.5))
    listed = [place(F.lit(k).cast("long"), F.lit(t)) for k, t in bounds]
    own = place(key, tie)
    block = F.size(F.filter(F.array(*listed[::step]), lambda b: b <= own))
    inside = F.size(F.filter(F.slice(F.array(*listed), (block - 1) * step + 1, F.lit(step)), lambda b: b <= own))
    return F.when(block == 0, F.lit(0)).otherwise((block - 1) * step + inside).cast("int")


MOST_FILTER_BITS = 1 << 28  # 32 MB


def with_possible(df: DataFrame, hash_: str, keys: DataFrame, key_hash: str, name: str = "possible") -> DataFrame:
    """Add ``name``, false only where no row of ``keys`` has the row's hash; null hashes are false.

    A filter of one bit per hash, sixteen per key, as a table of bitmaps that
    is broadcast: 32 MB at most, whatever the number of keys. Where that is too
    small more rows pass; what must be exact is decided by a join afterwards,
    which wide rows that cannot match then never enter.
    """
    size = min(MOST_FILTER_BITS, 1 << max(15, (16 * keys.count()).bit_length()))

    def place(h: str) -> Column:
        return F.pmod(F.col(h), F.lit(size)) + 1

    bitmaps = durable(
        keys.groupBy(F.bitmap_bucket_number(place(key_hash)).alias("__bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place(key_hash))).alias("__bits")), "hash-filter")
    at = F.bitmap_bit_position(place(hash_))
    byte = F.conv(F.hex(F.substring(F.col("__bits"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.floor(byte / F.pow(F.lit(2), at % 8)).cast("int") % 2
    met = df.join(F.broadcast(bitmaps), F.bitmap_bucket_number(place(hash_)) == F.col("__bucket"), "left")
    return met.withColumn(name, F.coalesce(bit == 1, F.lit(False))).drop("__bucket", "__bits")


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))
