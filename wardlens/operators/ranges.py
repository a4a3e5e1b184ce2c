"""Labels of numbers by a table of ranges, by minima over a tree of ranks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.functions.scalar import quoted
from wardlens.operators.order import ordered_index, running_totals
from wardlens.session import durable

_SLICE_LEVELS = 16  # ranks in a slice: 2 to this power
_NONE = np.iinfo(np.int64).max


def _width(level: Column) -> Column:
    return F.pow(F.lit(2.0), level).cast("long")


def _nodes(first: Column, end: Column, levels: int) -> Column:
    """The nodes of a binary tree over ranks that make up ``first`` to before ``end``, two a level at most."""
    def at(k: Column) -> Column:
        width = _width(k)
        lo, hi = F.floor((first + width - 1) / width).cast("long"), F.floor(end / width).cast("long")
        return F.array(F.when((lo < hi) & (lo % 2 == 1), F.struct(k.alias("level"), lo.alias("at"))),
                       F.when((lo < hi) & (hi % 2 == 1), F.struct(k.alias("level"), (hi - 1).alias("at"))))

    return F.filter(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), at)), lambda n: n.isNotNull())


def _sweep(levels: int):
    """Least place per rank of a slice: each node hands its own to the two below it."""
    def run(nodes: pd.DataFrame) -> pd.DataFrame:
        best = np.full(1, _NONE)
        for k in range(levels, -1, -1):
            best = best if k == levels else np.repeat(best, 2)
            mine = nodes[nodes["level"] == k]
            np.minimum.at(best, (mine["at"] - (nodes["slice"].iloc[0] << (levels - k))).to_numpy(), mine["place"].to_numpy())
        hit = np.flatnonzero(best < _NONE)
        return pd.DataFrame({"rank": hit + (int(nodes["slice"].iloc[0]) << levels), "place": best[hit]})
    return run


def label_ranges(df: DataFrame, value: str, ranges: DataFrame, *, low: str = "low", high: str = "high",
                 order: str = "position", label: str = "label", name: str = "label", default: str | None = None) -> DataFrame:
    """Add the label of the first closed range, by ``order``, that holds the number in ``value``.

    For range tables of any size, however much they overlap: numbers and ranges
    never meet in pairs. Ranges get their place by ``order`` (then label) from
    a sorted write. Only distinct numbers take part; running totals over them
    and the ends turn a range into a run of the numbers' ranks. A run is two
    nodes at most per level of a binary tree over the ranks; nodes fold to
    their least place on the map side, so no more than two per number are
    left. Slices of ranks then hand the least place down to each number, a
    group of bounded size at a time. Rows whose number is null, NaN or in no
    range get ``default``; ranges with a null end, an infinite one, or ends in
    the wrong order hold nothing. The join back to the rows is one on equal
    numbers, which adaptive execution splits where one is frequent.
    """
    lo, hi = quoted(low).cast("double"), quoted(high).cast("double")
    finite = lo.isNotNull() & hi.isNotNull() & (F.abs(lo) < float("inf")) & (F.abs(hi) < float("inf")) & (lo <= hi)
    # Zero has one sign here: sorting and grouping must agree on equal ends.
    table = ordered_index(ranges.where(finite).select(
        (lo + 0.0).alias("low"), (hi + 0.0).alias("high"), quoted(order).alias("order"),
        quoted(label).cast("string").alias("label")), ["order", "label"], "place")
    runs = durable(table.groupBy("low", "high").agg(F.min("place").alias("place")), "ranges")
    number = quoted(value).cast("double")
    numbers = df.select((number + 0.0).alias("x"), F.lit(1).cast("long").alias("n")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    ends = runs.select(F.explode(F.array("low", "high")).alias("x"), F.lit(0).cast("long").alias("n"))
    points = running_totals(numbers.unionByName(ends).groupBy("x").agg(F.max("n").alias("n")), [], [F.col("x")],
                            {"n": ("upto", "all")})
    points = durable(points, "points")
    count = points.agg(F.max("all")).first()[0] or 0

    # Ranks from 0: a run goes from the numbers below its low end to those up to its high end.
    starts = points.select(F.col("x").alias("low"), (F.col("upto") - F.col("n")).alias("first"))
    stops = points.select(F.col("x").alias("high"), F.col("upto").alias("end"))
    levels, inner = int(count).bit_length(), min(int(count).bit_length(), _SLICE_LEVELS)
    nodes = (runs.join(starts, "low").join(stops, "high").where("first < end")
             .select("place", F.inline(_nodes(F.col("first"), F.col("end"), levels)))
             .groupBy("level", "at").agg(F.min("place").alias("place")))
    # A node above the slices stands at the top of each slice below it; those are few.
    above = F.greatest(F.col("level") - inner, F.lit(0))
    wide = _width(above)
    begin = F.when(above > 0, F.col("at") * wide).otherwise(
        F.floor(F.col("at") / _width(inner - F.least(F.col("level"), F.lit(inner)))).cast("long"))
    sliced = nodes.select(F.least(F.col("level"), F.lit(inner)).alias("level"), "at", "place", above.alias("above"),
                          F.explode(F.sequence(begin, begin + wide - 1)).alias("slice"))
    sliced = sliced.select("slice", "level", F.when(F.col("above") > 0, F.col("slice")).otherwise(F.col("at")).alias("at"), "place")
    least = sliced.groupBy("slice").applyInPandas(_sweep(inner), "rank long, place long")
    found = (points.where("n = 1").select(F.col("x").alias("__number"), (F.col("upto") - 1).alias("rank")).join(least, "rank")
             .join(table.select("place", F.col("label").alias("__found")), "place").select("__number", "__found"))
    kept = [quoted(c) for c in df.columns if c != name]
    return (df.join(found, number == F.col("__number"), "left")
            .select(*kept, F.coalesce("__found", F.lit(default)).alias(name)))
