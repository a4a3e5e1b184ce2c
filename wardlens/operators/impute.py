"""Exact medians by bracketed selection: no column is shuffled or gathered."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.functions.scalar import quoted
from wardlens.operators.profile import columns_with_nulls


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


KEEP = 10_000  # different values strictly inside a bracket that may be collected, per column
_GRID = 64  # parts that a pass cuts the inside of a bracket into


@dataclass
class _Bracket:
    """Where the lower middle value of a column lies, both ends included, and what the last pass counted."""

    low: float = -float("inf")
    high: float = float("inf")
    total: int = 0
    nulls: int = 0
    numbers: int = 0  # neither null nor NaN
    below: int = 0
    at_low: int = 0
    between: int = 0
    at_high: int = 0
    above: float | None = None  # the least value over the bracket
    settled: bool = False

    @property
    def has_middle(self) -> bool:
        """Whether the lower middle value is a number, not NaN."""
        return 0 < self.total and (self.total + 1) // 2 <= self.numbers

    def settle_or_narrow(self, grid: Sequence[float]) -> None:
        """Close the bracket, or move its ends nearer to the middle for another pass."""
        rank = (self.total + 1) // 2
        if not self.has_middle or self.low == self.high:
            self.settled = True
            return
        if not self.below < rank <= self.below + self.at_low + self.between + self.at_high:
            raise RuntimeError("a median lies outside its bracket")
        inner = rank - self.below - self.at_low
        if inner < 1:
            self.high = self.low
        elif inner > self.between:
            self.low = self.high
        elif self.between <= max(KEEP, 8 * _GRID):  # below that a part is no more than a few ranks
            self.settled = True
        else:  # quantiles around the rank, one further on either side for the sketch's error
            part = int((inner - 1) / (self.between - 1) * _GRID)
            self.low, self.high = grid[max(0, part - 1)], grid[min(_GRID, part + 2)]

    def median(self, counts: Sequence[tuple[float, int]]) -> float | None:
        """The mean of the middle two, given how often each value of the bracket occurs; NaN sorts last."""
        if not self.total:
            return None
        upto, middle, ranks = self.below, [], ((self.total + 1) // 2, self.total // 2 + 1)
        for value, n in sorted(counts):
            middle += [value for rank in ranks if upto < rank <= upto + n]
            upto += n
        if len(middle) < 2 and ranks[1] <= self.numbers:
            middle.append(self.above)
        return sum(middle) / 2 if len(middle) == 2 else float("nan")


def _measure(df: DataFrame, brackets: dict[str, _Bracket]) -> None:
    """One pass over the table: counts around each bracket, quantiles strictly inside it.

    Sketches combine on the map side, so one row leaves each task.
    """
    grid = F.array(*[F.lit(i / _GRID) for i in range(_GRID + 1)])

    def counted(c: str, b: _Bracket) -> Column:
        v, low, high = quoted(c).cast("double"), F.lit(b.low), F.lit(b.high)
        number = v.isNotNull() & ~F.isnan(v)
        between = number & (v > low) & (v < high)
        return F.struct(F.count(v).alias("total"), F.count_if(number).alias("numbers"), F.count_if(v < low).alias("below"),
                        F.count_if(v == low).alias("at_low"), F.count_if(between).alias("between"),
                        F.count_if(number & (v == high) & (high > low)).alias("at_high"),
                        F.min(F.when(number & (v > high), v)).alias("above"),
                        F.percentile_approx(F.when(between, v), grid, F.lit(100 * _GRID)).alias("grid"))

    row = df.agg(F.count(F.lit(1)).alias("rows"), *[counted(c, b).alias(f"c{i}") for i, (c, b) in enumerate(brackets.items())]).first()
    for i, b in enumerate(brackets.values()):
        found = row[f"c{i}"]
        for name in ("total", "numbers", "below", "at_low", "between", "at_high", "above"):
            setattr(b, name, found[name])
        b.nulls = row["rows"] - b.total
        b.settle_or_narrow(found["grid"])


def _brackets(df: DataFrame, columns: Sequence[str]) -> dict[str, _Bracket]:
    """Settled brackets: one value, or at most ``KEEP`` values between the ends. Every pass narrows the others."""
    brackets = {c: _Bracket() for c in columns}
    while open_ := {c: b for c, b in brackets.items() if not b.settled}:
        _measure(df, open_)
    return brackets


def _medians(df: DataFrame, brackets: dict[str, _Bracket]) -> dict[str, float | None]:
    """The median of each column; only the values inside its bracket, with counts, reach the driver."""
    counts = {c: [(b.low, b.at_low)] if b.low == b.high else [] for c, b in brackets.items()}
    values = [F.when(quoted(c).cast("double").between(F.lit(b.low), F.lit(b.high)), quoted(c).cast("double")).alias(c)
              for c, b in brackets.items() if b.has_middle and b.low < b.high]
    if values:
        coded = df.select(*values)
        for r in (coded.unpivot([], [quoted(c) for c in coded.columns], "column", "value")
                  .where(F.col("value").isNotNull() & ~F.isnan("value"))
                  .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")).collect()):
            counts[r["column"]].append((r["value"], r["n"]))
    return {c: b.median(counts[c]) for c, b in brackets.items()}


def exact_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, median): mean of the middle two values, nulls ignored, NaN last; none for a column without values.

    A pass over the table counts what lies below a bracket and inside it, and
    cuts the inside to a few parts in ``_GRID`` by a quantile sketch. Once at
    most ``KEEP`` values lie between its ends, their counts settle the middle
    exactly. A small table takes one pass, a thousand million rows about five.
    """
    found = _medians(df, _brackets(df, columns))
    return df.sparkSession.createDataFrame([(c, m) for c, m in found.items() if m is not None], "column string, median double")


@dataclass(frozen=True)
class MedianImputerModel:
    medians: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        """Fill nulls of the fitted columns; they become doubles."""
        return df.withColumns({c: F.coalesce(quoted(c).cast("double"), F.lit(m))
                               for c, m in self.medians.items()})


@dataclass(frozen=True)
class MedianImputer:
    """Median fill for the numeric columns that hold nulls.

    A column without any value stays null.
    """

    columns: Sequence[str] | None = None

    def fit(self, df: DataFrame) -> MedianImputerModel:
        named = self.columns is not None
        columns = list(self.columns) if named else columns_with_nulls(df, numeric_columns(df))
        brackets = _brackets(df, columns)
        found = _medians(df, {c: b for c, b in brackets.items() if b.nulls})
        return MedianImputerModel({c: m for c, m in found.items() if m is not None})
