"""Row-wise expressions used by the encoders and the derived features."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.functions import codes


def sql_name(name: str) -> str:
    """A column name quoted for SQL text; names may hold ``-`` or ``.``."""
    return "`" + name.replace("`", "``") + "`"


def sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted(name: str) -> Column:
    """Column by exact name."""
    return F.col(sql_name(name))


def null_if_missing(name: str, tokens: Sequence[str] = codes.MISSING_TOKENS) -> Column:
    """The text column ``name`` with missing-value tokens turned to null."""
    listed = ", ".join(map(sql_text, tokens))
    column = sql_name(name)
    return F.expr(f"CASE WHEN {column} NOT IN ({listed}) THEN {column} END")


def map_codes(name: str, mapping: Mapping[str, object], default=None,
              dtype: str = "double") -> Column:
    """Look column ``name`` up in a fixed table; misses and nulls give ``default``.

    The table folds to one literal. Two dozen spelled-out CASE chains in a
    stage would outgrow the size limit of a generated method.
    """
    table = ", ".join(f"{sql_text(k)}, {v!r}" for k, v in mapping.items())
    found = f"try_element_at(map({table}), {sql_name(name)})"
    filled = found if default is None else f"coalesce({found}, {default!r})"
    return F.expr(f"CAST({filled} AS {dtype})")


def flag(condition: Column, dtype: str = "tinyint") -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.coalesce(condition, F.lit(False)).cast(dtype)


def equals_flag(col: Column, value) -> Column:
    return col.eqNullSafe(F.lit(value)).cast("tinyint")


def round_half_even(col: Column, digits: int) -> Column:
    """Scale, round half to even, scale back, on doubles."""
    factor = float(10 ** digits)
    return F.rint(col.cast("double") * F.lit(factor)) / F.lit(factor)


def at_least(col: Column, floor) -> Column:
    """Raise small values to ``floor``; null stays null, unlike ``greatest``."""
    return F.when(col < F.lit(floor), F.lit(floor)).otherwise(col)


def count_where(columns: Iterable[str], test: str, dtype: str = "smallint") -> Column:
    """In how many of the columns ``test`` (such as ``> 0``) holds; null does not count."""
    terms = [f"CAST(coalesce({sql_name(c)} {test}, false) AS INT)" for c in columns]
    return F.expr(f"CAST({' + '.join(terms) or '0'} AS {dtype})")


def range_label(name: str, ranges: Mapping[str, tuple[float, float]], default: str) -> Column:
    """Label of the first closed range that holds the number in column ``name``."""
    column = sql_name(name)
    arms = " ".join(f"WHEN {column} BETWEEN {lo} AND {hi} THEN {sql_text(label)}"
                    for label, (lo, hi) in ranges.items())
    return F.expr(f"CASE {arms} ELSE {sql_text(default)} END")


_BLANK = r"[\s\x1c-\x1f]"  # with (?U): every kind of whitespace, not only blanks


def is_supplement_code(code: Column) -> Column:
    """V and E codes, in either case; checked first, so ``E2`` is no exponent."""
    return F.coalesce(code.rlike(rf"(?iU)^{_BLANK}*[VE]"), F.lit(False))


def code_number(code: Column) -> Column:
    """The decimal integer before the first dot, exponent allowed, else null.

    The pattern is a guard: a bare cast also takes ``400D`` and ``NaN``, and
    NaN sorts above every range bound.
    """
    digits = r"[0-9]+(?:_[0-9]+)*"
    shape = rf"(?sU)^{_BLANK}*([+-]?{digits}(?:[eE][+-]?{digits})?){_BLANK}*(?:\..*)?$"
    found = F.nullif(F.regexp_extract(code, shape, 1), F.lit(""))
    return F.replace(found, F.lit("_"), F.lit("")).try_cast("double")


def icd9_category(supplement: Column, number: str) -> Column:
    """Broad diagnosis group from the two readings of a code above.

    ``number`` names a column, since the ranges mention it many times over.
    """
    by_range = range_label(number, codes.ICD9_RANGES, codes.ICD9_DEFAULT)
    return F.when(supplement, F.lit(codes.ICD9_SUPPLEMENT)).otherwise(by_range)


def exact_literal(value, dtype: T.DataType) -> Column:
    """A collected value as a literal of its own type, whatever the time zones."""
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast(dtype)
    return F.lit(value).cast(dtype)


def lexicographic_le(columns: Sequence[Column], bound: Sequence[Column]) -> Column:
    """``(c1, c2, ...) <= bound`` spelled with plain comparisons so it can push down."""
    last = columns[-1] <= bound[-1]
    pairs = list(zip(columns[:-1], bound[:-1]))
    return reduce(lambda inner, cb: (cb[0] < cb[1]) | ((cb[0] == cb[1]) & inner),
                  reversed(pairs), last)
