"""Exact statistics of whole texts that quality operators decide on."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.llm.common import map_text

COUNTS = ["n_chars_read", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_distinct_words", "n_capitals", "n_marks"]
_SPACE, _SYMBOLS, _MARKS = " \t\n\x0b\x0c\r", "#*$%&|<>", "!?"
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))


def repeat_words(ids: np.ndarray, distinct: int) -> int:
    """Words lying in three-word windows that occur twice or more, the first one included."""
    if len(ids) < 4:
        return 0
    pair = ids[:-2] * distinct + ids[1:-1]
    if distinct > 2_000_000:  # keep the triple below 2**63
        pair = np.unique(pair, return_inverse=True)[1]
    _, which, counts = np.unique(pair * distinct + ids[2:], return_inverse=True, return_counts=True)
    at = np.flatnonzero(counts[which] > 1)
    covered = np.zeros(len(ids), bool)
    for k in range(3):
        covered[at + k] = True
    return int(covered.sum())


def text_stats(text: str | None) -> tuple[int, ...]:
    """The counts of ``COUNTS``; all 0 for null and empty text."""
    if not text:
        return (0,) * len(COUNTS)
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    index = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (len(text), len(words), len(text) - sum(map(text.count, _SPACE)), sum(map(text.count, _SYMBOLS)),
            len(lines) - len(set(lines)), repeat_words(ids, len(index)), len(lines), len(index),
            len(data) - len(data.translate(None, _CAPITALS)), sum(map(text.count, _MARKS)))


def with_stats(df: DataFrame, text: str) -> DataFrame:
    """Append ``COUNTS`` as longs; columns of those names are replaced."""
    def make():
        def work(texts: Sequence[str | None]):
            rows = [text_stats(t) for t in texts]
            return [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * len(COUNTS)
        return work

    return map_text(df, text, make, [T.StructField(c, T.LongType()) for c in COUNTS])


def shares() -> dict[str, Column]:
    """Features that do not grow with length, by name; 0 for texts without words."""
    def ratio(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))

    return {"log_words": F.log1p(F.col("n_words").cast("double")), "word_length": ratio("word_chars", "n_words"),
            "symbol_share": ratio("n_symbols", "word_chars"), "dup_line_share": ratio("n_dup_lines", "n_lines"),
            "repeat_share": ratio("n_repeat_words", "n_words"), "distinct_share": ratio("n_distinct_words", "n_words"),
            "capital_share": ratio("n_capitals", "word_chars"), "mark_share": ratio("n_marks", "word_chars")}
