"""Input contracts: fail early with the missing piece named."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T


class ContractError(ValueError):
    """A required column is absent, or the input holds no rows."""


def present_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in columns if c in have]


def require(df: DataFrame, columns: Sequence[str], nonempty: bool = False) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ContractError(f"missing required columns: {', '.join(missing)}")
    if nonempty and df.isEmpty():
        raise ContractError("the input holds no rows")
    return df


def contract_report(df: DataFrame, required: Sequence[str], optional: Sequence[str]) -> DataFrame:
    """(column, required, present, dtype) for every column of the contract."""
    have = dict(df.dtypes)
    rows = [(c, need, c in have, have.get(c))
            for need, group in ((True, required), (False, optional)) for c in group]
    return df.sparkSession.createDataFrame(rows, T.StructType([
        T.StructField("column", T.StringType()), T.StructField("required", T.BooleanType()),
        T.StructField("present", T.BooleanType()), T.StructField("dtype", T.StringType())]))
