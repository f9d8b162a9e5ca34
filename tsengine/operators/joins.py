"""Joins between series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsengine.series import SeriesKeys


def join_feeds(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner join of two feeds; the join strategy and skew handling are left to adaptive execution."""
    return left.join(right, on, "inner")


def append_rows(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of both; a column one side lacks is null there."""
    return first.unionByName(second, allowMissingColumns=True)


def at_offset(df: DataFrame, lookup: DataFrame, ks: SeriesKeys, column: str, steps: int, out: str) -> DataFrame:
    """Adds the lookup table's ``column`` at ``time + steps`` by an equi-join, independent of any window."""
    shifted = lookup.select(*ks.keys, (F.col(ks.time) - ks.steps(steps)).alias(ks.time), F.col(column).alias(out))
    return df.join(shifted, ks.columns, "left")
