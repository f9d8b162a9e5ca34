"""Profiles of a table: sizes, nulls, infinities, duplicates, target statistics, gaps, order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsengine.series import SeriesKeys, epoch_seconds, floor_div, previous_value

GAP_BUCKET_STEPS = 65536


def dataset_profile(df: DataFrame, ks: SeriesKeys) -> DataFrame:
    return df.groupBy(*ks.keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.min(ks.time).alias("min_time"),
        F.max(ks.time).alias("max_time"),
    )


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, nulls), all columns counted in one pass."""
    columns = list(columns or df.columns)
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return one.unpivot([], columns, "column", "nulls")


def top_null_columns(df: DataFrame, k: int, columns: Sequence[str] | None = None) -> DataFrame:
    return null_counts(df, columns).orderBy(F.desc("nulls"), "column").limit(k)


def infinity_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    one = df.agg(*[F.count_if(F.abs(F.col(c)) == float("inf")).alias(c) for c in columns])
    return one.unpivot([], list(columns), "column", "infinities")


def duplicate_count(df: DataFrame, keys: Sequence[str], out: str = "duplicates") -> DataFrame:
    """Rows beyond the first of each key, and all rows. Copies combine map-side, so a hot key does not concentrate."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return per_key.agg(total(F.col("_n") - 1).alias(out), total(F.col("_n")).alias("n_rows"))


def target_statistics(df: DataFrame, targets: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(target, mean, std, min, max) in long form; sample deviation."""
    long = df.unpivot(list(by), list(targets), "target", "value")
    return long.groupBy(*by, "target").agg(
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )


def with_previous_time(df: DataFrame, ks: SeriesKeys) -> DataFrame:
    bucket = floor_div(epoch_seconds(F.col(ks.time)), ks.step_seconds * GAP_BUCKET_STEPS)
    return previous_value(df, list(ks.keys), ks.time, ks.time, bucket, "previous_time")


def gap_rows(df: DataFrame, ks: SeriesKeys) -> DataFrame:
    """The row after each gap, with the time before it."""
    seen = with_previous_time(df, ks)
    return seen.where(F.col(ks.time) - F.col("previous_time") != ks.steps(1)).select(*ks.columns, "previous_time")


def gap_summary(df: DataFrame, ks: SeriesKeys) -> DataFrame:
    seen = with_previous_time(df, ks)
    gaps = F.count_if(F.col(ks.time) - F.col("previous_time") != ks.steps(1))
    return seen.groupBy(*ks.keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        gaps.alias("gaps"),
        (gaps * 100.0 / F.count(F.lit(1))).alias("gap_percent"),
    )


def order_breaks(df: DataFrame, keys: Sequence[str], seq: str, time: str, bucket_rows: int = 1 << 20) -> DataFrame:
    """Rows earlier than the row stored before them, per series; 0 means non-decreasing order."""
    bucket = floor_div(F.col(seq).cast("bigint"), bucket_rows)
    seen = previous_value(df.select(*keys, seq, time), list(keys), seq, time, bucket, "_before")
    return seen.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("_before") > F.col(time)).alias("order_breaks")
    )


def edge_rows(df: DataFrame, order: Sequence[str], n: int, last: bool = False) -> DataFrame:
    """First or last ``n`` rows in order: a bounded top-n, no full sort."""
    columns = [F.desc(c) if last else F.asc(c) for c in order]
    return df.orderBy(*columns).limit(n)
