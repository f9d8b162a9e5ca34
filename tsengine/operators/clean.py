"""Cleaning and projection: required columns, coercion, duplicate removal, null and future-row filters."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsengine.functions.scalars import finite_or_null, parse_number, parse_time
from tsengine.series import SeriesKeys, floor_time

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def keep_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the listed columns; raises if one is absent."""
    return require_columns(df, columns).select(*columns)


def dropped_null_percent(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Share of nulls in each column that ``keep_columns`` removes, in one pass."""
    extra = [c for c in df.columns if c not in keep]
    one = df.agg(*[(F.count_if(F.col(c).isNull()) * 100.0 / F.count(F.lit(1))).alias(c) for c in extra])
    return one.unpivot([], extra, "column", "null_percent")


def project_features(
    df: DataFrame,
    features: Sequence[str],
    mode: str = "strict",
    never: Sequence[str] = (),
    carry: Sequence[str] = (),
) -> DataFrame:
    """Columns in list order. ``lenient`` skips absent names with a warning; names in ``never`` are always left out."""
    missing = [f for f in features if f not in df.columns]
    if missing and mode == "strict":
        raise ValueError(f"missing features: {missing}")
    if missing:
        warnings.warn(f"skipped absent features: {missing}", stacklevel=2)
    chosen = [f for f in features if f in df.columns and f not in never]
    if not chosen:
        raise ValueError("no usable feature in the list")
    return df.select(*carry, *chosen)


def numeric_candidates(df: DataFrame, candidates: Sequence[str]) -> tuple[list[str], list[str]]:
    """(numeric, rejected) by schema."""
    types = dict(df.dtypes)
    good = [c for c in candidates if types[c] in NUMERIC or types[c].startswith("decimal")]
    return good, [c for c in candidates if c not in good]


def coerce_time(df: DataFrame, column: str, on_invalid: str = "drop") -> DataFrame:
    """Text to zone-less timestamps. Invalid text is dropped, kept as null, or fails the job when reached."""
    parsed = parse_time(F.col(column))
    if on_invalid == "raise":
        bad = F.raise_error(F.concat(F.lit(f"invalid time in {column}: "), F.col(column))).cast("timestamp_ntz")
        parsed = F.when(parsed.isNull(), bad).otherwise(parsed)
    out = df.withColumn(column, parsed)
    return out.where(F.col(column).isNotNull()) if on_invalid == "drop" else out


def coerce_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: parse_number(F.col(c)) for c in columns})


def drop_full_duplicates(df: DataFrame, seq: str) -> DataFrame:
    """Equal rows collapse to their first copy; partial aggregation drops the copies before the shuffle."""
    columns = [c for c in df.columns if c != seq]
    return df.groupBy(*columns).agg(F.min(seq).alias(seq)).select(*df.columns)


def dedup_by_key(df: DataFrame, keys: Sequence[str], seq: str, keep: str = "last") -> DataFrame:
    """One row per key, the latest or earliest by ``seq``; combines map-side, so a hot key costs one row per task."""
    return picked_rows(df, keys, seq, F.max_by if keep == "last" else F.min_by)


#: Types whose values can be kept in place in a hash aggregate.
_FIXED_WIDTH = {"tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "date", "timestamp", "timestamp_ntz"}


def picked_rows(df: DataFrame, keys: Sequence[str], order: str, pick) -> DataFrame:
    """``pick`` (max_by or min_by) of each key's rows by ``order``, which must differ between rows of one key.

    Fixed-width columns are picked one by one, which Spark hashes; text and nested ones travel as one struct, which it sorts.
    """
    types = dict(df.dtypes)
    rest = [c for c in df.columns if c not in keys]
    wide = [c for c in rest if types[c] not in _FIXED_WIDTH]
    cells = [pick(F.col(c), F.col(order)).alias(c) for c in rest if c not in wide]
    if wide:
        cells = [pick(F.struct(*rest), F.col(order)).alias("_row")]
    out = df.groupBy(*keys).agg(*cells)
    return (out.select(*keys, "_row.*") if wide else out).select(*df.columns)


def two_stage_dedup(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Full-row copies first (keep first), then one row per key (keep last); the order of the two matters."""
    return dedup_by_key(drop_full_duplicates(df, seq), keys, seq, "last")


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(keys))


def complete_cases(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(columns) if columns else None)


def infinities_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: finite_or_null(F.col(c)) for c in columns})


def trim_future(df: DataFrame, time: str, now: datetime) -> DataFrame:
    """Rows up to the current whole hour; ``now`` is a parameter so that reruns repeat."""
    return df.where(F.col(time) <= F.lit(now.replace(minute=0, second=0, microsecond=0)).cast("timestamp_ntz"))


def now_times(df: DataFrame, ks: SeriesKeys, now: datetime, out: str) -> DataFrame:
    """Per series ``now``, or the series' last time when it ends earlier, floored to a step."""
    at = F.least(F.max(ks.time), F.lit(now).cast("timestamp_ntz"))
    return df.groupBy(*ks.keys).agg(floor_time(at, ks.step_seconds).alias(out))


def now_rows(df: DataFrame, ks: SeriesKeys, now: datetime) -> DataFrame:
    """The row of each series at its own now."""
    return df.join(now_times(df, ks, now, ks.time), ks.columns, "left_semi")


def null_counts_wide(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def assert_no_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Raises with the names of the null columns; use ``split_on_nulls`` to score the good rows of a batch anyway."""
    counts = null_counts_wide(df, columns).first().asDict()
    bad = [c for c, n in counts.items() if n]
    if bad:
        raise ValueError(f"null model inputs: {bad}")
    return df


def null_reasons(columns: Sequence[str]) -> Column:
    """Names of the null columns of a row, joined by commas; empty for a usable row."""
    return F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])


def split_on_nulls(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(usable, rejected with a ``null_columns`` reason)."""
    marked = df.withColumn("null_columns", null_reasons(columns))
    return marked.where("null_columns = ''").drop("null_columns"), marked.where("null_columns <> ''")
