"""Chronological splits and expanding folds. Cut times are scalars per table; rows are labelled, never moved."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsengine.series import SeriesKeys


def _last_time(df: DataFrame, ks: SeriesKeys):
    last = df.agg(F.max(ks.time)).first()[0]
    if last is None:
        raise ValueError("the table is empty")
    return last


def _at(value) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def chronological_split(
    df: DataFrame, ks: SeriesKeys, test: timedelta, validation: timedelta, embargo: timedelta = timedelta(0)
) -> DataFrame:
    """Adds ``split``: the last ``test`` span, the ``validation`` span before it, earlier rows ``train``.

    ``embargo`` removes the rows just before each cut, whose targets reach into the next span.
    """
    last = _last_time(df, ks)
    cut_test = last - test
    cut_val = cut_test - validation
    t = F.col(ks.time)
    label = (
        F.when(t >= _at(cut_test), "test")
        .when((t >= _at(cut_val)) & (t < _at(cut_test - embargo)), "val")
        .when(t < _at(cut_val - embargo), "train")
    )
    return df.withColumn("split", label).where(F.col("split").isNotNull())


def check_split(df: DataFrame, least: int = 72) -> dict[str, int]:
    """Raises on an empty train part or fewer than ``least`` validation or test rows."""
    sizes = {r["split"]: r["n"] for r in df.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get("train"):
        raise ValueError("training part is empty")
    for part in ("val", "test"):
        if sizes.get(part, 0) < least:
            raise ValueError(f"{part} part has fewer than {least} rows")
    return sizes


def selection_rows(df: DataFrame, ks: SeriesKeys, excluded: timedelta, least: int = 1000) -> DataFrame:
    """Rows before the last ``excluded`` span, for choosing features without seeing the evaluation span."""
    early = df.where(F.col(ks.time) < _at(_last_time(df, ks) - excluded))
    if early.select(ks.time).limit(least).count() < least:
        raise ValueError(f"fewer than {least} rows to select features on")
    return early


def expanding_folds(df: DataFrame, ks: SeriesKeys, k: int) -> DataFrame:
    """(fold, train_end, test_end): fold ``i`` trains on times before ``train_end`` and tests up to ``test_end``.

    Folds are cut on distinct times, so a time is never split. Every fold tests ``n // (k + 1)`` times, the first
    train part takes the remainder. Distinct times are numbered by counting per day first, then per minute of the days that hold
    a cut; only the distinct times of a minute with a cut are ranked one by one.
    """
    times = df.select(F.col(ks.time).alias("t")).distinct()
    times = times.select("t", F.date_trunc("day", "t").alias("day"), F.date_trunc("minute", "t").alias("minute"))
    # One row per calendar day of the table: a few thousand rows for decades.
    days = times.groupBy("day").agg(F.count(F.lit(1)).alias("n")).collect()
    total = sum(r["n"] for r in days)
    size = total // (k + 1)
    if size == 0:
        raise ValueError(f"{total} distinct times are too few for {k} folds")
    cuts = [total - (k - i) * size for i in range(k)] + [total]
    by_day = _holding(sorted((r["day"], r["n"]) for r in days), dict.fromkeys(cuts, 0))
    inside = times.where(F.col("day").isin([d for d, _ in by_day.values()]))
    minutes: dict = {}
    for r in inside.groupBy("day", "minute").agg(F.count(F.lit(1)).alias("n")).collect():  # at most 1440 for each of k + 1 days
        minutes.setdefault(r["day"], []).append((r["minute"], r["n"]))
    by_minute = {c: _holding(sorted(minutes[d]), {c: before})[c] for c, (d, before) in by_day.items()}
    spark = df.sparkSession
    places = spark.createDataFrame([(m, c, c - before) for c, (m, before) in by_minute.items()], "minute timestamp_ntz, cut bigint, rank bigint")
    near = inside.where(F.col("minute").isin([m for m, _ in by_minute.values()]))
    ranked = near.withColumn("place", F.row_number().over(Window.partitionBy("minute").orderBy("t")))
    found = ranked.join(F.broadcast(places), "minute").where("place = rank")  # k + 1 rows
    ends = {r["cut"]: r["t"] for r in found.select("cut", "t").collect()}
    rows = [(i, cuts[i], ends[cuts[i]], cuts[i + 1] - cuts[i], ends[cuts[i + 1]]) for i in range(k)]
    return spark.createDataFrame(
        rows, "fold int, train_times bigint, train_end timestamp_ntz, test_times bigint, test_end timestamp_ntz"
    )


def _holding(counted: list[tuple], cuts: dict[int, int]) -> dict[int, tuple]:
    """For each cut (a rank, and the rank that the first part begins after) the part that holds it, and the rank before that part."""
    out = {}
    for cut, seen in cuts.items():
        for part, n in counted:
            if seen < cut <= seen + n:
                out[cut] = (part, seen)
            seen += n
    return out


def fold_parts(df: DataFrame, ks: SeriesKeys, fold) -> tuple[DataFrame, DataFrame]:
    """(train, test) rows of one fold row; bounds are inclusive last times."""
    t = F.col(ks.time)
    train = df.where(t <= _at(fold["train_end"]))
    return train, df.where((t > _at(fold["train_end"])) & (t <= _at(fold["test_end"])))
