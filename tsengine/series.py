"""The series model: bucketed rows keyed by series and time, regular grids, chunks with halos.

Every ordered operator of this package runs over ``(series, chunk)`` instead of over a whole series. A chunk
holds a bounded run of grid steps plus copies of the neighbouring rows its frames reach (the halo), so one
series holding a third of the data still spreads over many tasks, and the result equals the whole-series window.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

MIN_CHUNK_STEPS = 4096
CHUNKS_PER_BLOCK = 1024  # keeps the arrays that unroll a very long series short
EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


@dataclass(frozen=True)
class SeriesKeys:
    """Which columns identify a series and its time, and how long one step is.

    ``aligned`` says that series start on whole steps of the epoch (as bucketed series do). When it is
    False the grid of each series is anchored at the series' own first time.
    """

    keys: tuple[str, ...] = ("series_id",)
    time: str = "time"
    step_seconds: int = 3600
    aligned: bool = True

    @property
    def columns(self) -> list[str]:
        return [*self.keys, self.time]

    def steps(self, n: int) -> Column:
        return F.expr(f"interval '{n * self.step_seconds}' second")

    def hours(self) -> float:
        return self.step_seconds / 3600


HOURLY = SeriesKeys()
DAILY = SeriesKeys(step_seconds=86400)


def _exact_seconds(column: Column) -> Column:
    """Seconds since the epoch of a zone-less timestamp, with fractions; independent of the session zone."""
    return (column - F.expr(EPOCH)).cast("interval second").cast("decimal(18,6)")


def epoch_seconds(column: Column) -> Column:
    """Whole seconds since the epoch, rounded down."""
    return F.floor(_exact_seconds(column)).cast("bigint")


def floor_div(column: Column, n: int) -> Column:
    """Integer division rounding down, for negative positions too. Exact for values below 2^53."""
    return F.floor(column / F.lit(n))


def floor_time(column: Column, step_seconds: int) -> Column:
    """Start of the epoch-aligned step a zone-less timestamp lies in."""
    return F.expr(EPOCH) + F.make_dt_interval(secs=floor_div(epoch_seconds(column), step_seconds) * step_seconds)


def period_date(column: Column, unit: str) -> Column:
    """The date itself, or the first date of its ``unit`` (week, month, quarter, year)."""
    day = column.cast("date")
    return day if unit == "day" else F.trunc(day, unit)


def bucketize(df: DataFrame, ks: SeriesKeys, event_time: str, aggregates: list[Column]) -> DataFrame:
    """Events to one row per series and tumbling step; sums combine before the shuffle."""
    bucket = floor_time(F.col(event_time), ks.step_seconds).alias(ks.time)
    return df.groupBy(*[F.col(k) for k in ks.keys], bucket).agg(*aggregates)


def restrict_with_halo(
    df: DataFrame, ks: SeriesKeys, start: datetime | None, end: datetime | None, back: int, ahead: int
) -> DataFrame:
    """Keep the rows a window over ``[start, end]`` can reach; filters reach the scan, unlike those above a Window."""
    t = F.col(ks.time)
    if start is not None:
        df = df.where(t >= F.lit(start).cast("timestamp_ntz") - ks.steps(back))
    if end is not None:
        df = df.where(t <= F.lit(end).cast("timestamp_ntz") + ks.steps(ahead))
    return df


@dataclass(frozen=True)
class ChunkedGrid:
    """Dense rows in ``(series, chunk)`` partitions; ``_core`` marks the rows that are not halo copies."""

    df: DataFrame
    ks: SeriesKeys
    window: WindowSpec
    measures: tuple[str, ...]

    def core(self, df: DataFrame) -> DataFrame:
        return df.where("_core").drop("_core", "_chunk", "_pos")


def _on_grid(time: Column, phase: Column, step: int) -> Column:
    return F.pmod(_exact_seconds(time) - phase, F.lit(step)) == 0


def _bounds(df: DataFrame, ks: SeriesKeys) -> DataFrame:
    """One row per series: ``_phase`` (offset of its grid from the epoch) and first and last step number."""
    t, step = F.col(ks.time), ks.step_seconds
    if ks.aligned:
        df = df.where(_on_grid(t, F.lit(0), step))
    first, last = epoch_seconds(F.min(t)), epoch_seconds(F.max(t))
    ends = df.groupBy(*ks.keys).agg(first.alias("_first"), last.alias("_last"))
    phase = F.lit(0).cast("bigint") if ks.aligned else F.pmod("_first", F.lit(step))
    ends = ends.withColumn("_phase", phase)
    return ends.select(
        *ks.keys,
        "_phase",
        floor_div(F.col("_first") - F.col("_phase"), step).alias("_lo"),
        floor_div(F.col("_last") - F.col("_phase"), step).alias("_hi"),
    )


def _given_bounds(bounds: DataFrame, ks: SeriesKeys) -> DataFrame:
    first, last, step = epoch_seconds(F.col("first")), epoch_seconds(F.col("last")), ks.step_seconds
    if ks.aligned:  # the whole steps inside
        lo, hi, phase = floor_div(first + (step - 1), step), floor_div(last, step), F.lit(0).cast("bigint")
    else:
        phase = F.pmod(first, F.lit(step))
        lo, hi = floor_div(first - phase, step), floor_div(last - phase, step)
    ends = bounds.select(*ks.keys, phase.alias("_phase"), lo.alias("_lo"), hi.alias("_hi"))
    return ends.where("_lo <= _hi")


def _twice(keys: list[str]) -> Column:
    return F.concat_ws(" ", F.lit("two rows of one series and time:"), *[F.col(k).cast("string") for k in keys], F.col("_pos").cast("string"))


def _positions(df: DataFrame, bounds: DataFrame, ks: SeriesKeys) -> DataFrame:
    """Adds ``_pos`` (step number) and ``_phase``; rows off the grid vanish."""
    t, phase = F.col(ks.time), F.col("_phase")
    if ks.aligned:
        df = df.withColumn("_phase", F.lit(0).cast("bigint"))
    else:
        df = df.join(bounds.select(*ks.keys, "_phase"), list(ks.keys))
    placed = df.where(_on_grid(t, phase, ks.step_seconds))
    return placed.withColumn("_pos", floor_div(epoch_seconds(t) - phase, ks.step_seconds))


def chunk_grid(
    df: DataFrame,
    ks: SeriesKeys,
    measures: list[str],
    back: int = 0,
    ahead: int = 0,
    chunk_steps: int | None = None,
    bounds: DataFrame | None = None,
) -> ChunkedGrid:
    """Regular grid from each series' first to last step, cut into chunks with halos.

    One shuffle moves the rows, keyed by ``(series, chunk)``; it serves the gap fill and every window after it.
    Each chunk travels as one marker row and is unrolled into its steps only after the shuffle, so the
    grid is never shuffled nor built by a single task. Two rows of one series and time fail the job.

    ``bounds`` (keys, ``first``, ``last``) gives each series' first and last time where the caller knows them: the grid then
    spans these, and ``df`` is read once. Series without bounds have no grid.
    """
    span = chunk_steps or max(MIN_CHUNK_STEPS, 4 * (back + ahead))
    keys = list(ks.keys)
    bounds = _bounds(df, ks) if bounds is None else _given_bounds(bounds, ks)
    placed = _positions(df.select(*ks.columns, *measures), bounds, ks)
    pos = F.col("_pos")

    wide = span * CHUNKS_PER_BLOCK
    blocks = bounds.select("*", F.explode(F.sequence(floor_div(F.col("_lo"), wide), floor_div(F.col("_hi"), wide))).alias("_block"))
    chunks = blocks.select(
        "*",
        F.explode(
            F.sequence(
                F.greatest(floor_div(F.col("_lo"), span), F.col("_block") * CHUNKS_PER_BLOCK),
                F.least(floor_div(F.col("_hi"), span), F.col("_block") * CHUNKS_PER_BLOCK + (CHUNKS_PER_BLOCK - 1)),
            )
        ).alias("_chunk"),
    )
    types = dict(df.dtypes)
    markers = chunks.select(
        *keys,
        "_phase",
        "_chunk",
        F.sequence(
            F.greatest(F.col("_lo"), F.col("_chunk") * span - back),
            F.least(F.col("_hi"), F.col("_chunk") * span + (span - 1 + ahead)),
        ).alias("_steps"),
        F.lit(0).alias("_own"),
        *[F.lit(None).cast(types[m]).alias(m) for m in measures],
    )
    home = floor_div(pos, span)
    if back or ahead:
        copies = F.explode(F.sequence(floor_div(pos - ahead, span), floor_div(pos + back, span)))
    else:
        copies = home
    rows = placed.select(*keys, "_phase", copies.alias("_chunk"), F.array(pos).alias("_steps"), F.lit(1).alias("_own"), *measures)
    dense = (
        markers.unionByName(rows)
        .repartition(*keys, "_chunk")
        .select(*keys, "_phase", "_chunk", F.explode("_steps").alias("_pos"), "_own", *measures)
        .groupBy(*keys, "_chunk", "_pos", "_phase")
        .agg(F.sum("_own").alias("_own"), *[F.max(m).alias(m) for m in measures])
        .where(F.when(F.col("_own") > 1, F.raise_error(_twice(keys))).otherwise(F.lit(True)))
        .select(
            *keys,
            F.expr(f"{EPOCH} + (_pos * {ks.step_seconds} + _phase) * interval '1' second").alias(ks.time),
            "_chunk",
            "_pos",
            (home == F.col("_chunk")).alias("_core"),
            *measures,
        )
    )
    window = Window.partitionBy(*keys, "_chunk").orderBy("_pos")
    return ChunkedGrid(dense, ks, window, tuple(measures))


def fill_gaps(df: DataFrame, ks: SeriesKeys, measures: list[str] | None = None, chunk_steps: int | None = None) -> DataFrame:
    """One row per step from each series' first to last time; missing steps carry nulls, off-grid rows vanish."""
    measures = measures or [c for c in df.columns if c not in ks.columns]
    grid = chunk_grid(df, ks, measures, chunk_steps=chunk_steps)
    return grid.core(grid.df)


def previous_value(
    df: DataFrame, keys: list[str], order: str, value: str, bucket: Column, out: str
) -> DataFrame:
    """``lag(value)`` in ``order`` within ``keys`` without one task per key.

    Rows lag inside ``(keys, bucket)``; the first row of a bucket takes the last value of the bucket before it, found by a
    window over one row per bucket. ``bucket`` must not decrease with ``order``.
    """
    rows = df.withColumn("_bucket", bucket)
    inside = Window.partitionBy(*keys, "_bucket").orderBy(order)
    rows = rows.repartition(*keys, "_bucket").withColumn(out, F.lag(value).over(inside)).withColumn(
        "_first", F.row_number().over(inside) == 1
    )
    last = df.withColumn("_bucket", bucket).groupBy(*keys, "_bucket").agg(F.max_by(value, order).alias("_last"))
    carried = last.select(*keys, "_bucket", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_bucket")).alias("_carry"))
    return (
        rows.join(carried, [*keys, "_bucket"], "left")
        .withColumn(out, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col(out)))
        .drop("_bucket", "_first", "_carry")
    )


def anchored(ks: SeriesKeys) -> SeriesKeys:
    """Same series with the grid anchored at each series' first time."""
    return replace(ks, aligned=False)
