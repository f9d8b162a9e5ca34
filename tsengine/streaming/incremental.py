"""Features kept current: each batch recomputes only the rows its changes can reach."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsengine.plans.feature_plan import FeatureSpec, build_features
from tsengine.series import SeriesKeys
from tsengine.session import materialize
from tsengine.sources.store import FeatureGroup


def changed_ranges(changes: DataFrame, raw: FeatureGroup, ks: SeriesKeys, spec: FeatureSpec) -> DataFrame:
    """Per touched series the times whose features a change can reach, ``_from`` to ``_to``, and its ``first`` and ``last`` time.

    Targets and leads look ahead, lags look back. A change after, before or inside a gap also makes the grid rows up
    to the next row on either side. ``raw`` is the group after the change. Neighbours and series ends come from its day summaries; rows are
    read only of the dates that hold a series' first or last change, and of them only keys and times.
    """
    touched = changes.groupBy(*ks.keys).agg(F.min(ks.time).alias("_min"), F.max(ks.time).alias("_max"))
    spark, t = changes.sparkSession, F.col(ks.time)
    days = raw.days(spark).select(*ks.keys, "first", "last")
    near = raw.times(spark, raw.edge_dates(changes)).select(*ks.keys, t.alias("first"), t.alias("last"))
    around = days.unionByName(near).join(touched, list(ks.keys)).groupBy(*ks.keys, "_min", "_max").agg(
        F.max(F.when(F.col("last") < F.col("_min"), F.col("last"))).alias("_before"),
        F.min(F.when(F.col("first") > F.col("_max"), F.col("first"))).alias("_after"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
    )
    start = F.least(F.col("_min") - ks.steps(spec.ahead), F.col("_before") + ks.steps(1))
    end = F.greatest(F.col("_max") + ks.steps(spec.back), F.col("_after") - ks.steps(1))
    return around.select(*ks.keys, start.alias("_from"), end.alias("_to"), "first", "last")


def recompute(series: DataFrame, ranges: DataFrame, spec: FeatureSpec, ks: SeriesKeys) -> DataFrame:
    """Fresh features of the touched rows, from the touched series' rows inside the reach of their windows.

    The grid spans that reach as far as the series does, whether or not its edges have rows.
    """
    t = F.col(ks.time)
    low, high = F.col("_from") - ks.steps(spec.back), F.col("_to") + ks.steps(spec.ahead)
    near = series.join(ranges.drop("first", "last"), list(ks.keys)).where(t.between(low, high))
    bounds = ranges.select(*ks.keys, F.greatest("first", low).alias("first"), F.least("last", high).alias("last"))
    fresh = build_features(near.drop("_from", "_to"), spec, ks, bounds=bounds)
    ends = ranges.select(*ks.keys, "_from", "_to")
    return fresh.join(ends, list(ks.keys)).where(t.between(F.col("_from"), F.col("_to"))).drop("_from", "_to")


def apply_changes(
    raw: FeatureGroup, features: FeatureGroup, changes: DataFrame, spec: FeatureSpec, ks: SeriesKeys, commit_id: int, batch: str | None = None
) -> None:
    """One batch (one row per key): changes into the raw group, then the reached features into the feature group.

    Raw rows outside the span that any changed window needs are never read: their directories are pruned. A series' very first row anchors its grid, so aligned series are required.
    """
    if not ks.aligned:
        raise ValueError("incremental features need an aligned grid")
    spark = changes.sparkSession
    changes = materialize(changes.select(*ks.columns, *spec.measures), "changes")
    raw.commit(changes, commit_id, batch)
    ranges = materialize(changed_ranges(changes, raw, ks, spec), "ranges")
    oldest, newest = ranges.agg(F.min("_from") - ks.steps(spec.back), F.max("_to") + ks.steps(spec.ahead)).first()
    if oldest is None:
        return
    features.commit(recompute(raw.read(spark, since=oldest, until=newest), ranges, spec, ks), commit_id, batch)
