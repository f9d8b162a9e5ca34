"""Feature rows at "now": history and a live window merged, then the same feature plan as training."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsengine.operators.clean import dedup_by_key, keep_columns, now_times, project_features, split_on_nulls
from tsengine.operators.joins import append_rows
from tsengine.plans.feature_plan import FeatureSpec, build_features
from tsengine.series import SeriesKeys
from tsengine.session import materialize


def live_times(history: DataFrame, live: DataFrame, ks: SeriesKeys, now: datetime, ends: DataFrame | None = None) -> DataFrame:
    """Per series of either table ``_now``: ``now``, or the series' last time when it ends earlier, floored to a step.

    Given ``ends`` (series, ``last``) of the history, as a feature group keeps them, the history is not read.
    """
    past = history.select(*ks.columns) if ends is None else ends.select(*ks.keys, F.col("last").alias(ks.time))
    both = past.unionByName(live.select(*ks.columns))
    return now_times(both, ks, now, "_now")


def merge_live(history: DataFrame, live: DataFrame, spec: FeatureSpec, ks: SeriesKeys) -> DataFrame:
    """Rows of both, the live value winning where both have a time."""
    columns = [*ks.columns, *spec.measures]
    both = append_rows(
        keep_columns(history, columns).withColumn("_seq", F.lit(0)), keep_columns(live, columns).withColumn("_seq", F.lit(1))
    )
    return dedup_by_key(both, ks.columns, "_seq", "last").drop("_seq")


def live_features(history: DataFrame, live: DataFrame, spec: FeatureSpec, ks: SeriesKeys, now: datetime, ends: DataFrame | None = None) -> DataFrame:
    """One row per series at ``now`` (or its last step when it ends earlier) with every feature of ``spec``.

    A series without a row at that step, such as one whose only row lies off the grid, comes with null features, so
    ``model_inputs`` rejects it by name. Series ends come from ``ends`` where given (see ``live_times``), else from keys and times alone. Both tables are cut to the steps that windows reach
    before rows are merged, by bounds on the time that reach the scan and by each series' own now.
    """
    spec = spec.without_targets()
    at = materialize(live_times(history, live, ks, now, ends), "live-times")
    first, last = at.agg(F.min("_now"), F.max("_now")).first()  # two times
    if first is None:
        return build_features(merge_live(history, live, spec, ks), spec, ks)
    back, ahead = ks.steps(spec.back), ks.steps(spec.ahead)
    t = F.col(ks.time)
    reach = (t >= F.lit(first).cast("timestamp_ntz") - back) & (t <= F.lit(last).cast("timestamp_ntz") + ahead)

    def near(df: DataFrame) -> DataFrame:
        cut = df.where(reach).join(at, list(ks.keys))
        return cut.where(t.between(F.col("_now") - back, F.col("_now") + ahead)).drop("_now")

    features = build_features(merge_live(near(history), near(live), spec, ks), spec, ks)
    return features.join(at.withColumnRenamed("_now", ks.time), ks.columns, "right")


def model_inputs(rows: DataFrame, features: Sequence[str], spec: FeatureSpec, ks: SeriesKeys) -> tuple[DataFrame, DataFrame]:
    """(rows ready to score in list order, rejected rows with their null columns).

    A missing level rejects a row like a missing feature: no forecast can be added to it. The rows are written once, because both halves
    and every model of an ensemble read them.
    """
    carry = [*ks.columns, *([] if spec.level in features else [spec.level])]
    return split_on_nulls(materialize(project_features(rows, features, "strict", carry=carry), "live"), [*features, *carry[len(ks.columns) :]])
