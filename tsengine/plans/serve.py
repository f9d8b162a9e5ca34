"""Scoring feature rows of many series: component changes, blended change, level, band, alert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsengine.functions import scalars as S
from tsengine.ml.frame import change_column
from tsengine.plans.feature_plan import FeatureSpec
from tsengine.series import SeriesKeys


def forecast_table(
    scored: DataFrame, components: Sequence[tuple[str, float]], spec: FeatureSpec, ks: SeriesKeys, horizons: Sequence[int]
) -> DataFrame:
    """One row per series, time and horizon from rows that carry each component's change columns.

    The served level is not below zero; changes are rounded to 2 and levels to 1 decimals, half to even.
    """
    level = F.col(spec.level)
    cells = []
    for h in horizons:
        parts = [(w, F.col(change_column(m, h))) for m, w in components]
        change = S.blend(parts)
        cells.append(
            F.struct(
                F.lit(h).alias("horizon"),
                *[F.bround(c, 2).alias(f"{m}_change") for (m, _), (_, c) in zip(components, parts, strict=True)],
                F.bround(change, 2).alias("predicted_change"),
                F.bround(S.reconstruct(level, change, clamp=True), 1).alias("predicted_level"),
            )
        )
    long = scored.select(*ks.columns, F.bround(level, 1).alias("current_level"), F.inline(F.array(*cells)))
    return long.withColumns(
        {"band": S.band(F.col("predicted_level")), "direction": S.direction(F.col("predicted_change"))}
    )


def alert_table(forecast: DataFrame, ks: SeriesKeys) -> DataFrame:
    """Alert of each series and time by the peak of its current and forecast levels; null if one of them is missing."""
    unknown = F.count_if(F.col("current_level").isNull() | F.col("predicted_level").isNull())
    peak = F.when(unknown == 0, F.max(F.greatest("current_level", "predicted_level")))
    peaks = forecast.groupBy(*ks.columns).agg(peak.alias("peak"))
    return peaks.withColumn("alert", S.alert([F.col("peak")]))
