"""Feature selection: correlation, relevance, pruning, top features per horizon, feature sets.

Passes over the data are Spark jobs; what reaches the driver is one number per feature or pair of features.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsengine.functions.scalars import row_mean

# The correlation limit, the features per horizon of each set, and the name prefixes of the breakdown.
CORRELATION_LIMIT = 0.95
SET_SIZES = (50, 70, 90, 110, 130)
FAMILY_PREFIXES = (("forecast_", "forecast"), ("aqi_lag_", "lags"), ("aqi_rolling_", "rolling"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Pearson matrix from one distributed pass over centred rows; constant columns give NaN. Rows must be complete."""
    rows = VectorAssembler(inputCols=list(columns), outputCol="_v").transform(df.select(*columns)).select("_v")
    return Correlation.corr(rows, "_v").first()[0].toArray()


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, abs_corr) for each pair a < b by position."""
    matrix = np.abs(correlation_matrix(df, columns))
    pairs = [
        (a, b, None if np.isnan(matrix[i, j]) else float(matrix[i, j]))
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
        if i < j
    ]
    return df.sparkSession.createDataFrame(pairs, "a string, b string, abs_corr double")


def relevance(df: DataFrame, features: Sequence[str], targets: dict[str, Column]) -> DataFrame:
    """(target, feature, relevance): absolute correlation with each target, 0 where undefined.

    One pass for all targets: rows unroll to (feature, x, targets) and combine map-side, so one row per feature and
    task is shuffled. A row counts for a target when both values are present.
    """
    ys = {f"_y{i}": (name, c) for i, (name, c) in enumerate(targets.items())}
    wide = df.select(
        *[c.cast("double").alias(y) for y, (_, c) in ys.items()], *[F.col(f).cast("double").alias(f) for f in features]
    )
    long = wide.unpivot(list(ys), list(features), "feature", "_x").where("_x is not null")
    cells = []
    for y, (name, _) in ys.items():
        x = F.when(F.col(y).isNotNull(), F.col("_x"))
        spread = F.stddev_samp(x) * F.stddev_samp(y)
        score = F.coalesce(F.abs(F.try_divide(F.covar_samp(x, F.col(y)), spread)), F.lit(0.0))
        cells.append(F.struct(F.lit(name).alias("target"), score.alias("relevance")))
    return long.groupBy("feature").agg(F.array(*cells).alias("_c")).select("feature", F.inline("_c")).select("target", "feature", "relevance")


def mean_target(targets: Sequence[str]) -> Column:
    return row_mean([F.col(t) for t in targets])


def prune(features: Sequence[str], scores: dict[str, float], matrix: np.ndarray, limit: float = CORRELATION_LIMIT):
    """(kept, dropped reason by name). Best score first, name breaks ties; a feature stays unless it correlates above
    ``limit`` with one already kept. Undefined correlation keeps it."""
    place = {f: i for i, f in enumerate(features)}
    strength = np.nan_to_num(np.abs(matrix), nan=0.0)
    kept: list[str] = []
    reasons: dict[str, str] = {}
    for f in sorted(features, key=lambda name: (-scores[name], name)):
        rivals = [k for k in kept if strength[place[f], place[k]] > limit]
        if rivals:
            reasons[f] = f"correlated {strength[place[f], place[rivals[0]]]:.3f} with {rivals[0]}"
        else:
            kept.append(f)
    return kept, reasons


def select_uncorrelated(df: DataFrame, features: Sequence[str], targets: Sequence[str], limit: float = CORRELATION_LIMIT):
    """Relevance and correlations from a single pass (the mean target rides along as a last column), then pruning."""
    columns = [*features, "_y"]
    matrix = correlation_matrix(df.withColumn("_y", mean_target(targets)), columns)
    scores = {f: round(abs(float(np.nan_to_num(matrix[i, -1]))), 9) for i, f in enumerate(features)}
    kept, reasons = prune(features, scores, matrix[:-1, :-1], limit)
    return kept, reasons, scores


def top_features(scores: DataFrame, n: int, score: str = "importance", by: Sequence[str] = ("horizon",)) -> DataFrame:
    """The ``n`` best features of each group, name breaking ties; the input is one row per feature."""
    ranked = Window.partitionBy(*by).orderBy(F.desc(score), "feature")
    return scores.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= n)


def feature_sets(scores: DataFrame, sizes: Sequence[int] = SET_SIZES, score: str = "importance") -> DataFrame:
    """(set_name, pos, feature): per size the union over horizons of the top features, in name order."""
    ranked = top_features(scores, max(sizes), score)
    fitting = F.explode(F.array(*[F.when(F.col("rank") <= n, F.lit(f"FS{n}")) for n in sizes]))
    tops = ranked.select(fitting.alias("set_name"), "feature").where("set_name is not null").distinct()
    order = Window.partitionBy("set_name").orderBy("feature")
    return tops.withColumn("pos", (F.row_number().over(order) - 1).cast("int")).select("set_name", "pos", "feature")


def family_breakdown(sets: DataFrame, prefixes: Sequence[tuple[str, str]] = FAMILY_PREFIXES) -> DataFrame:
    family = None
    for prefix, name in prefixes:
        hit = F.col("feature").startswith(prefix)
        family = F.when(hit, name) if family is None else family.when(hit, name)
    return sets.groupBy("set_name", family.otherwise("other").alias("family")).agg(F.count(F.lit(1)).alias("features"))
