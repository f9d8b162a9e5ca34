"""Regression metrics of long prediction tables ``(feature_set, model, horizon, …, actual, predicted)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BY = ("feature_set", "model", "horizon")
METRICS = ("rmse", "mae", "r2")


def regression_metrics(predictions: DataFrame, by: Sequence[str] = BY, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """rmse, mae and r2 = 1 - SSE / SST per group, in one pass with map-side partials."""
    error = F.col(predicted) - F.col(actual)
    sse = F.sum(error * error)
    sst = F.var_pop(actual) * F.count(actual)
    return predictions.groupBy(*by).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.lit(1.0) - F.try_divide(sse, sst)).alias("r2"),
    )


def horizon_means(metrics: DataFrame, by: Sequence[str] = ("feature_set", "model")) -> DataFrame:
    return metrics.groupBy(*by).agg(*[F.avg(m).alias(f"mean_{m}") for m in METRICS])


def winner(summary: DataFrame, by: Sequence[str] = (), score: str = "mean_rmse", ties: Sequence[str] = ("feature_set", "model")) -> DataFrame:
    """The row with the least score, overall or per group; ties go to the first by ``ties``."""
    pick = F.min_by(F.struct(*summary.columns), F.struct(score, *ties)).alias("_row")
    return (summary.groupBy(*by) if by else summary).agg(pick).select("_row.*")
