"""Small metadata tables: feature lists, experiment results, saved models, the model registry."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsengine.session import claim

FEATURE_LIST = "set_name string, pos int, feature string"


def parse_feature_list(text: str) -> list[str]:
    """A JSON list, or an object with ``feature_columns`` or ``features``."""
    value = json.loads(text)
    if isinstance(value, dict):
        value = value.get("feature_columns", value.get("features"))
    if not isinstance(value, list) or not all(isinstance(v, str) for v in value):
        raise ValueError("expected a list of feature names")
    return value


def feature_list_table(spark: SparkSession, sets: dict[str, Sequence[str]]) -> DataFrame:
    return spark.createDataFrame([(s, i, f) for s, names in sets.items() for i, f in enumerate(names)], FEATURE_LIST)


def write_feature_lists(spark: SparkSession, path: str, sets: dict[str, Sequence[str]]) -> None:
    feature_list_table(spark, sets).coalesce(1).write.mode("overwrite").parquet(path)


def read_feature_list(spark: SparkSession, path: str, set_name: str) -> list[str]:
    """Names in stored order; bounded by the number of columns of a table."""
    rows = spark.read.schema(FEATURE_LIST).parquet(path).where(F.col("set_name") == set_name).orderBy("pos").collect()
    if not rows:
        raise ValueError(f"no feature set {set_name}")
    return [r["feature"] for r in rows]


def results_wide(long: DataFrame, horizons: Sequence[int]) -> DataFrame:
    """One row per feature set and model, metrics of each horizon side by side, ordered by mean rmse."""
    metrics = ("rmse", "mae", "r2")
    wide = (
        long.groupBy("feature_set", "model")
        .pivot("horizon", list(horizons))
        .agg(*[F.first(m).alias(m) for m in metrics])
    )
    means = long.groupBy("feature_set", "model").agg(*[F.avg(m).alias(f"mean_{m}") for m in metrics])
    named = wide.select("feature_set", "model", *[F.col(f"{h}_{m}").alias(f"{m}_{h}") for m in metrics for h in horizons])
    return means.join(named, ["feature_set", "model"]).orderBy("mean_rmse", "feature_set", "model")


def write_results(long: DataFrame, best: DataFrame, path: str, horizons: Sequence[int]) -> None:
    """Long and wide results and the winner; all are a few rows per experiment."""
    long.write.mode("overwrite").json(f"{path}/long")
    results_wide(long, horizons).coalesce(1).write.mode("overwrite").option("header", True).csv(f"{path}/wide")
    best.coalesce(1).write.mode("overwrite").json(f"{path}/best")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


REGISTRY = "name string, version int, description string, artifact_path string, metrics map<string,double>"


def registry_rows(spark: SparkSession, path: str) -> DataFrame:
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(REGISTRY).parquet(path).select(*[c.split()[0] for c in REGISTRY.split(", ")])
    except AnalysisException:
        return spark.createDataFrame([], REGISTRY)


def register_model(spark: SparkSession, path: str, name: str, metrics: dict[str, float], artifact_path: str, description: str = "") -> int:
    """Appends the next version of ``name`` and returns it.

    The number is claimed by creating its file, so two writers never get the same one; each writes its row to a folder of its own. A writer
    lost after its claim leaves a gap.
    """
    newest = registry_rows(spark, path).where(F.col("name") == name).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]
    key = hashlib.sha256(name.encode()).hexdigest()
    version = newest + 1
    while not claim(spark, f"{path}/_claims/{key}/version={version}"):
        version += 1
    row = [(name, version, description, artifact_path, {k: float(v) for k, v in metrics.items()})]
    spark.createDataFrame(row, REGISTRY).coalesce(1).write.parquet(f"{path}/entry={key}-{version}")
    return version


def registered(spark: SparkSession, path: str, name: str, version: int | None = None):
    """The row of one version of ``name``, or of its newest."""
    rows = registry_rows(spark, path).where(F.col("name") == name)
    found = (rows if version is None else rows.where(F.col("version") == version)).orderBy(F.desc("version")).first()
    if found is None:
        raise ValueError(f"no model {name}" + ("" if version is None else f" of version {version}"))
    return found
