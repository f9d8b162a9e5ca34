"""Fitted models and ensembles as folders: weights and scalers as tables, tree models in Spark's own form, the rest as JSON."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import regression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsengine.ml.frame import Forecaster, Scaler, change_column
from tsengine.ml.linear import Ridge
from tsengine.ml.network import Network
from tsengine.ml.trees import TREE_NAMES, TreeModel

_WEIGHTS = "horizon int, weights array<double>, intercept double"


def write_json(spark: SparkSession, path: str, value: dict) -> None:
    spark.createDataFrame([(json.dumps(value),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()["value"])


def read_scaler(spark: SparkSession, path: str) -> Scaler:
    rows = spark.read.parquet(path).orderBy("pos").collect()  # one row per feature
    return Scaler(*(tuple(r[c] for r in rows) for c in ("feature", "mean", "deviation")))


def save_forecaster(spark: SparkSession, model, path: str) -> None:
    """A network with its scaler, a ridge model, or one tree model per horizon."""
    about = {"name": model.name, "horizons": list(model.horizons), "kind": type(model).__name__}
    if isinstance(model, Network):
        about["sizes"] = list(model.sizes)
        weights = spark.createDataFrame([(0, model.weights.tolist(), 0.0)], _WEIGHTS)
        weights.coalesce(1).write.mode("overwrite").parquet(f"{path}/weights")
        model.scaler.table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/scaler")
    elif isinstance(model, Ridge):
        rows = [(h, [float(w) for w in model.weights[h]], float(model.intercepts[h])) for h in model.horizons]
        spark.createDataFrame(rows, _WEIGHTS).coalesce(1).write.mode("overwrite").parquet(f"{path}/weights")
    else:
        about["classes"] = {str(h): type(m).__name__ for h, m in model.models.items()}
        for h, m in model.models.items():
            if isinstance(m, TreeModel):
                m.table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/horizon={h}")
            else:
                m.write().overwrite().save(f"{path}/horizon={h}")
        about["trees"] = {str(h): [m.base, m.out, m.vector, m.mean] for h, m in model.models.items() if isinstance(m, TreeModel)}
    write_json(spark, f"{path}/about", about)


def load_forecaster(spark: SparkSession, path: str):
    about = read_json(spark, f"{path}/about")
    name, horizons = about["name"], tuple(about["horizons"])
    if about["kind"] == "Network":
        weights = np.array(spark.read.schema(_WEIGHTS).parquet(f"{path}/weights").first()["weights"])
        return Network(name, horizons, tuple(about["sizes"]), weights, read_scaler(spark, f"{path}/scaler"))
    if about["kind"] == "Ridge":
        rows = spark.read.schema(_WEIGHTS).parquet(f"{path}/weights").collect()  # one row per horizon
        return Ridge(name, horizons, {r["horizon"]: np.array(r["weights"]) for r in rows}, {r["horizon"]: r["intercept"] for r in rows})
    models = {int(h): getattr(regression, c).load(f"{path}/horizon={h}") for h, c in about["classes"].items() if h not in about["trees"]}
    for h, how in about["trees"].items():
        rows = spark.read.parquet(f"{path}/horizon={h}").orderBy("tree").collect()  # a model
        models[int(h)] = TreeModel([[r[c] for c in TREE_NAMES] for r in rows], *how[:3], mean=how[3])
    return Forecaster(name, horizons, models)


@dataclass
class Ensemble:
    """What serving needs: the feature list in order, the component models and their weights."""

    features: list[str]
    components: list[tuple[str, float]]
    models: dict[str, object] = field(default_factory=dict)

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds each component's change columns; ``df`` has the feature columns and their vector."""
        for model in self.models.values():
            df = model.predict(df)
        return df


def save_ensemble(spark: SparkSession, ensemble: Ensemble, path: str) -> None:
    for name, model in ensemble.models.items():
        save_forecaster(spark, model, f"{path}/models/{name}")
    write_json(spark, f"{path}/ensemble", {"features": ensemble.features, "components": ensemble.components, "models": list(ensemble.models)})


def load_ensemble(spark: SparkSession, path: str) -> Ensemble:
    about = read_json(spark, f"{path}/ensemble")
    models = {name: load_forecaster(spark, f"{path}/models/{name}") for name in about["models"]}
    return Ensemble(about["features"], [(m, float(w)) for m, w in about["components"]], models)


def greatest_differences(before: DataFrame, after: DataFrame, keys: Sequence[str], names: Sequence[str], horizons: Sequence[int]) -> DataFrame:
    """(model, horizon, rows, greatest_difference) between two sets of predictions of the same rows."""
    columns = [change_column(n, h) for n in names for h in horizons]
    both = before.select(*keys, *columns).join(after.select(*keys, *[F.col(c).alias(f"_{c}") for c in columns]), list(keys))
    cells = [
        F.struct(F.lit(n).alias("model"), F.lit(h).alias("horizon"), F.count(change_column(n, h)).alias("rows"), F.max(F.abs(F.col(change_column(n, h)) - F.col(f"_{change_column(n, h)}"))).alias("greatest_difference"))
        for n in names
        for h in horizons
    ]
    return both.agg(F.array(*cells).alias("_c")).select(F.inline("_c"))
