"""From a grid to service: a ledger of finished jobs, the winner as an artifact with its record, and scoring by registered name and version."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsengine.ml.frame import VECTOR, Scaler, change_column
from tsengine.ml.saved import load_forecaster, read_json, read_scaler, save_forecaster, write_json
from tsengine.plans.feature_plan import FeatureSpec
from tsengine.plans.serve import forecast_table
from tsengine.series import SeriesKeys
from tsengine.sources import metadata

_DONE = "feature_set string, model string, horizon string, job string, features array<string>, on string, evaluated string, rows bigint"


def rows_mark(table: DataFrame, ks: SeriesKeys) -> int:
    """A number that tells one table of keys and parts from another; does not depend on the order of rows."""
    return table.agg(F.bit_xor(F.xxhash64(*ks.columns, "split"))).first()[0] or 0


@dataclass(frozen=True)
class Ledger:
    """Finished jobs of an experiment under ``path``: one line per set, model and horizon, published once model and predictions are written.

    A run that is started again trains only what has no line. Lines of other rows, features or parts raise.
    """

    path: str

    def finished(self, spark: SparkSession) -> dict[tuple[str, str], object]:
        """By (set, model) a line of each finished job; as many as there are jobs."""
        try:
            lines = spark.read.schema(_DONE).parquet(f"{self.path}/done").collect()
        except AnalysisException:
            return {}
        return {(r["feature_set"], r["model"]): r for r in lines}

    def check(self, line, features: Sequence[str], evaluated: str, mark: int) -> None:
        if (list(line["features"]), line["evaluated"], line["rows"]) != (list(features), evaluated, mark):
            raise ValueError(f"{self.path} holds {line['feature_set']} of other rows, features or parts")

    def keep(self, spark: SparkSession, key: tuple[str, str], model, scaler: Scaler, on: str, predictions: DataFrame, features, evaluated: str, mark: int) -> DataFrame:
        """Writes a job's model, scaler and predictions, then its lines; returns the predictions read back."""
        job = f"{self.path}/jobs/{uuid.uuid4().hex}"
        predictions.write.parquet(f"{job}/predictions")
        save_forecaster(spark, model, f"{job}/model")
        scaler.table(spark).coalesce(1).write.parquet(f"{job}/scaler")
        lines = [(*key, str(h), job, list(features), on, evaluated, mark) for h in model.horizons]
        spark.createDataFrame(lines, _DONE).coalesce(1).write.mode("append").parquet(f"{self.path}/done")
        return spark.read.schema(predictions.schema).parquet(f"{job}/predictions")

    def recall(self, spark: SparkSession, line) -> tuple[object, Scaler, DataFrame]:
        job = line["job"]
        return load_forecaster(spark, f"{job}/model"), read_scaler(spark, f"{job}/scaler"), spark.read.parquet(f"{job}/predictions")


@dataclass
class Served:
    """All that scoring needs: features in order, components and their weights, each model with the form of its input, and the record."""

    features: list[str]
    components: list[tuple[str, float]]
    models: dict[str, object]
    forms: dict[str, str]
    scaler: Scaler | None = None
    record: dict = field(default_factory=dict)

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds each component's change columns to rows that hold the feature columns."""
        forms = {"vectors": array_to_vector(F.array(*[F.col(f).cast("double") for f in self.features]))}
        if self.scaler is not None:
            forms["scaled"] = self.scaler.varying().vector()
        for name, _ in self.components:
            if name in self.models:
                form = forms.get(self.forms[name])
                df = self.models[name].predict(df if form is None else df.withColumn(VECTOR, form))
                df = df.drop(VECTOR)
            else:  # persistence
                df = df.withColumns({change_column(name, h): F.lit(0.0) for h in self.record["horizons"]})
        return df

    def forecast(self, df: DataFrame, spec: FeatureSpec, ks: SeriesKeys) -> DataFrame:
        return forecast_table(self.predict(df), self.components, spec, ks, spec.horizons)


def winner_record(experiment, ks: SeriesKeys, evaluated: str) -> dict:
    """The best model: set, model, mean metrics, metrics per horizon, and the rows and time span it was judged on."""
    best = experiment.best().first().asDict()
    own = experiment.predictions.where((F.col("feature_set") == best["feature_set"]) & (F.col("model") == best["model"]))
    by_horizon = {r["horizon"]: {m: r[m] for m in ("rmse", "mae", "r2")} for r in experiment.metrics().collect() if (r["feature_set"], r["model"]) == (best["feature_set"], best["model"])}
    rows, first, last = own.agg(F.count("predicted"), F.min(ks.time).cast("string"), F.max(ks.time).cast("string")).first()
    span = {"part": evaluated, "predictions": rows, "first": first, "last": last}
    return {**best, "by_horizon": by_horizon, "evaluated": span, "horizons": sorted(int(h) for h in by_horizon)}


def publish_winner(spark: SparkSession, experiment, sets: dict[str, Sequence[str]], ks: SeriesKeys, registry: str, name: str, root: str, evaluated: str = "val") -> int:
    """Saves the winner with features, scaler, weights and record under ``root``, registers it and returns its version."""
    record = winner_record(experiment, ks, evaluated)
    chosen, model = record["feature_set"], record["model"]
    components = list(experiment.ensemble) if model == "ensemble" else [(model, 1.0)]
    path = f"{root}/{name}-{uuid.uuid4().hex}"
    forms, scaler = {}, None
    for part, _ in components:
        if (chosen, part) in experiment.models:
            forms[part], scaler = experiment.served[chosen, part]
            save_forecaster(spark, experiment.models[chosen, part], f"{path}/models/{part}")
    if scaler is not None:
        scaler.table(spark).coalesce(1).write.parquet(f"{path}/scaler")
    write_json(spark, f"{path}/manifest", {"features": list(sets[chosen]), "components": components, "forms": forms, "scaler": scaler is not None, "record": record})
    scores = {m: record[f"mean_{m}"] for m in ("rmse", "mae", "r2") if record[f"mean_{m}"] is not None}
    return metadata.register_model(spark, registry, name, scores, path, json.dumps({"feature_set": chosen, "model": model}))


def load_registered(spark: SparkSession, registry: str, name: str, version: int | None = None) -> Served:
    """The model registered under a name, of one version or the newest."""
    path = metadata.registered(spark, registry, name, version)["artifact_path"]
    about = read_json(spark, f"{path}/manifest")
    models = {part: load_forecaster(spark, f"{path}/models/{part}") for part in about["forms"]}
    scaler = read_scaler(spark, f"{path}/scaler") if about["scaler"] else None
    return Served(about["features"], [(m, float(w)) for m, w in about["components"]], models, about["forms"], scaler, about["record"])
