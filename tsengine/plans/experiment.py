"""Feature sets times models times horizons: fits, one long prediction table, metrics and winners."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsengine.functions.scalars import reconstruct
from tsengine.ml import boosting, forest, linear, network
from tsengine.ml.frame import VECTOR, Scaler, change_column, fit_scaler, vector_table
from tsengine.operators.metrics import horizon_means, regression_metrics, winner
from tsengine.plans.feature_plan import FeatureSpec
from tsengine.plans.winners import Ledger, rows_mark
from tsengine.series import SeriesKeys
from tsengine.session import materialize

# The parts of the weighted ensemble.
ENSEMBLE = (("boosted_b", 0.5), ("network", 0.5))


@dataclass
class SetData:
    """One feature set's tables: wide rows for the network, raw and scaled vectors for the others, by part."""

    wide: DataFrame
    vectors: DataFrame
    scaled: DataFrame
    scaler: Scaler
    features: list[str]
    spec: FeatureSpec
    ks: SeriesKeys

    def part(self, table: str, *parts: str) -> DataFrame:
        return getattr(self, table).where(F.col("split").isin(*parts))


def prepare(table: DataFrame, features: Sequence[str], spec: FeatureSpec, ks: SeriesKeys) -> SetData:
    """``table`` carries a ``split`` column. The scaler sees training rows only; vectors are written once per set."""
    scaler = fit_scaler(table.where("split = 'train'"), features)
    both = vector_table(table.withColumn("_scaled", scaler.varying().vector()), features, spec, ks, carry=("_scaled",))
    stored = materialize(both, "vectors")
    scaled = stored.drop(VECTOR).withColumnRenamed("_scaled", VECTOR)
    return SetData(table, stored.drop("_scaled"), scaled, scaler, list(features), spec, ks)


def long_predictions(wide: DataFrame, name: str, feature_set: str, spec: FeatureSpec, ks: SeriesKeys) -> DataFrame:
    """(feature_set, model, horizon, keys, actual, predicted); predicted = level + change, not clamped."""
    cells = [
        F.struct(
            F.lit(str(h)).alias("horizon"),
            F.col(spec.level_target_name(h)).alias("actual"),
            reconstruct(F.col(spec.level), F.col(change_column(name, h)), clamp=False).alias("predicted"),
        )
        for h in spec.horizons
    ]
    return wide.select(F.lit(feature_set).alias("feature_set"), F.lit(name).alias("model"), *ks.columns, F.inline(F.array(*cells)))


def persistence(df: DataFrame, spec: FeatureSpec, name: str = "persistence") -> DataFrame:
    return df.withColumns({change_column(name, h): F.lit(0.0) for h in spec.horizons})


def default_trainers() -> dict[str, Callable[[SetData], tuple[object, str]]]:
    """Name to a function that fits and says which table it predicts on."""

    def fit_forest(d: SetData):
        return forest.train_forest(d.part("vectors", "train"), d.part("vectors", "train", "val"), d.spec, d.ks), "vectors"

    def fit_ridge(d: SetData):
        return linear.train_ridge(d.part("scaled", "train", "val"), d.spec, d.ks), "scaled"

    def boosted(name: str, grid):
        def fit(d: SetData):
            parts = d.part("vectors", "train"), d.part("vectors", "val"), d.part("vectors", "train", "val")
            return boosting.train_boosted(*parts, d.spec, name, grid), "vectors"

        return fit

    def fit_network(d: SetData):
        labels = d.spec.change_targets
        return network.train_network(d.part("wide", "train"), d.part("wide", "val"), d.scaler, labels, d.spec.horizons), "wide"

    return {
        "forest": fit_forest,
        "ridge": fit_ridge,
        "boosted_a": boosted("boosted_a", boosting.FAMILY_A),
        "boosted_b": boosted("boosted_b", boosting.FAMILY_B),
        "network": fit_network,
    }


@dataclass
class Experiment:
    predictions: DataFrame
    models: dict[tuple[str, str], object] = field(default_factory=dict)
    #: By set and model the form of the rows it predicts on, and the set's scaler.
    served: dict[tuple[str, str], tuple[str, Scaler]] = field(default_factory=dict)
    ensemble: Sequence[tuple[str, float]] = ()

    def metrics(self) -> DataFrame:
        return regression_metrics(self.predictions)

    def summary(self) -> DataFrame:
        return horizon_means(self.metrics())

    def best(self) -> DataFrame:
        return winner(self.summary())


def blend_predictions(predictions: DataFrame, keys: Sequence[str], parts: Sequence[tuple[str, float]], name: str) -> DataFrame:
    """Weighted sum of several models' levels per row; weights sum to 1, so blending levels blends changes."""
    weight = F.coalesce(*[F.when(F.col("model") == m, F.lit(w)) for m, w in parts])
    chosen = predictions.where(F.col("model").isin([m for m, _ in parts]))
    return chosen.groupBy("feature_set", *keys, "horizon").agg(
        F.first("actual").alias("actual"), F.sum(F.col("predicted") * weight).alias("predicted")
    ).withColumn("model", F.lit(name))


def run_experiment(
    table: DataFrame,
    sets: dict[str, Sequence[str]],
    spec: FeatureSpec,
    ks: SeriesKeys,
    trainers: dict[str, Callable] | None = None,
    evaluate_on: str = "val",
    ensemble: Sequence[tuple[str, float]] = ENSEMBLE,
    ledger: Ledger | None = None,
) -> Experiment:
    """Every model of every set, evaluated on one part.

    ``evaluate_on="val"`` picks winners without touching the test rows; ``"test"`` is the historical way. With a ``ledger`` each job is
    kept when it ends, and one that is kept already is read back and not trained again.
    """
    trainers = default_trainers() if trainers is None else trainers
    columns = ["feature_set", "model", *ks.columns, "horizon", "actual", "predicted"]
    spark, parts, models, served = table.sparkSession, [], {}, {}
    mark = rows_mark(table, ks) if ledger else 0
    finished = ledger.finished(spark) if ledger else {}
    for set_name, features in sets.items():
        data = None
        base = persistence(table.where(F.col("split") == evaluate_on), spec)
        parts.append(long_predictions(base, "persistence", set_name, spec, ks).select(*columns))
        for name, train in trainers.items():
            key = set_name, name
            if key in finished:
                ledger.check(finished[key], features, evaluate_on, mark)
                models[key], scaler, known = ledger.recall(spark, finished[key])
                served[key] = finished[key]["on"], scaler
                parts.append(known.select(*columns))
                continue
            data = data or prepare(table, features, spec, ks)
            model, on = train(data)
            models[key], served[key] = model, (on, data.scaler)
            predicted = long_predictions(model.predict(data.part(on, evaluate_on)), name, set_name, spec, ks).select(*columns)
            kept = ledger.keep(spark, key, model, data.scaler, on, predicted, features, evaluate_on, mark) if ledger else materialize(predicted, "predictions")
            parts.append(kept)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    names = [m for m, _ in ensemble]
    if all(n in trainers for n in names):
        out = out.unionByName(blend_predictions(out, ks.columns, ensemble, "ensemble").select(*columns))
    return Experiment(materialize(out, "predictions"), models, served, tuple(ensemble))
