"""What every learner shares: the vector table, scaling, the fitted-model interface."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tsengine.plans.feature_plan import FeatureSpec
from tsengine.series import SeriesKeys

VECTOR = "x"


def change_column(model: str, horizon: int) -> str:
    return f"{model}_change_{horizon}"


def vector_table(
    df: DataFrame, features: Sequence[str], spec: FeatureSpec, ks: SeriesKeys, carry: Sequence[str] = ()
) -> DataFrame:
    """Keys, split, level, targets and one feature vector; the wide columns are dropped before anything is stored."""
    keep = [*ks.columns, "split", spec.level, *spec.level_targets, *spec.change_targets, *carry]
    assembled = VectorAssembler(inputCols=list(features), outputCol=VECTOR, handleInvalid="error").transform(df)
    return assembled.select(*[c for c in keep if c in df.columns], VECTOR)


@dataclass(frozen=True)
class Scaler:
    """Population mean and deviation per feature; a constant feature is only centred."""

    features: tuple[str, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]

    def columns(self) -> list[Column]:
        return [
            ((F.col(f).cast("double") - m) / (s if s > 0 else 1.0)).alias(f)
            for f, m, s in zip(self.features, self.means, self.deviations, strict=True)
        ]

    def array(self) -> Column:
        return F.array(*self.columns())

    def vector(self) -> Column:
        return array_to_vector(self.array())

    def varying(self) -> "Scaler":
        """Without the constant features, which a linear model cannot use and whose normal equations are singular."""
        kept = [t for t in zip(self.features, self.means, self.deviations, strict=True) if t[2] > 0]
        return Scaler(*zip(*kept, strict=True)) if kept else self

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, *r) for i, r in enumerate(zip(self.features, self.means, self.deviations, strict=True))]
        return spark.createDataFrame(rows, "pos int, feature string, mean double, deviation double")


def fit_scaler(df: DataFrame, features: Sequence[str]) -> Scaler:
    """Two statistics per feature from one pass over the training rows."""
    cells = [c for f in features for c in (F.avg(f).alias(f"m_{f}"), F.stddev_pop(f).alias(f"s_{f}"))]
    row = df.agg(*cells).first()
    return Scaler(tuple(features), tuple(row[f"m_{f}"] for f in features), tuple(row[f"s_{f}"] for f in features))


@dataclass
class Forecaster:
    """A fitted model: one Spark ML model per horizon over the vector column, or a custom ``transform``."""

    name: str
    horizons: tuple[int, ...]
    models: dict[int, object] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds ``{name}_change_{h}`` per horizon."""
        for h in self.horizons:
            df = self.models[h].transform(df)
        return df


def in_parallel(jobs: Sequence, threads: int = 4) -> list:
    """Independent Spark jobs submitted from a few driver threads; the work itself runs on executors."""
    with ThreadPoolExecutor(max_workers=threads) as pool:
        return [f.result() for f in [pool.submit(j) for j in jobs]]
