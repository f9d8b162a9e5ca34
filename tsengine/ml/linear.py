"""Ridge regression over scaled features with expanding-fold choice of the penalty, from sums of products.

One pass over the rows gives, for each stretch of time between fold cuts, the matrix of products of all features and labels. Every fit and every
fold error of every penalty follows from sums of these matrices, whose size depends on the number of features alone.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsengine.ml.frame import VECTOR, change_column
from tsengine.operators.split import expanding_folds
from tsengine.plans.feature_plan import FeatureSpec
from tsengine.series import SeriesKeys

# The penalties to try and the number of folds.
ALPHAS = (0.1, 1.0, 5.0, 10.0, 50.0, 100.0)
FOLDS = 4

_PART = "stretch int, part int, products binary"


def rmse_of(model, rows: DataFrame, label: str, out: str) -> float:
    return RegressionEvaluator(labelCol=label, predictionCol=out, metricName="rmse").evaluate(model.transform(rows))


def product_sums(rows: DataFrame, labels: Sequence[str], stretch, vector: str = VECTOR) -> dict[int, np.ndarray]:
    """Per ``stretch`` the sum over its rows of z z', z = (1, features, labels); partial sums per task, then per 32 tasks, then all."""

    def multiply(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, sums = TaskContext.get().partitionId() % 32, {}
        for batch in batches:
            place = batch.column(0).to_numpy(zero_copy_only=False)
            z = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(place), -1) if len(place) else None
            for s in np.unique(place).tolist():
                own = z[place == s]
                sums[s] = sums.get(s, 0) + own.T @ own
        for s, m in sums.items():
            yield pa.record_batch({"stretch": pa.array([s], pa.int32()), "part": pa.array([part], pa.int32()), "products": pa.array([m.tobytes()], pa.binary())})

    def add(table):
        import pyarrow as pa

        total = sum(np.frombuffer(p.as_buffer()) for p in table["products"])
        return pa.table({"stretch": table["stretch"][:1], "part": table["part"][:1], "products": pa.array([total.tobytes()], pa.binary())})

    z = F.concat(F.array(F.lit(1.0)), vector_to_array(vector), F.array(*[F.col(c).cast("double") for c in labels]))
    parts = rows.select(stretch.cast("int").alias("stretch"), z.alias("z")).mapInArrow(multiply, _PART)
    found = parts.groupBy("stretch", "part").applyInArrow(add, _PART).groupBy("stretch").applyInArrow(add, _PART).collect()
    out = {}
    for r in found:
        m = np.frombuffer(r["products"])
        out[r["stretch"]] = m.reshape(math.isqrt(len(m)), -1)
    return out


def solve_ridge(products: np.ndarray, outputs: int, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """(coefficients by feature and label, intercepts): squared error plus ``alpha`` times the squared coefficients; intercepts are free."""
    n, p = products[0, 0], len(products) - 1 - outputs
    means = products[0] / n
    centred = products[1:, 1:] - n * np.outer(means[1:], means[1:])
    weights = np.linalg.solve(centred[:p, :p] + alpha * np.eye(p), centred[:p, p:])
    return weights, means[1 + p :] - means[1 : 1 + p] @ weights


def squared_errors(products: np.ndarray, weights: np.ndarray, intercepts: np.ndarray) -> np.ndarray:
    """Sum of squared errors per label over the rows behind ``products``."""
    v = np.vstack([-intercepts, -weights, np.eye(weights.shape[1])])
    return np.maximum(np.einsum("ij,ik,kj->j", v, products, v), 0)


@dataclass
class Ridge:
    """Coefficients per horizon over the scaled vector."""

    name: str
    horizons: tuple[int, ...]
    weights: dict[int, np.ndarray] = field(default_factory=dict)
    intercepts: dict[int, float] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)

    def predict(self, df: DataFrame) -> DataFrame:
        x = vector_to_array(VECTOR)
        for h in self.horizons:
            w = F.array(*[F.lit(float(v)) for v in self.weights[h]])
            product = F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
            df = df.withColumn(change_column(self.name, h), product + F.lit(float(self.intercepts[h])))
        return df


def train_ridge(
    rows: DataFrame, spec: FeatureSpec, ks: SeriesKeys, alphas: Sequence[float] = ALPHAS, folds: int = FOLDS, name: str = "ridge"
) -> Ridge:
    """``rows`` are the scaled vectors of the train and validation parts."""
    cuts = sorted(expanding_folds(rows, ks, folds).collect(), key=lambda r: r["fold"])  # one row per fold
    ends = [cuts[0]["train_end"], *[c["test_end"] for c in cuts[:-1]]]
    stretch = sum(((F.col(ks.time) > F.lit(e).cast("timestamp_ntz")).cast("int") for e in ends), F.lit(0))
    labels = [spec.change_target_name(h) for h in spec.horizons]
    parts = product_sums(rows, labels, stretch)
    empty = np.zeros_like(next(iter(parts.values())))
    parts = [parts.get(i, empty) for i in range(folds + 1)]
    out, everything = Ridge(name, spec.horizons), sum(parts)
    errors = {}
    for alpha in alphas:
        rmse = np.zeros(len(labels))
        for fold in range(folds):
            fit = solve_ridge(sum(parts[: fold + 1]), len(labels), alpha)
            test = parts[fold + 1]
            rmse += np.sqrt(squared_errors(test, *fit) / test[0, 0]) / folds
        errors[alpha] = rmse
    for i, h in enumerate(spec.horizons):
        best = min(alphas, key=lambda a: (errors[a][i], a))
        weights, intercepts = solve_ridge(everything, len(labels), best)
        out.weights[h], out.intercepts[h] = weights[:, i], float(intercepts[i])
        out.notes[h] = {"alpha": best, "cv_rmse": float(errors[best][i])}
    return out
