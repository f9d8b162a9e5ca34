"""A multi-output network trained data-parallel: every shard runs one epoch of mini-batch steps, results are averaged.

Shards are logical: a row belongs to one by the hash of its inputs, and the number of shards is a parameter, so the same rows meet in the
same order on any cluster. An epoch is one Spark job over the shards; weights travel to the tasks as a broadcast (their
size is fixed by the layers), and the shards' weights meet in a distributed mean weighted by rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsengine.ml.frame import Scaler, change_column
from tsengine.session import materialize

# Layers, dropout after the first two, Adam step, batch, epochs, patience, seed.
HIDDEN = (256, 128, 64)
DROPOUT = (0.2, 0.2, 0.0)
STEP = 1e-3
BATCH = 64
EPOCHS = 300
PATIENCE = 15
SEED = 42

# Shards that train side by side and are averaged after each epoch. A task holds one, so larger data needs more.
SHARDS = 8
#: Bytes of features and labels that a task holds on average.
SHARD_BYTES = 64 << 20

SHARD_OUT = "group int, rows double, sse double, val_rows double, val_sse double, state array<double>"


def layer_shapes(sizes: Sequence[int]) -> list[tuple[int, int]]:
    return list(zip(sizes[:-1], sizes[1:], strict=True))


def initial_weights(sizes: Sequence[int], seed: int) -> np.ndarray:
    """Flat weights and biases, uniform within sqrt(6 / (fan in + fan out)), biases zero."""
    rng = np.random.default_rng(seed)
    parts = []
    for a, b in layer_shapes(sizes):
        bound = math.sqrt(6.0 / (a + b))
        parts += [rng.uniform(-bound, bound, a * b), np.zeros(b)]
    return np.concatenate(parts)


def epoch_function(sizes, dropout, step, batch, seed, epoch, shared):
    """One epoch of one shard. Rows are put in order by their own hash and then shuffled by a seed of epoch and shard."""

    def run(key, pdf):
        import numpy as np
        import pandas as pd

        start = shared.value  # weights, first and second moments, step count
        shapes = list(zip(sizes[:-1], sizes[1:], strict=True))
        size = sum(a * b + b for a, b in shapes)
        w, m, v = start[:size].copy(), start[size : 2 * size].copy(), start[2 * size : 3 * size].copy()
        t = start[-1]
        shard = int(key[0])
        rng = np.random.default_rng([seed, epoch, shard])

        def layers(flat):
            at, out = 0, []
            for a, b in shapes:
                out.append((flat[at : at + a * b].reshape(a, b), flat[at + a * b : at + a * b + b]))
                at += a * b + b
            return out

        def forward(flat, x, masks=None):
            values = [x]
            ls = layers(flat)
            for i, (weight, bias) in enumerate(ls):
                z = values[-1] @ weight + bias
                if i < len(ls) - 1:
                    z = np.maximum(z, 0.0)
                    if masks is not None and masks[i] is not None:
                        z = z * masks[i]
                values.append(z)
            return values

        pdf = pdf.sort_values(["is_val", "place"], kind="stable")
        x, y = np.stack(pdf["x"].to_numpy()), np.stack(pdf["y"].to_numpy())
        val = pdf["is_val"].to_numpy()
        val_sse = float((((forward(w, x[val])[-1] - y[val]) ** 2).mean(axis=1)).sum()) if val.any() else 0.0
        val_rows = int(val.sum())
        x, y = x[~val], y[~val]
        rows, sse = len(x), 0.0
        order = rng.permutation(rows)
        for at in range(0, rows, batch):
            pick = order[at : at + batch]
            masks = [(rng.random((len(pick), n)) >= d) / (1 - d) if d else None for n, d in zip(sizes[1:-1], dropout, strict=True)]
            values = forward(w, x[pick], masks)
            error = values[-1] - y[pick]
            sse += float((error**2).mean(axis=1).sum())
            delta = 2.0 * error / error.size
            grads = []
            ls = layers(w)
            for i in range(len(ls) - 1, -1, -1):
                grads.append(np.concatenate([(values[i].T @ delta).ravel(), delta.sum(axis=0)]))
                if i:
                    delta = (delta @ ls[i][0].T) * (values[i] > 0)
                    if masks[i - 1] is not None:
                        delta = delta * masks[i - 1]
            g = np.concatenate(grads[::-1])
            t += 1
            m = 0.9 * m + 0.1 * g
            v = 0.999 * v + 0.001 * g * g
            w = w - step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-7)
        state = np.concatenate([w, m, v, [t]])
        return pd.DataFrame({"group": [shard % 32], "rows": [float(rows)], "sse": [sse], "val_rows": [float(val_rows)], "val_sse": [val_sse], "state": [state.tolist()]})

    return run


@dataclass
class Network:
    """Fitted weights with the scaler of their inputs. One output serves every horizon."""

    name: str
    horizons: tuple[int, ...]
    sizes: tuple[int, ...]
    weights: np.ndarray
    scaler: Scaler
    notes: dict = field(default_factory=dict)

    def predict(self, df: DataFrame) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(self.weights)  # a model, not data
        sizes = self.sizes

        def run(series: pd.Series) -> pd.Series:
            import numpy as np
            import pandas as pd

            if not len(series):
                return pd.Series([], dtype=object)
            at, z = 0, np.stack(series.to_numpy())
            for i, (a, b) in enumerate(zip(sizes[:-1], sizes[1:], strict=True)):
                z = z @ shared.value[at : at + a * b].reshape(a, b) + shared.value[at + a * b : at + a * b + b]
                at += a * b + b
                if i < len(sizes) - 2:
                    z = np.maximum(z, 0.0)
            return pd.Series(list(z))

        infer = F.pandas_udf(run, T.ArrayType(T.DoubleType()))
        df = df.withColumn("_net", infer(self.scaler.array()))
        single = sizes[-1] == 1
        out = [F.col("_net")[0 if single else i].alias(change_column(self.name, h)) for i, h in enumerate(self.horizons)]
        return df.select("*", *out).drop("_net")


def _mean_state(shards: DataFrame) -> tuple[np.ndarray, float, float]:
    """Row-weighted mean of the shards' states, first within 32 groups, then over the groups, and the mean losses; one job."""
    names = ("rows", "sse", "val_rows", "val_sse")
    sums = [F.sum(c).alias(c) for c in names]
    mean = Summarizer.mean(F.col("state"), F.col("rows")).alias("state")
    one = shards.withColumn("state", array_to_vector("state")).groupBy("group").agg(mean, *sums).agg(mean, *sums)
    row = one.select(vector_to_array("state").alias("state"), *names).first()
    loss = row["val_sse"] / row["val_rows"] if row["val_rows"] else math.nan
    return np.array(row["state"]), row["sse"] / row["rows"], loss


def train_network(
    train: DataFrame,
    validation: DataFrame,
    scaler: Scaler,
    labels: Sequence[str],
    horizons: Sequence[int],
    name: str = "network",
    hidden: Sequence[int] = HIDDEN,
    dropout: Sequence[float] = DROPOUT,
    step: float = STEP,
    batch: int = BATCH,
    epochs: int = EPOCHS,
    patience: int = PATIENCE,
    seed: int = SEED,
    shards: int | None = None,
) -> Network:
    """Fits on ``train`` only; ``validation`` decides when to stop, and the best weights are kept.

    The validation loss of an epoch's weights is measured inside the next epoch's job. The result depends on the data, the seed
    and ``shards``, not on cores, files or batch sizes. A task holds one shard: by default there are ``SHARDS``, or as many as keep the
    average one within ``SHARD_BYTES``; a smaller number raises.
    """
    sizes = (len(scaler.features), *hidden, len(labels))
    needed = math.ceil((train.count() + validation.count()) * 8 * (sizes[0] + sizes[-1]) / SHARD_BYTES)
    shards = max(SHARDS, needed) if shards is None else shards
    if shards < needed:
        raise ValueError(f"{shards} shards are too few for these rows: {needed} at least")
    y = F.array(*[F.col(c).cast("double") for c in labels]).alias("y")

    def part(df: DataFrame, is_val: bool) -> DataFrame:
        inputs = df.select(scaler.array().alias("x"), y).withColumn("place", F.xxhash64(F.lit(seed), "x", "y"))
        return inputs.select("x", "y", "place", F.pmod("place", F.lit(shards)).cast("int").alias("shard"), F.lit(is_val).alias("is_val"))

    rows = materialize(part(train, False).unionByName(part(validation, True)).repartition("shard"), "network")
    weights = initial_weights(sizes, seed)
    state = np.concatenate([weights, np.zeros(2 * len(weights) + 1)])
    best, best_loss, since, losses = weights, math.inf, 0, []
    context = rows.sparkSession.sparkContext
    for epoch in range(epochs + 1):
        shared = context.broadcast(state)
        run = epoch_function(sizes, tuple(dropout), step, batch, seed, epoch, shared)
        following, _, loss = _mean_state(rows.groupBy("shard").applyInPandas(run, SHARD_OUT))
        shared.unpersist()
        if epoch:
            losses.append(loss)
            if loss < best_loss:
                best, best_loss, since = state[: len(weights)], loss, 0
            else:
                since += 1
                if since >= patience:
                    break
        state = following
    return Network(name, tuple(horizons), sizes, best, scaler, {"val_loss": best_loss, "epochs": len(losses), "losses": losses})
