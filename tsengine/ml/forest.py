"""Random forests: importance of features, and a forecaster tuned by randomised search over expanding folds.

A table that fits ``trees.LOCAL_CELLS`` is binned once and dealt to several seats, each of which grows its share of the trees of all horizons, draws and
folds; larger tables are grown by Spark's own forests, level by level over all tasks.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsengine.ml import trees
from tsengine.ml.frame import VECTOR, Forecaster, change_column, in_parallel
from tsengine.ml.linear import rmse_of
from tsengine.ml.trees import Growth, TreeModel
from tsengine.operators.split import expanding_folds, fold_parts
from tsengine.plans.feature_plan import FeatureSpec
from tsengine.series import SeriesKeys
from tsengine.session import materialize, shared_root, ship_package

# Seed, the importance forest, and the search space (trees, depth, rows per leaf, features per split).
SEED = 42
IMPORTANCE = {"numTrees": 200, "maxDepth": 12, "minInstancesPerNode": 4}
SEARCH_SPACE = {
    "numTrees": (200, 300, 500),
    "maxDepth": (6, 10, 15, 20),
    "minInstancesPerNode": (1, 2, 4, 8),
    "featureSubsetStrategy": ("sqrt", "0.5", "0.8"),
}
DRAWS = 8
FOLDS = 3
#: Groups that a small table is dealt to; a tree's number decides its seat, so results do not depend on cores.
SEATS = 16


@dataclass(frozen=True)
class Job:
    """A forest for one label: of the rows before test part ``fold``, scored on that part, or of all rows (``fold`` -1)."""

    label: int
    growth: Growth
    trees: int
    fold: int = -1


def growth_of(params: dict) -> Growth:
    share = params.get("featureSubsetStrategy", "all")
    return Growth(depth=params["maxDepth"], least=params["minInstancesPerNode"], split_features={"all": 1.0}.get(share, share), bootstrap=True)


def _seat(jobs: Sequence[Job], seats: int, job_trees):
    """A function of one seat's table; ``job_trees(number, job, h, bins, y, test, grown)`` makes its rows from the grown trees of a job."""

    def run(key, table):
        seat = key[0].as_py()
        h, bins, y, order = trees.matrices(table)
        fold = table["fold"].to_numpy()[order]
        out = []
        for number, job in enumerate(jobs):
            own = fold < job.fold if job.fold >= 0 else np.ones(len(h), bool)
            grown = []
            for t in range(seat, job.trees, seats):
                w = trees.row_weights(h, job.growth, SEED, job.label, t) * own
                grown.append((t, trees.grow(bins, y[:, job.label], w, job.growth, SEED, job.label, t)))
            if grown:
                out.append(job_trees(number, job, h, bins, y, fold == job.fold, grown))
        return pa.concat_tables(out)

    return run


def _dealt(rows: DataFrame, seats: int, run, schema: str) -> DataFrame:
    dealt = rows.withColumn("seat", F.explode(F.sequence(F.lit(0), F.lit(seats - 1))))
    return dealt.repartition(4 * seats, "seat").groupBy("seat").applyInArrow(run, schema)


def forest_trees(rows: DataFrame, edges: list[np.ndarray], jobs: Sequence[Job], seats: int = SEATS) -> DataFrame:
    """``(job, tree, ...)``: all trees of all jobs, as rows."""

    def kept(number, job, h, bins, y, test, grown):
        return trees.tree_batch({"job": [number] * len(grown), "tree": [t for t, _ in grown]}, [t.arrays(edges, job.growth) for _, t in grown])

    seats = min(seats, *[j.trees for j in jobs])
    return _dealt(rows, seats, _seat(jobs, seats, kept), f"job int, tree int, {trees.TREE}")


def forest_errors(rows: DataFrame, jobs: Sequence[Job], seats: int = SEATS) -> DataFrame:
    """``(job, rows, rmse)`` of each job on its test part; only sums of predictions leave a seat."""

    def scored(number, job, h, bins, y, test, grown):
        total = sum(tree.values(job.growth)[tree.leaves(bins[test])] for _, tree in grown)
        return pa.table({"job": pa.array([number] * int(test.sum()), pa.int32()), "h": h[test], "actual": y[test, job.label], "total": np.asarray(total, float)})

    seats = min(seats, *[j.trees for j in jobs])
    parts = _dealt(rows, seats, _seat(jobs, seats, scored), "job int, h bigint, actual double, total double")
    sizes = F.element_at(F.array(*[F.lit(j.trees) for j in jobs]), F.col("job") + 1)
    whole = parts.groupBy("job", "h").agg((F.sum("total") / F.max(sizes)).alias("predicted"), F.max("actual").alias("actual"))
    return whole.groupBy("job").agg(F.count(F.lit(1)).alias("rows"), F.sqrt(F.avg((F.col("predicted") - F.col("actual")) ** 2)).alias("rmse"))


def tree_importances(grown: DataFrame) -> DataFrame:
    """``(job, feature, importance)`` of features that split: the gains of a tree sum to 1, and so do the means over trees."""
    splits = grown.select("job", "tree", F.inline(F.arrays_zip("feature", "gain"))).where("feature >= 0")
    by_tree = splits.groupBy("job", "tree", "feature").agg(F.sum("gain").alias("gain"))
    total = by_tree.groupBy("job", "tree").agg(F.sum("gain").alias("all"))
    shares = by_tree.join(total, ["job", "tree"]).groupBy("job", "feature").agg(F.sum(F.col("gain") / F.col("all")).alias("share"))
    count = total.groupBy("job").agg(F.count(F.lit(1)).alias("trees"))
    return shares.join(count, "job").select("job", "feature", (F.col("share") / F.col("trees")).alias("importance"))


def _binned(rows: DataFrame, labels: Sequence[str], keys: Sequence[str], edges=None) -> tuple[DataFrame, list[np.ndarray], bool]:
    """The written table of bins, the edges, and whether tasks may hold it whole."""
    ship_package(rows.sparkSession)
    width = len(rows.select(VECTOR).first()[0])
    edges = edges or trees.bin_edges(rows, VECTOR, width)
    table = materialize(trees.binned(rows, VECTOR, edges, labels, keys, ["fold"]), "binned")
    return table, edges, table.count() * width <= trees.LOCAL_CELLS


def _keys(rows: DataFrame, spec: FeatureSpec) -> list[str]:
    return [c for c in rows.columns if c not in (VECTOR, "split", "fold", spec.level, *spec.level_targets, *spec.change_targets)]


def forest(label: str, out: str, params: dict) -> RandomForestRegressor:
    """Spark's forest for tables that no task may hold; rows keep their nodes, written out in the checkpoint folder."""
    return RandomForestRegressor(featuresCol=VECTOR, labelCol=label, predictionCol=out, seed=SEED, cacheNodeIds=True, checkpointInterval=10, **params)


def _checkpoints(df: DataFrame) -> None:
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_root(df.sparkSession)}/checkpoints")


def importance_trees(rows: DataFrame, spec: FeatureSpec, params: dict | None = None) -> DataFrame:
    """The written trees of one importance forest per change target; job ``i`` is horizon ``i``."""
    chosen = {**IMPORTANCE, **(params or {})}
    labels = [spec.change_target_name(h) for h in spec.horizons]
    table, edges, _ = _binned(rows.withColumn("fold", F.lit(-1)), labels, _keys(rows, spec))
    return materialize(forest_trees(table, edges, [Job(i, growth_of(chosen), chosen["numTrees"]) for i in range(len(labels))]), "forest-trees")


def importances(rows: DataFrame, features: Sequence[str], spec: FeatureSpec, params: dict | None = None) -> DataFrame:
    """(horizon, feature, importance) from one forest per change target; 0 for a feature that never splits."""
    spark = rows.sparkSession
    if rows.count() * len(features) <= trees.LOCAL_CELLS:
        names = spark.createDataFrame([(i, f) for i, f in enumerate(features)], "feature int, name string")
        horizons = spark.createDataFrame(list(enumerate(spec.horizons)), "job int, horizon int")
        found = tree_importances(importance_trees(rows, spec, params))
        every = names.select("feature", "name", F.explode(F.array(*[F.lit(i) for i in range(len(spec.horizons))])).alias("job")).join(horizons, "job")
        return every.join(found, ["job", "feature"], "left").select("horizon", F.col("name").alias("feature"), F.coalesce("importance", F.lit(0.0)).alias("importance"))
    chosen = {"featureSubsetStrategy": "all", **IMPORTANCE, **(params or {})}
    _checkpoints(rows)

    def fit(h: int):
        model = forest(spec.change_target_name(h), "_p", chosen).fit(rows)
        return [(h, f, float(v)) for f, v in zip(features, model.featureImportances.toArray(), strict=True)]

    found = in_parallel([partial(fit, h) for h in spec.horizons], threads=len(spec.horizons))
    return spark.createDataFrame([row for part in found for row in part], "horizon int, feature string, importance double")  # one row per horizon and feature


def draw(space: dict[str, Sequence], n: int, seed: int = SEED) -> list[dict]:
    """``n`` distinct parameter sets of a grid, repeatable."""
    grid = [dict(zip(space, values, strict=True)) for values in itertools.product(*space.values())]
    return random.Random(seed).sample(grid, min(n, len(grid)))


def train_forest(
    train: DataFrame,
    refit: DataFrame,
    spec: FeatureSpec,
    ks: SeriesKeys,
    space: dict[str, Sequence] | None = None,
    draws: int = DRAWS,
    folds: int = FOLDS,
    name: str = "forest",
) -> Forecaster:
    """Search on the training rows, then one forest per horizon on ``refit`` (train and validation).

    ``notes["search"]`` has a row ``(horizon, draw, fold, rows, rmse)`` per fit; the draw with the least mean error wins, the first of equal ones.
    """
    candidates = draw(space or SEARCH_SPACE, draws)
    out = Forecaster(name, spec.horizons)
    labels = [spec.change_target_name(h) for h in spec.horizons]
    cuts = expanding_folds(train, ks, folds).collect() if len(candidates) > 1 else []  # one row per fold
    t = F.col(ks.time)
    fold = F.lit(-1)
    for c in cuts:
        fold = F.when(t > F.lit(c["train_end"]), F.lit(c["fold"])).otherwise(fold)
    table, edges, fits = _binned(train.withColumn("fold", fold), labels, ks.columns)
    search = [(h, i, c["fold"]) for h in range(len(labels)) for i in range(len(candidates)) for c in cuts]
    if not fits:
        return _train_over_tasks(train, refit, spec, ks, candidates, cuts, name)
    jobs = [Job(h, growth_of(candidates[i]), candidates[i]["numTrees"], f) for h, i, f in search]
    errors = {r["job"]: r for r in forest_errors(table, jobs).collect()} if jobs else {}  # one row per fit
    out.notes["search"] = [(spec.horizons[h], i, f, errors[k]["rows"], errors[k]["rmse"]) for k, (h, i, f) in enumerate(search)]
    best = {}
    for h in spec.horizons:
        means = [sum(e for g, j, _, _, e in out.notes["search"] if g == h and j == i) for i in range(len(candidates))]
        best[h] = candidates[min(range(len(candidates)), key=lambda i: (means[i], i))]
    again, _, _ = _binned(refit.withColumn("fold", F.lit(-1)), labels, ks.columns, edges)
    finals = [Job(i, growth_of(best[h]), best[h]["numTrees"]) for i, h in enumerate(spec.horizons)]
    grown = forest_trees(again, edges, finals).collect()  # the models
    for i, h in enumerate(spec.horizons):
        own = [[r[c] for c in trees.TREE_NAMES] for r in sorted((r for r in grown if r["job"] == i), key=lambda r: r["tree"])]
        out.models[h] = TreeModel(own, 0.0, change_column(name, h), VECTOR, mean=True)
        out.notes[h] = best[h]
    return out


def _train_over_tasks(train, refit, spec, ks, candidates, cuts, name) -> Forecaster:
    """The same search with Spark's forests."""
    _checkpoints(train)
    parts = [fold_parts(train, ks, f) for f in cuts]
    out = Forecaster(name, spec.horizons)

    def score(h: int, i: int, fold: int):
        label = spec.change_target_name(h)
        model = forest(label, "_p", candidates[i]).fit(parts[fold][0])
        return h, i, fold, None, rmse_of(model, parts[fold][1], label, "_p")

    out.notes["search"] = in_parallel([partial(score, h, i, f) for h in spec.horizons for i in range(len(candidates)) for f in range(len(cuts))])
    for h in spec.horizons:
        means = [sum(e for g, j, _, _, e in out.notes["search"] if g == h and j == i) for i in range(len(candidates))]
        best = candidates[min(range(len(candidates)), key=lambda i: (means[i], i))]
        out.models[h] = forest(spec.change_target_name(h), change_column(name, h), best).fit(refit)
        out.notes[h] = best
    return out
