"""Exact path-dependent Shapley values of tree ensembles, for every row of a table.

A tree is a sum over its leaves, and a leaf is a product over the distinct features on its path: 1 or 0 when the
feature is known (the row passes all its splits or not) and the share of training rows that passed when it is not. The
Shapley value of such a product is an integral of a polynomial, evaluated for many rows and leaves at once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsengine.ml.frame import VECTOR
from tsengine.ml.trees import TreeModel
from tsengine.session import materialize, new_path


#: Nodes of the trees that are sent to every task at a time, 36 bytes each.
SLICE_NODES = 1_000_000
#: Nodes whose path tables a task keeps for its next batch, about 200 bytes each; those of larger slices are made tree by tree.
_HELD_NODES = 200_000
#: Numbers in the arrays over rows, leaves and path features.
_CELLS = 1 << 18


def ensemble_nodes(model, spark) -> tuple[list[dict], dict[int, float]]:
    """(nodes, tree weights) from the model's own saved form; a few thousand nodes, bounded by trees and depth."""
    if isinstance(model, TreeModel):
        return _own_nodes(model), dict.fromkeys(range(len(model.trees)), 1.0 / len(model.trees) if model.mean else 1.0)
    path = new_path(spark, "trees")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    count = model.getNumTrees
    weights = list(model.treeWeights)
    if type(model).__name__.startswith("RandomForest"):
        weights = [1.0 / count] * count
    return [n.asDict(recursive=True) for n in nodes], dict(enumerate(weights))


def _own_nodes(model: TreeModel) -> list[dict]:
    return [
        {"treeID": t, "id": i, "leftChild": left, "rightChild": right, "split": {"featureIndex": f, "leftCategoriesOrThreshold": [edge]}, "rawCount": n, "prediction": v}
        for t, tree in enumerate(model.trees)
        for i, (f, edge, left, right, v, n, _) in enumerate(zip(*tree, strict=True))
    ]


def leaves(nodes: Sequence[dict], weights: dict[int, float]) -> list[tuple[float, list[tuple[int, float, float, float]]]]:
    """Per leaf (weighted value, [(feature, above, up to, share of rows)]), splits on one feature joined to an interval."""
    trees: dict[int, dict[int, dict]] = {}
    for n in nodes:
        trees.setdefault(n["treeID"], {})[n["id"]] = n
    found = []
    for tree, by_id in trees.items():
        stack = [(0, {})]
        while stack:
            at, path = stack.pop()
            node = by_id[at]
            if node["leftChild"] < 0:
                found.append((weights[tree] * node["prediction"], [(f, lo, hi, z) for f, (lo, hi, z) in path.items()]))
                continue
            feature = node["split"]["featureIndex"]
            edge = node["split"]["leftCategoriesOrThreshold"][0]
            lo, hi, z = path.get(feature, (float("-inf"), float("inf"), 1.0))
            for child, bounds in ((node["leftChild"], (lo, min(hi, edge))), (node["rightChild"], (max(lo, edge), hi))):
                share = by_id[child]["rawCount"] / node["rawCount"] if node["rawCount"] else 0.5  # a node of no row is never reached
                stack.append((child, {**path, feature: (*bounds, z * share)}))
    return found


def compact_trees(model, spark) -> Iterator[list[tuple]]:
    """The model in slices of at most ``SLICE_NODES`` nodes (or one tree): (weight, feature, threshold, left, right, value, rows) per tree.

    A model saved by Spark is read back slice by slice, so no more than one slice is on its way.
    """
    if isinstance(model, TreeModel):
        weight = 1.0 / len(model.trees) if model.mean else 1.0
        for group in _sliced([len(t[0]) for t in model.trees]):
            yield [_arrays(weight, *model.trees[i][:6]) for i in group]
        return
    path = new_path(spark, "trees")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    sizes = dict(nodes.groupBy("treeID").count().collect())  # one number per tree
    weights = [1.0 / model.getNumTrees] * model.getNumTrees if type(model).__name__.startswith("RandomForest") else list(model.treeWeights)
    edge = F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("edge")
    numbers = sorted(sizes)
    for group in _sliced([sizes[n] for n in numbers]):
        wanted = [numbers[i] for i in group]
        part = nodes.where(F.col("treeID").isin(wanted)).select("treeID", "id", "split.featureIndex", edge, "leftChild", "rightChild", "prediction", "rawCount")
        table = part.toPandas().sort_values(["treeID", "id"])
        yield [_arrays(weights[n], *(g[c].to_numpy() for c in table.columns[2:])) for n, g in table.groupby("treeID")]


def _arrays(weight: float, feature, threshold, left, right, value, rows) -> tuple:
    types = (np.int32, float, np.int32, np.int32, float, float)
    return (weight, *(np.nan_to_num(np.asarray(c, float)).astype(t) for c, t in zip((feature, threshold, left, right, value, rows), types, strict=True)))


def _sliced(sizes: Sequence[int]) -> Iterator[list[int]]:
    group, held = [], 0
    for i, n in enumerate(sizes):
        if group and held + n > SLICE_NODES:
            yield group
            group, held = [], 0
        group.append(i)
        held += n
    if group:
        yield group


def path_tables(tree: tuple) -> list[tuple[np.ndarray, ...]]:
    """A tree's leaves by number of distinct features on their path: (value, feature, above, up to, share of rows), one line per leaf."""
    weight, feature, threshold, left, right, value, rows = tree
    found: dict[int, list] = {}
    stack = [(0, {})]
    while stack:
        at, path = stack.pop()
        a, b = int(left[at]), int(right[at])
        if a < 0:
            found.setdefault(len(path), []).append((weight * value[at], [(f, *cell) for f, cell in path.items()]))
            continue
        f, edge = int(feature[at]), threshold[at]
        lo, hi, z = path.get(f, (-np.inf, np.inf, 1.0))
        for child, bounds in ((a, (lo, min(hi, edge))), (b, (max(lo, edge), hi))):
            share = rows[child] / rows[at] if rows[at] else 0.5  # a node of no row is never reached
            stack.append((child, {**path, f: (*bounds, z * share)}))
    tables = []
    for m, leaf in sorted(found.items()):
        cells = np.array([c for _, c in leaf], float).reshape(len(leaf), m, 4)
        tables.append((np.array([v for v, _ in leaf]), cells[..., 0].astype(np.int64), cells[..., 1], cells[..., 2], cells[..., 3]))
    return tables


def add_contributions(x: np.ndarray, table: tuple[np.ndarray, ...], total: np.ndarray) -> float:
    """Adds the leaves of ``table`` to ``total`` (rows by features) and returns their part of the base.

    The weight k! (m - 1 - k)! / m! of a subset of k others is the integral of t**k (1 - t)**(m - 1 - k) over 0..1, so a feature's value is
    (known - unknown) times the integral of the product of the others' ``known t + unknown (1 - t)``: a polynomial that Gauss nodes
    integrate exactly, with positive terms only.
    """
    value, feature, above, up_to, share = table
    m = feature.shape[1]
    base = float(value @ share.prod(axis=1))
    if not m:
        return base
    nodes, weights = np.polynomial.legendre.leggauss((m + 1) // 2)
    nodes, weights = (nodes + 1) / 2, weights / 2
    step = max(1, _CELLS // (m * len(value)))
    order = np.argsort(feature.ravel(), kind="stable")
    owner = feature.ravel()[order]
    starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    for begin in range(0, len(x), step):
        part = x[begin : begin + step]
        cell = part[:, feature]
        known = (cell > above) & (cell <= up_to)
        inside = np.zeros(known.shape)
        for t, w in zip(nodes, weights, strict=True):
            factor = np.maximum(np.where(known, t, 0.0) + share * (1 - t), 1e-30)
            inside += w * factor.prod(axis=2, keepdims=True) / factor
        inside *= (known - share) * value[:, None]
        total[begin : begin + step, owner[starts]] += np.add.reduceat(inside.reshape(len(part), -1)[:, order], starts, axis=1)
    return base


def attribute(df: DataFrame, model, features: Sequence[str], keys: Sequence[str], vector: str = VECTOR) -> DataFrame:
    """(keys, base, values) where ``values[i]`` is the contribution of feature ``i`` and base + sum = prediction.

    The model reaches the tasks in slices of bounded size, and each slice adds to the rows' sums. With several slices the sums are
    written between them, so a model may have any number of leaves, and rows never meet in a shuffle.
    """
    from pyspark.ml.functions import vector_to_array

    spark, width, names = df.sparkSession, len(features), list(keys)
    start = F.lit(float(getattr(model, "base", 0.0)))
    rows = df.select(*names, vector_to_array(vector).alias("_x"), start.alias("base"), F.array_repeat(F.lit(0.0), width).alias("values"))
    fields = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)
    slices = compact_trees(model, spark)
    trees = next(slices, None)
    while trees is not None:
        rows = rows.mapInPandas(_add_slice(spark.sparkContext.broadcast(trees), width), fields)  # at most SLICE_NODES nodes, or one tree
        trees = next(slices, None)
        if trees is not None:
            rows = materialize(rows, "contributions")
    return rows.drop("_x")


def _add_slice(shared, width: int):
    def run(batches):
        held = [t for tree in shared.value for t in path_tables(tree)] if sum(len(t[1]) for t in shared.value) <= _HELD_NODES else None
        for pdf in batches:
            if not len(pdf):
                yield pdf
                continue
            x, total, base = np.stack(pdf["_x"].to_numpy()), np.stack(pdf["values"].to_numpy()).reshape(len(pdf), width).copy(), 0.0
            for table in held if held is not None else (t for tree in shared.value for t in path_tables(tree)):
                base += add_contributions(x, table, total)
            pdf["base"] += base
            pdf["values"] = list(total)
            yield pdf

    return run


def top_drivers(attributions: DataFrame, features: Sequence[str], keys: Sequence[str], k: int = 10) -> DataFrame:
    """The ``k`` strongest contributions of each row, strongest first; sorted inside the row, no shuffle."""
    named = F.arrays_zip(F.transform("values", lambda v: F.abs(v)).alias("impact"), F.col("values").alias("value"), _names(features).alias("feature"))
    best = F.slice(F.sort_array(named, asc=False), 1, k)
    return attributions.select(*keys, F.posexplode(best).alias("pos", "_d")).select(
        *keys, (F.col("pos") + 1).alias("rank"), "_d.feature", "_d.value", "_d.impact"
    )


def global_drivers(attributions: DataFrame, features: Sequence[str], k: int = 10) -> DataFrame:
    """Mean absolute contribution per feature; combines map-side to one row per feature and task."""
    pairs = attributions.select(F.explode(F.arrays_zip(_names(features).alias("feature"), F.col("values").alias("value"))).alias("_d"))
    ranked = pairs.groupBy("_d.feature").agg(F.avg(F.abs("_d.value")).alias("mean_impact"))
    return ranked.orderBy(F.desc("mean_impact"), "feature").limit(k)


def _names(features: Sequence[str]):
    return F.array(*[F.lit(f) for f in features])
