"""Gradient-boosted trees: tune on train against validation, stop early, refit on both at the best round count.

All horizons and settings of a family boost side by side. A table that fits ``LOCAL_CELLS`` is dealt to one task per booster; a larger one stays where it is, and each level of all
trees is one aggregation of histograms over all tasks. Both grow the same trees.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import asdict, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsengine.ml import trees
from tsengine.ml.frame import VECTOR, Forecaster, change_column
from tsengine.ml.trees import Growth, Tree, TreeModel
from tsengine.plans.feature_plan import FeatureSpec
from tsengine.session import materialize, ship_package

# Depth, learning rate, row and feature shares and leaf penalty of the two boosted families, rounds and patience.
FAMILY_A = (
    Growth(depth=4, rate=0.05, rows=0.8, tree_features=0.8, penalty=1.0),
    Growth(depth=6, rate=0.03, rows=0.8, tree_features=0.8, penalty=1.0),
    Growth(depth=8, rate=0.02, rows=0.7, tree_features=0.7, penalty=1.0),
)
FAMILY_B = (
    Growth(depth=4, rate=0.05, penalty=3.0, equal=True),
    Growth(depth=6, rate=0.03, penalty=5.0, equal=True),
    Growth(depth=8, rate=0.02, penalty=7.0, equal=True),
)
PATIENCE = 50
SEED = 42
ROUNDS = 3000
#: Rounds after which a large table is written anew with the predictions so far.
_WRITE_EVERY = 20
#: Nodes whose histograms travel together.
_NODE_STEP = 8


def best_round(losses: Sequence[float], patience: int = PATIENCE) -> int:
    """Index of the least loss before ``patience`` rounds pass without a better one."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best


def _out_of_patience(losses: list[float], patience: int) -> bool:
    return len(losses) - 1 - best_round(losses, patience) >= patience


def boost(h: np.ndarray, bins: np.ndarray, y: np.ndarray, held: np.ndarray, growth: Growth, rounds: int, patience: int, *seeds: int) -> tuple[float, list[Tree], list[float]]:
    """(mean of the training rows, trees, error on the ``held`` rows by round) from rows in memory."""
    own = ~held
    base = float(y[own].mean()) if own.any() else 0.0
    f = np.full(len(y), base)
    grown, losses = [], []
    for r in range(rounds):
        tree = trees.grow(bins, y - f, trees.row_weights(h, growth, *seeds, r) * own, growth, *seeds, r)
        f += growth.rate * tree.values(growth)[tree.leaves(bins)]
        grown.append(tree)
        if held.any():
            losses.append(math.sqrt(float(((y - f)[held] ** 2).mean())))
            if _out_of_patience(losses, patience):
                break
    return base, grown, losses


_BOOSTED = "booster int, base double, losses array<double>, tree int, " + trees.TREE


def _finished(number: int, base: float, losses: list[float], grown: list[Tree], edges: list[np.ndarray], growth: Growth) -> pa.Table:
    n = len(grown)
    columns = {"booster": [number] * n, "base": pa.array([base] * n), "losses": pa.array([losses if i == 0 else [] for i in range(n)], pa.list_(pa.float64())), "tree": list(range(n))}
    return trees.tree_batch(columns, [t.arrays(edges, growth, growth.rate) for t in grown])


def boosters_in_tasks(rows: DataFrame, edges: list[np.ndarray], jobs: Sequence[tuple[int, Growth, int]], patience: int, keep_trees: bool) -> DataFrame:
    """Trees (or only the first of each, with the losses) of ``jobs``, ``(label, growth, rounds)``; each has a task and the rows to itself."""

    def run(key, table):
        number = key[0].as_py()
        label, growth, rounds = jobs[number]
        h, bins, y, order = trees.matrices(table)
        held = np.array(table["held"].to_pylist(), bool)[order]
        base, grown, losses = boost(h, bins, y[:, label], held, growth, rounds, patience, SEED, label)
        return _finished(number, base, losses, grown if keep_trees else grown[:1], edges, growth)

    seats = rows.withColumn("booster", F.explode(F.sequence(F.lit(0), F.lit(len(jobs) - 1))))
    return seats.repartition(8 * len(jobs), "booster").groupBy("booster").applyInArrow(run, _BOOSTED)


# --- over all tasks ----------------------------------------------------------------------------------------------


def _predictions(bins: np.ndarray, f: np.ndarray, since: list[list[Tree]], jobs) -> np.ndarray:
    out = f.copy()
    for b, ((_, growth, _), grown) in enumerate(zip(jobs, since, strict=True)):
        for tree in grown:
            out[:, b] += growth.rate * tree.values(growth)[tree.leaves(bins)]
    return out


def _rows_of(batch) -> tuple[np.ndarray, ...]:
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
    y, f = (np.array(batch.column(c).to_pylist(), float).reshape(batch.num_rows, -1) for c in ("y", "f"))
    return batch.column("h").to_numpy(), bins, y, np.array(batch.column("held").to_pylist(), bool), f


def _level_sums(rows: DataFrame, jobs, since, growing: dict[int, tuple[Tree, list[int], int]]) -> DataFrame:
    """(booster, part, payload): histograms of the active nodes of each growing tree, summed over all rows; part -1 has the squared error of the held rows."""

    def sums(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            h, bins, y, held, f = _rows_of(batch)
            f = _predictions(bins, f, since, jobs)
            out: dict[str, list] = {"booster": [], "part": [], "payload": []}

            def add(b, part, values):
                for column, v in zip(out.values(), (b, part, np.ascontiguousarray(values).tobytes()), strict=True):
                    column.append(v)

            for b, (tree, active, r) in growing.items():
                label, growth, _ = jobs[b]
                rest = y[:, label] - f[:, b]
                if active == [0]:
                    add(b, -1, np.array([(rest[held] ** 2).sum(), held.sum()]))
                w = trees.row_weights(h, growth, SEED, label, r) * ~held
                place = np.full(len(tree.feature), -1)
                place[active] = np.arange(len(active))
                node = place[tree.leaves(bins)]
                used = (w > 0) & (node >= 0)
                chosen = trees.tree_features(bins.shape[1], growth, SEED, label, r)
                hist = trees.histograms(bins[used], node[used], len(active), rest[used], w[used], chosen, None)
                for begin in range(0, len(active), _NODE_STEP):
                    add(b, begin, hist[:, begin : begin + _NODE_STEP])
            yield pa.record_batch([pa.array(out["booster"], pa.int32()), pa.array(out["part"], pa.int32()), pa.array(out["payload"], pa.binary())], list(out))

    def add_up(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(p.as_buffer(), float) for p in table["payload"])
        return pa.table([table["booster"][:1], table["part"][:1], pa.array([total.tobytes()], pa.binary())], ["booster", "part", "payload"])

    parts = rows.mapInArrow(sums, "booster int, part int, payload binary")
    return parts.groupBy("booster", "part").applyInArrow(add_up, "booster int, part int, payload binary")


def _level_splits(summed: DataFrame, jobs, growing, width: int) -> DataFrame:
    """One row per booster: the nodes of its tree after the level, those that may split further, and the error sums."""

    def split(key, table):
        b = key[0].as_py()
        label, growth, _ = jobs[b]
        tree, active, r = growing[b]
        payloads = dict(zip(table["part"].to_pylist(), table["payload"].to_pylist(), strict=True))
        error = np.frombuffer(payloads.pop(-1), float).tolist() if -1 in payloads else [0.0, 0.0]
        chosen = trees.tree_features(width, growth, SEED, label, r)
        hist = np.concatenate([np.frombuffer(payloads[p], float).reshape(2, -1, len(chosen), trees.BINS) for p in sorted(payloads)], axis=1)
        if active == [0]:
            tree.total[0], tree.rows[0] = hist[:, 0, 0].sum(axis=1).tolist()
        children = trees.apply_splits(tree, active, hist, chosen, None, growth)
        columns = [[b], [tree.feature], [tree.cut], [tree.left], [tree.right], [tree.total], [tree.rows], [tree.gain], [children], [error]]
        ints, doubles = pa.list_(pa.int32()), pa.list_(pa.float64())
        types = [pa.int32(), ints, ints, ints, ints, doubles, doubles, doubles, ints, doubles]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [c.split()[0] for c in schema.split(", ")])

    ints = "array<int>"
    schema = f"booster int, feature {ints}, cut {ints}, left {ints}, right {ints}, total array<double>, rows array<double>, gain array<double>, children {ints}, error array<double>"
    return summed.groupBy("booster").applyInArrow(split, schema)


def boost_over_tasks(rows: DataFrame, width: int, jobs: Sequence[tuple[int, Growth, int]], patience: int) -> list[tuple[float, list[Tree], list[float]]]:
    """As ``boost`` for each job, with the rows spread over all tasks: a level of all trees is one job of histogram sums.

    Only trees, split by split, and error sums reach the driver. Rows are written with their predictions every ``_WRITE_EVERY`` rounds.
    """
    if any(g.split_features != 1.0 for _, g, _ in jobs):
        raise ValueError("boosted trees draw features per tree, not per split")
    labels = sorted({label for label, _, _ in jobs})
    means = rows.where("not held").agg(*[F.avg(F.col("y")[label]).alias(f"m{label}") for label in labels]).first()
    bases = [float(means[f"m{label}"] or 0.0) for label, _, _ in jobs]
    table = rows.withColumn("f", F.array(*[F.lit(b) for b in bases]))
    grown: list[list[Tree]] = [[] for _ in jobs]
    losses: list[list[float]] = [[] for _ in jobs]
    written, open_ = 0, list(range(len(jobs)))
    for r in range(max(rounds for *_, rounds in jobs) + 1):
        since = [g[written:] for g in grown]
        growing = {b: (Tree(), [0], r) for b in open_}
        finished: dict[int, Tree] = {}
        for level in range(max([jobs[b][1].depth for b in open_], default=0)):
            found = _level_splits(_level_sums(table, jobs, since, growing), jobs, growing, width).collect()
            for row in found:
                b = row["booster"]
                if level == 0 and row["error"][1] and r:
                    losses[b].append(math.sqrt(row["error"][0] / row["error"][1]))
                tree = Tree(*[list(row[c]) for c in ("feature", "cut", "left", "right", "total", "rows", "gain")])
                growing[b] = (tree, row["children"], r)
                if not row["children"] or level + 1 == jobs[b][1].depth:
                    finished[b] = growing.pop(b)[0]
            if level == 0:  # the errors of the trees so far are known: boosters end here
                ended = [b for b in open_ if r == jobs[b][2] or _out_of_patience(losses[b], patience)] if r else []
                for b in ended:
                    growing.pop(b, None)
                    finished.pop(b, None)
                open_ = [b for b in open_ if b not in ended]
            if not growing:
                break
        for b, tree in finished.items():
            grown[b].append(tree)
        if not open_:
            break
        if (r + 1) % _WRITE_EVERY == 0:
            table = materialize(_updated(table, jobs, [g[written:] for g in grown]), "boosted-rows")
            written = r + 1
    return list(zip(bases, grown, losses, strict=True))


def _updated(table: DataFrame, jobs, since) -> DataFrame:
    def update(batches):
        for batch in batches:
            if batch.num_rows:
                _, bins, _, _, f = _rows_of(batch)
                f = _predictions(bins, f, since, jobs)
                yield batch.set_column(batch.schema.get_field_index("f"), "f", pa.array(f.tolist(), pa.list_(pa.float64())))

    return table.mapInArrow(update, table.schema)


# --- training ----------------------------------------------------------------------------------------------------


def train_boosted(
    train: DataFrame,
    validation: DataFrame,
    refit: DataFrame,
    spec: FeatureSpec,
    name: str,
    grid: Sequence[Growth] = FAMILY_A,
    rounds: int = ROUNDS,
    patience: int = PATIENCE,
    local_cells: int = trees.LOCAL_CELLS,
) -> Forecaster:
    """Every setting of ``grid`` for every horizon against validation, then one model per horizon on ``refit`` with the best setting's rounds.

    ``notes[h]`` has the setting, rounds and error; ``notes["search"]`` a row ``(horizon, setting, rounds, val_rmse, losses)`` per booster.
    """
    ship_package(train.sparkSession)
    out = Forecaster(name, spec.horizons)
    labels = [spec.change_target_name(h) for h in spec.horizons]
    keys = [c for c in train.columns if c not in (VECTOR, "split", spec.level, *spec.level_targets, *spec.change_targets)]
    width = len(train.select(VECTOR).first()[0])
    edges = trees.bin_edges(train, VECTOR, width)
    both = train.withColumn("held", F.lit(False)).unionByName(validation.withColumn("held", F.lit(True)))
    rows = materialize(trees.binned(both, VECTOR, edges, labels, keys, ["held"]), "binned")
    fits = rows.count() * width <= local_cells
    jobs = [(label, growth, rounds) for label in range(len(labels)) for growth in grid]
    if fits:
        found = boosters_in_tasks(rows, edges, jobs, patience, keep_trees=False).where("tree = 0").select("booster", "losses").collect()
        losses = {r["booster"]: list(r["losses"]) for r in found}
    else:
        losses = {b: kept for b, (_, _, kept) in enumerate(boost_over_tasks(rows, width, jobs, patience))}
    search, chosen = [], []
    for b, (label, _, _) in enumerate(jobs):
        at = best_round(losses[b], patience) if losses[b] else rounds - 1
        search.append((spec.horizons[label], b % len(grid), at + 1, losses[b][at] if losses[b] else 0.0, losses[b]))
    for label, h in enumerate(spec.horizons):
        _, rmse, i, n = min((0, rmse, i, n) for g, i, n, rmse, _ in search if g == h)
        chosen.append((label, grid[i], n))
        out.notes[h] = {**asdict(grid[i]), "rounds": n, "val_rmse": rmse}
    out.notes["search"] = search
    again = materialize(trees.binned(refit.withColumn("held", F.lit(False)), VECTOR, edges, labels, keys, ["held"]), "binned")
    if again.count() * width <= local_cells:
        kept = boosters_in_tasks(again, edges, chosen, patience, keep_trees=True).orderBy("booster", "tree").collect()  # the models
        parts = {b: [[list(r[c]) for c in trees.TREE_NAMES] for r in kept if r["booster"] == b] for b in range(len(chosen))}
        bases = {r["booster"]: r["base"] for r in kept}
    else:
        made = boost_over_tasks(again, width, chosen, patience)
        parts = {b: [t.arrays(edges, g, g.rate) for t in grown] for b, ((_, g, _), (_, grown, _)) in enumerate(zip(chosen, made, strict=True))}
        bases = {b: base for b, (base, _, _) in enumerate(made)}
    for label, h in enumerate(spec.horizons):
        out.models[h] = TreeModel(parts[label], bases.get(label, 0.0), change_column(name, h), VECTOR)
    return out


def setting(**values) -> Growth:
    """A setting of the first family with some values changed."""
    return replace(FAMILY_A[0], **values)
