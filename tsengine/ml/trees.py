"""Regression trees on binned features: bins by quantiles once, rows as bytes, histograms of gradients per node.

A split sends the bins up to ``cut`` to the left, that is values up to the edge of that bin. Rows are told apart by a hash of their keys, and every
random choice of rows or features depends on the seed and such numbers only, so trees do not depend on tasks or files.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BINS = 32
#: Cells (rows times features) of a table that a task may hold whole; larger ones are grown level by level over all tasks.
LOCAL_CELLS = 16 << 20
#: Features whose histograms are summed at a time.
_FEATURE_STEP = 32
#: Rows whose histograms fit one sum of whole numbers below 2**53.
_PACKED_ROWS = 8192

TREE = "feature array<int>, threshold array<double>, left array<int>, right array<int>, value array<double>, rows array<double>, gain array<double>"
_TREE_TYPES = [pa.list_(t) for t in (pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64())]
TREE_NAMES = [c.split()[0] for c in TREE.split(", ")]


@dataclass(frozen=True)
class Growth:
    """How trees grow: ``rows`` and ``tree_features`` are shares drawn per tree, ``split_features`` per node; ``least`` rows stay in a leaf.

    ``penalty`` is added to the rows of a leaf when its value is taken. ``equal`` splits all nodes of a level alike. ``bootstrap`` draws rows with repetition.
    """

    depth: int
    rate: float = 1.0
    penalty: float = 0.0
    rows: float = 1.0
    tree_features: float = 1.0
    split_features: float | str = 1.0
    least: int = 1
    equal: bool = False
    bootstrap: bool = False


def uniform(rows: np.ndarray, *seeds: int) -> np.ndarray:
    """A number in [0, 1) for each row hash."""
    x = rows.astype(np.uint64)
    for s in seeds:
        x = x + np.uint64((s * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(float) / 2**53


def row_weights(rows: np.ndarray, growth: Growth, *seeds: int) -> np.ndarray:
    """How often each row is in a tree's sample: 0 or 1, or a Poisson number, whose rows need not be counted first as a bootstrap's would."""
    if growth.bootstrap:
        u, p, out = uniform(rows, *seeds), np.exp(-1.0), np.zeros(len(rows))
        total = term = p
        for k in range(1, 13):
            out += u >= total
            term /= k
            total += term
        return out
    return (uniform(rows, *seeds) < growth.rows).astype(float) if growth.rows < 1 else np.ones(len(rows))


def tree_features(width: int, growth: Growth, *seeds: int) -> np.ndarray:
    if growth.tree_features >= 1:
        return np.arange(width)
    return np.sort(np.random.default_rng(seeds).permutation(width)[: max(1, round(growth.tree_features * width))])


def split_features(width: int, growth: Growth) -> int:
    share = width**0.5 / width if growth.split_features == "sqrt" else float(growth.split_features)
    return max(1, int(share * width))


def node_features(chosen: np.ndarray, growth: Growth, nodes: Sequence[int], *seeds: int) -> np.ndarray | None:
    """Features that each of ``nodes`` may split on; None if all of ``chosen``."""
    m = split_features(len(chosen), growth)
    if m >= len(chosen):
        return None
    keys = np.random.default_rng((*seeds, int(nodes[0]))).random((len(nodes), len(chosen)))
    return chosen[np.sort(np.argpartition(keys, m - 1, axis=1)[:, :m], axis=1)]


def histograms(bins: np.ndarray, node: np.ndarray, nodes: int, g: np.ndarray, w: np.ndarray, chosen: np.ndarray, per_node: np.ndarray | None) -> np.ndarray:
    """(2, nodes, features, BINS): sums of ``w * g`` and of ``w`` by node, feature and bin."""
    m = len(chosen) if per_node is None else per_node.shape[1]
    out = np.zeros((2, nodes, m, BINS))
    values = w * g
    # Few rows with counts that are whole: both sums come from one pass, the rows in the upper bits and the values, as fractions of the largest, in the lower.
    packed = 0 < len(g) <= _PACKED_ROWS and not (w % 1).any() and w.max() * len(w) <= 4 * _PACKED_ROWS
    unit = (np.abs(values).max() or 1.0) * len(g) * 2.0**-36 if packed else 1.0
    passes = (w * 2.0**38 + np.rint(values / unit),) if packed else (values, w)
    for begin in range(0, m, _FEATURE_STEP):
        end = min(m, begin + _FEATURE_STEP)
        part = bins[:, chosen[begin:end]] if per_node is None else np.take_along_axis(bins, per_node[:, begin:end][node], axis=1)
        cell = (part + (np.arange(end - begin) * BINS + node[:, None] * ((end - begin) * BINS))).ravel()
        for k, v in enumerate(passes):
            sums = np.bincount(cell, np.repeat(v, end - begin), nodes * (end - begin) * BINS)
            out[k, :, begin:end] = sums.reshape(nodes, end - begin, BINS)
    if packed:
        out[1] = np.rint(out[0] * 2.0**-38)
        out[0] = (out[0] - out[1] * 2.0**38) * unit
    return out


def split_gains(hist: np.ndarray, growth: Growth) -> np.ndarray:
    """(nodes, features, cuts): by how much a split lowers the penalised squared error; minus infinity where a side has too few rows."""
    least = max(growth.penalty, 1e-12)
    left, rows = (np.cumsum(h, axis=2) for h in hist)
    total, all_rows = left[..., -1:].copy(), rows[..., -1:].copy()
    left, rows = left[..., :-1], rows[..., :-1]
    gains = left * left / (rows + least) - total * total / (all_rows + least)
    left = total - left
    left *= left
    left /= all_rows - rows + least
    gains += left
    if not growth.equal:  # in a level of equal splits a node may stay whole and gains nothing
        gains[(rows < growth.least) | (all_rows - rows < growth.least)] = -np.inf
    return gains


@dataclass
class Tree:
    """Nodes by number; node 0 is the root, leaves have feature -1. ``cut`` is the last bin of the left side."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    total: list[float] = field(default_factory=lambda: [0.0])
    rows: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, gain: float, left: tuple[float, float], right: tuple[float, float]) -> None:
        self.feature[node], self.cut[node], self.gain[node] = feature, cut, gain
        self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
        for total, rows in (left, right):
            for column, v in zip((self.feature, self.cut, self.left, self.right, self.total, self.rows, self.gain), (-1, 0, -1, -1, total, rows, 0.0), strict=True):
                column.append(v)

    def settle(self, totals: np.ndarray, rows: np.ndarray, growth: Growth) -> None:
        """Sums and gains anew from the sums of the leaves, free of the rounding of histograms."""
        self.total, self.rows = totals.tolist(), rows.tolist()
        least = max(growth.penalty, 1e-12)

        def score(i: int) -> float:
            return self.total[i] ** 2 / (self.rows[i] + least)

        for i in range(len(self.feature) - 1, -1, -1):  # children come after their parent
            if self.feature[i] >= 0:
                a, b = self.left[i], self.right[i]
                self.total[i], self.rows[i] = self.total[a] + self.total[b], self.rows[a] + self.rows[b]
                self.gain[i] = score(a) + score(b) - score(i)

    def values(self, growth: Growth) -> np.ndarray:
        return np.array(self.total) / (np.array(self.rows) + max(growth.penalty, 1e-12))

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """Node that each row ends in."""
        feature, cut, left, right = (np.array(a) for a in (self.feature, self.cut, self.left, self.right))
        at, row = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while True:
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                return at
            goes_left = bins[row, np.maximum(f, 0)] <= cut[at]
            at = np.where(inner, np.where(goes_left, left[at], right[at]), at)

    def arrays(self, edges: Sequence[np.ndarray], growth: Growth, scale: float = 1.0) -> list:
        threshold = [float(edges[f][min(c, len(edges[f]) - 1)]) if f >= 0 and len(edges[f]) else 0.0 for f, c in zip(self.feature, self.cut, strict=True)]
        return [self.feature, threshold, self.left, self.right, (scale * self.values(growth)).tolist(), self.rows, self.gain]


def _first_best(gains: np.ndarray) -> list[int]:
    """The first place of each row that is as good as the best but for rounding."""
    best = gains.max(axis=1, keepdims=True)
    slack = np.where(np.isfinite(best), 1e-6 * np.abs(best) + 1e-9, 0)
    return (gains >= best - slack).argmax(axis=1).tolist()


def apply_splits(tree: Tree, ids: Sequence[int], hist: np.ndarray, chosen: np.ndarray, per_node: np.ndarray | None, growth: Growth) -> list[int]:
    """Splits the nodes ``ids`` of a level by their histograms; the children that may split further."""
    gains = split_gains(hist, growth)
    if growth.equal:
        together = gains.sum(axis=0)
        place = np.unravel_index(_first_best(together.reshape(1, -1))[0], together.shape)
        if together[place] <= 1e-9:
            return []
        best = [place] * len(ids)
    else:
        best = [np.unravel_index(k, gains.shape[1:]) for k in _first_best(gains.reshape(len(ids), -1))]
    children = []
    for i, (node, (f, cut)) in enumerate(zip(ids, best, strict=True)):
        if not growth.equal and not gains[i, f, cut] > 1e-9:
            continue
        left = hist[:, i, f, : cut + 1].sum(axis=1)
        right = hist[:, i, f, cut + 1 :].sum(axis=1)
        feature = int(chosen[f]) if per_node is None else int(per_node[i, f])
        tree.split(node, feature, int(cut), float(gains[i, f, cut]), tuple(left.tolist()), tuple(right.tolist()))
        for child in (tree.left[node], tree.right[node]):
            if growth.equal or tree.rows[child] >= 2 * growth.least:
                children.append(child)
    return children


def grow(bins: np.ndarray, g: np.ndarray, w: np.ndarray, growth: Growth, *seeds: int) -> Tree:
    """One tree from rows in memory."""
    used = w > 0
    bins, g, w = bins[used], g[used], w[used]
    tree = Tree(total=[float(w @ g)], rows=[float(w.sum())])
    chosen = tree_features(bins.shape[1], growth, *seeds)
    at, active = np.zeros(len(bins), np.int64), [0]
    row = np.arange(len(bins))
    known: dict[int, int] = {}
    above = None
    for _ in range(growth.depth):
        per_node = node_features(chosen, growth, active, *seeds)
        # A node's histogram is its parent's less its sibling's: only the smaller of two siblings is counted.
        derived = {}
        if per_node is None and above is not None:
            parent = {child: p for p in known for child in (tree.left[p], tree.right[p])}
            here = set(active)
            for p in known:
                a, b = tree.left[p], tree.right[p]
                if a in here and b in here:
                    small, large = (a, b) if tree.rows[a] <= tree.rows[b] else (b, a)
                    derived[large] = small
        counted = [i for i in active if i not in derived]
        place = np.full(len(tree.feature), -1)
        place[counted] = np.arange(len(counted))
        inside = place[at] >= 0
        hist = histograms(bins[inside], place[at[inside]], len(counted), g[inside], w[inside], chosen, per_node)
        if derived:
            whole = np.empty((2, len(active), *hist.shape[2:]))
            where = {node: i for i, node in enumerate(active)}
            whole[:, [where[i] for i in counted]] = hist
            large = list(derived)
            whole[:, [where[i] for i in large]] = above[:, [known[parent[i]] for i in large]] - whole[:, [where[derived[i]] for i in large]]
            hist = whole
        known, above = {node: i for i, node in enumerate(active)}, hist
        active = apply_splits(tree, active, hist, chosen, per_node, growth)
        feature = np.array(tree.feature)
        split = feature[at] >= 0
        goes_left = bins[row, np.maximum(feature[at], 0)] <= np.array(tree.cut)[at]
        at = np.where(split, np.where(goes_left, np.array(tree.left)[at], np.array(tree.right)[at]), at)
        if not active:
            break
    tree.settle(np.bincount(at, w * g, len(tree.feature)), np.bincount(at, w, len(tree.feature)), growth)
    return tree


# --- tables ------------------------------------------------------------------------------------------------------


def bin_edges(rows: DataFrame, vector: str, width: int, bins: int = BINS) -> list[np.ndarray]:
    """Ascending distinct inner edges per feature, by quantiles of all rows in one pass."""
    x = vector_to_array(vector)
    shares = [i / bins for i in range(1, bins)]
    cells = [F.percentile_approx(F.get(x, F.lit(i)), shares, 10_000).alias(f"q{i}") for i in range(width)]
    found = rows.agg(F.array(*cells)).first()[0]  # a number per feature and edge
    return [np.unique(np.array(e or [], float)) for e in found]


def binned(rows: DataFrame, vector: str, edges: list[np.ndarray], labels: Sequence[str], keys: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """``(h, bins, y, carry)``: hash of the keys, a byte per feature, the labels."""
    picked = rows.select(F.xxhash64(*keys).alias("h"), vector_to_array(vector).alias("x"), F.array(*[F.col(c).cast("double") for c in labels]).alias("y"), *carry)

    def run(batches):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            b = np.column_stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(edges)]).astype(np.uint8)
            columns = [batch.column(0), pa.array([r.tobytes() for r in b], pa.binary()), *batch.columns[2:]]
            yield pa.record_batch(columns, ["h", "bins", *batch.schema.names[2:]])

    more = "".join(f", {c} {t}" for c, t in picked.select(*carry).dtypes)
    return picked.mapInArrow(run, "h bigint, bins binary, y array<double>" + more)


def matrices(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row hashes, bins, labels of a binned table in the order of the hashes, and that order."""
    h = table["h"].to_numpy()
    order = np.argsort(h, kind="stable")
    bins = np.frombuffer(b"".join(table["bins"].to_pylist()), np.uint8).reshape(len(h), -1)
    y = np.array(table["y"].to_pylist(), float).reshape(len(h), -1)
    return h[order], bins[order], y[order], order


def tree_batch(columns: dict[str, list], trees: list[list]) -> pa.Table:
    """Rows of finished trees: ``columns`` in front of the arrays of each."""
    arrays = [pa.array([t[k] for t in trees], kind) for k, kind in enumerate(_TREE_TYPES)]
    return pa.table([*[v if isinstance(v, pa.Array) else pa.array(v, pa.int32()) for v in columns.values()], *arrays], [*columns, *TREE_NAMES])


class TreeModel:
    """Trees of one target: ``base`` plus the sum of the trees' values, or their mean for a forest. ``transform`` adds ``out``."""

    def __init__(self, trees: list, base: float, out: str, vector: str, mean: bool = False):
        self.trees, self.base, self.out, self.vector, self.mean = trees, base, out, vector, mean

    def transform(self, df: DataFrame) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast((self.trees, self.base, self.mean))  # a model, bounded by trees and depth

        @F.pandas_udf("double")
        def predict(x):
            import pandas as pd

            trees, base, mean = shared.value
            return pd.Series(predicted(np.stack(x.to_numpy()), trees, base, mean) if len(x) else [], dtype=float)

        return df.withColumn(self.out, predict(vector_to_array(self.vector)))

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(i, *[list(a) for a in t]) for i, t in enumerate(self.trees)], f"tree int, {TREE}")


def predicted(x: np.ndarray, trees: list, base: float, mean: bool) -> np.ndarray:
    total, row = np.zeros(len(x)), np.arange(len(x))
    for feature, threshold, left, right, value, *_ in trees:
        feature, threshold, left, right, value = (np.asarray(a) for a in (feature, threshold, left, right, value))
        at = np.zeros(len(x), np.int64)
        while True:
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                break
            goes_left = x[row, np.maximum(f, 0)] <= threshold[at]
            at = np.where(inner, np.where(goes_left, left[at], right[at]), at)
        total += value[at]
    return base + (total / max(len(trees), 1) if mean else total)
