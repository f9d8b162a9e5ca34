import itertools
import math
import random
from datetime import timedelta
from unittest.mock import MagicMock

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from helpers import START, hourly
from tsengine.ml import attribution, boosting, forest, linear, network, saved, trees
from tsengine.ml.frame import fit_scaler, vector_table
from tsengine.operators import metrics, selection, split
from tsengine.plans import experiment, live, serve, winners
from tsengine.plans.feature_plan import FeatureSpec, build_features, training_table
from tsengine.queries import models
from tsengine.series import HOURLY
from tsengine.session import materialize, new_path
from tsengine.sources import metadata

SPEC = FeatureSpec(level="v", prefix="v", measures=("v",), lags=(1, 12, 24), windows=(6, 24), stats=("mean",), horizons=(6, 12))


@pytest.fixture(scope="module")
def seasonal(spark):
    """A noisy daily cycle, which persistence cannot follow."""
    rng = random.Random(3)
    values = [50 + 20 * math.sin(2 * math.pi * i / 24) + rng.gauss(0, 1) for i in range(1200)]
    table = training_table(build_features(hourly(spark, values), SPEC, HOURLY), SPEC)
    return materialize(split.chronological_split(table, HOURLY, timedelta(days=8), timedelta(days=6)), "seasonal")


@pytest.fixture(scope="module")
def data(seasonal):
    return experiment.prepare(seasonal, SPEC.features, SPEC, HOURLY)


def test_metrics(spark):
    rows = [("s", "m", "1", 50.0, 55.0), ("s", "m", "1", 60.0, 60.0), ("s", "m", "1", 80.0, 70.0)]
    df = spark.createDataFrame(rows, "feature_set string, model string, horizon string, actual double, predicted double")
    got = metrics.regression_metrics(df).first()
    assert [round(got[m], 6) for m in metrics.METRICS] == [6.454972, 5.0, 0.732143]
    tied = spark.createDataFrame([("b", "m", 1.0), ("a", "m", 1.0), ("c", "m", 2.0)], "feature_set string, model string, mean_rmse double")
    assert metrics.winner(tied).first()["feature_set"] == "a"


def test_constant_column_is_kept_last(spark):
    rng = np.random.default_rng(0)
    a = rng.normal(size=50)
    rows = [(float(x), float(2 * x), float(rng.normal()), 1.0, float(x + rng.normal() / 10)) for x in a]
    df = spark.createDataFrame(rows, "a double, b double, noise double, flat double, t double")
    kept, reasons, scores = selection.select_uncorrelated(df, ["a", "b", "noise", "flat"], ["t"])
    assert kept == ["a", "noise", "flat"] and list(reasons) == ["b"] and scores["flat"] == 0
    table = {r["feature"]: r["relevance"] for r in selection.relevance(df, ["a", "flat"], {"t": F.col("t")}).collect()}
    assert table["flat"] == 0 and table["a"] == pytest.approx(abs(np.corrcoef(a, [r[4] for r in rows])[0, 1]))


def test_feature_sets(spark):
    rows = [(h, f, i) for h, fs in ((24, "abc"), (48, "cba")) for f, i in zip(fs, (3.0, 2.0, 1.0), strict=True)]
    scores = spark.createDataFrame(rows, "horizon int, feature string, importance double")
    sets = selection.feature_sets(scores, (1, 2)).orderBy("set_name", "pos").collect()
    assert [(r["set_name"], r["feature"]) for r in sets] == [("FS1", "a"), ("FS1", "c"), ("FS2", "a"), ("FS2", "b"), ("FS2", "c")]


def test_ridge_equals_closed_form_and_plain_folds(spark):
    rng = np.random.default_rng(1)
    x, alpha = rng.normal(size=(200, 3)), 7.0
    y = np.stack([x @ [1.0, -2.0, 0.5] + 4 + rng.normal(size=200), x @ [0.0, 1.0, 1.0] - 9 + rng.normal(size=200)], axis=1)
    rows = [("s", START + timedelta(hours=i), Vectors.dense(r), float(t[0]), float(t[1])) for i, (r, t) in enumerate(zip(x, y, strict=True))]
    spec = FeatureSpec(level="v", prefix="v", measures=("v",), horizons=(6, 12))
    names = [spec.change_target_name(h) for h in spec.horizons]
    df = spark.createDataFrame(rows, ["series_id", "time", "x", *names]).withColumn("time", F.col("time").cast("timestamp_ntz")).repartition(5)
    products = sum(linear.product_sums(df, names, F.lit(0)).values())
    weights, intercepts = linear.solve_ridge(products, 2, alpha)
    fit = lambda a, b, k: np.linalg.solve((a - a.mean(0)).T @ (a - a.mean(0)) + k * np.eye(3), (a - a.mean(0)).T @ (b - b.mean(0)))
    assert np.allclose(weights, fit(x, y, alpha), atol=1e-9)
    assert np.allclose(intercepts, y.mean(0) - x.mean(0) @ weights)
    errors = {}
    for k in (0.1, 10.0, 100.0):
        total = np.zeros(2)
        for cut, end in ((40, 80), (80, 120), (120, 160), (160, 200)):
            w = fit(x[:cut], y[:cut], k)
            guess = (x[cut:end] - x[:cut].mean(0)) @ w + y[:cut].mean(0)
            total += np.sqrt(((guess - y[cut:end]) ** 2).mean(0)) / 4
        errors[k] = total
    model = linear.train_ridge(df, spec, HOURLY, alphas=tuple(errors))
    for i, h in enumerate(spec.horizons):
        assert model.notes[h]["alpha"] == min(errors, key=lambda k: errors[k][i])
        assert math.isclose(model.notes[h]["cv_rmse"], min(e[i] for e in errors.values()), rel_tol=1e-9)
    row = model.predict(df.where("time = timestamp_ntz'2024-01-01 00:00:00'")).first()
    assert math.isclose(row["ridge_change_6"], x[0] @ model.weights[6] + model.intercepts[6])


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, flat double")
    rows = df.select(fit_scaler(df, ["a", "flat"]).array().alias("z")).collect()
    assert [r["z"] for r in rows] == [[-1.0, 0.0], [1.0, 0.0]]


def test_learners_beat_persistence(seasonal, data):
    trainers = {
        "ridge": lambda d: (linear.train_ridge(d.part("scaled", "train"), SPEC, HOURLY, alphas=(1.0,), folds=2), "scaled"),
        "boosted_b": lambda d: (
            boosting.train_boosted(
                d.part("vectors", "train"), d.part("vectors", "val"), d.part("vectors", "train"), SPEC, "boosted_b",
                (boosting.setting(depth=3, rate=0.5),), rounds=4,
            ),
            "vectors",
        ),
        "network": lambda d: (
            network.train_network(
                d.part("wide", "train"), d.part("wide", "val"), d.scaler, SPEC.change_targets, SPEC.horizons,
                hidden=(16,), dropout=(0.0,), step=1e-2, batch=8, epochs=8, shards=2,
            ),
            "wide",
        ),
    }
    done = experiment.run_experiment(seasonal, {"all": SPEC.features}, SPEC, HOURLY, trainers)
    rmse = {r["model"]: r["mean_rmse"] for r in done.summary().collect()}
    assert set(rmse) == {"persistence", "ridge", "boosted_b", "network", "ensemble"}
    assert {m: r for m, r in rmse.items() if m != "persistence" and r > 0.7 * rmse["persistence"]} == {}
    assert done.best().first()["mean_rmse"] == min(rmse.values())


def test_shards_follow_the_rows(data, monkeypatch):
    def fit(**how):
        return network.train_network(data.part("wide", "train"), data.part("wide", "val"), data.scaler, SPEC.change_targets, SPEC.horizons, hidden=(4,), dropout=(0.0,), epochs=1, **how)

    bytes_of_rows = data.part("wide", "train", "val").count() * 8 * (len(SPEC.features) + len(SPEC.change_targets))
    monkeypatch.setattr(network, "SHARD_BYTES", bytes_of_rows // 10)
    with pytest.raises(ValueError, match="too few"):
        fit(shards=9)
    assert fit().notes["epochs"] == 1


def test_an_aborted_grid_goes_on_and_its_winner_serves(spark, seasonal):
    fitted = []

    def ridge(d):
        fitted.append(("ridge", len(d.features)))
        return linear.train_ridge(d.part("scaled", "train"), SPEC, HOURLY, alphas=(1.0,), folds=2), "scaled"

    def trees_of(d):
        fitted.append(("boosted_b", len(d.features)))
        parts = d.part("vectors", "train"), d.part("vectors", "val"), d.part("vectors", "train")
        return boosting.train_boosted(*parts, SPEC, "boosted_b", (boosting.setting(depth=3, rate=0.5),), rounds=4), "vectors"

    def wide_net(d):
        fitted.append(("network", len(d.features)))
        how = {"hidden": (8,), "dropout": (0.0,), "epochs": 2, "shards": 2}
        return network.train_network(d.part("wide", "train"), d.part("wide", "val"), d.scaler, SPEC.change_targets, SPEC.horizons, **how), "wide"

    def lost(d):
        raise RuntimeError("lost")

    sets = {"all": list(SPEC.features), "few": [SPEC.level, *SPEC.features[-3:]]}
    ledger = winners.Ledger(new_path(spark, "ledger"))
    with pytest.raises(RuntimeError, match="lost"):
        experiment.run_experiment(seasonal, sets, SPEC, HOURLY, {"ridge": ridge, "boosted_b": lost}, ledger=ledger)
    done = experiment.run_experiment(seasonal, sets, SPEC, HOURLY, {"ridge": ridge, "boosted_b": trees_of, "network": wide_net}, ledger=ledger)
    assert [m for m, _ in fitted] == ["ridge", "boosted_b", "network", "ridge", "boosted_b", "network"]
    again = experiment.run_experiment(seasonal, sets, SPEC, HOURLY, {"ridge": lost, "boosted_b": lost, "network": lost}, ledger=ledger)
    assert {tuple(r) for r in again.summary().collect()} == {tuple(r) for r in done.summary().collect()}
    lines = spark.read.parquet(f"{ledger.path}/done")
    assert lines.count() == 2 * 3 * 2 and lines.select("feature_set", "model", "horizon").distinct().count() == 12
    with pytest.raises(ValueError, match="other rows"):
        experiment.run_experiment(seasonal, {"all": list(SPEC.features[:-1])}, SPEC, HOURLY, {"ridge": ridge}, ledger=ledger)

    registry, root = new_path(spark, "registry"), new_path(spark, "artifacts")
    assert winners.publish_winner(spark, again, sets, HOURLY, registry, "winner", root) == 1
    served = winners.load_registered(spark, registry, "winner")
    best = done.best().first()
    assert (served.record["feature_set"], served.record["model"]) == (best["feature_set"], best["model"]) and served.features == sets[best["feature_set"]]
    assert served.record["evaluated"]["predictions"] == seasonal.where("split = 'val'").count() * 2 and set(served.record["by_horizon"]) == {"6", "12"}
    # each model in turn as the winner: rows scored from the registry are those of the grid
    for version, model in enumerate(("ridge", "boosted_b", "network", "ensemble", "persistence"), start=2):
        only = experiment.Experiment(done.predictions.where((F.col("feature_set") == "few") & (F.col("model") == model)), done.models, done.served, done.ensemble)
        assert winners.publish_winner(spark, only, sets, HOURLY, registry, "winner", root) == version
        scored = winners.load_registered(spark, registry, "winner", version).forecast(seasonal.where("split = 'val'").drop("split"), SPEC, HOURLY)
        want = only.predictions.select("series_id", "time", F.col("horizon").cast("int"), F.bround(F.greatest("predicted", F.lit(0.0)), 1).alias("want"))
        both = scored.join(want, ["series_id", "time", "horizon"])
        assert both.count() == want.count() and both.where("abs(predicted_level - want) > 0.11").count() == 0
    assert metadata.registry_rows(spark, registry).count() == 6


def test_network_does_not_depend_on_layout(data, spark):
    def fit(rows, batch):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        try:
            return network.train_network(
                rows, data.part("wide", "val"), data.scaler, SPEC.change_targets, SPEC.horizons, hidden=(8,), dropout=(0.2,), epochs=2, shards=3
            )
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")

    first, second = fit(data.part("wide", "train"), 10_000), fit(data.part("wide", "train").repartition(7), 100)
    assert np.allclose(first.weights, second.weights, rtol=0, atol=1e-12) and len(first.notes["losses"]) == 2


def table_of(n, seed, bins=trees.BINS):
    rng = np.random.default_rng(seed)
    b = rng.integers(0, bins, (n, 6)).astype(np.uint8)
    y = np.where(b[:, 0] > 9, b[:, 1] * 1.0, -3) + b[:, 2] / 5 + rng.normal(size=n)
    return rng.integers(0, 2**62, n), b, y, np.arange(n) % 5 == 0


def test_boosting_stops_when_patience_ends():
    h, b, y, held = table_of(300, 1)
    base, grown, losses = boosting.boost(h, b, y, held, boosting.setting(depth=3, rate=0.5), 400, 10, 1)
    at = boosting.best_round(losses, 10)
    assert len(grown) == len(losses) == at + 11 < 400 and losses[at] == min(losses)
    assert base == pytest.approx(y[~held].mean())
    assert len(boosting.boost(h, b, y, np.zeros(300, bool), boosting.setting(depth=3), 7, 10, 1)[1]) == 7


@pytest.mark.parametrize("growth", [trees.Growth(depth=3, penalty=1.0), trees.Growth(depth=3, penalty=2.0, equal=True), trees.Growth(depth=4, least=15)])
def test_trees_split_where_loops_would(growth):
    """First split by trying all cuts; leaf values in closed form; rows of a leaf."""
    _, b, y, _ = table_of(200, 2)
    tree = trees.grow(b, y, np.ones(200), growth, 3)

    def score(part):
        return part.sum() ** 2 / (len(part) + growth.penalty) if len(part) else 0.0

    tried = {}
    for f in range(6):
        for cut in range(trees.BINS - 1):
            left, right = y[b[:, f] <= cut], y[b[:, f] > cut]
            if min(len(left), len(right)) >= growth.least or growth.equal:
                tried[f, cut] = score(left) + score(right) - score(y)
    assert tree.gain[0] == pytest.approx(max(tried.values())) and tried[tree.feature[0], tree.cut[0]] == pytest.approx(max(tried.values()))
    at, values = tree.leaves(b), tree.values(growth)
    for leaf in set(at.tolist()):
        own = y[at == leaf]
        assert tree.rows[leaf] == len(own) >= growth.least and values[leaf] == pytest.approx(own.sum() / (len(own) + growth.penalty))
    if growth.equal:
        level = [tree.left[0], tree.right[0]]
        assert len({(tree.feature[i], tree.cut[i]) for i in level}) == 1


def test_boosting_over_tasks_grows_the_same_trees(spark):
    h, b, y, held = table_of(240, 4)
    second = np.round(y * 2 - b[:, 3], 3)
    rows = [(int(i), bytes(r), [float(u), float(v)], bool(o)) for i, r, u, v, o in zip(h, b, y, second, held)]
    df = spark.createDataFrame(rows, "h bigint, bins binary, y array<double>, held boolean").repartition(3)
    jobs = [(0, boosting.setting(depth=3, rate=0.5), 4), (1, trees.Growth(depth=2, rate=0.3, penalty=2.0, equal=True), 25)]
    got = boosting.boost_over_tasks(df, 6, jobs, patience=3)
    for (label, growth, rounds), (base, grown, losses) in zip(jobs, got, strict=True):
        want = boosting.boost(h, b, (y, second)[label], held, growth, rounds, 3, boosting.SEED, label)
        assert base == pytest.approx(want[0]) and np.allclose(losses, want[2])
        assert [(t.feature, t.cut, t.left) for t in grown] == [(t.feature, t.cut, t.left) for t in want[1]]
        assert np.allclose(np.concatenate([t.values(growth) for t in grown]), np.concatenate([t.values(growth) for t in want[1]]))


def test_boosted_models_of_small_and_large_tables_agree(data, monkeypatch):
    parts = [data.part("vectors", *p) for p in (("train",), ("val",), ("train", "val"))]
    one = boosting.train_boosted(*parts, SPEC, "b", (boosting.setting(depth=2, rate=0.5),), rounds=3)
    two = boosting.train_boosted(*parts, SPEC, "b", (boosting.setting(depth=2, rate=0.5),), rounds=3, local_cells=0)
    for h in SPEC.horizons:
        assert one.notes[h] == pytest.approx(two.notes[h])
        assert [t[0] for t in one.models[h].trees] == [t[0] for t in two.models[h].trees]


def test_forest_search_scores_whole_forests(spark, data):
    """Errors of folds against the mean of all trees; importances from the trees; the chosen draw is the best."""
    rows = data.part("vectors", "train")
    space = {"numTrees": (5,), "maxDepth": (2, 4), "minInstancesPerNode": (2,), "featureSubsetStrategy": ("0.5",)}
    model = forest.train_forest(rows, rows, SPEC, HOURLY, space, draws=2, folds=2)
    for h in SPEC.horizons:
        found = [(i, e) for g, i, f, n, e in model.notes["search"] if g == h and n > 0]
        assert len(found) == 4
        means = [sum(e for i, e in found if i == k) for k in (0, 1)]
        assert model.notes[h] == forest.draw(space, 2)[int(np.argmin(means))] and len(model.models[h].trees) == 5
    again = forest.train_forest(rows.repartition(7), rows, SPEC, HOURLY, space, draws=2, folds=2)
    assert [r[:4] for r in again.notes["search"]] == [r[:4] for r in model.notes["search"]]
    assert [r[4] for r in again.notes["search"]] == pytest.approx([r[4] for r in model.notes["search"]])
    shares = forest.importances(rows, SPEC.features, SPEC, {"numTrees": 6, "maxDepth": 3}).collect()
    assert len(shares) == len(SPEC.features) * len(SPEC.horizons)
    for h in SPEC.horizons:
        assert sum(r["importance"] for r in shares if r["horizon"] == h) == pytest.approx(1)


def test_saved_ensemble_predicts_the_same(data, spark, seasonal):
    ridge = linear.train_ridge(data.part("scaled", "train"), SPEC, HOURLY, alphas=(1.0,), folds=2)
    boosted = boosting.train_boosted(data.part("vectors", "train"), data.part("vectors", "val"), data.part("vectors", "train"), SPEC, "boosted_b", (boosting.setting(depth=2),), rounds=2)
    net = network.train_network(data.part("wide", "train"), data.part("wide", "val"), data.scaler, SPEC.change_targets, SPEC.horizons, hidden=(4,), dropout=(0.0,), epochs=1)
    path = new_path(spark, "ensemble")
    saved.save_ensemble(spark, saved.Ensemble(list(SPEC.features), [("boosted_b", 0.5), ("network", 0.5)], {"boosted_b": boosted, "network": net}), path)
    again = saved.load_ensemble(spark, path)
    assert again.features == list(SPEC.features) and again.components == [("boosted_b", 0.5), ("network", 0.5)]
    rows = vector_table(seasonal.where("split = 'test'"), SPEC.features, SPEC, HOURLY, carry=[f for f in SPEC.features if f != SPEC.level])
    gaps = saved.greatest_differences(net.predict(boosted.predict(rows)), again.predict(rows), HOURLY.columns, ["boosted_b", "network"], SPEC.horizons)
    assert {r["greatest_difference"] for r in gaps.collect()} == {0.0}
    saved.save_forecaster(spark, ridge, f"{path}/ridge")
    scaled = data.part("scaled", "test")
    gaps = saved.greatest_differences(ridge.predict(scaled), saved.load_forecaster(spark, f"{path}/ridge").predict(scaled), HOURLY.columns, ["ridge"], SPEC.horizons)
    assert {r["greatest_difference"] for r in gaps.collect()} == {0.0}


def test_registered_ensembles_and_sets_are_whole(monkeypatch):
    """The network of the grid and of the saved ensemble has the library's size, over all candidates; every set size is compared."""
    seen = {}

    class Data:
        scaler = None

        def part(self, *names):
            return names

    def prepare(rows, features, *_):
        seen["features"] = list(features)
        return Data()

    def run(rows, sets, *_):
        seen["sets"] = list(sets)
        raise StopIteration

    monkeypatch.setattr(models, "split_rows", lambda spark, sf_dir: None)
    monkeypatch.setattr(models, "_boosted", lambda *a, **k: None)
    monkeypatch.setattr(models, "new_path", lambda spark, name: name)
    monkeypatch.setattr(experiment, "prepare", prepare)
    monkeypatch.setattr(network, "train_network", lambda *a, **how: seen.setdefault("how", []).append(set(how)))
    monkeypatch.setattr(saved, "save_ensemble", lambda spark, ensemble, path: seen.update(saved=ensemble.features))
    monkeypatch.setattr(saved, "load_ensemble", lambda *a: None)
    models._ensemble(None, "")
    models._small_trainers()["network"](Data())
    assert seen["features"] == seen["saved"] == list(models.FULL.features)
    assert seen["how"] == [{"shards"}, {"shards"}]

    monkeypatch.setattr(models, "_horizon_scores", lambda *a: None)
    monkeypatch.setattr(selection, "feature_sets", lambda scores, sizes=selection.SET_SIZES: MagicMock())
    monkeypatch.setattr(models.metadata, "read_feature_list", lambda spark, path, name: [name])
    monkeypatch.setattr(experiment, "run_experiment", run)
    with pytest.raises(StopIteration):
        models.selected_sets_experiment(None, "")
    assert seen["sets"] == [f"FS{n}" for n in selection.SET_SIZES]


@pytest.mark.parametrize("name", ["boosted_forecast_a", "boosted_forecast_b", "forest_forecast", "attribution_check"])
def test_registered_trees_see_all_candidates(name, monkeypatch):
    """Boosted forecasts also go on until the library's patience ends."""
    seen = {}

    def prepare(rows, features, *_):
        seen["features"] = list(features)
        return MagicMock()

    def stop(*args, **how):
        seen["how"] = how
        raise StopIteration

    monkeypatch.setattr(models, "split_rows", lambda spark, sf_dir: None)
    monkeypatch.setattr(experiment, "prepare", prepare)
    monkeypatch.setattr(boosting, "train_boosted", stop)
    monkeypatch.setattr(forest, "train_forest", stop)
    with pytest.raises(StopIteration):
        models.QUERIES[name](None, "")
    assert seen["features"] == list(models.FULL.features)
    if name.startswith("boosted"):
        assert seen["how"] == {"rounds": boosting.ROUNDS}


def test_best_round_waits_for_patience():
    assert boosting.best_round([5, 4, 3, 4, 4, 4, 1], patience=3) == 2
    assert boosting.best_round([5, 4, 3, 4, 4, 4, 1], patience=10) == 6


def test_random_draws_repeat():
    assert forest.draw(forest.SEARCH_SPACE, 8) == forest.draw(forest.SEARCH_SPACE, 8)
    assert len({tuple(d.items()) for d in forest.draw(forest.SEARCH_SPACE, 8)}) == 8


def brute_force(leaf_list, x):
    """Shapley values by enumerating all subsets of features."""
    def value(known):
        total = 0.0
        for v, path in leaf_list:
            for f, lo, hi, z in path:
                v *= float(lo < x[f] <= hi) if f in known else z
            total += v
        return total

    n, out = len(x), np.zeros(len(x))
    for i in range(n):
        others = [j for j in range(n) if j != i]
        for k in range(n):
            for s in itertools.combinations(others, k):
                weight = math.factorial(k) * math.factorial(n - k - 1) / math.factorial(n)
                out[i] += weight * (value({*s, i}) - value(set(s)))
    return value(set()), out


@pytest.mark.parametrize("kind", ["boosted", "forest", "spark"])
def test_attribution_matches_brute_force(spark, kind):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4))
    y = x[:, 0] * 2 + np.where(x[:, 1] > 0, x[:, 2], -1) + rng.normal(size=300) / 10
    df = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))], ["id", "a", "b", "c", "d", "t"])
    rows = VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="x").transform(df)
    if kind == "spark":
        model = forest.forest("t", "p", {"numTrees": 3, "maxDepth": 4}).fit(rows)
    else:
        edges = trees.bin_edges(rows, "x", 4)
        table = trees.binned(rows.withColumn("held", F.lit(False)).withColumn("fold", F.lit(-1)), "x", edges, ["t"], ["id"], ["held", "fold"])
        if kind == "boosted":
            found = boosting.boosters_in_tasks(table, edges, [(0, boosting.setting(depth=3, rate=0.5), 4)], 50, True).orderBy("tree").collect()
        else:
            found = forest.forest_trees(table, edges, [forest.Job(0, forest.growth_of({"numTrees": 3, "maxDepth": 4, "minInstancesPerNode": 1}), 3)]).orderBy("tree").collect()
        model = trees.TreeModel([[r[c] for c in trees.TREE_NAMES] for r in found], found[0]["base"] if kind == "boosted" else 0.0, "p", "x", mean=kind == "forest")
    leaf_list = attribution.leaves(*attribution.ensemble_nodes(model, spark)) + [(getattr(model, "base", 0.0), [])]
    got = attribution.attribute(rows, model, ["a", "b", "c", "d"], ["id"]).join(model.transform(rows).select("id", "p"), "id").collect()
    assert len(got) == 300
    for r in got[:5]:
        base, want = brute_force(leaf_list, x[r["id"]])
        assert r["base"] == pytest.approx(base) and np.allclose(r["values"], want)
    assert all(r["base"] + sum(r["values"]) == pytest.approx(r["p"]) for r in got)
    top = attribution.top_drivers(attribution.attribute(rows, model, ["a", "b", "c", "d"], ["id"]), ["a", "b", "c", "d"], ["id"], 2)
    assert top.count() == 600 and top.where("rank = 1").select(F.min("impact")).first()[0] >= 0


def test_attribution_of_a_model_in_slices(spark, monkeypatch):
    """Deep trees in many slices: base and contributions add up to the prediction and are those of one slice."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 12))
    y = x[:, 0] * x[:, 1] + np.sin(3 * x[:, 2]) + rng.normal(size=2000) / 5
    df = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))], ["id", *[f"f{j}" for j in range(12)], "t"])
    rows = VectorAssembler(inputCols=[f"f{j}" for j in range(12)], outputCol="x").transform(df)
    edges = trees.bin_edges(rows, "x", 12)
    table = trees.binned(rows.withColumn("held", F.lit(False)).withColumn("fold", F.lit(-1)), "x", edges, ["t"], ["id"], ["held", "fold"])
    growth = forest.growth_of({"numTrees": 6, "maxDepth": 12, "minInstancesPerNode": 1})
    found = forest.forest_trees(table, edges, [forest.Job(0, growth, 6)]).orderBy("tree").collect()
    model = trees.TreeModel([[r[c] for c in trees.TREE_NAMES] for r in found], 0.0, "p", "x", mean=True)
    assert max(len(t[0]) for t in model.trees) > 1000
    few = rows.where("id < 40")
    whole = {r["id"]: r for r in attribution.attribute(few, model, [f"f{j}" for j in range(12)], ["id"]).collect()}
    monkeypatch.setattr(attribution, "SLICE_NODES", 2500)
    monkeypatch.setattr(attribution, "_CELLS", 5000)
    assert len(list(attribution.compact_trees(model, spark))) >= 3
    for r in attribution.attribute(few, model, [f"f{j}" for j in range(12)], ["id"]).join(model.transform(few).select("id", "p"), "id").collect():
        assert r["base"] + sum(r["values"]) == pytest.approx(r["p"], abs=1e-9)
        assert np.allclose(r["values"], whole[r["id"]]["values"]) and r["base"] == pytest.approx(whole[r["id"]]["base"])
    assert attribution.attribute(rows.limit(0), model, [f"f{j}" for j in range(12)], ["id"]).count() == 0


def test_live_row_equals_training_row(spark):
    """The row built at now from history and a live window is the training row of that hour."""
    rng = random.Random(9)
    values = [rng.randint(1, 90) for _ in range(200)]
    full = hourly(spark, values)
    now = START + timedelta(hours=150)
    spec = FeatureSpec(level="v", prefix="v", measures=("v",), lags=(1, 24), windows=(6, 48), lead_measures=("v",), leads=(6,), horizons=(6,))
    history = full.where(F.col("time") <= F.lit(now - timedelta(hours=10)).cast("timestamp_ntz")).withColumn("extra", F.lit(1))
    window = full.where(F.col("time") >= F.lit(now - timedelta(hours=60)).cast("timestamp_ntz"))
    row = live.live_features(history, window, spec, HOURLY, now + timedelta(minutes=20))
    want = build_features(full, spec, HOURLY).where(F.col("time") == F.lit(now).cast("timestamp_ntz")).select(*row.columns)
    assert row.count() == 1 and row.exceptAll(want).count() == 0
    ready, rejected = live.model_inputs(row, spec.features, spec, HOURLY)
    assert (ready.count(), rejected.count()) == (1, 0)
    early = live.live_features(history, window, spec, HOURLY, START + timedelta(hours=3))
    assert live.model_inputs(early, spec.features, spec, HOURLY)[1].count() == 1


def test_forecast_rounding_and_alert(spark):
    df = spark.createDataFrame([("a", START, 10.0, -30.0, -10.0)], "series_id string, time timestamp_ntz, v double, x_change_6 double, y_change_6 double")
    out = serve.forecast_table(df, (("x", 0.5), ("y", 0.5)), SPEC, HOURLY, (6,))
    row = out.first()
    assert (row["predicted_change"], row["predicted_level"], row["band"], row["direction"]) == (-20.0, 0.0, "Good", "down")
    assert serve.alert_table(out, HOURLY).first()["alert"] == "none"


def test_vector_table_keeps_no_wide_columns(seasonal):
    assert vector_table(seasonal, SPEC.features, SPEC, HOURLY).columns == [
        "series_id", "time", "split", "v", *SPEC.level_targets, *SPEC.change_targets, "x",
    ]
