"""Forecasters, the experiment grid, live scoring and attribution over the daily series."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from tsengine.functions import scalars as S
from tsengine.ml import attribution, boosting, forest, linear, network, saved, trees
from tsengine.ml.frame import VECTOR, change_column, fit_scaler, vector_table
from tsengine.operators import metrics, selection, split
from tsengine.plans import experiment, live, serve, winners
from tsengine.queries.bindings import FULL, feature_sql, lineitem_days, lineitem_days_sql, rounded, rounded_sql, stored_days
from tsengine.queries.evaluation import _SPLIT, HELD_OUT, TEST, VALIDATION, _horizon_scores, training_rows
from tsengine.series import DAILY
from tsengine.session import materialize, new_path
from tsengine.sources import metadata

QUERIES = {}
ORACLES = {}


def query(sql: str | None = None):
    def add(run):
        QUERIES[run.__name__] = run
        if sql:
            ORACLES[run.__name__] = sql
        return run

    return add


# Learners of a family run with the library defaults: all settings, patience, folds. The README lists what the grid and the ensemble queries leave out.
FOREST_SPACE = {**forest.SEARCH_SPACE, "numTrees": (40,)}
SMALL_SEARCH = {"numTrees": (40,), "maxDepth": (10,), "minInstancesPerNode": (4,), "featureSubsetStrategy": ("sqrt",)}
COMPACT = [
    *FULL.measures,
    *FULL.families()["calendar"],
    *FULL.families()["lags"],
    *FULL.families()["rolling mean"],
    *FULL.families()["rolling std"],
    *FULL.families()["deviation"],
]


def split_rows(spark, sf_dir):
    """The labelled training table, written once per query."""
    rows = split.chronological_split(training_rows(spark, sf_dir), DAILY, TEST, VALIDATION)
    split.check_split(rows)
    return materialize(rows, "split")


def _facts(model, rows, name):
    """Per horizon: rows scored, and 1 if the model's error is below that of persistence."""
    wide = experiment.persistence(model.predict(rows), FULL)
    long = [experiment.long_predictions(wide, n, "all", FULL, DAILY) for n in (name, "persistence")]
    scores = metrics.regression_metrics(long[0].unionByName(long[1]))
    error = {n: F.max(F.when(F.col("model") == n, F.col("rmse"))) for n in (name, "persistence")}
    counts = long[0].groupBy("horizon").agg(F.count("predicted").alias("scored"))
    better = scores.groupBy("horizon").agg((error[name] < error["persistence"]).cast("int").alias("better"))
    return counts.join(better, "horizon")


_FACTS = _SPLIT + "select h.horizon, count(*) as scored, 1 as better from parts cross join (values ('24'), ('48'), ('72')) h(horizon) where split = 'test' group by 1"


@query(
    _SPLIT
    + "select p.series_id, p.time, "
    + ", ".join(f"round((p.{c} - s.m_{c}) / case when s.s_{c} > 0 then s.s_{c} else 1 end, 6) as {c}" for c in FULL.features)
    + " from parts p cross join (select "
    + ", ".join(f"avg({c}) as m_{c}, stddev_pop({c}) as s_{c}" for c in FULL.features)
    + " from parts where split = 'train') s"
)
def standardised_features(spark, sf_dir):
    """Scaled by statistics of the training rows only."""
    rows = split_rows(spark, sf_dir)
    scaler = fit_scaler(rows.where("split = 'train'"), FULL.features)
    return rounded(rows.select("series_id", "time", *scaler.columns()), FULL.features)


def _selection_vectors(spark, sf_dir, features):
    rows = split.selection_rows(training_rows(spark, sf_dir), DAILY, HELD_OUT)
    kept = features(rows)
    return materialize(vector_table(rows, kept, FULL, DAILY), "vectors"), kept


@query("select h.horizon, 188 as features, 1.0 as total, 200 as trees, 0 as wrong_gains, 0 as small_leaves from (values (24), (48), (72)) h(horizon)")
def forest_importance(spark, sf_dir):
    """Importance of all candidates per horizon from 200 trees of depth 12: they sum to 1. Recomputed from the stored trees: a split's gain is what its
    children's sums give, and no leaf has fewer than four rows."""
    vectors, kept = _selection_vectors(spark, sf_dir, lambda rows: list(FULL.features))
    grown = forest.importance_trees(vectors, FULL)
    horizon = F.element_at(F.array(*[F.lit(h) for h in FULL.horizons]), F.col("job") + 1).alias("horizon")
    splits = grown.select(horizon, "tree", F.posexplode("feature").alias("node", "f"), "left", "right", "rows", "value", "gain")

    def score(node):
        return F.get("rows", node) * F.get("value", node) * F.get("value", node)

    gain = score(F.get("left", F.col("node"))) + score(F.get("right", F.col("node"))) - score(F.col("node"))
    size = 1 + score(F.get("left", F.col("node"))) + score(F.get("right", F.col("node")))
    off = (F.col("f") >= 0) & (F.abs(gain - F.get("gain", F.col("node"))) > 1e-5 * size)
    small = (F.col("f") < 0) & (F.get("rows", F.col("node")) < 4) & (F.size("rows") > 1)
    facts = splits.groupBy("horizon").agg(F.countDistinct("tree").cast("int").alias("trees"), F.count_if(off).cast("int").alias("wrong_gains"), F.count_if(small).cast("int").alias("small_leaves"))
    shares = forest.tree_importances(grown).select(horizon, "feature", "importance")
    totals = shares.groupBy("horizon").agg(F.round(F.sum("importance"), 6).alias("total"))
    return totals.join(facts, "horizon").select("horizon", F.lit(len(kept)).alias("features"), "total", "trees", "wrong_gains", "small_leaves")


@query()
def feature_sets_by_forest(spark, sf_dir):
    """Pruned features, forest importance per horizon, unions of the top features per set size."""
    vectors, kept = _selection_vectors(spark, sf_dir, lambda rows: selection.select_uncorrelated(rows, FULL.features, FULL.change_targets)[0])
    return selection.feature_sets(forest.importances(vectors, kept, FULL))


@query(_FACTS)
def ridge_forecast(spark, sf_dir):
    """All candidates, penalties and folds."""
    data = experiment.prepare(split_rows(spark, sf_dir), FULL.features, FULL, DAILY)
    model = linear.train_ridge(data.part("scaled", "train", "val"), FULL, DAILY)
    return _facts(model, data.part("scaled", "test"), "ridge")


@query(
    _SPLIT
    + f"""select h.horizon, name as feature, 0.0 as slope from (unpivot (select {', '.join(f'cast({f} as double) as {f}' for f in FULL.features)} from parts where split = 'train')
 on {', '.join(FULL.features)} into name name value x) cross join (values (24), (48), (72)) h(horizon) group by 1, 2 having stddev_pop(x) > 0"""
)
def ridge_optimality(spark, sf_dir):
    """Slope of the penalised error in each coefficient at the fitted ones, from the predictions themselves: 0 at the optimum."""
    data = experiment.prepare(split_rows(spark, sf_dir), FULL.features, FULL, DAILY)
    rows = data.part("scaled", "train", "val")
    model = linear.train_ridge(rows, FULL, DAILY)
    predicted, names = model.predict(rows).withColumn("_x", vector_to_array(VECTOR)), data.scaler.varying().features
    cells = []
    for h in FULL.horizons:
        error = F.col(FULL.change_target_name(h)) - F.col(change_column("ridge", h))
        for i, f in enumerate(names):
            pull = model.notes[h]["alpha"] * float(model.weights[h][i])
            slope = (F.sum(F.col("_x")[i] * error) - F.lit(pull)) / F.count(F.lit(1))
            cells.append(F.struct(F.lit(h).alias("horizon"), F.lit(f).alias("feature"), (F.round(slope, 6) + F.lit(0.0)).alias("slope")))
    return predicted.agg(F.array(*cells).alias("_c")).select(F.inline("_c"))


def _with_columns(sql: str, columns: str) -> str:
    return f"select *, {columns} from ({sql})"


@query(_with_columns(_FACTS, "24 as fits, 8 as draws, 0 as wrong_choice"))
def forest_forecast(spark, sf_dir):
    """Eight draws over three folds per horizon, 40 trees each; the draw with the least mean error is the fitted one."""
    data = experiment.prepare(split_rows(spark, sf_dir), FULL.features, FULL, DAILY)
    model = forest.train_forest(data.part("vectors", "train"), data.part("vectors", "train", "val"), FULL, DAILY, FOREST_SPACE)
    candidates = forest.draw(FOREST_SPACE, forest.DRAWS)
    search = spark.createDataFrame([(str(h), i, f, float(e)) for h, i, f, _, e in model.notes["search"]], "horizon string, draw int, fold int, rmse double")
    used = spark.createDataFrame([(str(h), candidates.index(model.notes[h])) for h in FULL.horizons], "horizon string, used int")
    means = search.groupBy("horizon", "draw").agg(F.count("rmse").alias("fits"), F.avg("rmse").alias("mean"))
    best = means.groupBy("horizon").agg(F.sum("fits").cast("int").alias("fits"), F.count("draw").cast("int").alias("draws"), F.min_by("draw", F.struct("mean", "draw")).alias("best"))
    chosen = best.join(used, "horizon").select("horizon", "fits", "draws", (F.col("best") != F.col("used")).cast("int").alias("wrong_choice"))
    return _facts(model, data.part("vectors", "test"), "forest").join(chosen, "horizon")


def _boosted(data, name, grid, rounds=boosting.ROUNDS):
    parts = data.part("vectors", "train"), data.part("vectors", "val"), data.part("vectors", "train", "val")
    return boosting.train_boosted(*parts, FULL, name, grid, rounds=rounds)


def _boosting_facts(spark, data, model, name):
    """``_facts``, and from the stored losses: settings tried, those whose rounds are not the least loss's or that ended before patience."""
    search = spark.createDataFrame([(str(h), n, list(losses)) for h, _, n, _, losses in model.notes["search"]], "horizon string, rounds int, losses array<double>")
    least = F.array_position("losses", F.array_min("losses"))
    early = (F.size("losses") - F.col("rounds") < boosting.PATIENCE) & (F.size("losses") < boosting.ROUNDS)
    found = search.groupBy("horizon").agg(F.count("rounds").cast("int").alias("settings"), F.count_if((least != F.col("rounds")) | early).cast("int").alias("wrong_rounds"))
    return _facts(model, data.part("vectors", "test"), name).join(found, "horizon")


@query(_with_columns(_FACTS, "3 as settings, 0 as wrong_rounds"))
def boosted_forecast_a(spark, sf_dir):
    """All three settings of the first family, up to 3,000 rounds with patience 50."""
    data = experiment.prepare(split_rows(spark, sf_dir), FULL.features, FULL, DAILY)
    return _boosting_facts(spark, data, _boosted(data, "boosted_a", boosting.FAMILY_A), "boosted_a")


@query(_with_columns(_FACTS, "1 as settings, 0 as wrong_rounds, 0.0 as leaf_difference"))
def boosted_forecast_b(spark, sf_dir):
    """The first setting of the second family (see the README), up to 3,000 rounds with patience 50. ``leaf_difference``: the values of the first tree against their closed form, the rate times the
    sum of residuals over rows plus penalty, taken from the fitted rows."""
    data = experiment.prepare(split_rows(spark, sf_dir), FULL.features, FULL, DAILY)
    model = _boosted(data, "boosted_b", boosting.FAMILY_B[:1])
    rows, parts = data.part("vectors", "train", "val"), []
    for h in FULL.horizons:
        m, how = model.models[h], model.notes[h]
        first = trees.TreeModel(m.trees[:1], 0.0, "_leaf", VECTOR).transform(rows)
        value = how["rate"] * F.sum(F.col(FULL.change_target_name(h)) - F.lit(m.base)) / (F.count(F.lit(1)) + F.lit(how["penalty"]))
        leaves = first.groupBy("_leaf").agg(value.alias("_again"))
        parts.append(leaves.agg(F.lit(str(h)).alias("horizon"), (F.round(F.max(F.abs(F.col("_leaf") - F.col("_again"))), 6) + F.lit(0.0)).alias("leaf_difference")))
    return _boosting_facts(spark, data, model, "boosted_b").join(parts[0].union(parts[1]).union(parts[2]), "horizon")


def _network(data, **how):
    return network.train_network(data.part("wide", "train"), data.part("wide", "val"), data.scaler, FULL.change_targets, FULL.horizons, **how)


@query(_FACTS)
def network_forecast(spark, sf_dir):
    """All candidates, full layers, epochs and patience; data-parallel over the logical shards."""
    data = experiment.prepare(split_rows(spark, sf_dir), FULL.features, FULL, DAILY)
    return _facts(_network(data, shards=2), data.part("wide", "test"), "network")


def _small_trainers():
    return {
        "ridge": lambda d: (linear.train_ridge(d.part("scaled", "train"), FULL, DAILY), "scaled"),
        "forest": lambda d: (
            forest.train_forest(d.part("vectors", "train"), d.part("vectors", "train"), FULL, DAILY, SMALL_SEARCH, draws=1),
            "vectors",
        ),
        "boosted_b": lambda d: (_boosted(d, "boosted_b", boosting.FAMILY_B[:1]), "vectors"),
        "network": lambda d: (_network(d, shards=2), "wide"),
    }


_MODELS = ("persistence", "ridge", "forest", "boosted_b", "network", "ensemble")


@query(
    _SPLIT
    + f"""select s.feature_set, m.model, h.horizon, count(*) as scored, 0.0 as blend_error from parts cross join (values ('means'), ('lags')) s(feature_set)
 cross join (values {', '.join(f"('{m}')" for m in _MODELS)}) m(model) cross join (values ('24'), ('48'), ('72')) h(horizon) where split = 'val' group by 1, 2, 3"""
)
def experiment_grid(spark, sf_dir):
    """Two feature sets times four learners, the blend and persistence on validation rows: rows scored, and how far the ensemble is from its parts."""
    rows = split_rows(spark, sf_dir)
    sets = {"means": [FULL.level, *FULL.families()["rolling mean"]], "lags": [FULL.level, *FULL.families()["lags"]]}
    long = experiment.run_experiment(rows, sets, FULL, DAILY, _small_trainers()).predictions
    keys = ["feature_set", *DAILY.columns, "horizon"]
    weights = dict(experiment.ENSEMBLE)
    part = F.coalesce(*[F.when(F.col("model") == m, F.lit(w)) for m, w in weights.items()])
    blend = long.groupBy(*keys).agg(F.sum(F.col("predicted") * part).alias("_blend"))
    off = F.when(F.col("model") == "ensemble", F.abs(F.col("predicted") - F.col("_blend"))).otherwise(F.lit(0.0))
    return long.join(blend, keys).groupBy("feature_set", "model", "horizon").agg(F.count("predicted").alias("scored"), F.round(F.max(off), 6).alias("blend_error"))


def _ensemble(spark, sf_dir):
    """The deployed pair over all candidates, fitted, saved and read back from its folder."""
    data = experiment.prepare(split_rows(spark, sf_dir), FULL.features, FULL, DAILY)
    models = {"boosted_b": _boosted(data, "boosted_b", boosting.FAMILY_B[:1]), "network": _network(data, shards=2)}
    path = new_path(spark, "ensemble")
    saved.save_ensemble(spark, saved.Ensemble(list(FULL.features), list(experiment.ENSEMBLE), models), path)
    return data, models, saved.load_ensemble(spark, path)


@query(
    _SPLIT
    + """select model, cast(h.horizon as int) as horizon, count(*) as rows, 0.0 as greatest_difference from parts
 cross join (values ('boosted_b'), ('network')) m(model) cross join (values (24), (48), (72)) h(horizon) where split = 'test' group by 1, 2"""
)
def model_round_trip(spark, sf_dir):
    """The saved and reloaded ensemble predicts the same on every test row."""
    data, models, again = _ensemble(spark, sf_dir)
    carry = [f for f in FULL.features if f != FULL.level]
    rows = vector_table(data.part("wide", "test"), FULL.features, FULL, DAILY, carry=carry)
    before = models["network"].predict(models["boosted_b"].predict(rows))
    return saved.greatest_differences(before, again.predict(rows), DAILY.columns, list(models), FULL.horizons)


@query(
    _SPLIT
    + """select cast(h.horizon as int) as horizon, 1 as version, count(*) as rows, 0 as differing from parts
 cross join (values (24), (48), (72)) h(horizon) where split = 'test' group by 1"""
)
def registered_winner_forecast(spark, sf_dir):
    """A grid kept in a ledger and taken up again, its winner registered, and the test rows scored from name and version alone, beside the fitted model's own forecast."""
    rows = split_rows(spark, sf_dir)
    sets = {"means": [FULL.level, *FULL.families()["rolling mean"]], "lags": [FULL.level, *FULL.families()["lags"]]}
    trainers = {"ridge": _small_trainers()["ridge"]}
    ledger = winners.Ledger(new_path(spark, "ledger"))
    experiment.run_experiment(rows, {"means": sets["means"]}, FULL, DAILY, trainers, ledger=ledger)  # ends after its first set
    grid = experiment.run_experiment(rows, sets, FULL, DAILY, trainers, ledger=ledger)
    registry = new_path(spark, "registry")
    version = winners.publish_winner(spark, grid, sets, DAILY, registry, "forecast", new_path(spark, "artifacts"))
    served = winners.load_registered(spark, registry, "forecast", version)
    test = rows.where("split = 'test'")
    chosen = served.record["feature_set"]
    data = experiment.prepare(rows, sets[chosen], FULL, DAILY)
    own = serve.forecast_table(grid.models[chosen, "ridge"].predict(data.part("scaled", "test")), [("ridge", 1.0)], FULL, DAILY, FULL.horizons)
    both = served.forecast(test, FULL, DAILY).join(own.select(*DAILY.columns, "horizon", F.col("predicted_level").alias("_own")), [*DAILY.columns, "horizon"])
    off = F.count_if(~F.col("predicted_level").eqNullSafe(F.col("_own"))).cast("int")
    return both.groupBy("horizon").agg(F.lit(version).alias("version"), F.count(F.lit(1)).alias("rows"), off.alias("differing"))


# --- live rows and scoring ---------------------------------------------------------------------------------------

NOW = datetime(2000, 6, 1, 9, 30)
_LIVE_SOURCE = f"""(with raw as ({lineitem_days_sql()}) select * replace (us_aqi + case when time >= timestamp '2000-03-01' then 5 else 0 end as us_aqi)
 from raw where time <= timestamp '2000-08-12')"""


def _history_and_live(spark, sf_dir):
    """History up to now; a live window from 92 days before to 72 days after it, with revised levels."""
    days = stored_days(spark, sf_dir)
    history = days.where(F.col("time") <= F.lit("2000-06-01").cast("timestamp_ntz"))
    window = days.where(F.col("time").between(F.lit("2000-03-01").cast("timestamp_ntz"), F.lit("2000-08-12").cast("timestamp_ntz")))
    return history, window.withColumn("us_aqi", F.col("us_aqi") + 5)


@query(
    feature_sql(FULL.without_targets(), f"select * from {_LIVE_SOURCE}")
    + rounded_sql(FULL.features, "features")
    + " where time = timestamp '2000-06-01'"
)
def live_feature_rows(spark, sf_dir):
    history, window = _history_and_live(spark, sf_dir)
    return rounded(live.live_features(history, window, FULL, DAILY, NOW), FULL.features)


@query(
    feature_sql(FULL.without_targets(), f"select * from {_LIVE_SOURCE}")
    + "select series_id, time, h.horizon, us_aqi as current_level, 1 as consistent from features cross join (values (24), (48), (72)) h(horizon)"
    + f" where time = timestamp '2000-06-01' and {' and '.join(f'{c} is not null' for c in COMPACT)}"
)
def live_forecast(spark, sf_dir):
    """The row at now scored from the saved ensemble alone. A consistent row has the blend of its components, the level they lead
    to, not below zero, and the band and direction of these."""
    _, _, ensemble = _ensemble(spark, sf_dir)
    history, window = _history_and_live(spark, sf_dir)
    ready, _ = live.model_inputs(live.live_features(history, window, FULL, DAILY, NOW), ensemble.features, FULL, DAILY)
    vectors = vector_table(ready, ensemble.features, FULL, DAILY, carry=[f for f in ensemble.features if f != FULL.level])
    out = serve.forecast_table(ensemble.predict(vectors), ensemble.components, FULL, DAILY, FULL.horizons)
    blend = sum((F.col(f"{m}_change") * w for m, w in ensemble.components), F.lit(0.0))
    level = F.greatest(F.lit(0.0), F.col("current_level") + F.col("predicted_change"))
    fits = (F.abs(blend - F.col("predicted_change")) <= 0.011) & (F.abs(level - F.col("predicted_level")) <= 0.11)
    fits = fits & (F.col("band") == S.band(F.col("predicted_level"))) & (F.col("direction") == S.direction(F.col("predicted_change")))
    return out.select("series_id", "time", "horizon", "current_level", fits.cast("int").alias("consistent"))


_EARLY = "timestamp_ntz'2000-05-20 13:00:00'"


@query(
    f"""with raw as ({lineitem_days_sql()}), s as (select series_id, time from raw where time <= timestamp '2000-06-01')
 select series_id || k.kind as series_id, cast(case k.kind when '' then timestamp '2000-06-01' when ' early' then timestamp '2000-05-20' else timestamp '2000-05-25' end as timestamp) as time,
 case when k.kind = ' short' then 'rejected' else 'ready' end as verdict
 from (select distinct series_id from s) cross join (values (''), (' early'), (' short')) k(kind)"""
)
def live_rejects(spark, sf_dir):
    """Series that end off the grid are scored at their last whole step, those too short for their windows are rejected; none is lost."""
    history = lineitem_days(spark, sf_dir).where("time <= timestamp_ntz'2000-06-01'")
    early = history.where(f"time < {_EARLY}").withColumn("series_id", F.concat("series_id", F.lit(" early")))
    last = early.groupBy("series_id").agg(F.lit(1).alias("one")).select("series_id", F.expr(_EARLY).alias("time"), *[F.lit(1.0).alias(m) for m in FULL.measures])
    short = history.where("time between timestamp_ntz'2000-05-23' and timestamp_ntz'2000-05-25'").withColumn("series_id", F.concat("series_id", F.lit(" short")))
    both = history.unionByName(early).unionByName(last.select(history.columns)).unionByName(short)
    spec = replace(FULL.without_targets(), leads=(), lead_measures=(), lead_deltas=(), forward_sums=(), angles=())
    ready, rejected = live.model_inputs(live.live_features(both, both.limit(0), spec, DAILY, NOW), ["us_aqi", "aqi_lag_24"], spec, DAILY)
    return ready.select("series_id", "time", F.lit("ready").alias("verdict")).union(rejected.select("series_id", "time", F.lit("rejected")))


def _batch_scored(spark, sf_dir):
    rows = split_rows(spark, sf_dir).where("split = 'test'")
    level, lag24 = F.col("us_aqi"), F.col("aqi_lag_24")
    return rows.withColumns(
        {change_column(m, h): (lag24 - level) * w for m, w in (("boosted_b", 0.25), ("network", 3.0)) for h in FULL.horizons}
    )


_FORECAST_SQL = (
    _SPLIT
    + """, f as (select series_id, time, h.horizon, us_aqi, (aqi_lag_24 - us_aqi) * 0.25 as a, (aqi_lag_24 - us_aqi) * 3.0 as b
 from parts cross join (values (24), (48), (72)) h(horizon) where split = 'test'),
 o as (select series_id, time, horizon, us_aqi as current_level, round_even(a, 2) as boosted_b_change, round_even(b, 2) as network_change,
 round_even(0.5 * a + 0.5 * b, 2) as predicted_change, round_even(greatest(0, us_aqi + 0.5 * a + 0.5 * b), 1) as predicted_level from f)
"""
)
_BAND = """case when predicted_level <= 50 then 'Good' when predicted_level <= 100 then 'Moderate' when predicted_level <= 150 then 'Unhealthy (Sensitive)'
 when predicted_level <= 200 then 'Unhealthy' when predicted_level <= 300 then 'Very Unhealthy' else 'Hazardous' end"""


@query(
    _FORECAST_SQL
    + f"select *, {_BAND} as band, case when predicted_change > 0 then 'up' when predicted_change < 0 then 'down' else 'flat' end as direction from o"
)
def batch_forecast(spark, sf_dir):
    """The serving table over all test rows, from given component changes."""
    return serve.forecast_table(_batch_scored(spark, sf_dir), experiment.ENSEMBLE, FULL, DAILY, FULL.horizons)


@query(
    _FORECAST_SQL
    + """, p as (select series_id, time, max(greatest(current_level, predicted_level)) as peak from o group by 1, 2)
 select series_id, time, peak, case when peak >= 200 then 'severe' when peak >= 150 then 'sensitive' else 'none' end as alert from p"""
)
def forecast_alerts(spark, sf_dir):
    return serve.alert_table(serve.forecast_table(_batch_scored(spark, sf_dir), experiment.ENSEMBLE, FULL, DAILY, FULL.horizons), DAILY)


# --- attribution -------------------------------------------------------------------------------------------------


def _attributed(spark, sf_dir):
    data = experiment.prepare(split_rows(spark, sf_dir), FULL.features, FULL, DAILY)
    model = _boosted(data, "boosted_b", boosting.FAMILY_B[:1]).models[24]
    test = data.part("vectors", "test")
    return attribution.attribute(test, model, FULL.features, DAILY.columns), model.transform(test)


@query(_SPLIT + "select series_id, time, 10 as drivers, 0 as misplaced from parts where split = 'test'")
def attribution_top_ten(spark, sf_dir):
    """The ten strongest drivers of each test row's 24-step prediction, counted, with those that a stronger one is missing or ranked after."""
    shares = materialize(_attributed(spark, sf_dir)[0], "attributions")
    top = attribution.top_drivers(shares, FULL.features, DAILY.columns)
    strengths = shares.select(*DAILY.columns, F.sort_array(F.transform("values", lambda v: F.abs(v)), asc=False).alias("_all"))
    placed = top.join(strengths, DAILY.columns)
    wrong = F.count_if(F.col("impact") != F.expr("_all[rank - 1]"))
    return placed.groupBy(*DAILY.columns).agg(F.count("feature").cast("int").alias("drivers"), wrong.cast("int").alias("misplaced"))


@query("select cast(r as int) as rank, 0.0 as difference from range(1, 11) t(r)")
def attribution_ranking(spark, sf_dir):
    """The ten features of greatest mean impact; each place against the same mean taken column by column."""
    shares = materialize(_attributed(spark, sf_dir)[0], "attributions")
    found = attribution.global_drivers(shares, FULL.features).select(F.row_number().over(Window.orderBy(F.desc("mean_impact"), "feature")).alias("rank"), "mean_impact")
    means = shares.agg(F.sort_array(F.array(*[F.avg(F.abs(F.col("values")[i])) for i in range(len(FULL.features))]), asc=False).alias("_means"))
    again = means.select(F.posexplode("_means").alias("_pos", "_mean"))
    return found.join(again, F.col("rank") == F.col("_pos") + 1).select("rank", (F.round(F.col("mean_impact") - F.col("_mean"), 6) + F.lit(0.0)).alias("difference"))


@query(_SPLIT + "select series_id, time, 0.0 as difference from parts where split = 'test'")
def attribution_check(spark, sf_dir):
    """Base plus contributions against the model's own prediction, per row."""
    shares, predicted = _attributed(spark, sf_dir)
    total = F.col("base") + F.aggregate("values", F.lit(0.0), lambda a, v: a + v)
    both = shares.join(predicted.select(*DAILY.columns, F.col(change_column("boosted_b", 24)).alias("prediction")), DAILY.columns)
    return both.select(*DAILY.columns, (F.round(total - F.col("prediction"), 6) + F.lit(0.0)).alias("difference"))


@query("select 'ridge' as model, 1 as winners")
def selected_sets_experiment(spark, sf_dir):
    """All selected feature sets compared with ridge and persistence, winner by validation error."""
    sets = selection.feature_sets(_horizon_scores(spark, sf_dir))
    path = new_path(spark, "lists")
    sets.coalesce(1).write.parquet(path)
    names = {s: metadata.read_feature_list(spark, path, s) for s in (f"FS{n}" for n in selection.SET_SIZES)}
    trainers = {"ridge": _small_trainers()["ridge"]}
    best = experiment.run_experiment(split_rows(spark, sf_dir), names, FULL, DAILY, trainers).best()
    return best.groupBy("model").agg(F.count(F.lit(1)).alias("winners"))
