"""Quality report, splits, selection and the metrics of baseline forecasts."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tsengine.functions import scalars as S
from tsengine.operators import metrics, profile, quality, selection, split
from tsengine.plans.feature_plan import build_features, training_table
from tsengine.queries.bindings import FULL, complete_sql, event_hours, event_hours_sql, stored_days
from tsengine.series import DAILY, HOURLY
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


TARGETS = [*FULL.level_targets, *FULL.change_targets]
NON_NEGATIVE = ["us_aqi", "european_aqi", *FULL.level_targets, "pm10", "pm2_5", "carbon_monoxide", "nitrogen_dioxide", "sulphur_dioxide", "ozone"]
# Daily steps: spans several times those of an hourly series.
TEST, VALIDATION, HELD_OUT = timedelta(days=240), timedelta(days=120), timedelta(days=360)


def training_rows(spark, sf_dir, spec=FULL):
    """The complete feature table, written once because several passes read it."""
    return materialize(training_table(build_features(stored_days(spark, sf_dir), spec, DAILY), spec), "training")


# --- data quality ------------------------------------------------------------------------------------------------


def _report_sql() -> str:
    names = [c for c in [*FULL.features, *TARGETS]]
    groups = {"keys": ["series_id", "time"], **FULL.families(), "targets": FULL.level_targets, "change targets": FULL.change_targets}
    rows = [f"select 'columns: {g}' as \"check\", 'pass' as status, 0 as bad, {len(c)} as checked" for g, c in groups.items()]
    rows.append(f"select 'numeric columns', 'pass', 0, {len(names)}")
    rows.append(f"select 'no leakage', 'pass', 0, {len(FULL.features)}")
    verdict = "case when b > 0 then 'fail' else 'pass' end, b, n"
    count = "select '{}', " + verdict + " from (select count(*) filter (where {}) as b, count(*) as n from complete)"
    for c, (lo, hi) in quality.CALENDAR_RANGES.items():
        rows.append(count.format(f"range: {c}", f"{c} not between {lo} and {hi}"))
    rows += [count.format(f"not negative: {c}", f"{c} < 0") for c in NON_NEGATIVE]
    rows.append(count.format("no nulls", " or ".join(f"{c} is null" for c in names)))
    rows.append(count.format("no infinities", " or ".join(f"isinf({c})" for c in names if c not in quality.CALENDAR_RANGES)))
    rows.append("select 'enough rows', case when count(*) < 500 then 'warn' else 'pass' end, 0, count(*) from complete")
    rows.append(
        "select 'no duplicate times', case when d > 0 then 'fail' else 'pass' end, d, n from"
        " (select count(*) - count(distinct (series_id, time)) as d, count(*) as n from complete)"
    )
    rows.append(
        """select 'regular steps', case when g * 100.0 / n > 0.5 then 'fail' when g > 0 then 'warn' else 'pass' end, g, n from
 (select count(*) filter (where time - p <> interval '1 day') as g, count(*) as n from
 (select time, lag(time) over (partition by series_id order by time) as p from complete))"""
    )
    for h in FULL.horizons:
        rows.append(
            f"""select 'coverage: {h}', {verdict} from (select count(*) filter (where r < e + interval '{h} day') as b, count(*) as n
 from (select series_id, max(time) as e from complete group by 1) join (select series_id, max(time) as r from series group by 1) using (series_id))"""
        )
    aligned = [(f"aqi_lag_{n}", "s.us_aqi", -n) for n in FULL.lags]
    aligned += [(FULL.level_target_name(h), "s.us_aqi", h) for h in FULL.horizons]
    aligned += [(FULL.change_target_name(h), "s.us_aqi - c.us_aqi", h) for h in FULL.horizons]
    aligned += [(f"forecast_{m}_{h}", f"s.{m}", h) for m in FULL.lead_measures for h in FULL.leads]
    for name, expected, steps in aligned:
        rows.append(
            f"""select 'aligned: {name}', case when b > 0 or n = 0 then 'fail' else 'pass' end, b, n from
 (select count(*) filter (where abs(c.{name} - ({expected})) > 1e-6) as b, count(*) filter (where ({expected}) is not null) as n
 from complete c left join series s on s.series_id = c.series_id and s.time = c.time + interval '{steps} day')"""
        )
    return complete_sql() + "\n" + "\nunion all ".join(rows)


@query(_report_sql())
def quality_report(spark, sf_dir):
    raw = stored_days(spark, sf_dir)
    return quality.quality_report(training_rows(spark, sf_dir), raw, FULL, DAILY, NON_NEGATIVE)


_FAULTY = len([*FULL.features, *TARGETS]) - 1
_COUNTED = "select '{}' as \"check\", 'fail' as status, count(*) filter (where day = {}) as bad, count(*) as checked from twice"


@query(
    complete_sql()
    + """, twice as (select series_id, time, day from complete union all select series_id, time, day from complete where day = 6)
"""
    + "\nunion all ".join(
        [
            _COUNTED.format("range: hour", 1),
            _COUNTED.format("not negative: pm10", 2),
            _COUNTED.format("aligned: target_change_24", 3),
            _COUNTED.format("no infinities", 4),
            _COUNTED.format("no nulls", 5),
            _COUNTED.format("no duplicate times", 6).replace("filter (where day = 6)", "- count(distinct (series_id, time))"),
            "select 'chronological', 'fail', count(distinct (series_id, time)) - count(distinct series_id), count(*) from twice",
            f"select 'columns: lags', 'fail', 1, {len(FULL.families()['lags'])}",
            "select 'aligned: aqi_lag_24', 'fail', 0, 0",
            f"select 'no leakage', 'fail', 1, {len(FULL.features) + 1}",
            f"select 'numeric columns', 'fail', 1, {_FAULTY + 1}",
        ]
    )
)
def quality_report_faults(spark, sf_dir):
    """A table with one fault for each kind of check; the checks that must see them."""
    good, day = training_rows(spark, sf_dir), F.dayofmonth("time")
    put = lambda c, d, v: F.when(day == d, v).otherwise(F.col(c))
    # A level off by 5 with a change off by -5 agrees with itself, not with the raw table.
    bad = good.withColumns(
        {
            "hour": put("hour", 1, F.lit(30)),
            "pm10": put("pm10", 2, F.lit(-1.0)),
            "us_aqi": put("us_aqi", 3, F.col("us_aqi") + 5),
            "target_change_24": put("target_change_24", 3, F.col("target_change_24") - 5),
            "pm_total": put("pm_total", 4, F.lit(float("inf"))),
            "ozone": put("ozone", 5, F.lit(None)),
            "note": F.lit("text"),
            "seq": -F.unix_date(F.col("time").cast("date")),
        }
    ).drop("aqi_lag_24")
    bad = materialize(bad.unionByName(bad.where(F.dayofmonth("time") == 6)), "faults")
    report = quality.quality_report(bad, stored_days(spark, sf_dir), FULL, DAILY, NON_NEGATIVE, [*FULL.features, "target_aqi_24"], "seq")
    return report.where(F.col("status") == "fail").where(~F.col("check").isin("regular steps"))


@query(
    f"""with series as ({event_hours_sql(True)}),
 p as (select *, lag(time) over (partition by series_id order by time) as before from series),
 c as (select count(*) filter (where time - before <> interval '1 hour') as g, count(*) as n from p)
 select 'no duplicate times' as "check", 'pass' as status, 0 as bad, n as checked from c
 union all select 'regular steps', case when g * 100.0 / n > 0.5 then 'fail' when g > 0 then 'warn' else 'pass' end, g, n from c"""
)
def gap_quality(spark, sf_dir):
    """The key checks on hours with gaps beyond the tolerance."""
    return quality.key_checks(event_hours(spark, sf_dir, by_type=True), HOURLY)


@query(
    complete_sql()
    + "\n"
    + " union all ".join(
        f"select '{t}' as target, round(avg({t}), 6) as mean, round(stddev_samp({t}), 6) as std, min({t}) as min, max({t}) as max from complete"
        for t in TARGETS
    )
)
def target_statistics(spark, sf_dir):
    stats = profile.target_statistics(training_rows(spark, sf_dir).select(*TARGETS), TARGETS)
    return stats.withColumns({c: F.round(c, 6) for c in ("mean", "std")})


# --- splits ------------------------------------------------------------------------------------------------------

_SPLIT = complete_sql() + """,
cut as (select max(time) - interval '240 day' as test_from, max(time) - interval '360 day' as val_from from complete),
parts as (select complete.*, case when time >= test_from then 'test' when time >= val_from then 'val' else 'train' end as split
 from complete cross join cut)
"""


@query(_SPLIT + "select series_id, time, split from parts")
def chronological_split(spark, sf_dir):
    rows = split.chronological_split(training_rows(spark, sf_dir), DAILY, TEST, VALIDATION)
    split.check_split(rows)
    return rows.select("series_id", "time", "split")


@query(_SPLIT + "select split, count(*) as n_rows, min(time) as min_time, max(time) as max_time from parts where split in ('train', 'val') group by 1")
def refit_rows(spark, sf_dir):
    """Train and validation rows together, for the refit after tuning: a filter, not a union."""
    rows = split.chronological_split(training_rows(spark, sf_dir), DAILY, TEST, VALIDATION).where("split in ('train', 'val')")
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.min("time").alias("min_time"), F.max("time").alias("max_time"))


@query(complete_sql() + " select series_id, time, us_aqi from complete where time < (select max(time) - interval '360 day' from complete)")
def selection_cutoff(spark, sf_dir):
    return split.selection_rows(training_rows(spark, sf_dir), DAILY, HELD_OUT).select("series_id", "time", "us_aqi")


@query(
    complete_sql()
    + """, t as (select time, row_number() over (order by time) as i, count(*) over () as n from (select distinct time from complete)),
 k as (select unnest(range(4)) as fold),
 c as (select fold, max(n) as n, max(n // 5) as size from t cross join k group by 1)
 select cast(fold as integer) as fold, n - (4 - fold) * size as train_times, size as test_times,
 (select time from t where i = n - (4 - fold) * size) as train_end, (select time from t where i = n - (3 - fold) * size) as test_end from c"""
)
def expanding_folds(spark, sf_dir):
    return split.expanding_folds(training_rows(spark, sf_dir), DAILY, 4)


# --- selection ---------------------------------------------------------------------------------------------------

_PLACES = ", ".join(f"('{f}', {i})" for i, f in enumerate(FULL.features))


@query(
    complete_sql()
    + f""", s as (select row_number() over () as r, * from complete where time < (select max(time) - interval '360 day' from complete)),
 l as (unpivot (select r, {', '.join(f'cast({f} as double) as {f}' for f in FULL.features)} from s) on {', '.join(FULL.features)} into name name value x),
 o as (select name, i, stddev_pop(x) > 0 as varies from l join (values {_PLACES}) p(name, i) using (name) group by 1, 2),
 v as (select l.r, o.i, l.x from l join o using (name) where o.varies),
 c as (select a.i as i, b.i as j, round(abs(corr(a.x, b.x)), 5) as abs_corr from v a join v b on a.r = b.r and a.i < b.i group by 1, 2)
 select a.name as a, b.name as b, c.abs_corr from o a join o b on a.i < b.i left join c on c.i = a.i and c.j = b.i"""
)
def correlation_matrix(spark, sf_dir):
    """Every pair of the candidates; null where one of them is constant."""
    rows = split.selection_rows(training_rows(spark, sf_dir), DAILY, HELD_OUT)
    return selection.correlation_pairs(rows, FULL.features).withColumn("abs_corr", F.round("abs_corr", 5))


_MEAN_TARGET = "(target_change_24 + target_change_48 + target_change_72) / 3"
_SELECTION = complete_sql() + ", s as (select * from complete where time < (select max(time) - interval '360 day' from complete)),\n"


# corr() is undefined for a constant column; the SQL reads it as 0 too.
@query(
    _SELECTION
    + f"l as (unpivot (select {_MEAN_TARGET} as y, {', '.join(f'cast({f} as double) as {f}' for f in FULL.features)} from s) on {', '.join(FULL.features)} into name feature value x)\n"
    + "select feature, round(case when stddev_samp(x) > 0 then abs(corr(x, y)) else 0 end, 6) as relevance from l group by 1"
)
def target_relevance(spark, sf_dir):
    rows = split.selection_rows(training_rows(spark, sf_dir), DAILY, HELD_OUT)
    scores = selection.relevance(rows, FULL.features, {"mean": selection.mean_target(FULL.change_targets)})
    return scores.select("feature", F.round("relevance", 6).alias("relevance"))


_BY_HORIZON = (
    _SELECTION
    + "l as (unpivot (select target_change_24, target_change_48, target_change_72, "
    + ", ".join(f"cast({f} as double) as {f}" for f in FULL.features)
    + f" from s) on {', '.join(FULL.features)} into name feature value x),\n r as ("
    + " union all ".join(
        f"select {h} as horizon, feature, round(case when stddev_samp(x) > 0 then abs(corr(x, target_change_{h})) else 0 end, 6) as importance from l group by 2"
        for h in FULL.horizons
    )
    + "), t as (select *, row_number() over (partition by horizon order by importance desc, feature) as rank from r)\n"
)


def _horizon_scores(spark, sf_dir):
    rows = split.selection_rows(training_rows(spark, sf_dir), DAILY, HELD_OUT)
    scores = selection.relevance(rows, FULL.features, {str(h): F.col(FULL.change_target_name(h)) for h in FULL.horizons})
    return scores.select(F.col("target").cast("int").alias("horizon"), "feature", F.round("relevance", 6).alias("importance"))


@query(_BY_HORIZON + "select horizon, feature, importance, rank from t where rank <= 15")
def top_features_per_horizon(spark, sf_dir):
    return selection.top_features(_horizon_scores(spark, sf_dir), 15)


_SETS = " union ".join(f"select 'FS{n}' as set_name, feature from t where rank <= {n}" for n in selection.SET_SIZES)


@query(_BY_HORIZON + f"select set_name, cast(row_number() over (partition by set_name order by feature) - 1 as integer) as pos, feature from ({_SETS})")
def feature_sets_by_relevance(spark, sf_dir):
    """Five feature sets: unions over horizons of the top features, ranked by correlation."""
    return selection.feature_sets(_horizon_scores(spark, sf_dir))


@query(
    _BY_HORIZON
    + f"""select set_name, case when starts_with(feature, 'forecast_') then 'forecast' when starts_with(feature, 'aqi_lag_') then 'lags'
 when starts_with(feature, 'aqi_rolling_') then 'rolling' else 'other' end as family, count(*) as features from ({_SETS}) group by 1, 2"""
)
def family_breakdown(spark, sf_dir):
    return selection.family_breakdown(selection.feature_sets(_horizon_scores(spark, sf_dir)))


@query(
    complete_sql().replace("with ", "with recursive ", 1)
    + f""", s as (select row_number() over () as r, {_MEAN_TARGET} as y, * from complete where time < (select max(time) - interval '360 day' from complete)),
 l as (unpivot (select r, y, {', '.join(f'cast({f} as double) as {f}' for f in FULL.features)} from s) on {', '.join(FULL.features)} into name name value x),
 v as (select name, stddev_pop(x) > 0 as varies, corr(x, y) as c from l group by 1),
 o as materialized (select name, varies, relevance, row_number() over (order by relevance desc, name) as k from (select name, varies, case when varies then round(abs(c), 9) else 0 end as relevance from v)),
 w as (select l.r, o.k, l.x from l join o using (name) where o.varies),
 pairs as (select a.k as j, b.k as k, abs(corr(a.x, b.x)) as c from w a join w b on a.r = b.r and a.k < b.k group by 1, 2),
 rivals as materialized (select k, list(j) as js from pairs where c > {selection.CORRELATION_LIMIT} group by 1),
 walk as (select 0::bigint as k, [0::bigint] as kept, 0::bigint as rival
  union all select o.k, case when coalesce(len(list_intersect(walk.kept, rivals.js)), 0) = 0 then list_append(walk.kept, o.k) else walk.kept end,
  coalesce(list_min(list_intersect(walk.kept, rivals.js)), 0) from walk join o on o.k = walk.k + 1 left join rivals on rivals.k = o.k)
 select o.name as feature, round(o.relevance, 6) as relevance, walk.rival = 0 as kept, coalesce(p.name, '') as rival from walk join o using (k) left join o p on p.k = walk.rival"""
)
def pruned_features(spark, sf_dir):
    """Greedy correlation pruning over all 188 features, with the better feature that each dropped one is too close to."""
    rows = split.selection_rows(training_rows(spark, sf_dir), DAILY, HELD_OUT)
    kept, reasons, scores = selection.select_uncorrelated(rows, FULL.features, FULL.change_targets)
    table = [(f, round(scores[f], 6), f in kept, reasons.get(f, "").split(" ")[-1]) for f in FULL.features]
    return spark.createDataFrame(table, "feature string, relevance double, kept boolean, rival string")


@query(_BY_HORIZON + "select 'FS50' as set_name, cast(row_number() over (order by feature) - 1 as integer) as pos, feature from (select distinct feature from t where rank <= 50)")
def feature_list_store(spark, sf_dir):
    """Feature sets written as a table and one read back in stored order."""
    path = new_path(spark, "lists")
    selection.feature_sets(_horizon_scores(spark, sf_dir), (50,)).coalesce(1).write.parquet(path)
    names = metadata.read_feature_list(spark, path, "FS50")
    return metadata.feature_list_table(spark, {"FS50": names})


# --- baseline forecasts and their metrics ------------------------------------------------------------------------

_PREDICTIONS = _SPLIT + """, base as (select * from parts where split = 'test'),
pred as (
""" + " union all ".join(
    f"""select 'all' as feature_set, m.model, '{h}' as horizon, series_id, time, target_aqi_{h} as actual,
 case m.model when 'persistence' then us_aqi when 'half lag' then us_aqi + 0.5 * (aqi_lag_24 - us_aqi) else us_aqi + 0.5 * 0 + 0.5 * (0.5 * (aqi_lag_24 - us_aqi)) end as predicted
 from base cross join (values ('persistence'), ('half lag'), ('blend')) m(model)"""
    for h in FULL.horizons
) + ")\n"


def baseline_predictions(spark, sf_dir):
    """Persistence, a naive drift toward the level a lag ago, and the blend of both, on test rows, in one long table."""
    rows = split.chronological_split(training_rows(spark, sf_dir), DAILY, TEST, VALIDATION).where("split = 'test'")
    level = F.col(FULL.level)
    flat, drift = F.lit(0.0), (F.col("aqi_lag_24") - level) * 0.5
    changes = {"persistence": flat, "half lag": drift, "blend": S.blend([(0.5, flat), (0.5, drift)])}
    cells = [
        F.struct(
            F.lit("all").alias("feature_set"),
            F.lit(m).alias("model"),
            F.lit(str(h)).alias("horizon"),
            F.col(FULL.level_target_name(h)).alias("actual"),
            S.reconstruct(level, change, clamp=False).alias("predicted"),
        )
        for m, change in changes.items()
        for h in FULL.horizons
    ]
    return rows.select("series_id", "time", F.inline(F.array(*cells)))


@query(_PREDICTIONS + "select feature_set, model, horizon, series_id, time, actual, predicted from pred where model <> 'blend'")
def persistence_predictions(spark, sf_dir):
    return baseline_predictions(spark, sf_dir).where("model <> 'blend'").select("feature_set", "model", "horizon", "series_id", "time", "actual", "predicted")


@query(_PREDICTIONS + "select series_id, time, horizon, predicted from pred where model = 'blend'")
def weighted_blend(spark, sf_dir):
    return baseline_predictions(spark, sf_dir).where("model = 'blend'").select("series_id", "time", "horizon", "predicted")


_METRICS = (
    _PREDICTIONS[:-1]
    + """, m as (select feature_set, model, horizon, sqrt(avg((predicted - actual) ** 2)) as rmse, avg(abs(predicted - actual)) as mae,
 1 - sum((predicted - actual) ** 2) / (var_pop(actual) * count(*)) as r2 from pred group by 1, 2, 3),
 s as (select feature_set, model, avg(rmse) as mean_rmse, avg(mae) as mean_mae, avg(r2) as mean_r2 from m group by 1, 2)
"""
)


def _round(df, columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _round_sql(columns, digits=6):
    return ", ".join(f"round({c}, {digits}) as {c}" for c in columns)


MEANS = ["mean_rmse", "mean_mae", "mean_r2"]


@query(_METRICS + f"select feature_set, model, horizon, {_round_sql(metrics.METRICS)} from m")
def regression_metrics(spark, sf_dir):
    return _round(metrics.regression_metrics(baseline_predictions(spark, sf_dir)), metrics.METRICS)


@query(_METRICS + f"select feature_set, model, {_round_sql(MEANS)} from s order by mean_rmse, feature_set, model")
def horizon_means(spark, sf_dir):
    means = metrics.horizon_means(metrics.regression_metrics(baseline_predictions(spark, sf_dir)))
    return _round(means, MEANS).orderBy("mean_rmse", "feature_set", "model")


@query(_METRICS + f"select feature_set, model, {_round_sql(MEANS)} from s order by s.mean_rmse, feature_set, model limit 1")
def best_model(spark, sf_dir):
    means = metrics.horizon_means(metrics.regression_metrics(baseline_predictions(spark, sf_dir)))
    return _round(metrics.winner(means), MEANS)


@query(
    _METRICS
    + f"select feature_set, model, horizon, {_round_sql(metrics.METRICS)} from m qualify row_number() over (partition by horizon order by m.rmse, feature_set, model) = 1"
)
def best_model_per_horizon(spark, sf_dir):
    scores = metrics.regression_metrics(baseline_predictions(spark, sf_dir))
    return _round(metrics.winner(scores, by=("horizon",), score="rmse"), metrics.METRICS)


_WIDE = [f"{m}_{h}" for m in metrics.METRICS for h in FULL.horizons]


@query(
    _METRICS
    + f"select feature_set, model, {_round_sql(MEANS)}, "
    + ", ".join(f"round(max({m}) filter (where horizon = '{h}'), 6) as {m}_{h}" for m in metrics.METRICS for h in FULL.horizons)
    + " from s join m using (feature_set, model) group by feature_set, model, s.mean_rmse, s.mean_mae, s.mean_r2"
)
def results_wide(spark, sf_dir):
    """Long and wide results and the winner written; the wide table read back."""
    long = metrics.regression_metrics(baseline_predictions(spark, sf_dir))
    long = materialize(long, "results")
    path = new_path(spark, "results")
    best = metrics.winner(metrics.horizon_means(long))
    metadata.write_results(long, best, path, [str(h) for h in FULL.horizons])
    schema = "feature_set string, model string, " + ", ".join(f"{c} double" for c in [*MEANS, *_WIDE])
    return _round(spark.read.schema(schema).option("header", True).csv(f"{path}/wide"), [*MEANS, *_WIDE])


@query(
    _METRICS
    + "select 'persistence' as name, v as version, round(mean_rmse, 6) as rmse from s cross join (values (1), (2)) t(v) where model = 'persistence'"
)
def model_registry(spark, sf_dir):
    """The same model registered twice gets versions 1 and 2."""
    means = metrics.horizon_means(metrics.regression_metrics(baseline_predictions(spark, sf_dir).where("model = 'persistence'")))
    row = means.first()
    path = new_path(spark, "registry")
    for _ in range(2):
        metadata.register_model(spark, path, "persistence", {"rmse": row["mean_rmse"]}, "none", "change = 0")
    rows = metadata.registry_rows(spark, path)
    return rows.select("name", "version", F.round(F.col("metrics")["rmse"], 6).alias("rmse"))
