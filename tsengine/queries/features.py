"""Feature families, one query each, and the whole wide table."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tsengine.functions import scalars as S
from tsengine.operators import windows as W
from tsengine.operators.clean import complete_cases
from tsengine.plans.feature_plan import FeatureSpec, build_features, training_table
from tsengine.queries.bindings import (
    FULL,
    complete_sql,
    event_hours,
    event_hours_sql,
    feature_sql,
    lineitem_days,
    stored_days,
    lineitem_days_sql,
    rounded,
    rounded_sql,
    table,
)
from tsengine.series import DAILY, HOURLY, chunk_grid

QUERIES = {}
ORACLES = {}

BARE = FeatureSpec(level=FULL.level, prefix=FULL.prefix, measures=FULL.measures, calendar=False)
FAMILIES: dict[str, FeatureSpec] = {
    "level_lags": replace(BARE, lags=FULL.lags),
    **{f"rolling_{s}": replace(BARE, windows=FULL.windows, stats=(s,)) for s in FULL.stats},
    "level_change": replace(BARE, changes=FULL.changes),
    "percent_change": replace(BARE, percent_changes=FULL.percent_changes),
    "trend": replace(BARE, trends=FULL.trends),
    "deviation_from_rolling_mean": replace(BARE, deviations=FULL.deviations),
    "same_phase_history": replace(BARE, phase_count=7),
    "weekly_phase_history": replace(BARE, phase_count=7, phase_period=7, phase_name="same_weekday", phase_suffix="7w"),
    "column_changes": replace(BARE, change_measures=FULL.change_measures, change_steps=FULL.change_steps),
    "lead_features": replace(BARE, lead_measures=FULL.lead_measures, leads=FULL.leads),
    "lead_delta": replace(BARE, lead_deltas=FULL.lead_deltas, leads=FULL.leads),
    "forward_rolling_sum": replace(BARE, forward_sums=FULL.forward_sums, leads=FULL.leads),
    "direction_components": replace(BARE, angles=FULL.angles, leads=FULL.leads),
    "safe_ratios": replace(BARE, sums=FULL.sums, ratios=FULL.ratios),
    "interaction_products": replace(BARE, products=FULL.products),
}


def _family_query(spec: FeatureSpec, names: list[str]):
    def run(spark, sf_dir):
        return rounded(build_features(stored_days(spark, sf_dir), spec, DAILY), names)

    return run


for _name, _spec in FAMILIES.items():
    _columns = [c for c in _spec.features if c not in _spec.measures]
    QUERIES[_name] = _family_query(_spec, _columns)
    ORACLES[_name] = feature_sql(_spec) + "\n" + rounded_sql(_columns, "features")

_targets = replace(BARE, horizons=FULL.horizons)
QUERIES["level_targets"] = _family_query(_targets, _targets.level_targets)
ORACLES["level_targets"] = feature_sql(_targets) + "\n" + rounded_sql(_targets.level_targets, "features")
QUERIES["change_targets"] = _family_query(_targets, _targets.change_targets)
ORACLES["change_targets"] = feature_sql(_targets) + "\n" + rounded_sql(_targets.change_targets, "features")

_sum_only = replace(BARE, sums=FULL.sums)
QUERIES["sum_composition"] = _family_query(_sum_only, ["pm_total"])
ORACLES["sum_composition"] = feature_sql(_sum_only) + "\n" + rounded_sql(["pm_total"], "features")

ALL_COLUMNS = [*FULL.features, *FULL.level_targets, *FULL.change_targets]


def feature_table(spark, sf_dir):
    """188 features and 6 targets on every row of the regular grid."""
    return rounded(build_features(stored_days(spark, sf_dir), FULL, DAILY), ALL_COLUMNS)


def complete_feature_table(spark, sf_dir):
    features = build_features(stored_days(spark, sf_dir), FULL, DAILY)
    return rounded(training_table(features, FULL), ALL_COLUMNS)


QUERIES["feature_table"] = feature_table
ORACLES["feature_table"] = feature_sql() + "\n" + rounded_sql(ALL_COLUMNS, "features")
QUERIES["complete_feature_table"] = complete_feature_table
ORACLES["complete_feature_table"] = complete_sql() + "\n" + rounded_sql(ALL_COLUMNS, "complete")

# One series per supplier: their number grows with the data.
SUPPLIER = replace(
    BARE, lags=(1, 7, 28), windows=(7, 28, 84), changes=(7,), percent_changes=(28,), forward_sums=FULL.forward_sums, leads=(7, 28), horizons=(7, 28)
)
_supplier_columns = [c for c in SUPPLIER.features if c not in SUPPLIER.measures] + SUPPLIER.level_targets


def supplier_features(spark, sf_dir):
    return rounded(build_features(stored_days(spark, sf_dir, "l_suppkey"), SUPPLIER, DAILY), _supplier_columns)


QUERIES["supplier_features"] = supplier_features
ORACLES["supplier_features"] = (
    feature_sql(SUPPLIER, lineitem_days_sql("l_suppkey")) + "\n" + rounded_sql(_supplier_columns, "features")
)

HOUR_SPEC = FeatureSpec(
    level="cents", prefix="cents", measures=("n", "cents", "top_user"), lags=(1, 3, 6, 12), windows=(6, 12), horizons=(6, 12)
)


def hourly_event_features(spark, sf_dir):
    """Raw events to hours, gaps filled, calendar, lags, rolling statistics and targets per event type."""
    features = build_features(event_hours(spark, sf_dir, by_type=True), HOUR_SPEC, HOURLY)
    return rounded(features, [*HOUR_SPEC.features, *HOUR_SPEC.level_targets, *HOUR_SPEC.change_targets])


QUERIES["hourly_event_features"] = hourly_event_features
ORACLES["hourly_event_features"] = (
    feature_sql(HOUR_SPEC, event_hours_sql(True), "'1 hour'")
    + "\n"
    + rounded_sql([*HOUR_SPEC.features, *HOUR_SPEC.level_targets, *HOUR_SPEC.change_targets], "features")
)


def range_rolling_mean(spark, sf_dir):
    """Rolling mean by time range on the rows as they are, gaps left open; equals the gridded one on those rows."""
    days = event_hours(spark, sf_dir, by_type=True)
    grid = chunk_grid(days, HOURLY, ["n"], back=11)
    present = grid.df.where(F.col("n").isNotNull())
    mean = W.rolling("n", 12, "mean", grid.window, by_time=True)
    return grid.core(present.withColumn("n_mean_12", F.round(mean, 6))).drop("n")


QUERIES["range_rolling_mean"] = range_rolling_mean
ORACLES["range_rolling_mean"] = f"""with series as ({event_hours_sql(True)})
select series_id, time, round(case when count(n) over f = 12 then avg(n) over f end, 6) as n_mean_12
from series window f as (partition by series_id order by time range between interval 11 hour preceding and current row)"""


def calendar_parts(spark, sf_dir):
    parts = S.calendar_parts(F.col("ts"))
    return table(spark, sf_dir, "events").select("event_id", *[c.alias(n) for n, c in parts.items()])


QUERIES["calendar_parts"] = calendar_parts
ORACLES["calendar_parts"] = """select event_id, cast(hour(ts) as integer) as hour, cast(day(ts) as integer) as day,
 cast(month(ts) as integer) as month, cast(isodow(ts) - 1 as integer) as day_of_week,
 cast(dayofyear(ts) as integer) as day_of_year, cast(weekofyear(ts) as integer) as week_of_year,
 case when isodow(ts) >= 6 then 1 else 0 end as is_weekend from events"""


def cyclical_encoding(spark, sf_dir):
    parts = S.calendar_parts(F.col("ts"))
    circles = {n: S.on_circle(parts[n], period) for n, period in S.CYCLES.items()}
    return table(spark, sf_dir, "events").select(
        "event_id",
        *[F.round(c, 6).alias(f"{n}_{fn}") for n, pair in circles.items() for fn, c in zip(("sin", "cos"), pair, strict=True)],
    )


QUERIES["cyclical_encoding"] = cyclical_encoding
ORACLES["cyclical_encoding"] = "select event_id, " + ", ".join(
    f"round({fn}(2 * pi() * {e} / {period}), 6) as {n}_{fn}"
    for n, e, period in (
        ("hour", "hour(ts)", 24),
        ("day_of_week", "(isodow(ts) - 1)", 7),
        ("month", "month(ts)", 12),
        ("day_of_year", "dayofyear(ts)", 365.25),
    )
    for fn in ("sin", "cos")
) + " from events"


def complete_cases_level(spark, sf_dir):
    """Rows with no null among a few lags, on the series with gaps."""
    spec = replace(BARE, lags=(1, 24), horizons=(24,))
    return rounded(complete_cases(build_features(stored_days(spark, sf_dir), spec, DAILY)), ["us_aqi", "aqi_lag_1", "aqi_lag_24", "target_aqi_24"])


_cc = replace(BARE, lags=(1, 24), horizons=(24,))
QUERIES["complete_cases"] = complete_cases_level
ORACLES["complete_cases"] = (
    feature_sql(_cc)
    + "\n"
    + rounded_sql(["us_aqi", "aqi_lag_1", "aqi_lag_24", "target_aqi_24"], "features")
    + " where " + " and ".join(f"{c} is not null" for c in [*_cc.features, "target_aqi_24", "target_change_24"])
)
