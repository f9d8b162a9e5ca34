import math
import random
import re
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import START, column, hourly
from tsengine.functions import scalars as S
from tsengine import queries
from tsengine.operators.windows import part_size
from tsengine.plans import serve
from tsengine.plans.feature_plan import FeatureSpec, air_quality_spec, build_features
from tsengine.queries import bindings, features  # noqa: F401
from tsengine.series import HOURLY, anchored, bucketize, fill_gaps

SMALL = FeatureSpec(
    level="v",
    prefix="v",
    measures=("v",),
    calendar=False,
    lags=(1,),
    windows=(3,),
    changes=(2,),
    percent_changes=(1,),
    lead_measures=("v",),
    leads=(2,),
    forward_sums=(("sum", "v"),),
)


def test_lag_rolling_change_lead(spark):
    out = build_features(hourly(spark, [10, 20, None, 40, 0, 50, 60, 30]), SMALL, HOURLY)
    n = None
    assert column(out, "v_lag_1") == [n, 10, 20, n, 40, 0, 50, 60]
    assert column(out, "v_rolling_mean_3") == [n, n, n, n, n, 30, 36.666667, 46.666667]
    assert column(out, "v_rolling_median_3") == [n, n, n, n, n, 40, 50, 50]
    assert column(out, "v_rolling_std_3") == [n, n, n, n, n, 26.457513, 32.145503, 15.275252]
    assert column(out, "v_change_2") == [n, n, n, 20, n, 10, 60, -20]
    assert column(out, "v_pct_change_1") == [n, 100, n, n, -100, n, 20, -50]
    assert column(out, "forecast_v_2") == [n, 40, 0, 50, 60, 30, n, n]
    assert column(out, "forecast_sum_2") == [n, n, 40, 50, 110, 90, n, n]


def test_same_phase_skips_nulls(spark):
    spec = FeatureSpec(level="v", prefix="v", measures=("v",), calendar=False, phase_period=2, phase_count=3)
    out = build_features(hourly(spark, [1, 2, 3, None, 5, 6, 7, 8]), spec, HOURLY)
    n = None
    assert column(out, "v_same_hour_mean_7d") == [n, n, 1, 2, 2, 2, 3, 4]
    assert column(out, "v_same_hour_std_7d") == [n, n, n, n, 1.414214, n, 2, 2.828427]
    assert column(out, "v_same_hour_min_7d") == [n, n, 1, 2, 1, 2, 1, 2]
    assert column(out, "v_same_hour_max_7d") == [n, n, 1, 2, 3, 2, 5, 6]


def test_grid_fills_gaps_and_drops_off_grid_rows(spark):
    at = [timedelta(hours=0), timedelta(hours=1), timedelta(hours=2, minutes=30), timedelta(hours=4)]
    rows = [("a", START + t, float(i + 1)) for i, t in enumerate(at)]
    df = spark.createDataFrame(rows, "series_id string, time timestamp_ntz, v double")
    assert column(fill_gaps(df, HOURLY), "v") == [1, 2, None, None, 4]
    shifted = df.withColumn("time", F.expr("time + interval '20' minute"))
    assert column(fill_gaps(shifted, anchored(HOURLY)), "v") == [1, 2, None, None, 4]


def test_grid_before_the_epoch(spark):
    df = hourly(spark, [1, 2, None, 4], start=datetime(1969, 12, 31, 22)).where("v is not null")
    assert column(fill_gaps(df, HOURLY, chunk_steps=2), "v") == [1, 2, None, 4]


def test_chunks_do_not_change_results(spark):
    """One long series cut into many chunks gives what one chunk gives, nulls included."""
    rng = random.Random(1)
    values = [None if rng.random() < 0.02 else rng.randint(0, 50) for _ in range(900)]
    spec = FeatureSpec(
        level="v",
        prefix="v",
        measures=("v",),
        lags=(1, 30),
        windows=(6, 24, 48, 72),
        forward_sums=(("sum", "v"),),
        leads=(24, 48),
        phase_period=24,
        phase_count=3,
        horizons=(24,),
    )
    df = hourly(spark, values).where("v is not null").unionByName(hourly(spark, values[:300], series="b").where("v is not null"))
    whole = build_features(df, spec, HOURLY, chunk_steps=100_000)
    cut = build_features(df, spec, HOURLY, chunk_steps=80)
    names = [c for c in whole.columns if c not in HOURLY.columns]
    rounded = lambda d: d.select("series_id", "time", *[F.round(c, 9).alias(c) for c in names])
    assert whole.count() == cut.count()
    assert rounded(whole).exceptAll(rounded(cut)).count() == 0


def test_composed_windows_match_direct_statistics(spark):
    rng = random.Random(2)
    values = [rng.uniform(-1e3, 1e3) for _ in range(120)]
    spec = FeatureSpec(level="v", prefix="v", measures=("v",), calendar=False, windows=(72,))
    row = build_features(hourly(spark, values), spec, HOURLY).orderBy(F.desc("time")).first()
    last = sorted(values[-72:])
    mean = sum(last) / 72
    assert row["v_rolling_mean_72"] == pytest.approx(mean)
    assert row["v_rolling_std_72"] == pytest.approx(math.sqrt(sum((x - mean) ** 2 for x in last) / 71))
    assert row["v_rolling_median_72"] == pytest.approx((last[35] + last[36]) / 2)
    assert (row["v_rolling_min_72"], row["v_rolling_max_72"]) == (last[0], last[-1])
    assert [part_size(n) for n in (6, 24, 48, 72, 168, 97)] == [6, 24, 24, 24, 24, 97]


def test_recipe_size():
    spec = air_quality_spec()
    sizes = {k: len(v) for k, v in spec.families().items()}
    assert len(spec.features) == len(set(spec.features)) == 188
    assert sizes["measures"] == 17 and sizes["calendar"] == 15 and sizes["measure changes"] == 36 and sizes["directions"] == 8
    assert spec.level_targets + spec.change_targets == [f"target_{k}_{h}" for k in ("aqi", "change") for h in (24, 48, 72)]
    assert (spec.back, spec.ahead) == (504, 72)


def test_calendar_and_circle(spark):
    times = [(datetime(2024, 12, 30, 18),), (datetime(2024, 1, 6),)]
    df = spark.createDataFrame(times, "t timestamp_ntz").select("t", *[c.alias(n) for n, c in S.calendar_parts(F.col("t")).items()])
    monday, saturday = df.orderBy(F.desc("t")).collect()
    assert (monday["day_of_week"], monday["day_of_year"], monday["week_of_year"], monday["is_weekend"]) == (0, 365, 1, 0)
    assert (saturday["day_of_week"], saturday["is_weekend"]) == (5, 1)
    sin, cos = S.on_circle(F.lit(18), 24.0)
    row = spark.range(1).select(F.round(sin, 9), F.round(cos, 9)).first()
    assert tuple(row) == (-1.0, 0.0)


@pytest.mark.parametrize(
    ("value", "name"),
    [(50, "Good"), (50.1, "Moderate"), (150, "Unhealthy (Sensitive)"), (200, "Unhealthy"), (200.1, "Very Unhealthy"), (300, "Very Unhealthy"), (300.1, "Hazardous")],
)
def test_bands(spark, value, name):
    assert spark.range(1).select(S.band(F.lit(value))).first()[0] == name


@pytest.mark.parametrize(("value", "name"), [(149.9, "none"), (150.0, "sensitive"), (199.9, "sensitive"), (200.0, "severe")])
def test_alerts(spark, value, name):
    assert spark.range(1).select(S.alert([F.lit(10.0), F.lit(value)])).first()[0] == name


def test_reconstruction_clamps_only_when_serving(spark):
    change = S.blend([(0.5, F.lit(-30.0)), (0.5, F.lit(-10.0))])
    row = spark.range(1).select(change, S.reconstruct(F.lit(10.0), change, True), S.reconstruct(F.lit(10.0), change, False)).first()
    assert tuple(row) == (-20.0, 0.0, -10.0)


def test_one_shuffle_serves_grid_and_all_windows(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("series_id", F.col("event_type"))
    hours = bucketize(events, HOURLY, "ts", [F.count(F.lit(1)).cast("double").alias("v")])
    spec = FeatureSpec(level="v", prefix="v", measures=("v",), lags=(1, 504), windows=(24, 168), horizons=(72,))
    plan = build_features(hours, spec, HOURLY)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 1
    # bucketing twice (bounds read only the time column) and the bounds themselves; none for windows or gap filling
    assert plan.count("Exchange hashpartitioning") <= 4
    assert plan.count("Window [") == 2 and plan.count("Sort [series_id") == 1
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan or "props" not in plan


def test_two_rows_of_one_time_fail(spark):
    rows = hourly(spark, [1, 2, 3]).unionByName(hourly(spark, [99]))
    spec = FeatureSpec(level="v", prefix="v", measures=("v",), lags=(1,))
    with pytest.raises(Exception, match="two rows of one series and time"):
        build_features(rows, spec, HOURLY).collect()


def test_given_bounds_span_the_grid_and_save_a_scan(spark):
    rows = hourly(spark, [None, 5, 6]).where("v is not null")
    ends = spark.createDataFrame([("a", START, START + timedelta(hours=4))], "series_id string, first timestamp_ntz, last timestamp_ntz")
    spec = FeatureSpec(level="v", prefix="v", measures=("v",), lags=(1,))
    built = build_features(rows, spec, HOURLY, bounds=ends)
    assert column(built, "v_lag_1") == [None, None, 5, 6, None]
    assert column(build_features(rows, spec, HOURLY), "v_lag_1") == [None, 5]


def test_raw_table_is_read_once(spark):
    plan = queries.features.feature_table(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan  # the stored series is read instead; writing it is the one scan of the raw table
    days = queries.bindings.lineitem_days(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert days.count("FileScan") == 1


def test_missing_inputs_stay_missing_when_served(spark):
    spec = FeatureSpec(level="v", prefix="v", measures=("v",), horizons=(6,))
    rows = spark.createDataFrame([("a", 10.0, None), ("b", None, 3.0), ("c", 10.0, 3.0)], "series_id string, v double, m_change_6 double")
    rows = rows.withColumn("time", F.lit(START).cast("timestamp_ntz"))
    table = serve.forecast_table(rows, [("m", 1.0)], spec, HOURLY, (6,))
    got = {r["series_id"]: (r["predicted_level"], r["band"]) for r in table.collect()}
    assert got == {"a": (None, None), "b": (None, None), "c": (13.0, "Good")}
    assert {r["series_id"]: r["alert"] for r in serve.alert_table(table, HOURLY).collect()} == {"a": None, "b": None, "c": "none"}


def test_parts_of_windows_come_without_sliding_frames(spark):
    """Whole numbers, gaps and windows of one, two and four parts equal a plain loop; Spark re-aggregates no frame row by row."""
    rng = random.Random(3)
    values = [None if i in (1, 95) else rng.randint(-50, 50) for i in range(200)]
    spec = FeatureSpec(level="v", prefix="v", measures=("v",), calendar=False, windows=(1, 7, 28, 84), forward_sums=(("sum", "v"),), leads=(7, 28))
    rows = hourly(spark, values).withColumn("v", F.col("v").cast("int"))
    out = build_features(rows, spec, HOURLY)
    assert not re.search(r"RowFrame, -\d+, currentrow", out._jdf.queryExecution().executedPlan().toString())
    assert dict(out.dtypes)["forecast_sum_7"] == "bigint" and dict(out.dtypes)["v_rolling_max_84"] == "int"
    plain = {"mean": statistics.mean, "min": min, "max": max, "median": statistics.median, "std": lambda x: statistics.stdev(x) if len(x) > 1 else None}
    whole = lambda x, n, f: f(x) if len(x) == n and None not in x else None
    want = {f"v_rolling_{s}_{n}": [whole(values[max(0, i - n + 1) : i + 1], n, f) for i in range(200)] for s, f in plain.items() for n in spec.windows}
    want |= {f"forecast_sum_{n}": [whole(values[i + 1 : i + 1 + n], n, sum) for i in range(200)] for n in spec.leads}
    got = out.orderBy("time").collect()
    for name, expected in want.items():
        assert [r[name] for r in got] == pytest.approx(expected), name
