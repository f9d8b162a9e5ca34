import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import START, column, hourly
from tsengine.operators import clean, joins, profile, quality, split
from tsengine.plans.feature_plan import FeatureSpec, build_features, training_table
from tsengine.series import HOURLY, SeriesKeys, previous_value
from tsengine.session import materialize, new_path, release
from tsengine.sources import feeds, metadata
from tsengine.sources.store import FeatureGroup, GateError, feature_view, gate


def test_two_stage_dedup_order(spark):
    rows = spark.createDataFrame([("t", "a", 1), ("t", "b", 2), ("t", "a", 3)], "time string, v string, seq int")
    assert clean.two_stage_dedup(rows, ["time"], "seq").first()["v"] == "b"
    assert clean.dedup_by_key(rows, ["time"], "seq").first()["v"] == "a"


def test_coercion(spark):
    texts = spark.createDataFrame([("2024-01-01T05:00",), ("2024-01-01 05:00:00",), ("bad",)], "time string")
    assert [r[0] for r in clean.coerce_time(texts, "time").collect()] == [datetime(2024, 1, 1, 5)] * 2
    assert clean.coerce_time(texts, "time", "null").where("time is null").count() == 1
    with pytest.raises(Exception, match="invalid time"):
        clean.coerce_time(texts, "time", "raise").collect()
    numbers = spark.createDataFrame([("x",), ("1.5",), ("NaN",)], "n string")
    assert column(clean.coerce_numbers(numbers, ["n"]), "n", order="n") == [None, None, 1.5]


def test_projection_modes(spark):
    df = hourly(spark, [1]).withColumn("target", F.lit(1.0))
    with pytest.raises(ValueError, match="missing"):
        clean.project_features(df, ["v", "other"])
    with pytest.warns(UserWarning):
        out = clean.project_features(df, ["target", "v", "other"], "lenient", never=("target",))
    assert out.columns == ["v"]
    with pytest.raises(ValueError, match="no usable"):
        clean.project_features(df, ["target"], never=("target",))
    with pytest.raises(ValueError, match="missing"):
        clean.require_columns(df, ["v", "nope"])


def test_now_rows(spark):
    df = hourly(spark, [0, 1, 2, 3, 4])
    assert clean.now_rows(df, HOURLY, START + timedelta(hours=6, minutes=40)).first()["v"] == 4
    assert clean.now_rows(df, HOURLY, START + timedelta(hours=3, minutes=59)).first()["v"] == 3
    with pytest.raises(ValueError, match="null model inputs"):
        clean.assert_no_nulls(hourly(spark, [None]), ["v"])


def test_split_and_folds(spark):
    days = spark.sql("select 'a' series_id, explode(sequence(timestamp_ntz'2024-01-01', timestamp_ntz'2024-06-30', interval 1 day)) as time")
    daily = SeriesKeys(step_seconds=86400)
    parts = split.chronological_split(days, daily, timedelta(days=60), timedelta(days=30))
    firsts = {r["split"]: r["t"] for r in parts.groupBy("split").agg(F.min("time").alias("t")).collect()}
    assert firsts["test"] == datetime(2024, 5, 1) and firsts["val"] == datetime(2024, 4, 1)
    with pytest.raises(ValueError, match="val part"):
        split.check_split(parts)
    apart = split.chronological_split(days, daily, timedelta(days=60), timedelta(days=30), embargo=timedelta(days=3))
    assert apart.count() == days.count() - 6
    folds = split.expanding_folds(hourly(spark, range(11)), HOURLY, 3).orderBy("fold").collect()
    assert [(f["train_times"], f["test_times"]) for f in folds] == [(5, 2), (7, 2), (9, 2)]
    assert folds[0]["train_end"] == START + timedelta(hours=4) and folds[2]["test_end"] == START + timedelta(hours=10)


def test_previous_value_across_buckets(spark):
    df = spark.range(50).select(F.lit("a").alias("k"), "id", (F.col("id") * 3).alias("v")).where("id < 7 or id > 33")
    out = previous_value(df, ["k"], "id", "v", (F.col("id") / 5).cast("bigint"), "before").orderBy("id").collect()
    ids = [r["id"] for r in out]
    assert [r["before"] for r in out] == [None] + [i * 3 for i in ids[:-1]]


def test_gaps_and_order(spark):
    df = hourly(spark, [1, None, 3, 4]).where("v is not null")
    assert profile.gap_rows(df, HOURLY).first()["time"] == START + timedelta(hours=2)
    mixed = spark.createDataFrame([("a", 1, 5), ("a", 2, 3), ("a", 3, 4)], "k string, seq int, t int")
    assert profile.order_breaks(mixed, ["k"], "seq", "t", bucket_rows=2).first()["order_breaks"] == 1


def test_store_latest_and_as_of(spark):
    group = FeatureGroup(new_path(spark, "g"), "x", 1, HOURLY)
    first, second = hourly(spark, [1, 2]), hourly(spark, [20, 30], start=START + timedelta(hours=1))
    group.commit(first, 1)
    group.commit(second, 2)
    group.commit(second, 2)  # a retried commit counts once
    assert column(group.read(spark), "v") == [1, 20, 30]
    assert column(group.read(spark, as_of=1), "v") == [1, 2]
    assert group.log(spark).count() == 4
    packed = FeatureGroup(group.root, "x", 2, HOURLY)
    group.compact(spark, packed, 1)
    assert column(packed.read(spark), "v") == [1, 20, 30]


def test_gate_and_view(spark):
    good = hourly(spark, [1, 2])
    assert gate(good, HOURLY, ["v"]) == {"nulls": 0, "duplicates": 0}
    with pytest.raises(GateError):
        gate(good.union(good), HOURLY, ["v"])
    with pytest.raises(GateError):
        gate(hourly(spark, [1, None]), HOURLY, ["v"])
    view, labels = feature_view(good.withColumn("c", F.lit(1)), ["c"], ["v"])
    assert view.columns == good.columns and labels.first()["label"] == "v"


def test_feeds(spark):
    path = new_path(spark, "feed")
    texts = ['{"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "a": [1.5, null]}}', '{"error": true}']
    spark.createDataFrame([(t,) for t in texts], "value string").write.text(path)
    rows, rejected = feeds.read_payloads(spark, path, {"a": "double"})
    assert column(rows, "a") == [1.5, None] and rejected.count() == 1
    path = new_path(spark, "csv")
    spark.createDataFrame([("time,v",), ("2024-01-01 00:00:00,1",), ("2024-01-01T01:00,x",)], "value string").coalesce(1).write.text(path)
    rows, corrupt = feeds.read_csv(spark, path, "time string, v double", "time")
    assert column(rows, "v") == [1] and corrupt.count() == 1


def test_metadata(spark):
    assert metadata.parse_feature_list('["a"]') == metadata.parse_feature_list('{"features": ["a"]}') == ["a"]
    with pytest.raises(ValueError):
        metadata.parse_feature_list('{"x": 1}')
    path = new_path(spark, "lists")
    metadata.write_feature_lists(spark, path, {"s": ["z", "a"]})
    assert metadata.read_feature_list(spark, path, "s") == ["z", "a"]
    path = new_path(spark, "registry")
    assert [metadata.register_model(spark, path, n, {"rmse": 1}, "p") for n in ("m", "m", "other")] == [1, 2, 1]


def test_quality_report(spark):
    spec = FeatureSpec(
        level="v", prefix="v", measures=("v", "m"), lags=(1, 2), lead_measures=("m",), leads=(2,), horizons=(2,)
    )
    raw = hourly(spark, range(30)).withColumn("m", F.col("v") * 2)
    good = training_table(build_features(raw, spec, HOURLY), spec)
    report = {r["check"]: r for r in quality.quality_report(good, raw, spec, HOURLY, ["v"]).collect()}
    assert {r["status"] for c, r in report.items() if c != "enough rows"} == {"pass"} and report["enough rows"]["status"] == "warn"
    bad = good.withColumn("v_lag_1", F.col("v_lag_1") + F.when(F.col("v") == 7, 1).otherwise(0)).withColumn("v", -F.col("v"))
    report = {r["check"]: r for r in quality.quality_report(bad, raw, spec, HOURLY, ["v"], ["v", "target_v_2"]).collect()}
    assert report["aligned: v_lag_1"]["bad"] == 1 and report["not negative: v"]["status"] == "fail"
    assert report["no leakage"]["status"] == "fail"
    empty = quality.alignment_checks(good.limit(0), raw, HOURLY, quality.lag_rules(spec)).collect()
    assert all(r["status"] == "fail" for r in empty)


def test_offset_and_append(spark):
    df = hourly(spark, [1, 2, 3])
    assert column(joins.at_offset(df, df, HOURLY, "v", 1, "next"), "next") == [2, 3, None]
    assert column(joins.append_rows(df.drop("v"), df), "v", order="v") == [None] * 3 + [1, 2, 3]


def test_hot_key_dedup_keeps_the_last(spark):
    """A third of all rows on one key."""
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("seq"))
    out = clean.dedup_by_key(rows.withColumn("v", F.col("seq")), ["k"], "seq")
    assert out.where("k = 0").first()["v"] == 29_997 and out.count() == 20_001


def test_csv_columns_are_found_by_name(spark, tmp_path):
    folder = str(tmp_path / "csv")
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "a.csv").write_text("x,y,note\n1.0,2.0,n\n3.0,bad,n\n")
    rows, corrupt = feeds.read_csv(spark, folder, "y double, x double")
    assert [tuple(r) for r in rows.collect()] == [(2.0, 1.0)] and corrupt.count() == 1
    with pytest.raises(ValueError, match="not in the header"):
        feeds.read_csv(spark, folder, "z double")


def test_group_grows_columns_and_reruns_replace(spark):
    group = FeatureGroup(new_path(spark, "group"), "g", 1, HOURLY)
    with pytest.raises(ValueError, match="no commit"):
        group.read(spark)
    two = hourly(spark, [1, 2])
    group.commit(two, 1)
    group.commit(two.limit(1), 1)
    assert group.read(spark).count() == 1
    group.commit(hourly(spark, [5], start=START + timedelta(days=3)).withColumn("extra", F.lit("e")), 2)
    got = {r["v"]: r["extra"] for r in group.read(spark).collect()}
    assert got == {1.0: None, 5.0: "e"} or got == {2.0: None, 5.0: "e"}
    assert group.read(spark, as_of=1).columns == ["series_id", "time", "v"]
    assert group.next_commit(spark) == 3 and group.next_commit(spark, "stream:0") == 3
    group.commit(two, 3, "stream:0")
    assert group.next_commit(spark, "stream:0") == 3 and group.next_commit(spark, "stream:1") == 4
    spark.createDataFrame([(1,)], "half int").write.parquet(f"{group.path}/rows/commit_id=9/attempt=unpublished/event_date=2024-01-01")
    assert group.read(spark).count() == 3


def test_written_tables_are_released(spark):
    table = materialize(spark.range(3), "numbers")
    place = table.inputFiles()[0].removeprefix("file://").removeprefix("file:")
    assert os.path.exists(place)
    release(spark)
    assert not os.path.exists(place)


def test_latest_rows_are_hashed_not_sorted(spark):
    rows = hourly(spark, [1, 2, 2]).withColumn("seq", F.lit(1).cast("bigint"))
    plan = clean.dedup_by_key(rows, HOURLY.columns, "seq")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    kept = clean.dedup_by_key(spark.createDataFrame([("a", 1, 5.0), ("a", 2, None)], "k string, seq int, v double"), ["k"], "seq")
    assert kept.first()["v"] is None
