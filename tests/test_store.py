"""Snapshots, day summaries and version claims of the stores."""

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tsengine.queries import streams
from tsengine.series import HOURLY
from tsengine.session import new_path
from tsengine.sources import metadata, store
from tsengine.sources.store import FeatureGroup
from tsengine.streaming import incremental

START = datetime(2024, 1, 1)


def rows(spark, *cells):
    """Rows of series ``a`` from (hour, value)."""
    return spark.createDataFrame([("a", START + timedelta(hours=h), float(v)) for h, v in cells], "series_id string, time timestamp_ntz, v double")


def values(df):
    return {int((r["time"] - START).total_seconds() // 3600): r["v"] for r in df.collect()}


def test_snapshot_and_tail_are_all_that_is_read(spark, monkeypatch):
    monkeypatch.setattr(store, "BLOCK", 3)
    group = FeatureGroup(new_path(spark, "g"), "x", 1, HOURLY)
    for i in range(1, 6):
        group.commit(rows(spark, (0, i), (i, 10 * i)), i, f"s:{i}")
    assert group.snapshot(spark) == 5 and group.snapshot(spark) == 5
    group.commit(rows(spark, (2, -2), (90, 9)), 6, "s:6")
    assert values(group.read(spark)) == {0: 5, 1: 10, 2: -2, 3: 30, 4: 40, 5: 50, 90: 9}
    opened = group.read(spark).inputFiles()
    assert all("/snapshots/through=5/" in f or "/rows/commit_id=6/" in f for f in opened)
    for as_of in range(1, 6):  # before, between and at what is folded
        assert values(group.read(spark, as_of=as_of)) == {0: as_of} | {i: 10 * i for i in range(1, as_of + 1)}
    assert group.log(spark).count() == 12
    assert [r["commit_id"] for r in group.markers(spark)] == [1, 2, 3, 4, 5, 6]
    assert [r["commit_id"] for r in group.markers(spark, 5)] == [6]
    assert values(group.read(spark, since=START + timedelta(hours=3), until=START + timedelta(hours=4))) == {3: 30, 4: 40}
    assert group.ends(spark).first().asDict() == {"series_id": "a", "first": START, "last": START + timedelta(hours=90)}
    assert group.ends(spark, 3).first()["last"] == START + timedelta(hours=3)
    # a second snapshot reads the first one, not the commits below it
    assert group.snapshot(spark) == 6 and values(group.read(spark))[2] == -2
    assert all("/snapshots/through=6/" in f for f in group.read(spark).inputFiles())
    assert group.days(spark).agg(F.sum("rows")).first()[0] == 12


def test_folded_commits_are_final(spark):
    group = FeatureGroup(new_path(spark, "g"), "x", 1, HOURLY)
    assert group.snapshot(spark) == 0 and group.retire(spark, 9) == 0
    group.commit(rows(spark, (0, 1)), 1, "s:1")
    group.commit(rows(spark, (1, 2)).limit(0), 2, "s:2")  # a batch without rows
    group.snapshot(spark)
    assert group.next_commit(spark, "s:1") == 1 and group.next_commit(spark, "s:3") == 3
    group.commit(rows(spark, (0, 7)), 1, "s:1")  # replayed after the snapshot: nothing changes
    assert values(group.read(spark)) == {0: 1}
    with pytest.raises(ValueError, match="within the snapshot"):
        group.commit(rows(spark, (0, 7)), 1)
    group.commit(rows(spark, (5, 5)).withColumn("extra", F.lit("e")), 3)
    assert {r["v"]: r["extra"] for r in group.read(spark).collect()} == {1.0: None, 5.0: "e"}


def test_retired_commits_are_gone(spark):
    group = FeatureGroup(new_path(spark, "g"), "x", 1, HOURLY)
    for i in (1, 2, 3):
        group.commit(rows(spark, (i, i)), i)
        if i == 2:
            group.snapshot(spark)
    assert group.retire(spark, 1) == 0 and group.retire(spark, 3) == 2
    assert values(group.read(spark)) == {1: 1, 2: 2, 3: 3} and values(group.read(spark, as_of=2)) == {1: 1, 2: 2}
    for lost in (lambda: group.read(spark, as_of=1), lambda: group.log(spark)):
        with pytest.raises(ValueError, match="keeps no commit up to 2"):
            lost()
    group.snapshot(spark)
    assert values(group.read(spark)) == {1: 1, 2: 2, 3: 3} and group.next_commit(spark) == 4


def test_a_batch_opens_no_folder_outside_its_reach(spark):
    raw, wide = (FeatureGroup(new_path(spark, n), n, 1, HOURLY) for n in ("raw", "wide"))

    def batch(lo, hi, plus=0):
        cells = [("a", START + timedelta(hours=h), float(h % 7), float(h * h % 101 + plus)) for h in range(lo, hi)]
        return spark.createDataFrame(cells, "series_id string, time timestamp_ntz, n double, cents double")

    incremental.apply_changes(raw, wide, batch(0, 24 * 20), streams.SPEC, HOURLY, 1)
    raw.snapshot(spark)
    reach = {START.date() + timedelta(days=d) for d in range(8, 13)}  # the tenth day, its windows and its targets
    spoilt = 0
    for f in Path(raw.path.removeprefix("file:")).rglob("event_date=*/*.parquet"):
        if datetime.fromisoformat(f.parent.name.split("=")[1]).date() not in reach or "/rows/commit_id=1/" in str(f):
            f.write_bytes(b"spoilt")
            spoilt += 1
    assert spoilt > 20
    for crc in Path(raw.path.removeprefix("file:")).rglob(".*.crc"):
        crc.unlink()
    incremental.apply_changes(raw, wide, batch(24 * 10, 24 * 10 + 3, 5), streams.SPEC, HOURLY, 2)
    changed = batch(0, 24 * 20).withColumn("cents", F.when(F.col("time").between(START + timedelta(days=10), START + timedelta(days=10, hours=2)), F.col("cents") + 5).otherwise(F.col("cents")))
    rebuilt = streams.build_features(changed, streams.SPEC, HOURLY)
    kept = wide.read(spark).select(rebuilt.columns)
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, rebuilt.collect()))


def test_two_writers_get_two_versions(spark):
    path = new_path(spark, "registry")
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda i: metadata.register_model(spark, path, "m/x", {"rmse": i}, f"place {i}"), range(4)))
    assert sorted(got) == [1, 2, 3, 4]
    stored = {r["version"]: r["artifact_path"] for r in metadata.registry_rows(spark, path).collect()}
    assert stored == {v: f"place {i}" for i, v in enumerate(got)}
    assert metadata.registered(spark, path, "m/x")["version"] == 4 and metadata.registered(spark, path, "m/x", 2)["artifact_path"] == stored[2]
    with pytest.raises(ValueError, match="no model"):
        metadata.registered(spark, path, "m/x", 9)
