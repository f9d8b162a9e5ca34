from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import types as T

import __spark_entry__ as contract
from check import TABLES, difference
from tsengine.queries import streams
from tsengine.series import HOURLY
from tsengine.session import new_path
from tsengine.sources.store import FeatureGroup
from tsengine.streaming import incremental

FOLDER = "/root/testdata/sf0.001"
# These run on the smallest tables; the others need enough history for 504-step lags.
SMALL = [
    "json_feed_rows", "csv_round_trip", "keyed_upsert", "as_of_read", "timestamp_coercion", "numeric_coercion", "full_row_dedup",
    "keyed_keep_last", "two_stage_dedup", "regular_grid", "anchored_grid", "offset_lookup", "null_counts", "gap_summary",
    "chronology_breaks", "category_band", "alert_level", "rolling_mean", "rolling_median", "rolling_std", "forward_rolling_sum",
    "same_phase_history", "hourly_event_features", "range_rolling_mean", "calendar_parts", "streamed_hours", "incremental_upsert",
    "incremental_features", "halo_restricted_features", "streamed_revisions", "late_event_rejects", "streamed_alerts",
]


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from read_parquet('{FOLDER}/{t}.parquet')")
    return connection


@pytest.mark.parametrize("name", SMALL)
def test_query_matches_sql(spark, db, name):
    got = contract.queries()[name](spark, FOLDER).toPandas()
    assert difference(got, db.execute(contract.oracle_sql()[name]).fetchdf()) == ""


def test_entry(spark):
    out = contract.entry(spark)
    assert out.count() > 0 and out.schema["time"].dataType == T.TimestampNTZType()


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_incremental_equals_rebuild_in_every_case(spark):
    """A gap before, inside and after what is known, a late row, a new series: all rows, both ways, after each batch."""
    start = datetime(2024, 1, 1)

    def batch(*spans):
        rows = [(s, start + timedelta(hours=h), float(h % 7), float(h * h % 101 + plus)) for s, lo, hi, plus in spans for h in range(lo, hi)]
        return spark.createDataFrame(rows, "series_id string, time timestamp_ntz, n double, cents double")

    raw = FeatureGroup(new_path(spark, "raw"), "r", 1, HOURLY)
    wide = FeatureGroup(new_path(spark, "wide"), "w", 1, HOURLY)
    batches = [
        batch(("a", 100, 160, 0)),
        batch(("a", 230, 250, 0), ("b", 120, 130, 0)),
        batch(("a", 190, 191, 0), ("a", 150, 152, 5)),
        batch(("a", 20, 22, 0), ("b", 300, 301, 0)),
    ]
    for i, changes in enumerate(batches, start=1):
        incremental.apply_changes(raw, wide, changes, streams.SPEC, HOURLY, i)
        rebuilt, kept = streams.build_features(raw.read(spark), streams.SPEC, HOURLY), wide.read(spark)
        assert sorted(map(repr, kept.select(rebuilt.columns).collect())) == sorted(map(repr, rebuilt.collect()))
