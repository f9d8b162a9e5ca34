"""Sources, sinks, cleaning, joins and set operations."""

from __future__ import annotations

import functools
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsengine.functions import scalars as S
from tsengine.operators import clean, joins, profile
from tsengine.operators.windows import lead
from tsengine.queries.bindings import (
    FULL,
    ORDER_DAYS_SQL,
    event_hours,
    event_hours_sql,
    grid_sql,
    lineitem_days,
    lineitem_days_sql,
    order_days,
    table,
)
from tsengine.series import DAILY, HOURLY, anchored, chunk_grid, fill_gaps
from tsengine.session import new_path
from tsengine.sources import feeds
from tsengine.sources.store import FeatureGroup, GateError, feature_view, gate

QUERIES = {}
ORACLES = {}


def query(sql: str | None = None):
    def add(run):
        QUERIES[run.__name__] = run
        if sql:
            ORACLES[run.__name__] = sql
        return run

    return add


DAYS = f"with series as ({lineitem_days_sql()})"
HOURS = f"with series as ({event_hours_sql(True)})"
FEED_COLUMNS = {"n": "bigint", "cents": "bigint", "top_user": "bigint"}


# --- sources and sinks -------------------------------------------------------------------------------------------


@query(f"{HOURS} select series_id, time, n, cents, top_user from series")
def json_feed_rows(spark, sf_dir):
    """Hourly series landed as JSON payloads, one per series and day, read back by position; bad payloads rejected."""
    hours = event_hours(spark, sf_dir, by_type=True)
    path = new_path(spark, "payloads")
    day = F.col("time").cast("date").alias("day")
    good = feeds.to_payloads(hours, "time", list(FEED_COLUMNS), ["series_id", day])
    bad = hours.select("series_id", day).distinct().select(F.to_json(F.struct("series_id", F.lit("no data").alias("reason"))).alias("value"))
    good.union(bad).write.text(path)
    rows, _ = feeds.read_payloads(spark, path, FEED_COLUMNS, {"series_id": "string"})
    return rows


@query(f"{HOURS} select series_id, count(distinct time::date) as rejected from series group by 1")
def json_feed_rejects(spark, sf_dir):
    hours = event_hours(spark, sf_dir, by_type=True)
    path = new_path(spark, "payloads")
    day = F.col("time").cast("date").alias("day")
    bad = hours.select("series_id", day).distinct().select(F.to_json(F.struct("series_id", F.lit("no data").alias("reason"))).alias("value"))
    bad.write.text(path)
    _, rejected = feeds.read_payloads(spark, path, FEED_COLUMNS, {"series_id": "string"})
    return rejected.groupBy("series_id").agg(F.count(F.lit(1)).alias("rejected"))


@query(f"{DAYS} select series_id, time, us_aqi, pm10, pm2_5 from series")
def csv_round_trip(spark, sf_dir):
    """Series written as headed CSV with formatted times and read back under an explicit schema."""
    path = new_path(spark, "csv")
    feeds.write_csv(lineitem_days(spark, sf_dir).select("series_id", "time", "us_aqi", "pm10", "pm2_5"), path, "time")
    rows, _ = feeds.read_csv(spark, path, "series_id string, time string, us_aqi double, pm10 double, pm2_5 double", "time")
    return rows


@query(f"{DAYS} select series_id, time, us_aqi, pm10, pm2_5 from series where time >= timestamp '1998-01-01'")
def parquet_series_sink(spark, sf_dir):
    """Series written by date and read back with date pruning."""
    path = new_path(spark, "series")
    days = lineitem_days(spark, sf_dir).select("series_id", "time", "us_aqi", "pm10", "pm2_5")
    feeds.write_series(days, path, ["series_id"], "time", unit="year")
    return spark.read.parquet(path).where(F.col("period") >= F.lit("1998-01-01").cast("date")).drop("period")


def _two_commits(spark, sf_dir) -> FeatureGroup:
    """Commit 1: times up to mid 1999. Commit 2: from 1998 on, with revised levels."""
    days = lineitem_days(spark, sf_dir).select("series_id", "time", "us_aqi", "pm10")
    group = FeatureGroup(new_path(spark, "group"), "line_days", 1, DAILY, unit="year")
    group.commit(days.where(F.col("time") < F.lit("1999-07-01").cast("timestamp_ntz")), 1)
    revised = days.where(F.col("time") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    group.commit(revised.withColumn("us_aqi", F.col("us_aqi") + 1000), 2)
    return group


@query(
    f"{DAYS} select series_id, time, us_aqi + case when time >= timestamp '1998-01-01' then 1000 else 0 end as us_aqi, pm10 from series"
)
def keyed_upsert(spark, sf_dir):
    """Two overlapping commits; the later one wins per key."""
    return _two_commits(spark, sf_dir).read(spark)


@query(f"{DAYS} select series_id, time, us_aqi, pm10 from series where time < timestamp '1999-07-01'")
def as_of_read(spark, sf_dir):
    return _two_commits(spark, sf_dir).read(spark, as_of=1)


@query(f"{DAYS} select series_id, time, us_aqi + 1000 as us_aqi, pm10 from series where time >= timestamp '2000-01-01'")
def group_read_since(spark, sf_dir):
    """Group read from an event time on: directories of earlier dates are pruned."""
    return _two_commits(spark, sf_dir).read(spark, since=datetime(2000, 1, 1))


def _state_sql(as_of: int) -> str:
    """Rows after so many of the commits of ``_snapshots``; a later addition wins."""
    known = ["time < timestamp '1999-07-01'", "time >= timestamp '1998-01-01'", "pm10 % 3 = 0"][:as_of]
    added = ["0", "1000", "-5"][:as_of]
    cases = " ".join(f"when {k} then us_aqi + {a}" for k, a in reversed(list(zip(known, added, strict=True))))
    return f"select {as_of} as as_of, series_id, time, case {cases} end as us_aqi, pm10 from series where {' or '.join(known)}"


def _snapshots(spark, sf_dir) -> FeatureGroup:
    """Two overlapping commits, a snapshot of both, a third commit and a second snapshot."""
    group = _two_commits(spark, sf_dir)
    group.snapshot(spark)
    days = lineitem_days(spark, sf_dir).select("series_id", "time", "us_aqi", "pm10")
    group.commit(days.where("pm10 % 3 = 0").withColumn("us_aqi", F.col("us_aqi") - 5), 3)
    group.snapshot(spark)
    return group


@query(DAYS + " " + " union all ".join(_state_sql(i) for i in (1, 2, 3)))
def snapshot_reads(spark, sf_dir):
    """The group as of a commit before the first snapshot, at it and at the second one."""
    group = _snapshots(spark, sf_dir)
    states = [group.read(spark, as_of=i).select(F.lit(i).alias("as_of"), "series_id", "time", "us_aqi", "pm10") for i in (1, 2, 3)]
    return functools.reduce(DataFrame.unionByName, states)


@query(f"{DAYS} select series_id, min(time) as first, max(time) as last from series group by 1")
def group_ends(spark, sf_dir):
    """First and last time of each series from the summaries kept with snapshots and commits, without reading rows."""
    return _snapshots(spark, sf_dir).ends(spark)


@query(f"{DAYS} select series_id, time, us_aqi, lead(us_aqi, 24) over (partition by series_id order by time) as target_aqi_24 from ({grid_sql('series', chr(39) + '1 day' + chr(39), ['us_aqi'])}) series")
def feature_view_read(spark, sf_dir):
    """The group's columns without the change target; the level target is the label."""
    grid = chunk_grid(lineitem_days(spark, sf_dir), DAILY, ["us_aqi"], ahead=24)
    ahead = lead("us_aqi", 24, grid.window)
    wide = grid.core(grid.df.withColumn("target_aqi_24", ahead)).withColumn("target_change_24", F.col("target_aqi_24") - F.col("us_aqi"))
    view, _ = feature_view(wide, ["target_change_24"], ["target_aqi_24"])
    return view


@query(
    f"""{DAYS}, dirty as (select series_id, time, case when us_aqi % 7 = 0 then null else us_aqi end as us_aqi, pm10 from series
 union all select series_id, time, us_aqi, pm10 from series where pm10 % 5 = 0)
 select (select count(*) filter (where us_aqi is null) from dirty) as nulls, (select count(*) - count(distinct (series_id, time)) from dirty) as duplicates, count(*) as admitted from series"""
)
def store_gate(spark, sf_dir):
    """What keeps a table with nulls and repeated keys out of the store, and the rows of one that may enter."""
    days = lineitem_days(spark, sf_dir)
    gate(days, DAILY, ["us_aqi", "pm10"])
    columns = ["series_id", "time", "us_aqi", "pm10"]
    holes = days.select(columns).withColumn("us_aqi", F.when(F.col("us_aqi") % 7 != 0, F.col("us_aqi")))
    try:
        gate(holes.unionByName(days.select(columns).where("pm10 % 5 = 0")), DAILY, ["us_aqi", "pm10"])
    except GateError as error:
        found = error.found
    return days.agg(F.lit(found["nulls"]).alias("nulls"), F.lit(found["duplicates"]).alias("duplicates"), F.count(F.lit(1)).alias("admitted"))


# --- cleaning ----------------------------------------------------------------------------------------------------


@query(
    """select 'event_id' as "column", 100.0 * count(*) filter (where event_id is null) / count(*) as null_percent from events
 union all select 'user_id', 100.0 * count(*) filter (where event_id % 4 = 0 or user_id is null) / count(*) from events
 union all select 'props', 100.0 * count(*) filter (where event_type = 'click' or props is null) / count(*) from events"""
)
def dropped_column_nulls(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    e = e.withColumns({"user_id": F.when(F.col("event_id") % 4 != 0, F.col("user_id")), "props": F.when(F.col("event_type") != "click", F.col("props"))})
    return clean.dropped_null_percent(e, ["ts", "event_type", "value"])


@query("select ts, event_type, value from events")
def required_columns_only(spark, sf_dir):
    return clean.keep_columns(table(spark, sf_dir, "events"), ["ts", "event_type", "value"])


@query(f"{DAYS} select series_id, time, pm10, us_aqi, ozone from series")
def ordered_projection(spark, sf_dir):
    """Feature list order; an absent name is skipped in lenient mode and a target never passes."""
    names = ["pm10", "us_aqi", "not_there", "ozone", "european_aqi"]
    import warnings

    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return clean.project_features(
            lineitem_days(spark, sf_dir), names, mode="lenient", never=("european_aqi",), carry=("series_id", "time")
        )


def _mixed_time_text():
    """Events with their time as text in three forms, one of them unreadable."""
    t = F.col("ts")
    form = F.col("event_id") % 3
    return (
        F.when(form == 0, F.date_format(t, "yyyy-MM-dd HH:mm:ss"))
        .when(form == 1, F.date_format(t, "yyyy-MM-dd'T'HH:mm"))
        .otherwise(F.concat(F.lit("bad "), F.col("event_type")))
    )


@query(
    """select event_id, date_trunc('second', ts)::timestamp as time from events where event_id % 3 = 0
       union all select event_id, date_trunc('minute', ts)::timestamp from events where event_id % 3 = 1"""
)
def timestamp_coercion(spark, sf_dir):
    texts = table(spark, sf_dir, "events").select("event_id", _mixed_time_text().alias("time"))
    return clean.coerce_time(texts, "time", on_invalid="drop")


@query("""select event_id, try_cast(json_extract_string(props, '$.k') as double) as k, try_cast(event_type as double) as t from events""")
def numeric_coercion(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.col("event_type").alias("t"))
    return clean.coerce_numbers(e, ["k", "t"])


def _repeated_events(spark, sf_dir):
    """Every event once, and every second one again later."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    first = e.withColumn("seq", F.col("event_id"))
    again = e.where(F.col("event_id") % 2 == 0).withColumn("seq", F.col("event_id") + 1000000000)
    return first.union(again)


_REPEATED = """with r as (select event_id, ts, event_type, value, event_id as seq from events
 union all select event_id, ts, event_type, value, event_id + 1000000000 from events where event_id % 2 = 0)"""


@query(f"{_REPEATED} select event_id, ts, event_type, value, min(seq) as seq from r group by 1, 2, 3, 4")
def full_row_dedup(spark, sf_dir):
    return clean.drop_full_duplicates(_repeated_events(spark, sf_dir), "seq")


def _hour_rows(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_type", S.floor_hour(F.col("ts")).alias("time"), F.col("event_id").alias("seq"), "user_id", "value")


_HOUR_ROWS = "select event_type, date_trunc('hour', ts)::timestamp as time, event_id as seq, user_id, value from events"


@query(f"select * from ({_HOUR_ROWS}) qualify row_number() over (partition by event_type, time order by seq desc) = 1")
def keyed_keep_last(spark, sf_dir):
    return clean.dedup_by_key(_hour_rows(spark, sf_dir), ["event_type", "time"], "seq", "last")


@query(f"select * from ({_HOUR_ROWS}) qualify row_number() over (partition by event_type, time order by seq) = 1")
def keyed_keep_first(spark, sf_dir):
    return clean.dedup_by_key(_hour_rows(spark, sf_dir), ["event_type", "time"], "seq", "first")


@query(
    f"""{_REPEATED}, once as (select event_id, ts, event_type, value, min(seq) as seq from r group by 1, 2, 3, 4)
 select event_id, ts, event_type, value, seq from (select *, row_number() over (partition by event_type, ts order by seq desc) as rn from once)
 where rn = 1"""
)
def two_stage_dedup(spark, sf_dir):
    """Copies of a whole row first, then the last row of each series and time."""
    return clean.two_stage_dedup(_repeated_events(spark, sf_dir), ["event_type", "ts"], "seq")


@query(f"{HOURS}, grid as ({grid_sql('series', chr(39) + '1 hour' + chr(39), ['n', 'cents'])}) select * from grid where n is not null")
def drop_null_key(spark, sf_dir):
    grid = fill_gaps(event_hours(spark, sf_dir, by_type=True), HOURLY, ["n", "cents"])
    return clean.drop_null_keys(grid, ["n"])


@query(f"{DAYS} select series_id, time, round(case when ozone = 0 then null else nitrogen_dioxide / ozone end, 6) as ratio from series")
def infinity_to_null(spark, sf_dir):
    days = lineitem_days(spark, sf_dir)
    raw = F.when(F.col("ozone") == 0, F.lit(float("inf"))).otherwise(F.try_divide("nitrogen_dioxide", "ozone"))
    out = clean.infinities_to_null(days.select("series_id", "time", raw.alias("ratio")), ["ratio"])
    return out.withColumn("ratio", F.round("ratio", 6))


@query("select event_id, ts, value from events where ts <= timestamp '2024-01-20 13:00:00'")
def trim_future_rows(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    return clean.trim_future(e, "ts", datetime(2024, 1, 20, 13, 45, 10))


_NOW = datetime(2024, 1, 25, 6, 40)
_GRID_HOURS = f"{HOURS}, grid as ({grid_sql('series', chr(39) + '1 hour' + chr(39), ['n', 'cents'])})"


@query(
    f"""{_GRID_HOURS} select g.* from grid g join (select series_id, least(max(time), timestamp '2024-01-25 06:00:00') as time
 from grid group by 1) m using (series_id, time)"""
)
def now_row_per_series(spark, sf_dir):
    grid = fill_gaps(event_hours(spark, sf_dir, by_type=True), HOURLY, ["n", "cents"])
    return clean.now_rows(grid, HOURLY, _NOW)


@query(f"{_GRID_HOURS} select series_id, time, 'n,cents' as null_columns from grid where n is null")
def null_guard_rejects(spark, sf_dir):
    """Rows a model cannot score, with the names of their null inputs."""
    grid = fill_gaps(event_hours(spark, sf_dir, by_type=True), HOURLY, ["n", "cents"])
    return clean.split_on_nulls(grid, ["n", "cents"])[1].select("series_id", "time", "null_columns")


@query(
    """select column_name as feature, case when column_type in ('BIGINT', 'INTEGER', 'DOUBLE', 'FLOAT') or column_type like 'DECIMAL%' then 'numeric' else 'rejected' end as verdict
 from (describe select event_id, ts, user_id, event_type, value, props, value::float as small, user_id::decimal(10, 2) as exact from events)"""
)
def numeric_candidate_columns(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumns({"small": F.col("value").cast("float"), "exact": F.col("user_id").cast("decimal(10,2)")})
    good, rejected = clean.numeric_candidates(e, e.columns)
    return spark.createDataFrame([(c, "numeric") for c in good] + [(c, "rejected") for c in rejected], "feature string, verdict string")


# --- joins and set operations ------------------------------------------------------------------------------------


@query(
    f"""with a as (select time, sum(us_aqi) as us_aqi, sum(pm10) as pm10 from ({lineitem_days_sql('l_linestatus')}) group by 1),
 b as ({ORDER_DAYS_SQL}) select a.time, a.us_aqi, a.pm10, b.orders, b.total_cents from a join b on a.time = b.time"""
)
def two_feed_join(spark, sf_dir):
    ship = lineitem_days(spark, sf_dir, "l_linestatus").groupBy("time").agg(F.sum("us_aqi").alias("us_aqi"), F.sum("pm10").alias("pm10"))
    return joins.join_feeds(ship, order_days(spark, sf_dir).drop("series_id"), ["time"])


@query(f"{_GRID_HOURS} select * from grid")
def regular_grid(spark, sf_dir):
    return fill_gaps(event_hours(spark, sf_dir, by_type=True), HOURLY, ["n", "cents"])


@query(
    f"""with series as (select user_id % 7 as series_id, date_trunc('minute', ts) as time, sum(cast(round(value * 100) as bigint))::bigint as cents
 from events group by 1, 2),
 grid as (select series_id, unnest(generate_series(min(time), max(time), interval '1 hour'))::timestamp as time from series group by 1)
 select g.series_id, g.time, s.cents from grid g left join series s on s.series_id = g.series_id and s.time = g.time"""
)
def anchored_grid(spark, sf_dir):
    """Minute rows on an hourly grid that starts at each series' own first minute; other minutes vanish."""
    e = table(spark, sf_dir, "events").withColumn("series_id", F.col("user_id") % 7)
    minutes = e.groupBy("series_id", F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("time")).agg(
        F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents")
    )
    return fill_gaps(minutes, anchored(HOURLY), ["cents"])


@query(
    f"""{DAYS} select a.series_id, a.time, a.us_aqi, b.us_aqi as earlier from series a
 left join series b on b.series_id = a.series_id and b.time = a.time - interval '24 day'"""
)
def offset_lookup(spark, sf_dir):
    days = lineitem_days(spark, sf_dir).select("series_id", "time", "us_aqi")
    return joins.at_offset(days, days, DAILY, "us_aqi", -24, "earlier")


@query(
    f"""{DAYS} select series_id, time, us_aqi, case when time >= timestamp '1998-01-01' then pm10 end as pm10 from series"""
)
def schema_tolerant_append(spark, sf_dir):
    """Two halves, the first without a column the second has."""
    days = lineitem_days(spark, sf_dir).select("series_id", "time", "us_aqi", "pm10")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    return joins.append_rows(days.where(F.col("time") < cut).drop("pm10"), days.where(F.col("time") >= cut))


# --- profiles ----------------------------------------------------------------------------------------------------


@query(f"{DAYS} select series_id, count(*) as n_rows, {len(FULL.measures) + 2} as n_columns, min(time) as min_time, max(time) as max_time from series group by 1")
def dataset_profile(spark, sf_dir):
    return profile.dataset_profile(lineitem_days(spark, sf_dir), DAILY)


_NULLS = " union all ".join(f"select '{c}' as \"column\", count(*) - count({c}) as nulls from grid" for c in ("series_id", "time", "n", "cents"))


@query(f"{_GRID_HOURS} {_NULLS}")
def null_counts(spark, sf_dir):
    grid = fill_gaps(event_hours(spark, sf_dir, by_type=True), HOURLY, ["n", "cents"])
    return profile.null_counts(grid)


@query(f"{_GRID_HOURS} select * from ({_NULLS}) order by nulls desc, \"column\" limit 2")
def top_null_columns(spark, sf_dir):
    grid = fill_gaps(event_hours(spark, sf_dir, by_type=True), HOURLY, ["n", "cents"])
    return profile.top_null_columns(grid, 2)


@query(
    f"""{DAYS} select 'ratio' as "column", count(*) filter (where ozone = 0 and nitrogen_dioxide > 0) as infinities from series
 union all select 'us_aqi', 0"""
)
def infinity_counts(spark, sf_dir):
    days = lineitem_days(spark, sf_dir)
    ratio = F.when(F.col("ozone") == 0, F.when(F.col("nitrogen_dioxide") > 0, F.lit(float("inf")))).otherwise(
        F.try_divide("nitrogen_dioxide", "ozone")
    )
    return profile.infinity_counts(days.select("us_aqi", ratio.alias("ratio")), ["ratio", "us_aqi"])


@query(
    """select 'key' as kind, count(*) - count(distinct (event_type, date_trunc('hour', ts))) as duplicates, count(*) as n_rows from events
 union all select 'row', count(*) filter (where event_id % 2 = 0), count(*) + count(*) filter (where event_id % 2 = 0) from events"""
)
def duplicate_counts(spark, sf_dir):
    by_key = profile.duplicate_count(_hour_rows(spark, sf_dir), ["event_type", "time"])
    whole = profile.duplicate_count(_repeated_events(spark, sf_dir), ["event_id", "ts", "event_type", "value"])
    return by_key.withColumn("kind", F.lit("key")).unionByName(whole.withColumn("kind", F.lit("row")))


@query(
    f"""{HOURS}, p as (select *, lag(time) over (partition by series_id order by time) as previous_time from series)
 select series_id, time, previous_time from p where time - previous_time <> interval '1 hour'"""
)
def gap_locations(spark, sf_dir):
    return profile.gap_rows(event_hours(spark, sf_dir, by_type=True), HOURLY)


@query(
    f"""{HOURS}, p as (select *, lag(time) over (partition by series_id order by time) as previous_time from series)
 select series_id, count(*) as n_rows, count(*) filter (where time - previous_time <> interval '1 hour') as gaps,
 round(count(*) filter (where time - previous_time <> interval '1 hour') * 100.0 / count(*), 6) as gap_percent from p group by 1"""
)
def gap_summary(spark, sf_dir):
    return profile.gap_summary(event_hours(spark, sf_dir, by_type=True), HOURLY).withColumn("gap_percent", F.round("gap_percent", 6))


@query(
    """with p as (select *, lag(ts) over (partition by event_type order by event_id) as before from events)
 select event_type, count(*) as n_rows, count(*) filter (where before > ts) as order_breaks from p group by 1"""
)
def chronology_breaks(spark, sf_dir):
    return profile.order_breaks(table(spark, sf_dir, "events"), ["event_type"], "event_id", "ts", bucket_rows=1 << 10)


_EMPTY_ROWS = f"{_GRID_HOURS} select series_id, time from grid where n is null order by time %s, series_id %s limit 10"


@query(_EMPTY_ROWS % ("", ""))
def first_flagged_rows(spark, sf_dir):
    grid = fill_gaps(event_hours(spark, sf_dir, by_type=True), HOURLY, ["n"])
    return profile.edge_rows(grid.where(F.col("n").isNull()).select("series_id", "time"), ["time", "series_id"], 10)


@query(_EMPTY_ROWS % ("desc", "desc"))
def last_flagged_rows(spark, sf_dir):
    grid = fill_gaps(event_hours(spark, sf_dir, by_type=True), HOURLY, ["n"])
    return profile.edge_rows(grid.where(F.col("n").isNull()).select("series_id", "time"), ["time", "series_id"], 10, last=True)


@query(f"{DAYS} select series_id, time, us_aqi from series")
def sorted_by_time(spark, sf_dir):
    """Presentation order: a range-partitioned total sort, only at the end of a plan."""
    return lineitem_days(spark, sf_dir).select("series_id", "time", "us_aqi").orderBy("time", "series_id")


# --- scalar functions --------------------------------------------------------------------------------------------


@query("select event_id, date_trunc('hour', ts)::timestamp as hour_start from events")
def floor_to_hour(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", S.floor_hour(F.col("ts")).alias("hour_start"))


@query("select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as time_text from events")
def format_timestamps(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", S.format_time(F.col("ts")).alias("time_text"))


@query(
    """select event_id, case when value is null then null when value <= 50 then 'Good' when value <= 100 then 'Moderate'
 when value <= 150 then 'Unhealthy (Sensitive)' when value <= 200 then 'Unhealthy' when value <= 300 then 'Very Unhealthy'
 else 'Hazardous' end as band from events"""
)
def category_band(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", S.band(F.col("value")).alias("band"))


@query(
    f"""{DAYS}, grid as ({grid_sql('series', chr(39) + '1 day' + chr(39), ['us_aqi'])}),
 l as (select series_id, time, greatest(us_aqi, lead(us_aqi, 1) over w, lead(us_aqi, 2) over w, lead(us_aqi, 3) over w) as peak from grid
 window w as (partition by series_id order by time))
 select series_id, time, case when peak is null then null when peak >= 200 then 'severe' when peak >= 150 then 'sensitive' else 'none' end as alert
 from l"""
)
def alert_level(spark, sf_dir):
    grid = chunk_grid(lineitem_days(spark, sf_dir), DAILY, ["us_aqi"], ahead=3)
    ahead = [lead("us_aqi", h, grid.window).alias(f"h{h}") for h in (1, 2, 3)]
    rows = grid.core(grid.df.select("*", *ahead))
    return rows.select("series_id", "time", S.alert([F.col(c) for c in ("us_aqi", "h1", "h2", "h3")]).alias("alert"))


@query(
    f"""{DAYS}, grid as ({grid_sql('series', chr(39) + '1 day' + chr(39), ['us_aqi'])}),
 l as (select series_id, time, us_aqi, us_aqi - lag(us_aqi, 1) over w as change from grid window w as (partition by series_id order by time))
 select series_id, time, case when change > 0 then 'up' when change < 0 then 'down' when change = 0 then 'flat' end as direction,
 case when us_aqi is null or change is null then null else greatest(0, us_aqi + 3 * change) end as level from l"""
)
def change_direction_and_level(spark, sf_dir):
    """Direction of the last change, and the level three such changes later, not below zero."""
    grid = chunk_grid(lineitem_days(spark, sf_dir), DAILY, ["us_aqi"], back=1)
    rows = grid.core(grid.df.withColumn("change", F.col("us_aqi") - F.lag("us_aqi", 1).over(grid.window)))
    level = S.reconstruct(F.col("us_aqi"), F.col("change") * 3, clamp=True)
    return rows.select(
        "series_id",
        "time",
        S.direction(F.col("change")).alias("direction"),
        F.when(F.col("change").isNotNull(), level).alias("level"),
    )


@query(
    f"""{DAYS} select series_id, count(*) filter (where abs(pm2_5 / pm10 - us_aqi / pm10) <= 1e-8 + 0.05 * abs(us_aqi / pm10)) as near,
 count(*) filter (where us_aqi between 50 and 150) as in_range, count(*) filter (where weather_code in (1, 2, 3)) as listed,
 count(*) filter (where us_aqi - pm2_5 < 0) as negative from series group by 1"""
)
def tolerance_and_range_counts(spark, sf_dir):
    days = lineitem_days(spark, sf_dir)
    a, b = F.col("pm2_5") / F.col("pm10"), F.col("us_aqi") / F.col("pm10")
    return days.groupBy("series_id").agg(
        F.count_if(S.close(a, b, atol=1e-8, rtol=0.05)).alias("near"),
        F.count_if(F.col("us_aqi").between(50, 150)).alias("in_range"),
        F.count_if(F.col("weather_code").isin(1, 2, 3)).alias("listed"),
        F.count_if(F.col("us_aqi") - F.col("pm2_5") < 0).alias("negative"),
    )


@query(f"{DAYS} select series_id, time, round((pm10 + pm2_5 + nullif(ozone, 0)) / 3, 6) as full_mean, round(list_aggregate([pm10, pm2_5, nullif(ozone, 0)], 'avg'), 6) as mean from series")
def row_wise_mean(spark, sf_dir):
    ozone = F.nullif(F.col("ozone"), F.lit(0.0))
    columns = [F.col("pm10"), F.col("pm2_5"), ozone]
    return lineitem_days(spark, sf_dir).select(
        "series_id",
        "time",
        F.round((columns[0] + columns[1] + columns[2]) / 3, 6).alias("full_mean"),
        F.round(S.row_mean(columns), 6).alias("mean"),
    )
