"""Streaming jobs run to completion over the landed tables, compared with the batch result."""

from __future__ import annotations

from datetime import datetime, time, timedelta

from pyspark.sql import functions as F

from tsengine.ml.frame import change_column
from tsengine.operators.clean import dedup_by_key
from tsengine.plans.feature_plan import FeatureSpec, build_features
from tsengine.queries.bindings import event_hours, event_hours_sql, feature_sql, rounded, rounded_sql, table
from tsengine.series import HOURLY
from tsengine.session import materialize, new_path
from tsengine.sources.store import FeatureGroup
from tsengine.streaming import alerts, incremental, ingest

QUERIES = {}
ORACLES = {}


def query(sql: str | None = None):
    def add(run):
        QUERIES[run.__name__] = run
        if sql:
            ORACLES[run.__name__] = sql
        return run

    return add


HOURS = f"with series as ({event_hours_sql(True)})"
SPEC = FeatureSpec(
    level="cents",
    prefix="cents",
    measures=("n", "cents"),
    calendar=False,
    lags=(1, 6, 24),
    windows=(6, 24),
    stats=("mean", "max"),
    horizons=(6, 12),
)
NAMES = [*SPEC.features, *SPEC.level_targets, *SPEC.change_targets]


def _events(spark, sf_dir):
    return ingest.file_stream(spark, sf_dir, "events.parquet", table(spark, sf_dir, "events").schema)


def _wait(run):
    run.awaitTermination()
    if run.exception():
        raise run.exception()


@query(f"{HOURS} select series_id, time, n, cents from series")
def streamed_hours(spark, sf_dir):
    """Events streamed into hourly series; updates of an hour replace each other in the store."""
    stream = _events(spark, sf_dir).withColumn("series_id", F.col("event_type"))
    cents = F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents")
    hours = ingest.tumbling_series(stream, HOURLY, "ts", [F.count(F.lit(1)).alias("n"), cents], "92 days")
    group = FeatureGroup(new_path(spark, "stream"), "hours", 1, HOURLY)
    _wait(ingest.upsert_stream(hours, group, new_path(spark, "checkpoint")))
    return group.read(spark).select("series_id", "time", "n", "cents")


def _landed_twice(spark, sf_dir):
    """Events landed in two files, the second repeating one in four."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    folder = new_path(spark, "landing")
    e.write.parquet(f"{folder}/landed=1")
    e.where("event_id % 4 = 0").write.parquet(f"{folder}/landed=2")
    return folder, e.schema


@query("select event_id, ts, event_type, value from events")
def streamed_without_repeats(spark, sf_dir):
    """Repeats dropped inside the watermark, a few files per micro-batch."""
    folder, schema = _landed_twice(spark, sf_dir)
    stream = ingest.file_stream(spark, f"{folder}/*", "*.parquet", schema, files_per_batch=4)
    once = ingest.drop_repeats(stream, "ts", ["event_id"], "40 days")
    out = new_path(spark, "once")
    run = (
        once.writeStream.option("checkpointLocation", new_path(spark, "checkpoint"))
        .trigger(availableNow=True)
        .format("parquet")
        .start(out)
    )
    _wait(run)
    return spark.read.parquet(out).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


_CUT = "2024-01-16"
_REVISED_SQL = f"""with raw as ({event_hours_sql(True)}),
 series as (select series_id, time, cast(n as double) as n, cast(cents + case when time >= timestamp '{_CUT}' - interval '2 day'
 and time < timestamp '{_CUT}' then 100 else 0 end as double) as cents from raw)"""


def _two_batches(spark, sf_dir):
    """Hours before the cut; then the last two days again, revised, with everything after the cut."""
    hours = event_hours(spark, sf_dir, by_type=True).select(
        "series_id", "time", F.col("n").cast("double").alias("n"), F.col("cents").cast("double").alias("cents")
    )
    cut = F.lit(_CUT).cast("timestamp_ntz")
    t = F.col("time")
    first = hours.where(t < cut)
    second = hours.where(t >= cut - F.expr("interval '2' day"))
    return first, second.withColumn("cents", F.when(t < cut, F.col("cents") + 100).otherwise(F.col("cents")))


def _stream_of(spark, folder, df):
    """One landed batch, a subfolder of its own, as a stream that ends when it is read."""
    df.write.parquet(folder)
    return ingest.file_stream(spark, folder, "*.parquet", df.schema)


@query(f"{_REVISED_SQL} select series_id, time, n, cents from series")
def incremental_upsert(spark, sf_dir):
    """Two landed batches streamed into the store by two streams with checkpoints of their own; the later value of a key wins."""
    group = FeatureGroup(new_path(spark, "stream"), "hours", 1, HOURLY)
    for batch in _two_batches(spark, sf_dir):
        _wait(ingest.upsert_stream(_stream_of(spark, new_path(spark, "landing"), batch), group, new_path(spark, "checkpoint")))
    return group.read(spark).select("series_id", "time", "n", "cents")


_FAR = "2024-01-26"


@query(
    f"""{HOURS}, b as (select *, case when time >= timestamp '{_FAR}' then 1 else 2 end as landed from series),
 e as (select series_id, max(time) as last from series group by 1)
 select series_id, time, n, cents, case when time >= last - interval '10 day' then 'accepted' else 'rejected' end as verdict from b join e using (series_id)"""
)
def streamed_revisions(spark, sf_dir):
    """The newest days land first, older ones after them: what lies behind the revision window is kept with the rejects."""
    hours = event_hours(spark, sf_dir, by_type=True).select("series_id", "time", "n", "cents")
    far = F.lit(_FAR).cast("timestamp_ntz")
    root = new_path(spark, "stream")
    group, rejects = FeatureGroup(root, "hours", 1, HOURLY), FeatureGroup(root, "rejects", 1, HOURLY)
    for batch in (hours.where(F.col("time") >= far), hours.where(F.col("time") < far)):
        stream = _stream_of(spark, new_path(spark, "landing"), batch)
        _wait(ingest.revision_stream(stream, group, rejects, new_path(spark, "checkpoint"), timedelta(days=10)))
    accepted, rejected = group.read(spark), rejects.read(spark)
    return accepted.withColumn("verdict", F.lit("accepted")).unionByName(rejected.withColumn("verdict", F.lit("rejected")))


_MIDDLE = "2024-01-18"
_OUTCOMES_SQL = f"""with mark as (select max(ts) - interval '10 day' as mark from events where ts >= timestamp '{_FAR}'),
 judged as (select e.*, date_trunc('hour', ts) as time, ts >= timestamp '{_FAR}' or date_trunc('hour', ts) + interval '1 hour' > mark as kept from events e, mark)"""


def _late_landings(spark, sf_dir):
    """The newest days land first, then those before them, then the oldest: one stream of three batches."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value").withColumn("series_id", F.col("event_type"))
    ends = [F.lit(d).cast("timestamp_ntz") for d in (_FAR, _MIDDLE)]
    landings = (events.where(F.col("ts") >= ends[0]), events.where((F.col("ts") < ends[0]) & (F.col("ts") >= ends[1])), events.where(F.col("ts") < ends[1]))
    folder, rejects, checkpoint = (new_path(spark, n) for n in ("landing", "rejects", "checkpoint"))
    group = FeatureGroup(new_path(spark, "stream"), "hours", 1, HOURLY)
    partials = {"n": (F.count(F.lit(1)), "sum"), "cents": (F.sum(F.round(F.col("value") * 100).cast("bigint")), "sum")}
    for i, batch in enumerate(landings):
        batch.write.parquet(f"{folder}/landed={i}")
        stream = ingest.file_stream(spark, f"{folder}/*", "*.parquet", events.schema)
        _wait(ingest.bucket_stream(stream, HOURLY, "ts", partials, timedelta(days=10), group, rejects, checkpoint))
    return group.read(spark), spark.read.schema(events.schema).parquet(f"{rejects}/rows")


@query(f"{_OUTCOMES_SQL} select event_id, ts, value from judged where not kept")
def late_event_rejects(spark, sf_dir):
    """Events whose bucket lies behind the watermark of the stream are kept apart, not lost."""
    return _late_landings(spark, sf_dir)[1].select("event_id", "ts", "value")


@query(
    f"""{_OUTCOMES_SQL} select event_type as series_id, time, case when kept then 'accepted' else 'rejected' end as outcome, count(*) as n,
 cast(sum(cast(round(value * 100) as bigint)) as bigint) as cents from judged group by 1, 2, 3"""
)
def late_event_outcomes(spark, sf_dir):
    """Three batches, each event once: in its bucket, also in one that straddles the watermark, or with the rejects."""
    accepted, rejected = _late_landings(spark, sf_dir)
    late = rejected.groupBy("series_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("time"))
    late = late.agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents"))
    both = accepted.withColumn("outcome", F.lit("accepted")).unionByName(late.withColumn("outcome", F.lit("rejected")))
    return both.select("series_id", "time", "outcome", "n", "cents")


@query(
    f"""{HOURS}, e as (select series_id, max(time) as last from series group by 1)
 select series_id, time, n, cents, case when time >= last - interval '10 day' then 'accepted' else 'rejected' end as verdict
 from series join e using (series_id)"""
)
def revision_window(spark, sf_dir):
    """Rows older than the revision window go to the reject side."""
    hours = materialize(event_hours(spark, sf_dir, by_type=True).select("series_id", "time", "n", "cents"), "hours")
    newest = hours.groupBy("series_id").agg(F.max("time").alias("_newest"))
    accepted, rejected = ingest.split_revisions(hours, HOURLY, newest, timedelta(days=10))
    return accepted.withColumn("verdict", F.lit("accepted")).unionByName(rejected.withColumn("verdict", F.lit("rejected")))


# Three batches. All series: hours up to the 8th, those from the 16th on, and then, late, all hours between. Copies of two series, with ids of their own: the first without the
# hours between (but one), the second only from the 16th on; both have their hours of the 5th in the last batch, with other values.
_GAP = "(time < timestamp '2024-01-08' or time >= timestamp '2024-01-16' or time = timestamp '2024-01-11 05:00:00')"
_FIFTH = "time >= timestamp '2024-01-05' and time < timestamp '2024-01-06'"
_COPIED = ("view", "click")
_GAPPED_SQL = f"""with raw as ({event_hours_sql(True)}),
 series as (select series_id, time, cast(n as double) as n, cast(cents as double) as cents from raw
 union all select series_id || ' copy', time, cast(n as double), cast(cents + case when {_FIFTH} then 7 else 0 end as double) from raw
 where series_id in {_COPIED} and {_GAP} and (series_id <> 'click' or time >= timestamp '2024-01-16' or {_FIFTH} or time = timestamp '2024-01-11 05:00:00'))"""


def gapped_batches(spark, sf_dir):
    hours = event_hours(spark, sf_dir, by_type=True).select(
        "series_id", "time", F.col("n").cast("double").alias("n"), F.col("cents").cast("double").alias("cents")
    )
    copies = hours.where(F.col("series_id").isin(*_COPIED)).withColumn("series_id", F.concat("series_id", F.lit(" copy")))
    early, late = "time < timestamp_ntz'2024-01-08'", "time >= timestamp_ntz'2024-01-16'"
    fifth = _FIFTH.replace("timestamp", "timestamp_ntz")
    return (
        hours.where(early).unionByName(copies.where(f"{early} and series_id <> 'click copy'")),
        hours.where(late).unionByName(copies.where(late)),
        hours.where(f"not ({early}) and not ({late})").unionByName(
            copies.where(f"{fifth} or time = timestamp_ntz'2024-01-11 05:00:00'").withColumn("cents", F.expr(f"cents + if({fifth}, 7, 0)"))
        ),
    )


@query(feature_sql(SPEC, f"select * from ({_GAPPED_SQL} select * from series)", "'1 hour'") + "\n" + rounded_sql(NAMES, "features"))
def incremental_features(spark, sf_dir):
    """Features after three batches with a long gap, a new series and late rows, each recomputing only what it reached, equal those of a full rebuild."""
    raw = FeatureGroup(new_path(spark, "raw"), "hours", 1, HOURLY)
    wide = FeatureGroup(new_path(spark, "wide"), "hour_features", 1, HOURLY)
    for number, batch in enumerate(gapped_batches(spark, sf_dir), start=1):
        incremental.apply_changes(raw, wide, batch, SPEC, HOURLY, number)
    return rounded(wide.read(spark), NAMES)


# The landing is cut every six days from the first day on, at eleven o'clock; the last batch has no end.
_ALERT_BATCHES, _ALERT_DAYS = 5, 6
_ALERTS_SQL = (
    feature_sql(SPEC.without_targets(), f"select * from ({HOURS} select series_id, time, cast(n as double) as n, cast(cents as double) as cents from series)", "'1 hour'")
    + f""", first as (select date_trunc('day', min(ts)) + interval '11 hour' as t from events),
 ends as (select i as batch, case when i = 0 then timestamp '1970-01-01' else t + to_days(cast({_ALERT_DAYS} * i as int)) end as since,
 case when i = {_ALERT_BATCHES - 1} then timestamp '2200-01-01' else t + to_days(cast({_ALERT_DAYS} * (i + 1) as int)) end as upto from range({_ALERT_BATCHES}) r(i), first),
 last as (select batch, f.series_id, max(f.time) as time from ends join (select series_id, time from features where n is not null) f on f.time <= upto and f.time > since group by 1, 2),
 scored as (select l.batch, f.series_id, f.time, round_even(f.cents, 1) as level, round_even(greatest(0, f.cents + (f.cents_lag_1 - f.cents) * 0.5), 1) as ahead
 from last l join features f on f.series_id = l.series_id and f.time = l.time where f.cents_lag_1 is not null and f.cents_rolling_mean_24 is not null)
 select batch, series_id, time, greatest(level, ahead) as peak, case when greatest(level, ahead) >= 200 then 'severe' when greatest(level, ahead) >= 150 then 'sensitive' else 'none' end as alert from scored"""
)


@query(_ALERTS_SQL)
def streamed_alerts(spark, sf_dir):
    """The whole table in batches, each scored at its newest time from all rows so far; the drift model stands in for a trained one."""
    hours = event_hours(spark, sf_dir, by_type=True).select(
        "series_id", "time", F.col("n").cast("double").alias("n"), F.col("cents").cast("double").alias("cents")
    )
    root = new_path(spark, "alerts")
    raw, out, rejects = (FeatureGroup(root, n, 1, HOURLY) for n in ("raw", "alerts", "rejects"))

    def drift(rows):
        change = (F.col("cents_lag_1") - F.col("cents")) * 0.5
        return rows.withColumns({change_column("drift", h): change for h in SPEC.horizons})

    first = datetime.combine(table(spark, sf_dir, "events").agg(F.min("ts").cast("timestamp_ntz")).first()[0], time()) + timedelta(hours=11)
    since = F.lit("1970-01-01").cast("timestamp_ntz")
    for i in range(_ALERT_BATCHES):
        end = first + timedelta(days=_ALERT_DAYS * (i + 1)) if i + 1 < _ALERT_BATCHES else datetime(2200, 1, 1)
        upto = F.lit(end).cast("timestamp_ntz")
        stream = _stream_of(spark, new_path(spark, "landing"), hours.where((F.col("time") > since) & (F.col("time") <= upto)))
        names = ["cents", "cents_lag_1", "cents_rolling_mean_24"]
        _wait(alerts.score_stream(stream, raw, names, drift, (("drift", 1.0),), SPEC, HOURLY, out, rejects, new_path(spark, "checkpoint")))
        since = upto
    return out.log(spark).select((F.col("commit_id") - 1).alias("batch"), "series_id", "time", "peak", "alert")


@query(feature_sql(SPEC, f"select * from ({_REVISED_SQL} select * from series)", "'1 hour'") + "\n" + rounded_sql(NAMES, "features") + " where time between timestamp '2024-01-20' and timestamp '2024-01-22'")
def halo_restricted_features(spark, sf_dir):
    """Features of a time span, reading only the rows its windows reach."""
    first, second = _two_batches(spark, sf_dir)
    merged = first.withColumn("_seq", F.lit(0)).unionByName(second.withColumn("_seq", F.lit(1)))
    merged = dedup_by_key(merged, HOURLY.columns, "_seq").drop("_seq")
    return rounded(build_features(merged, SPEC, HOURLY, datetime(2024, 1, 20), datetime(2024, 1, 22)), NAMES)
