"""Streams into series: tumbling buckets, latest-wins appends, and a bound on how old a revision may be."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tsengine.series import SeriesKeys, floor_time
from tsengine.session import materialize
from tsengine.sources.store import FeatureGroup

# Fixed value: how far back a feed may rewrite its past.
REVISION_WINDOW = timedelta(days=92)


def file_stream(spark: SparkSession, folder: str, pattern: str, schema, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def drop_repeats(stream: DataFrame, event_time: str, keys: Sequence[str], within: str) -> DataFrame:
    """Exact repeats of an event arriving within the watermark are dropped; state is bounded by it."""
    timed = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return timed.withWatermark(event_time, within).dropDuplicatesWithinWatermark(list(keys))


def tumbling_series(stream: DataFrame, ks: SeriesKeys, event_time: str, aggregates: Sequence[Column], lateness: str) -> DataFrame:
    """Streaming form of ``bucketize``: one row per series and bucket, updated while the watermark lets events in."""
    timed = stream.withColumn("_at", F.col(event_time).cast("timestamp")).withWatermark("_at", lateness)
    buckets = timed.groupBy(*ks.keys, F.window("_at", f"{ks.step_seconds} seconds").alias("_w")).agg(*aggregates)
    names = [c for c in buckets.columns if c not in (*ks.keys, "_w")]
    return buckets.select(*ks.keys, F.col("_w.start").cast("timestamp_ntz").alias(ks.time), *names)


def batch_name(checkpoint: str, batch_id: int) -> str:
    """Names a micro-batch of one stream for good: replayed, it finds its own commit; another stream never meets it."""
    return f"{checkpoint.rstrip('/')}:{batch_id}"


def upsert_stream(stream: DataFrame, group: FeatureGroup, checkpoint: str) -> StreamingQuery:
    """Each micro-batch becomes one commit, so the latest value of a key wins.

    Commits go on from the group's last number, also under a new checkpoint; a batch replayed after a failure replaces itself.
    """

    def commit(batch: DataFrame, batch_id: int) -> None:
        name = batch_name(checkpoint, batch_id)
        group.commit(batch, group.next_commit(batch.sparkSession, name), name)

    return (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(commit)
        .start()
    )


def revision_stream(stream: DataFrame, group: FeatureGroup, rejects: FeatureGroup, checkpoint: str, window: timedelta = REVISION_WINDOW) -> StreamingQuery:
    """Like ``upsert_stream`` for bucketed rows, but rows older than a series' newest time less ``window`` go to ``rejects``.

    No row is lost: each is in one group or the other. The newest times are those of the group before the batch, from its day summaries.
    """
    ks = group.ks

    def commit(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, batch_name(checkpoint, batch_id)
        batch = materialize(batch, "revisions")
        number = group.next_commit(spark, name)
        before = group.last_commit(spark, number)
        past = group.ends(spark, before) if before else batch.select(*ks.keys, F.col(ks.time).alias("last")).limit(0)
        newest = past.select(*ks.keys, F.col("last").alias("_newest"))
        accepted, rejected = split_revisions(batch, ks, newest, window)
        rejects.commit(rejected.drop("_newest"), rejects.next_commit(spark, name), name)
        group.commit(accepted.drop("_newest"), number, name)

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(commit).start()


def merged_buckets(parts: DataFrame, known: DataFrame, ks: SeriesKeys, merges: dict[str, str]) -> DataFrame:
    """Partial aggregates of buckets added to those that ``known`` has of the same buckets; ``merges`` says how: sum, min or max."""
    touched = known.join(parts.select(*ks.columns), ks.columns, "left_semi").select(*ks.columns, *merges)
    merge = {"sum": F.sum, "min": F.min, "max": F.max}
    return parts.select(*ks.columns, *merges).unionByName(touched).groupBy(*ks.columns).agg(*[merge[how](c).alias(c) for c, how in merges.items()])


def bucket_stream(
    stream: DataFrame,
    ks: SeriesKeys,
    event_time: str,
    partials: dict[str, tuple[Column, str]],
    lateness: timedelta,
    group: FeatureGroup,
    rejects: str,
    checkpoint: str,
) -> StreamingQuery:
    """Events into buckets of ``group``, or to the folder ``rejects``: each event has exactly one of the two outcomes.

    The watermark of a batch is the newest event time of all batches before it less ``lateness``, kept beside the rejected rows. An event is late if its whole
    bucket lies at or before the watermark; events of a bucket that straddles it still count. ``partials`` maps each measure to its aggregate over events and to how
    two partial results merge. Only the touched buckets are read back, as they were before the batch, so a replayed batch gives the same commit. A null event time is late.
    """
    end = floor_time(F.col(event_time).cast("timestamp_ntz"), ks.step_seconds) + F.expr(f"interval '{ks.step_seconds}' second")
    merges = {name: how for name, (_, how) in partials.items()}

    def run(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, batch_name(checkpoint, batch_id)
        batch = materialize(batch, "events")
        try:
            seen = spark.read.schema("batch_id bigint, newest timestamp_ntz").parquet(f"{rejects}/newest").where(F.col("batch_id") < batch_id)
            newest = seen.agg(F.max("newest")).first()[0]
        except AnalysisException:
            newest = None
        on_time = F.col(event_time).isNotNull()
        if newest is not None:
            on_time = F.coalesce(end > F.lit(newest - lateness).cast("timestamp_ntz"), F.lit(False))
        batch.where(~on_time).write.mode("overwrite").parquet(f"{rejects}/rows/batch_id={batch_id}")
        buckets = batch.where(on_time).groupBy(*ks.keys, floor_time(F.col(event_time).cast("timestamp_ntz"), ks.step_seconds).alias(ks.time))
        parts = materialize(buckets.agg(*[c.alias(n) for n, (c, _) in partials.items()]), "partial-buckets")
        first, last = parts.agg(F.min(ks.time), F.max(ks.time)).first()
        if first is not None:
            number = group.next_commit(spark, name)
            before = group.last_commit(spark, number)
            known = group.read(spark, before, first, last) if before else parts.limit(0)
            group.commit(merged_buckets(parts, known, ks, merges), number, name)
        top = batch.agg(F.max(event_time).cast("timestamp_ntz").alias("newest")).select(F.lit(batch_id).cast("bigint").alias("batch_id"), "newest")
        top.coalesce(1).write.mode("append").parquet(f"{rejects}/newest")

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(run).start()


def split_revisions(batch: DataFrame, ks: SeriesKeys, newest: DataFrame, window: timedelta = REVISION_WINDOW) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): rows older than each series' newest known time less ``window`` are rejected.

    ``newest`` is (series, ``_newest``); a new series is measured against its own batch.
    """
    own = batch.groupBy(*ks.keys).agg(F.max(ks.time).alias("_own"))
    ends = own.join(newest, list(ks.keys), "left").select(*ks.keys, F.greatest("_own", "_newest").alias("_end"))
    placed = batch.join(ends, list(ks.keys))  # the ends are one row per series
    recent = F.col(ks.time) >= F.col("_end") - F.expr(f"interval '{int(window.total_seconds())}' second")
    return placed.where(recent).drop("_end"), placed.where(~recent).drop("_end")
