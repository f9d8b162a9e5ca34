"""Score and alert on every batch of new rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tsengine.plans.feature_plan import FeatureSpec
from tsengine.plans.live import live_features, model_inputs
from tsengine.plans.serve import alert_table, forecast_table
from tsengine.series import SeriesKeys
from tsengine.session import materialize
from tsengine.sources.store import FeatureGroup
from tsengine.streaming.ingest import batch_name


def score_stream(
    stream: DataFrame,
    raw: FeatureGroup,
    features: Sequence[str],
    predict: Callable[[DataFrame], DataFrame],
    components: Sequence[tuple[str, float]],
    spec: FeatureSpec,
    ks: SeriesKeys,
    alerts: FeatureGroup,
    rejects: FeatureGroup,
    checkpoint: str,
    clock: Callable[[], datetime] | None = None,
) -> StreamingQuery:
    """Per micro-batch: its rows into the raw group, rows at now from that group, their forecast, one alert per series.

    ``predict`` adds the components' change columns. Now is the batch's newest time, or what ``clock`` says. Only series
    present in the batch are scored; those that cannot be go to ``rejects`` with their missing columns. All rows of earlier
    batches count: the group is read as far back as the windows reach.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, batch_name(checkpoint, batch_id)
        batch = materialize(batch.select(*ks.columns, *spec.measures), "batch")
        newest, oldest_end = batch.groupBy(*ks.keys).agg(F.max(ks.time).alias("t")).agg(F.max("t"), F.min("t")).first()
        if newest is None:
            return
        raw.commit(batch, raw.next_commit(spark, name), name)
        now = clock() if clock else newest
        since = min(now, oldest_end) - timedelta(seconds=ks.step_seconds * (spec.back + 1))
        touched = batch.select(*ks.keys).distinct()
        past = raw.read(spark, since=since).join(touched, list(ks.keys), "left_semi")
        ends = raw.ends(spark).join(touched, list(ks.keys), "left_semi")
        ready, missing = model_inputs(live_features(past, batch, spec, ks, now, ends), features, spec, ks)
        rejects.commit(missing.select(*ks.columns, "null_columns"), rejects.next_commit(spark, name), name)
        forecast = forecast_table(predict(ready), components, spec, ks, spec.horizons)
        scored = alert_table(forecast, ks).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        alerts.commit(scored, alerts.next_commit(spark, name), name)

    return (
        stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(run).start()
    )
