"""Series made from the test tables, in Spark and in SQL.

Base measures are whole numbers, so sums do not depend on the order in which rows arrive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tsengine.plans.feature_plan import FeatureSpec, air_quality_spec
from tsengine.series import DAILY, HOURLY, bucketize
from tsengine.session import materialize

FULL = air_quality_spec()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def _measures() -> dict[str, Column]:
    n = F.count(F.lit(1))
    return {
        "us_aqi": F.floor(F.sum(_cents("l_extendedprice")) / 100000),
        "temperature_2m": F.sum(_cents("l_discount")),
        "relative_humidity_2m": F.sum(_cents("l_tax")),
        "dew_point_2m": F.sum("l_linenumber"),
        "surface_pressure": F.max("l_quantity"),
        "cloud_cover": F.min("l_quantity"),
        "wind_speed_10m": F.sum(F.col("l_suppkey") % 10),
        "wind_direction_10m": (n * 37) % 360,
        "precipitation": F.count_if(_cents("l_discount") >= 5),
        "weather_code": n % 100,
        "pm10": n,
        "pm2_5": F.sum("l_quantity"),
        "carbon_monoxide": F.sum(F.col("l_linenumber") * F.col("l_quantity")),
        "nitrogen_dioxide": F.count_if(F.col("l_quantity") > 25),
        "sulphur_dioxide": F.count_if(_cents("l_tax") >= 4),
        "ozone": F.count_if(_cents("l_discount") < 5),
        "european_aqi": F.floor(F.max(_cents("l_extendedprice")) / 100000),
    }


_MEASURE_SQL = {
    "us_aqi": "floor(sum(cast(round(l_extendedprice * 100) as bigint)) / 100000)",
    "temperature_2m": "sum(cast(round(l_discount * 100) as bigint))",
    "relative_humidity_2m": "sum(cast(round(l_tax * 100) as bigint))",
    "dew_point_2m": "sum(l_linenumber)",
    "surface_pressure": "max(l_quantity)",
    "cloud_cover": "min(l_quantity)",
    "wind_speed_10m": "sum(l_suppkey % 10)",
    "wind_direction_10m": "(count(*) * 37) % 360",
    "precipitation": "count(*) filter (where round(l_discount * 100) >= 5)",
    "weather_code": "count(*) % 100",
    "pm10": "count(*)",
    "pm2_5": "sum(l_quantity)",
    "carbon_monoxide": "sum(l_linenumber * l_quantity)",
    "nitrogen_dioxide": "count(*) filter (where l_quantity > 25)",
    "sulphur_dioxide": "count(*) filter (where round(l_tax * 100) >= 4)",
    "ozone": "count(*) filter (where round(l_discount * 100) < 5)",
    "european_aqi": "floor(max(cast(round(l_extendedprice * 100) as bigint)) / 100000)",
}


def lineitem_days(spark: SparkSession, sf_dir: str, key: str = "l_returnflag") -> DataFrame:
    """One row per ``key`` and ship date with the 17 measures."""
    li = table(spark, sf_dir, "lineitem").withColumn("series_id", F.col(key).cast("string"))
    measures = [c.cast("double").alias(m) for m, c in _measures().items()]
    return bucketize(li, DAILY, "l_shipdate", measures)


def lineitem_days_sql(key: str = "l_returnflag") -> str:
    measures = ",\n ".join(f"cast({s} as double) as {m}" for m, s in _MEASURE_SQL.items())
    return f"select cast({key} as varchar) as series_id, date_trunc('day', l_shipdate)::timestamp as time,\n {measures}\nfrom lineitem group by 1, 2"


def stored_days(spark: SparkSession, sf_dir: str, key: str = "l_returnflag") -> DataFrame:
    """``lineitem_days`` written once: feature plans read a series twice (bounds and rows), the raw table should be read once."""
    return materialize(lineitem_days(spark, sf_dir, key), "series")


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order date: the second feed."""
    o = table(spark, sf_dir, "orders").withColumn("series_id", F.lit("all"))
    return bucketize(
        o,
        DAILY,
        "o_orderdate",
        [F.count(F.lit(1)).alias("orders"), F.sum(_cents("o_totalprice")).alias("total_cents")],
    )


ORDER_DAYS_SQL = """select 'all' as series_id, date_trunc('day', o_orderdate)::timestamp as time, count(*) as orders,
 sum(cast(round(o_totalprice * 100) as bigint))::bigint as total_cents from orders group by 1, 2"""


def event_hours(spark: SparkSession, sf_dir: str, by_type: bool) -> DataFrame:
    """One row per hour (and event type): count, value in cents, distinct-free integer sums."""
    e = table(spark, sf_dir, "events").withColumn("series_id", F.col("event_type") if by_type else F.lit("all"))
    return bucketize(
        e,
        HOURLY,
        "ts",
        [
            F.count(F.lit(1)).alias("n"),
            F.sum(_cents("value")).alias("cents"),
            F.max("user_id").alias("top_user"),
        ],
    )


def event_hours_sql(by_type: bool) -> str:
    key = "event_type" if by_type else "'all'"
    return f"""select {key} as series_id, date_trunc('hour', ts)::timestamp as time, count(*) as n,
 sum(cast(round(value * 100) as bigint))::bigint as cents, max(user_id) as top_user from events group by 1, 2"""


def grid_sql(source: str, step: str, columns: list[str]) -> str:
    """Regular grid per series over a source CTE."""
    picked = ", ".join(f"s.{c}" for c in columns)
    return f"""select g.series_id, g.time, {picked} from (
 select series_id, unnest(generate_series(lo, hi, interval {step})) as time
 from (select series_id, min(time) as lo, max(time) as hi from {source} group by 1)) g
 left join {source} s on s.series_id = g.series_id and s.time = g.time"""


def feature_sql(spec: FeatureSpec = FULL, source: str | None = None, step: str = "'1 day'") -> str:
    """``with`` clause ending in a CTE ``features``: the wide table of ``spec``, window by window, written for SQL."""
    v, p, f = spec.level, spec.prefix, spec.lead_prefix
    out = [f"{m}" for m in spec.measures]
    if spec.calendar:
        parts = {
            "hour": "hour(time)",
            "day": "day(time)",
            "month": "month(time)",
            "day_of_week": "isodow(time) - 1",
            "day_of_year": "dayofyear(time)",
            "week_of_year": "weekofyear(time)",
            "is_weekend": "case when isodow(time) >= 6 then 1 else 0 end",
        }
        out += [f"cast({e} as integer) as {n}" for n, e in parts.items()]
        for n, period in (("hour", 24), ("day_of_week", 7), ("month", 12), ("day_of_year", 365.25)):
            out += [f"{fn}(2 * pi() * ({parts[n]}) / {period}) as {n}_{fn}" for fn in ("sin", "cos")]
    out += [f"lag({v}, {n}) over w as {p}_lag_{n}" for n in spec.lags]
    frames = {}
    agg = {"mean": "avg", "min": "min", "max": "max", "median": "median", "std": "stddev_samp"}
    for n in sorted({*spec.windows, *spec.deviations}):
        frames[f"f{n}"] = f"f{n} as (partition by series_id order by time rows between {n - 1} preceding and current row)"
    for s in spec.stats:
        out += [f"case when count({v}) over f{n} = {n} then {agg[s]}({v}) over f{n} end as {p}_rolling_{s}_{n}" for n in spec.windows]
    out += [f"{v} - lag({v}, {n}) over w as {p}_change_{n}" for n in spec.changes]
    out += [f"({v} - lag({v}, {n}) over w) / nullif(lag({v}, {n}) over w, 0) * 100 as {p}_pct_change_{n}" for n in spec.percent_changes]
    out += [f"({v} - lag({v}, {n}) over w) / {n} as {p}_trend_{n}" for n in spec.trends]
    out += [f"{v} - case when count({v}) over f{n} = {n} then avg({v}) over f{n} end as {p}_deviation_from_mean_{n}" for n in spec.deviations]
    if spec.phase_count:
        past = ", ".join(f"lag({v}, {spec.phase_period * d}) over w" for d in range(1, spec.phase_count + 1))
        for stat, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max")):
            out.append(f"list_aggregate([{past}], '{fn}') as {p}_{spec.phase_name}_{stat}_{spec.phase_suffix}")
    sums = {n: f"({a} + {b})" for n, a, b in spec.sums}
    out += [f"{e} as {n}" for n, e in sums.items()]
    out += [f"{sums.get(a, a)} / nullif({sums.get(b, b)}, 0) as {n}" for n, a, b in spec.ratios]
    out += [f"{a} * {b} as {n}" for n, a, b in spec.products]
    out += [f"{m} - lag({m}, {n}) over w as {m}_change_{n}" for m in spec.change_measures for n in spec.change_steps]
    out += [f"lead({m}, {h}) over w as {f}_{m}_{h}" for m in spec.lead_measures for h in spec.leads]
    out += [f"lead({m}, {h}) over w - {m} as {f}_{n}_{h}" for n, m in spec.lead_deltas for h in spec.leads]
    for n, m in spec.forward_sums:
        for h in spec.leads:
            frames[f"a{h}"] = f"a{h} as (partition by series_id order by time rows between 1 following and {h} following)"
            out.append(f"case when count({m}) over a{h} = {h} then sum({m}) over a{h} end as {f}_{n}_{h}")
    for n, m in spec.angles:
        out += [f"{fn}(2 * pi() * {m} / 360) as {n}_{fn}" for fn in ("sin", "cos")]
        out += [f"{fn}(2 * pi() * lead({m}, {h}) over w / 360) as {f}_{n}_{fn}_{h}" for h in spec.leads for fn in ("sin", "cos")]
    for h in spec.horizons:
        out.append(f"lead({v}, {h}) over w as {spec.level_target_name(h)}")
        out.append(f"lead({v}, {h}) over w - {v} as {spec.change_target_name(h)}")
    windows = ",\n ".join(["w as (partition by series_id order by time)", *frames.values()])
    body = ",\n ".join(out)
    return f"""with series as ({source or lineitem_days_sql()}),
grid as ({grid_sql('series', step, list(spec.measures))}),
features as (select series_id, time, {body}
 from grid window {windows})"""


def complete_sql(spec: FeatureSpec = FULL) -> str:
    """``features`` plus a CTE ``complete`` of the rows without a null."""
    names = [*spec.features, *spec.level_targets, *spec.change_targets]
    test = " and ".join(f"{n} is not null" for n in names)
    return feature_sql(spec) + f",\ncomplete as (select * from features where {test})"


def rounded(df: DataFrame, columns: list[str], digits: int = 6, keep: tuple[str, ...] = ("series_id", "time")) -> DataFrame:
    return df.select(*keep, *[F.round(F.col(c).cast("double"), digits).alias(c) for c in columns])


def rounded_sql(columns: list[str], source: str, digits: int = 6, keep: tuple[str, ...] = ("series_id", "time")) -> str:
    picked = ", ".join([*keep, *[f"round(cast({c} as double), {digits}) as {c}" for c in columns]])
    return f"select {picked} from {source}"
