"""The data-quality report: one row per check ``(check, status, bad, checked)``."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsengine.functions.scalars import close
from tsengine.operators.clean import NUMERIC
from tsengine.operators.profile import duplicate_count, gap_summary, order_breaks
from tsengine.plans.feature_plan import FeatureSpec
from tsengine.series import SeriesKeys, chunk_grid

# The range of each calendar part, and the accepted share of gaps in percent.
CALENDAR_RANGES = {
    "hour": (0, 23),
    "day": (1, 31),
    "month": (1, 12),
    "day_of_week": (0, 6),
    "day_of_year": (1, 366),
    "week_of_year": (1, 53),
    "is_weekend": (0, 1),
}
GAP_TOLERANCE_PERCENT = 0.5
SCHEMA = "check string, status string, bad bigint, checked bigint"


@dataclass(frozen=True)
class Alignment:
    """``feature`` must equal ``column`` of the raw table ``steps`` away, less ``minus`` of the raw table at the row's own time."""

    feature: str
    column: str
    steps: int
    minus: str | None = None
    atol: float = 1e-6
    rtol: float = 0.0


def lag_rules(spec: FeatureSpec) -> list[Alignment]:
    return [Alignment(f"{spec.prefix}_lag_{n}", spec.level, -n) for n in spec.lags]


def target_rules(spec: FeatureSpec, atol: float = 1e-6) -> list[Alignment]:
    levels = [Alignment(spec.level_target_name(h), spec.level, h, atol=atol) for h in spec.horizons]
    return levels + [Alignment(spec.change_target_name(h), spec.level, h, spec.level, atol) for h in spec.horizons]


def lead_rules(spec: FeatureSpec) -> list[Alignment]:
    return [
        Alignment(f"{spec.lead_prefix}_{m}_{h}", m, h, atol=1e-8, rtol=1e-5) for m in spec.lead_measures for h in spec.leads
    ]


def alignment_checks(features: DataFrame, raw: DataFrame, ks: SeriesKeys, rules: Sequence[Alignment], fail_when_empty: bool = True) -> DataFrame:
    """Recomputes shifted features from the raw table and compares them; a rule whose column is missing fails.

    Expectations of all rules are shifts over one regular grid of the raw rows, which join the feature rows once; no row is made per rule.
    """
    present = [r for r in rules if r.feature in features.columns]
    absent = [(f"aligned: {r.feature}", "fail", 0, 0) for r in rules if r.feature not in features.columns]
    missing = features.sparkSession.createDataFrame(absent, SCHEMA)
    if not present:
        return missing
    columns = sorted({c for r in present for c in (r.column, r.minus) if c})
    back = max(0, *[-r.steps for r in present])
    ahead = max(0, *[r.steps for r in present])
    grid = chunk_grid(raw, ks, columns, back, ahead)
    shifted = {}
    for r in present:
        value = F.lead(F.col(r.column).cast("double"), r.steps).over(grid.window)
        shifted[f"_e_{r.feature}"] = value - F.col(r.minus).cast("double") if r.minus else value
    expected = grid.core(grid.df.select(*ks.columns, "_core", *[e.alias(n) for n, e in shifted.items()]))
    met = features.select(*ks.columns, *[F.col(r.feature).cast("double").alias(f"_a_{r.feature}") for r in present]).join(expected, ks.columns, "left")
    counters = []
    for r in present:
        got, want = F.col(f"_a_{r.feature}"), F.col(f"_e_{r.feature}")
        both = got.isNotNull() & want.isNotNull()
        counters.append(F.struct(F.lit(f"aligned: {r.feature}").alias("check"), F.count_if(both & ~close(got, want, r.atol, r.rtol)).alias("bad"), F.count_if(both).alias("checked")))
    counted = met.agg(F.array(*counters).alias("_c")).select(F.inline("_c"))
    bad = F.col("bad") > 0
    if fail_when_empty:
        bad = bad | (F.col("checked") == 0)
    return counted.select("check", _status(bad).alias("status"), "bad", "checked").unionByName(missing)


def _status(bad: Column, warn: Column | None = None) -> Column:
    out = F.when(bad, "fail")
    if warn is not None:
        out = out.when(warn, "warn")
    return out.otherwise("pass")


def schema_checks(
    features: DataFrame,
    ks: SeriesKeys,
    groups: dict[str, Sequence[str]],
    feature_list: Sequence[str],
    spec: FeatureSpec,
    seq: str | None = None,
) -> list[tuple[str, str, int, int]]:
    """Checks that need only names and types: column groups, numeric types, leakage."""
    present, types = set(features.columns), dict(features.dtypes)
    rows = []
    for name, columns in groups.items():
        missing = sum(c not in present for c in columns)
        rows.append((f"columns: {name}", "fail" if missing else "pass", missing, len(columns)))
    values = [c for c in features.columns if c not in ks.columns and c != seq]
    odd = sum(types[c] not in NUMERIC and not types[c].startswith("decimal") for c in values)
    rows.append(("numeric columns", "fail" if odd else "pass", odd, len(values)))
    targets = {*spec.level_targets, *spec.change_targets}
    leaked = sum(c in targets for c in feature_list)
    leaked += sum(c.startswith(spec.lead_prefix + "_") and spec.prefix in c.lower() for c in feature_list)
    rows.append(("no leakage", "fail" if leaked else "pass", leaked, len(feature_list)))
    return rows


def value_checks(features: DataFrame, ks: SeriesKeys, spec: FeatureSpec, non_negative: Sequence[str], few_rows: int = 500) -> DataFrame:
    """Ranges, nulls, infinities and negatives, all counted in one pass over the table."""
    values = [c for c in features.columns if c not in ks.columns]
    doubles = [c for c in values if dict(features.dtypes)[c] in ("double", "float")]
    counters: dict[str, Column] = {}
    for c, (low, high) in CALENDAR_RANGES.items():
        if c in values:
            counters[f"range: {c}"] = F.count_if(~F.col(c).between(low, high))
    counters["no nulls"] = F.sum(sum((F.col(c).isNull().cast("bigint") for c in values), F.lit(0).cast("bigint")))
    counters["no infinities"] = F.sum(
        sum((F.coalesce(F.abs(F.col(c)) == float("inf"), F.lit(False)).cast("bigint") for c in doubles), F.lit(0).cast("bigint"))
    )
    for c in non_negative:
        if c in features.columns:
            counters[f"not negative: {c}"] = F.count_if(F.col(c) < 0)
    names = list(counters)
    one = features.agg(F.count(F.lit(1)).alias("_rows"), *[F.coalesce(v, F.lit(0)).alias(n) for n, v in counters.items()])
    long = one.unpivot(["_rows"], names, "check", "bad")
    checks = long.select("check", _status(F.col("bad") > 0).alias("status"), "bad", F.col("_rows").alias("checked"))
    enough = one.select(
        F.lit("enough rows").alias("check"),
        _status(F.lit(False), F.col("_rows") < few_rows).alias("status"),
        F.lit(0).cast("bigint").alias("bad"),
        F.col("_rows").alias("checked"),
    )
    absent = [(f"not negative: {c}", "fail", 0, 0) for c in non_negative if c not in features.columns]
    return checks.unionByName(enough).unionByName(features.sparkSession.createDataFrame(absent, SCHEMA))


def key_checks(features: DataFrame, ks: SeriesKeys, seq: str | None = None) -> DataFrame:
    """Duplicate times, gaps against the tolerance and, when the stored order is known, chronology."""
    counted = duplicate_count(features, ks.columns, "bad")
    dup = counted.select(
        F.lit("no duplicate times").alias("check"), _status(F.col("bad") > 0).alias("status"), "bad", F.col("n_rows").alias("checked")
    )
    gaps = gap_summary(features.select(*ks.columns), ks).agg(F.sum("gaps").alias("bad"), F.sum("n_rows").alias("checked"))
    share = F.col("bad") * 100.0 / F.col("checked")
    gap = gaps.select(
        F.lit("regular steps").alias("check"), _status(share > GAP_TOLERANCE_PERCENT, F.col("bad") > 0).alias("status"), "bad", "checked"
    )
    out = dup.unionByName(gap)
    if seq:
        order = order_breaks(features, ks.keys, seq, ks.time).agg(F.sum("order_breaks").alias("bad"), F.sum("n_rows").alias("checked"))
        out = out.unionByName(order.select(F.lit("chronological").alias("check"), _status(F.col("bad") > 0).alias("status"), "bad", "checked"))
    return out


def coverage_checks(features: DataFrame, raw: DataFrame, ks: SeriesKeys, horizons: Sequence[int]) -> DataFrame:
    """Raw data of each series must reach its last feature time plus each horizon."""
    ends = features.groupBy(*ks.keys).agg(F.max(ks.time).alias("_end")).join(
        raw.groupBy(*ks.keys).agg(F.max(ks.time).alias("_raw_end")), list(ks.keys), "left"
    )
    one = ends.agg(
        F.count(F.lit(1)).alias("checked"),
        *[F.count_if(F.coalesce(F.col("_raw_end") < F.col("_end") + ks.steps(h), F.lit(True))).alias(f"coverage: {h}") for h in horizons],
    )
    long = one.unpivot(["checked"], [f"coverage: {h}" for h in horizons], "check", "bad")
    return long.select("check", _status(F.col("bad") > 0).alias("status"), "bad", "checked")


def quality_report(
    features: DataFrame,
    raw: DataFrame,
    spec: FeatureSpec,
    ks: SeriesKeys,
    non_negative: Sequence[str],
    feature_list: Sequence[str] | None = None,
    seq: str | None = None,
) -> DataFrame:
    """All checks in one table. ``features`` should be a written table: several passes read it."""
    groups = {"keys": ks.columns, **spec.families(), "targets": spec.level_targets, "change targets": spec.change_targets}
    metadata = schema_checks(features, ks, groups, feature_list if feature_list is not None else spec.features, spec, seq)
    rules = [*lag_rules(spec), *target_rules(spec), *lead_rules(spec)]
    return (
        features.sparkSession.createDataFrame(metadata, SCHEMA)
        .unionByName(value_checks(features.drop(seq) if seq else features, ks, spec, non_negative))
        .unionByName(key_checks(features, ks, seq))
        .unionByName(coverage_checks(features, raw, ks, spec.horizons))
        .unionByName(alignment_checks(features, raw, ks, rules))
    )


def passed(report: DataFrame) -> bool:
    return report.where("status = 'fail'").isEmpty()
