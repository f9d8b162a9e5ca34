"""The wide feature table: a ``FeatureSpec`` is data, ``build_features`` turns it into one window pass."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsengine.functions import scalars as S
from tsengine.operators import windows as W
from tsengine.series import SeriesKeys, chunk_grid, restrict_with_halo

STATS = ("mean", "min", "max", "median", "std")


@dataclass(frozen=True)
class FeatureSpec:
    """What to derive from which measures. Empty tuples switch a family off.

    ``level`` is the measure to forecast; families derived from it start with ``prefix``.
    """

    level: str
    prefix: str
    measures: tuple[str, ...]
    calendar: bool = True
    lags: tuple[int, ...] = ()
    windows: tuple[int, ...] = ()
    stats: tuple[str, ...] = STATS
    changes: tuple[int, ...] = ()
    percent_changes: tuple[int, ...] = ()
    trends: tuple[int, ...] = ()
    deviations: tuple[int, ...] = ()
    phase_period: int = 24
    phase_count: int = 0
    phase_name: str = "same_hour"
    phase_suffix: str = "7d"
    sums: tuple[tuple[str, str, str], ...] = ()
    ratios: tuple[tuple[str, str, str], ...] = ()
    products: tuple[tuple[str, str, str], ...] = ()
    change_measures: tuple[str, ...] = ()
    change_steps: tuple[int, ...] = ()
    lead_prefix: str = "forecast"
    lead_measures: tuple[str, ...] = ()
    leads: tuple[int, ...] = ()
    lead_deltas: tuple[tuple[str, str], ...] = ()
    forward_sums: tuple[tuple[str, str], ...] = ()
    angles: tuple[tuple[str, str], ...] = ()
    horizons: tuple[int, ...] = ()
    level_target: str = field(default="", repr=False)
    change_target: str = field(default="target_change", repr=False)

    @property
    def back(self) -> int:
        """Steps of history the widest feature needs."""
        reach = [0, *self.lags, *self.changes, *self.percent_changes, *self.trends, *self.change_steps]
        reach += [w - 1 for w in (*self.windows, *self.deviations)]
        return max(*reach, self.phase_period * self.phase_count)

    @property
    def ahead(self) -> int:
        return max([0, *self.leads, *self.horizons])

    def level_target_name(self, h: int) -> str:
        return f"{self.level_target or 'target_' + self.prefix}_{h}"

    def change_target_name(self, h: int) -> str:
        return f"{self.change_target}_{h}"

    @property
    def level_targets(self) -> list[str]:
        return [self.level_target_name(h) for h in self.horizons]

    @property
    def change_targets(self) -> list[str]:
        return [self.change_target_name(h) for h in self.horizons]

    def without_targets(self) -> "FeatureSpec":
        """The same features at serving time, when the future level is unknown."""
        return replace(self, horizons=())

    def families(self) -> dict[str, list[str]]:
        """Feature names by family, in table order."""
        p, f = self.prefix, self.lead_prefix
        out: dict[str, list[str]] = {"measures": list(self.measures)}
        if self.calendar:
            out["calendar"] = [*CALENDAR, *[f"{c}_{x}" for c in S.CYCLES for x in ("sin", "cos")]]
        out["lags"] = [f"{p}_lag_{n}" for n in self.lags]
        for s in self.stats:
            out[f"rolling {s}"] = [f"{p}_rolling_{s}_{n}" for n in self.windows]
        out["change"] = [f"{p}_change_{n}" for n in self.changes]
        out["percent change"] = [f"{p}_pct_change_{n}" for n in self.percent_changes]
        out["trend"] = [f"{p}_trend_{n}" for n in self.trends]
        out["deviation"] = [f"{p}_deviation_from_mean_{n}" for n in self.deviations]
        if self.phase_count:
            out["same phase"] = [f"{p}_{self.phase_name}_{s}_{self.phase_suffix}" for s in ("mean", "std", "min", "max")]
        out["composition"] = [n for n, _, _ in (*self.sums, *self.ratios)]
        out["products"] = [n for n, _, _ in self.products]
        out["measure changes"] = [f"{m}_change_{n}" for m in self.change_measures for n in self.change_steps]
        out["leads"] = [f"{f}_{m}_{n}" for m in self.lead_measures for n in self.leads]
        out["lead deltas and sums"] = [f"{f}_{n}_{h}" for n, _ in (*self.lead_deltas, *self.forward_sums) for h in self.leads]
        out["directions"] = [f"{n}_{x}" for n, _ in self.angles for x in ("sin", "cos")]
        out["directions"] += [f"{f}_{n}_{x}_{h}" for n, _ in self.angles for h in self.leads for x in ("sin", "cos")]
        return {k: v for k, v in out.items() if v}

    @property
    def features(self) -> list[str]:
        return [name for names in self.families().values() for name in names]


CALENDAR = ("hour", "day", "month", "day_of_week", "day_of_year", "week_of_year", "is_weekend")

# Measure names and offsets of the air-quality recipe.
AIR_QUALITY_MEASURES = (
    "us_aqi",
    "temperature_2m",
    "relative_humidity_2m",
    "dew_point_2m",
    "surface_pressure",
    "cloud_cover",
    "wind_speed_10m",
    "wind_direction_10m",
    "precipitation",
    "weather_code",
    "pm10",
    "pm2_5",
    "carbon_monoxide",
    "nitrogen_dioxide",
    "sulphur_dioxide",
    "ozone",
    "european_aqi",
)


def air_quality_spec() -> FeatureSpec:
    """The full recipe: 188 features and 6 targets."""
    return FeatureSpec(
        level="us_aqi",
        prefix="aqi",
        measures=AIR_QUALITY_MEASURES,
        lags=(1, 3, 6, 12, 24, 48, 72, 96, 120, 168, 336, 504),
        windows=(6, 12, 24, 48, 72, 168),
        changes=(1, 3, 6, 12, 24, 48, 72),
        percent_changes=(3, 6, 12, 24, 48, 72, 168),
        trends=(6, 12, 24, 48, 72, 168),
        deviations=(24, 48, 72, 168),
        phase_count=7,
        sums=(("pm_total", "pm2_5", "pm10"),),
        ratios=(
            ("pm25_pm10_ratio", "pm2_5", "pm10"),
            ("pm25_aqi_ratio", "pm2_5", "us_aqi"),
            ("pm10_aqi_ratio", "pm10", "us_aqi"),
            ("no2_o3_ratio", "nitrogen_dioxide", "ozone"),
            ("pm25_fraction", "pm2_5", "pm_total"),
        ),
        products=(
            ("temperature_humidity_interaction", "temperature_2m", "relative_humidity_2m"),
            ("wind_pm25_interaction", "wind_speed_10m", "pm2_5"),
            ("humidity_pm25_interaction", "relative_humidity_2m", "pm2_5"),
            ("pressure_pm25_interaction", "surface_pressure", "pm2_5"),
            ("temperature_pm25_interaction", "temperature_2m", "pm2_5"),
            ("wind_pm10_interaction", "wind_speed_10m", "pm10"),
        ),
        change_measures=(
            "temperature_2m",
            "relative_humidity_2m",
            "surface_pressure",
            "wind_speed_10m",
            "cloud_cover",
            "pm2_5",
            "pm10",
            "ozone",
            "nitrogen_dioxide",
        ),
        change_steps=(3, 6, 12, 24),
        lead_measures=(
            "temperature_2m",
            "relative_humidity_2m",
            "surface_pressure",
            "wind_speed_10m",
            "wind_direction_10m",
            "cloud_cover",
            "precipitation",
        ),
        leads=(24, 48, 72),
        lead_deltas=(("wind_speed_change", "wind_speed_10m"), ("pressure_change", "surface_pressure")),
        forward_sums=(("precipitation_total", "precipitation"),),
        angles=(("wind_direction", "wind_direction_10m"),),
        horizons=(24, 48, 72),
    )


def _ordered_columns(spec: FeatureSpec, w) -> W.WindowPasses:
    """Everything that needs the window, hidden helpers (``_``) included; each value is computed once."""
    p, f, v = spec.prefix, spec.lead_prefix, spec.level
    passes = W.WindowPasses()
    needed = {*spec.lags, *spec.changes, *spec.percent_changes, *spec.trends}
    needed |= {spec.phase_period * d for d in range(1, spec.phase_count + 1)}
    for n in sorted(needed):
        passes.first[f"_lag_{n}"] = W.lag(v, n, w)
    for n in spec.windows:
        passes.add_rolling(v, n, spec.stats, w, lambda stat, n=n: f"{p}_rolling_{stat}_{n}")
    for n in spec.deviations:
        passes.add_rolling(v, n, ("mean",), w, lambda stat, n=n: f"_mean_{n}")
    for m in spec.change_measures:
        for n in spec.change_steps:
            passes.first[f"{m}_change_{n}"] = F.col(m) - W.lag(m, n, w)
    lead_measures = {*spec.lead_measures, *[m for _, m in spec.lead_deltas], *[m for _, m in spec.angles]}
    for m in sorted(lead_measures):
        for h in spec.leads:
            passes.first[f"_lead_{m}_{h}"] = W.lead(m, h, w)
    for n, m in spec.forward_sums:
        for h in spec.leads:
            passes.add_forward_sum(m, h, w, f"{f}_{n}_{h}")
    for h in spec.horizons:
        passes.first[spec.level_target_name(h)] = W.lead(v, h, w)
    return passes


def _row_columns(spec: FeatureSpec, time: str, merged: dict[str, Column]) -> dict[str, Column]:
    """Features that need only the columns of the row itself, the merged window results included."""
    p, f, v = spec.prefix, spec.lead_prefix, F.col(spec.level)
    out = dict(merged)
    if spec.calendar:
        parts = S.calendar_parts(F.col(time))
        out.update(parts)
        for name, period in S.CYCLES.items():
            out[f"{name}_sin"], out[f"{name}_cos"] = S.on_circle(parts[name], period)
    for n in spec.lags:
        out[f"{p}_lag_{n}"] = F.col(f"_lag_{n}")
    for n in spec.changes:
        out[f"{p}_change_{n}"] = v - F.col(f"_lag_{n}")
    for n in spec.percent_changes:
        out[f"{p}_pct_change_{n}"] = S.percent_change(v, F.col(f"_lag_{n}"))
    for n in spec.trends:
        out[f"{p}_trend_{n}"] = (v - F.col(f"_lag_{n}")) / n
    for n in spec.deviations:
        out[f"{p}_deviation_from_mean_{n}"] = v - merged[f"_mean_{n}"]
    if spec.phase_count:
        past = [F.col(f"_lag_{spec.phase_period * d}") for d in range(1, spec.phase_count + 1)]
        mean = S.row_mean(past)
        low, high = (F.least(*past), F.greatest(*past)) if len(past) > 1 else (past[0], past[0])
        for stat, column in (("mean", mean), ("std", S.row_std(past, mean)), ("min", low), ("max", high)):
            out[f"{p}_{spec.phase_name}_{stat}_{spec.phase_suffix}"] = column
    made: dict[str, Column] = {}
    for n, a, b in spec.sums:
        made[n] = F.col(a) + F.col(b)
    for n, a, b in spec.ratios:
        made[n] = S.safe_ratio(made.get(a, F.col(a)), made.get(b, F.col(b)))
    for n, a, b in spec.products:
        made[n] = F.col(a) * F.col(b)
    out.update(made)
    for m in spec.lead_measures:
        for h in spec.leads:
            out[f"{f}_{m}_{h}"] = F.col(f"_lead_{m}_{h}")
    for n, m in spec.lead_deltas:
        for h in spec.leads:
            out[f"{f}_{n}_{h}"] = F.col(f"_lead_{m}_{h}") - F.col(m)
    for n, m in spec.angles:
        out[f"{n}_sin"], out[f"{n}_cos"] = S.on_circle(F.col(m), 360.0)
        for h in spec.leads:
            out[f"{f}_{n}_sin_{h}"], out[f"{f}_{n}_cos_{h}"] = S.on_circle(F.col(f"_lead_{m}_{h}"), 360.0)
    for h in spec.horizons:
        out[spec.change_target_name(h)] = F.col(spec.level_target_name(h)) - v
    return out


def build_features(
    df: DataFrame,
    spec: FeatureSpec,
    ks: SeriesKeys,
    start: datetime | None = None,
    end: datetime | None = None,
    chunk_steps: int | None = None,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """Measures on the regular grid, every feature of ``spec`` and its targets, in that order.

    With ``start``/``end`` only that span is returned and only the rows its frames reach are read. ``bounds`` as in ``chunk_grid``.
    """
    df = restrict_with_halo(df, ks, start, end, spec.back, spec.ahead)
    grid = chunk_grid(df, ks, list(spec.measures), spec.back, spec.ahead, chunk_steps, bounds)
    passes = _ordered_columns(spec, grid.window)
    wide = passes.over(grid.df)
    if start is not None:
        wide = wide.where(F.col(ks.time) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        wide = wide.where(F.col(ks.time) <= F.lit(end).cast("timestamp_ntz"))
    row = _row_columns(spec, ks.time, passes.row)
    targets = [n for h in spec.horizons for n in (spec.level_target_name(h), spec.change_target_name(h))]
    names = [*spec.features, *targets]
    return wide.select(*ks.columns, *[row[n].alias(n) if n in row else F.col(n) for n in names])


def training_table(features: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Rows on which every feature and target is known and finite."""
    from tsengine.operators.clean import complete_cases

    return complete_cases(features, [*spec.features, *spec.level_targets, *spec.change_targets])
