"""The daily feature panel (flagship) and the plain time series.

Plan shape (all districts in one job):

  cases --filter(date range, pushed to scan)--> partial count --shuffle(district,date)--> daily
  districts --explode(sequence(start, as_of))--> calendar (districts x 366 rows)
  calendar LEFT JOIN daily LEFT JOIN climate LEFT JOIN water on (district_code, date)
  --> mean fill (Window partitionBy district) --> lags + rolling means (Window
  partitionBy district orderBy date) --> calendar parts, season flags

The heavy input (cases) is aggregated to one row per (district, day) before
any join, so a district holding a third of all cases still gives a 366-row
window partition; the panel's size is districts x days whatever the volume.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel import config as C
from riskpanel.functions.scalar import calendar_parts, season_flags
from riskpanel.operators.aggregates import daily_cases
from riskpanel.operators.joins import calendar_cross, calendar_left_join
from riskpanel.operators.predicates import filter_date_range
from riskpanel.operators.windows import lag_columns, mean_fill, rolling_columns

PANEL_MEASURES = ["rainfall_mm", "temperature_celsius", "humidity_percent", "water_area_sqkm"]
CLIMATE_MEASURES = ["rainfall_mm", "temperature_celsius", "humidity_percent"]
WATER_MEASURES = ["water_area_sqkm", "flood_risk_score"]


def _as_date(d):
    return d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d))


def _restrict(df: DataFrame, district_code, key="district_code"):
    if district_code is None:
        return df
    codes = [district_code] if isinstance(district_code, str) else list(district_code)
    return df.filter(F.col(key).isin(codes))


def one_per_day(df: DataFrame, columns, start, end, key: str = "district_code") -> DataFrame:
    """A measurement table in start..end reduced to one row per (district, day):
    the mean of repeated readings. The key is unique by declaration; reducing
    first (combined map-side) keeps repeated keys in two tables from
    multiplying in the calendar joins."""
    f = filter_date_range(df, "date", start, end)
    return f.groupBy(key, "date").agg(*[F.avg(c).alias(c) for c in columns])


def training_panel(cases: DataFrame, climate: DataFrame, water: DataFrame, districts: DataFrame,
                   as_of, days: int = C.LOOKBACK_DAYS, district_code=None) -> DataFrame:
    """Complete daily calendar per district (both ends inclusive: days+1 rows)
    with cases, climate and water, filled, plus lags, rolling means and season flags.

    Fill rule per column: cases and flood score -> 0; rainfall, temperature,
    humidity and water area -> the district's mean over the look-back (a column
    with no values at all stays null).
    """
    end = _as_date(as_of)
    start = end - _dt.timedelta(days=days)
    d = _restrict(districts, district_code)
    cal = calendar_cross(d, start, end)
    daily = daily_cases(_restrict(cases, district_code), start, end)
    clim = one_per_day(_restrict(climate, district_code), CLIMATE_MEASURES, start, end)
    wat = one_per_day(_restrict(water, district_code), WATER_MEASURES, start, end)

    panel = calendar_left_join(cal, daily, clim, wat)
    panel = panel.withColumns({
        "cases_count": F.coalesce(F.col("cases_count"), F.lit(0)).cast("long"),
        "flood_risk_score": F.coalesce(F.col("flood_risk_score"), F.lit(0.0)),
    })
    panel = mean_fill(panel, PANEL_MEASURES)

    parts = calendar_parts("date")
    feats = {}
    feats.update(parts)
    src = {"cases": "cases_count", "rainfall": "rainfall_mm", "temperature": "temperature_celsius"}
    feats.update(lag_columns(src, C.PANEL_LAGS))
    feats.update(rolling_columns(src, C.PANEL_ROLLS))
    panel = panel.withColumns(feats)
    panel = panel.withColumns(season_flags("month"))
    return panel.select(*PANEL_COLUMNS)


PANEL_COLUMNS = (
    ["district_code", "date", "cases_count", "rainfall_mm", "temperature_celsius",
     "humidity_percent", "water_area_sqkm", "flood_risk_score", "day_of_week", "month", "year"]
    + [f"{p}_lag_{k}" for k in C.PANEL_LAGS for p in ("cases", "rainfall", "temperature")]
    + [f"{p}_roll_{n}" for n in C.PANEL_ROLLS for p in ("cases", "rainfall", "temperature")]
    + ["is_rainy_season", "is_dry_season"]
)


def time_series(cases: DataFrame, climate: DataFrame, districts: DataFrame, as_of,
                days: int = C.TIME_SERIES_DAYS, district_code=None) -> DataFrame:
    """days+1 calendar rows per district with cases and climate, every gap -> 0."""
    end = _as_date(as_of)
    start = end - _dt.timedelta(days=days)
    d = _restrict(districts, district_code)
    cal = calendar_cross(d, start, end)
    daily = daily_cases(_restrict(cases, district_code), start, end)
    clim = one_per_day(_restrict(climate, district_code), CLIMATE_MEASURES, start, end)
    out = calendar_left_join(cal, daily, clim)
    return out.select(
        "district_code", "date",
        F.coalesce("cases_count", F.lit(0)).cast("long").alias("cases_count"),
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("rainfall_mm", "temperature_celsius",
                                                      "humidity_percent")])


def raw_panel(cases: DataFrame, climate: DataFrame, districts: DataFrame, as_of,
              days: int = C.LOOKBACK_DAYS) -> DataFrame:
    """Calendar joined to daily cases and climate *before* any fill (nulls kept)."""
    end = _as_date(as_of)
    start = end - _dt.timedelta(days=days)
    cal = calendar_cross(districts, start, end)
    daily = daily_cases(cases, start, end)
    clim = one_per_day(climate, CLIMATE_MEASURES, start, end)
    return calendar_left_join(cal, daily, clim)


def case_series(cases: DataFrame, districts: DataFrame, as_of, days: int = C.LOOKBACK_DAYS,
                district_code=None) -> DataFrame:
    """The panel's daily case series alone (``district_code, date, y``): the
    calendar joined to daily counts, gaps -> 0. Equal to the panel's
    ``cases_count`` without its climate, water and feature columns, for jobs
    that only forecast the counts."""
    end = _as_date(as_of)
    start = end - _dt.timedelta(days=days)
    cal = calendar_cross(_restrict(districts, district_code), start, end)
    daily = daily_cases(_restrict(cases, district_code), start, end)
    return calendar_left_join(cal, daily).select(
        "district_code", "date", F.coalesce("cases_count", F.lit(0)).cast("double").alias("y"))
