"""Scalar Column functions (no Python UDFs)."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskpanel import config as C

__all__ = [
    "r4", "to_col", "severity", "risk_band", "clamp", "fallback", "fallback_flag",
    "interval_bounds", "calendar_parts", "season_flags", "null_to_zero", "date_shift",
    "to_date_col", "features_json", "features_map", "alert_id", "display_count",
    "display_score", "display_stamp", "iso_text", "code", "thresholds", "ntz_lit", "date_lit",
]


def ntz_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal from a datetime, date or ISO text. Built from
    text, so neither the Python process's zone nor the session zone moves it."""
    import datetime as _dt
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        value = value.isoformat() + " 00:00:00"
    return F.lit(str(value)).cast("timestamp_ntz")


def date_lit(value) -> Column:
    """A DATE literal from a date or ISO text."""
    import datetime as _dt
    if isinstance(value, _dt.datetime):
        value = value.date()
    return F.lit(value.isoformat() if isinstance(value, _dt.date) else str(value)).cast("date")


def to_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def r4(c) -> Column:
    """Round to 4 decimals half-up in a way both Spark and DuckDB agree on.

    ``round`` differs between engines at binary halfway ties, so this floors
    ``x*1e4 + 0.500001`` instead; use it on every computed double output.
    """
    return F.floor(to_col(c) * F.lit(1e4) + F.lit(0.500001)) / F.lit(1e4)


def code(prefix: str, c, width: int | None = None) -> Column:
    """Text key such as ``D007`` or ``C123`` from a number."""
    if width:
        return F.format_string(f"{prefix}%0{width}d", to_col(c))
    return F.concat(F.lit(prefix), to_col(c).cast("string"))


def thresholds(**overrides) -> dict:
    """Alert thresholds with some overridden (the reference's update/read back)."""
    out = dict(C.RISK_THRESHOLDS)
    out.update({k: float(v) for k, v in overrides.items()})
    return out


def severity(score, th: dict | None = None) -> Column:
    """critical >= 90, high >= 75, medium >= 50, else low; a null score counts as 0."""
    th = th or C.RISK_THRESHOLDS
    s = F.coalesce(to_col(score).cast("double"), F.lit(0.0))
    return (F.when(s >= F.lit(th["critical"]), "critical")
            .when(s >= F.lit(th["high"]), "high")
            .when(s >= F.lit(th["medium"]), "medium")
            .otherwise("low"))


def risk_band(score) -> Column:
    """Dashboard band: > 75 high, (50, 75] medium, <= 50 low (null stays null)."""
    s = to_col(score)
    return (F.when(s > F.lit(C.RISK_BAND_HIGH), "high")
            .when(s > F.lit(C.RISK_BAND_MEDIUM), "medium")
            .when(s.isNotNull(), "low"))


def fallback(pred, default: float = C.DEFAULT_SCORE) -> Column:
    """A model that produced nothing scores the default (50.0)."""
    p = to_col(pred).cast("double")
    return F.when(p.isNull() | F.isnan(p), F.lit(default)).otherwise(p)


def fallback_flag(pred) -> Column:
    p = to_col(pred).cast("double")
    return p.isNull() | F.isnan(p)


def clamp(pred, lo: float = 0.0, hi: float = 100.0) -> Column:
    """Fallback first (greatest/least skip nulls), then clamp into lo..hi."""
    return F.greatest(F.lit(lo), F.least(F.lit(hi), fallback(pred)))


def interval_bounds(score) -> tuple[Column, Column]:
    """0.8x and 1.2x of the score, rounded half-up to 2 decimals (DECIMAL(5,2) storage).

    Not clamped: scores over 83.33 give an upper bound over 100 on purpose.
    """
    s = to_col(score).cast("double")
    lo = F.floor(s * F.lit(C.CI_LOWER_FACTOR * 100) + F.lit(0.500001)) / F.lit(100.0)
    hi = F.floor(s * F.lit(C.CI_UPPER_FACTOR * 100) + F.lit(0.500001)) / F.lit(100.0)
    return lo, hi


def calendar_parts(d) -> dict[str, Column]:
    """day_of_week with Monday = 0 (``weekday``, not ``dayofweek``), month, year."""
    d = to_col(d)
    return {"day_of_week": F.weekday(d), "month": F.month(d), "year": F.year(d)}


def season_flags(month) -> dict[str, Column]:
    m = to_col(month)
    return {"is_rainy_season": m.isin(C.RAINY_MONTHS).cast("int"),
            "is_dry_season": m.isin(C.DRY_MONTHS).cast("int")}


def null_to_zero(c) -> Column:
    return F.coalesce(to_col(c), F.lit(0))


def date_shift(d, days=0, weeks=0) -> Column:
    """Date plus days and weeks (weeks x 7); negative values go back."""
    total = to_col(days) if isinstance(days, Column) else F.lit(int(days))
    if isinstance(weeks, Column):
        total = total + weeks * F.lit(7)
    elif weeks:
        total = total + F.lit(int(weeks) * 7)
    return F.date_add(to_col(d), total)


def to_date_col(c) -> Column:
    """Text or timestamp to DATE."""
    return F.to_date(to_col(c))


def features_json(features: dict | None = None) -> Column:
    """The features_used document as JSON text."""
    return F.lit(json.dumps(features or C.FEATURES_USED, separators=(",", ":")))


def features_map(c) -> Column:
    """Read features_used back as MAP<STRING,INT>."""
    return F.from_json(to_col(c), "map<string,int>")


def alert_id(*keys) -> Column:
    """Deterministic id of 32 characters: the first half of the SHA-256 of the
    key columns, so re-runs agree (the declared width is 50)."""
    return F.substring(F.sha2(F.concat_ws("|", *[to_col(k).cast("string") for k in keys]), 256), 1, 32)


def display_count(c) -> Column:
    """Thousands separators, no decimals: 12,345."""
    return F.format_number(to_col(c).cast("double"), 0)


def display_score(c) -> Column:
    """One decimal, half-up: 57.5. Rounded before formatting so no binary tie
    reaches the formatter."""
    return F.format_string("%.1f", F.floor(to_col(c) * F.lit(10.0) + F.lit(0.500001)) / F.lit(10.0))


def display_stamp(c) -> Column:
    return F.date_format(to_col(c), "yyyy-MM-dd HH:mm:ss")


def iso_text(c) -> Column:
    """Date or timestamp as ISO text."""
    return to_col(c).cast("string")
