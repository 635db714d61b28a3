"""Filters, projections, sorts, limits and pages (all pushed down by Catalyst).

Trailing windows follow the application: ``d >= as_of - n`` with **no upper
bound**. Every ordering ends in the surrogate ``id`` so results are stable.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel import config as C


def _lit_date(d):
    return F.lit(d).cast("date") if isinstance(d, (str, _dt.date)) else d


def filter_district(df: DataFrame, district_code: str, column: str = "district_code") -> DataFrame:
    """Equality on the district (pushed into the parquet scan)."""
    return df.filter(F.col(column) == F.lit(district_code))


def filter_optional(df: DataFrame, **equalities) -> DataFrame:
    """Conjunction of only the filters that are given (None = not given)."""
    conds = [F.col(k) == F.lit(v) for k, v in equalities.items() if v is not None]
    return df.filter(reduce(lambda a, b: a & b, conds)) if conds else df


def filter_date_range(df: DataFrame, column: str, start, end, **equalities) -> DataFrame:
    """start <= column <= end (both inclusive), plus optional equalities."""
    out = df.filter(F.col(column).between(_lit_date(start), _lit_date(end)))
    return filter_optional(out, **equalities)


def trailing_since(as_of, days: int, column_type: str = "date"):
    """The lower bound as_of - days as a literal of the column's type."""
    if isinstance(as_of, str):
        as_of = (_dt.datetime.fromisoformat(as_of) if (" " in as_of or "T" in as_of)
                 else _dt.date.fromisoformat(as_of))
    if column_type == "timestamp" and not isinstance(as_of, _dt.datetime):
        as_of = _dt.datetime.combine(as_of, _dt.time())
    bound = as_of - _dt.timedelta(days=days)
    from riskpanel.functions.scalar import date_lit, ntz_lit
    return ntz_lit(bound) if column_type == "timestamp" else date_lit(bound)


def trailing_days(df: DataFrame, column: str, as_of, days: int, column_type: str = "date") -> DataFrame:
    """column >= as_of - days; the application sets no upper bound."""
    return df.filter(F.col(column) >= trailing_since(as_of, days, column_type))


def older_than(df: DataFrame, column: str, as_of, days: int, column_type: str = "date") -> DataFrame:
    """column < as_of - days."""
    return df.filter(F.col(column) < trailing_since(as_of, days, column_type))


def filter_in_set(df: DataFrame, column: str, values) -> DataFrame:
    return df.filter(F.col(column).isin(list(values)))


def lookup_one(df: DataFrame, key: str, value, order: str = "id") -> DataFrame:
    """First row by key (lowest id); an empty frame means not found."""
    return df.filter(F.col(key) == F.lit(value)).orderBy(order).limit(1)


def project(df: DataFrame, columns) -> DataFrame:
    return df.select(*columns)


def rename(df: DataFrame, mapping: dict) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def drop_nulls(df: DataFrame, subset=None) -> DataFrame:
    return df.dropna(how="any", subset=subset)


def list_keys(df: DataFrame, key: str = "district_code") -> DataFrame:
    return df.select(key).distinct()


def model_features(df: DataFrame, exclude=("date", "cases_count")) -> list[str]:
    """All columns but the date and the target, in order (schema only, no job)."""
    return [c for c in df.columns if c not in exclude]


def filter_view(df: DataFrame, **selectors) -> DataFrame:
    """Dashboard selectors: a value filters, 'all' or None does not."""
    return filter_optional(df, **{k: (None if v in (None, "all") else v) for k, v in selectors.items()})


def filter_predictions_view(preds: DataFrame, district=None, model=None, horizon=None) -> DataFrame:
    return filter_view(preds, district_code=district, model_name=model, prediction_horizon_weeks=horizon)


def filter_alerts_view(alerts: DataFrame, severity=None, district=None) -> DataFrame:
    return filter_view(alerts, severity=severity, district_code=district)


# ---- sorts, limits, pages -------------------------------------------------

def page(df: DataFrame, skip: int = 0, limit: int = C.PAGE_SIZE, order=("id",)) -> DataFrame:
    """offset/limit over a stable order (the application pages without one)."""
    return df.orderBy(*order).offset(skip).limit(limit)


def recent_predictions(preds: DataFrame, n: int = C.RECENT_PREDICTIONS) -> DataFrame:
    """n latest by prediction date (TakeOrderedAndProject, no global sort)."""
    return preds.orderBy(F.col("prediction_date").desc(), F.col("id").desc()).limit(n)


def top_recent_risk(preds: DataFrame, as_of, days: int = C.ALERT_WINDOW_DAYS,
                    n: int = C.TOP_RECENT_RISK) -> DataFrame:
    """Last ``days`` days, newest date first, then highest score; top n."""
    from riskpanel.functions.scalar import risk_band
    recent = trailing_days(preds, "prediction_date", as_of, days)
    return (recent.orderBy(F.col("prediction_date").desc(), F.col("risk_score").desc(), F.col("id"))
            .limit(n)
            .select("id", "district_code", "prediction_date", "prediction_horizon_weeks",
                    "risk_score", "model_name", "confidence_interval_lower",
                    "confidence_interval_upper", risk_band("risk_score").alias("risk_band")))


def active_alerts(alerts: DataFrame, district_code: str | None = None) -> DataFrame:
    """Active alerts, optionally one district, newest first; null score -> 0."""
    out = filter_optional(alerts.filter(F.col("status") == "active"), district_code=district_code)
    return (out.orderBy(F.col("triggered_at").desc(), F.col("id"))
            .select("id", "alert_id", "district_code", "alert_type", "severity",
                    F.coalesce("risk_score", F.lit(0.0)).alias("risk_score"),
                    "prediction_horizon_weeks", "triggered_at", "status"))


def district_alerts(alerts: DataFrame, district_code: str, as_of_ts, days: int = C.RECENT_DAYS) -> DataFrame:
    """One district's alerts of the last ``days`` days, newest first."""
    out = trailing_days(filter_district(alerts, district_code), "triggered_at", as_of_ts, days, "timestamp")
    return (out.orderBy(F.col("triggered_at").desc(), F.col("id"))
            .select("id", "alert_id", "alert_type", "severity",
                    F.coalesce("risk_score", F.lit(0.0)).alias("risk_score"),
                    "prediction_horizon_weeks", "triggered_at", "acknowledged_at",
                    "acknowledged_by", "status"))


def ordered_series(df: DataFrame, order=("district_code", "date")) -> DataFrame:
    """Sort only at the sink."""
    return df.orderBy(*order)
