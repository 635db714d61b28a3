"""Filters and projections (2.2)."""

from riskpanel import config as C
from riskpanel.catalog.base import CASES_AS_OF, DISTRICT, EVENTS_AS_OF, EVENTS_AS_OF_TS, minus, register
from riskpanel.operators import aggregates as A
from riskpanel.operators import predicates as P

CASE_COLS = "id, case_id, district_code, facility_code, case_date, age_group, gender, case_status, " \
            "lab_confirmed, outcome, created_at, updated_at"


@register("filter_district", "F1", f"SELECT * FROM cases WHERE district_code = '{DISTRICT}'")
def q_filter_district(t):
    """One district's cases (equality pushed into the scan)."""
    return P.filter_district(t.cases, DISTRICT)


@register("filter_optional", "F2", f"""
SELECT * FROM risk_predictions WHERE district_code = '{DISTRICT}' AND model_name = 'Ensemble'""")
def q_filter_optional(t):
    """Predictions filtered by the given (district, model) only; status not given."""
    return P.filter_optional(t.predictions, district_code=DISTRICT, model_name=C.ENSEMBLE, status=None)


@register("filter_optional_alerts", "F2", f"""
SELECT * FROM alerts WHERE district_code = '{DISTRICT}' AND status = 'active'""")
def q_filter_optional_alerts(t):
    """Alerts filtered by the given (district, status) only; severity not given."""
    return P.filter_optional(t.alerts, district_code=DISTRICT, status="active", severity=None)


@register("filter_date_range", "F3", f"""
SELECT * FROM climate_data WHERE date BETWEEN DATE '{minus(CASES_AS_OF, 90)}' AND DATE '{CASES_AS_OF}'
AND district_code = '{DISTRICT}'""", ["rainfall_mm", "temperature_celsius", "humidity_percent"])
def q_filter_date_range(t):
    """One district's climate in an inclusive 90-day range."""
    return P.filter_date_range(t.climate, "date", minus(CASES_AS_OF, 90), CASES_AS_OF,
                               district_code=DISTRICT)


@register("trailing_days", "F4", f"""
SELECT * FROM risk_predictions WHERE prediction_date >= DATE '{minus(EVENTS_AS_OF, 7)}'""")
def q_trailing_days(t):
    """Predictions of the last 7 days (no upper bound)."""
    return P.trailing_days(t.predictions, "prediction_date", EVENTS_AS_OF, 7)


@register("older_than", "F5", f"""
SELECT * FROM alerts WHERE triggered_at < TIMESTAMP '{minus(EVENTS_AS_OF_TS, 7)}'""")
def q_older_than(t):
    """Alerts triggered more than 7 days before as_of."""
    return P.older_than(t.alerts, "triggered_at", EVENTS_AS_OF_TS, 7, "timestamp")


@register("filter_in_set", "F6", "SELECT * FROM alerts WHERE status IN ('active', 'acknowledged')")
def q_filter_in_set(t):
    """Alerts whose status is in a set."""
    return P.filter_in_set(t.alerts, "status", C.RETENTION_ALERT_STATUSES)


@register("lookup_one", "F7", f"""
SELECT * FROM districts WHERE district_code = '{DISTRICT}' ORDER BY id LIMIT 1""")
def q_lookup_one(t):
    """First district with the code (empty = not found)."""
    return P.lookup_one(t.districts, "district_code", DISTRICT)


@register("project", "F8", "SELECT case_id, district_code, case_date, outcome FROM cases")
def q_project(t):
    """Column subset in a given order."""
    return P.project(t.cases, ["case_id", "district_code", "case_date", "outcome"])


@register("rename", "F9", """
SELECT district_code, case_date AS ds, count(*) AS y FROM cases GROUP BY ALL""")
def q_rename(t):
    """Daily cases renamed to the (ds, y) form of the seasonal model."""
    return P.rename(A.daily_cases(t.cases), {"date": "ds", "cases_count": "y"})


@register("drop_nulls", "F10", f"""
SELECT {CASE_COLS} FROM cases WHERE age_group IS NOT NULL AND gender IS NOT NULL
AND outcome IS NOT NULL AND facility_code IS NOT NULL AND case_status IS NOT NULL""")
def q_drop_nulls(t):
    """Cases with no null in any column."""
    return P.drop_nulls(t.cases)


@register("list_keys", "F11", "SELECT DISTINCT district_code FROM cases")
def q_list_keys(t):
    """Distinct district codes that have cases."""
    return P.list_keys(t.cases)


@register("filter_predictions_view", "F13", """
SELECT * FROM risk_predictions WHERE model_name = 'Ensemble' AND prediction_horizon_weeks = 8""")
def q_filter_predictions_view(t):
    """Dashboard selectors: district 'all', model Ensemble, horizon 8."""
    return P.filter_predictions_view(t.predictions, district="all", model=C.ENSEMBLE, horizon=8)


@register("filter_alerts_view", "F14", "SELECT * FROM alerts WHERE severity = 'high'")
def q_filter_alerts_view(t):
    """Dashboard selectors: severity high, district 'all'."""
    return P.filter_alerts_view(t.alerts, severity="high", district="all")
