"""The engine's entry points in one place, named after the application's
services (SURVEY 2.13). Every function takes DataFrames and an explicit
``as_of`` where time matters, and covers all districts unless a district is
given."""

from riskpanel.functions.scalar import severity, thresholds  # noqa: F401
from riskpanel.operators.aggregates import (  # noqa: F401
    daily_cases, national_daily_cases, risk_histogram, avg_recent_risk, completeness, fit_metrics)
from riskpanel.operators.forecast import arima_111_forecast, seasonal_trend_forecast  # noqa: F401
from riskpanel.operators.learn import boosted_forecast, sequence_forecast, model_runs  # noqa: F401
from riskpanel.operators.predicates import (  # noqa: F401
    active_alerts, district_alerts, filter_alerts_view, filter_predictions_view, list_keys, lookup_one,
    page, recent_predictions, top_recent_risk)
from riskpanel.operators.quality import (  # noqa: F401
    panel_gate, quality_report, validate_cases, validate_climate, validate_districts,
    validate_predictions)
from riskpanel.operators.state import (  # noqa: F401
    acknowledge, generate_alerts, resolve, retain, unknown_ids, upsert)
from riskpanel.plans.jobs import TrainingRequest, daily_job, predict_and_alert, weekly_training  # noqa: F401
from riskpanel.plans.panel import case_series, time_series, training_panel  # noqa: F401
from riskpanel.plans.predictions import predict as ensemble_predictions  # noqa: F401
from riskpanel.plans.reports import (  # noqa: F401
    alert_statistics, dashboard_summary, district_statistics, national_statistics, summary_cards)
from riskpanel.sources.bindings import bind  # noqa: F401
from riskpanel.sources.files import (  # noqa: F401
    create_tables, drop_tables, import_csv, ingest_json, read_cases_csv, read_climate_csv,
    read_districts_csv, read_districts_geojson, read_facilities_csv, read_water_csv, scan_table,
    write_metrics)
