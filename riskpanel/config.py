"""Fixed values of the domain.

FIXED VALUES: these must equal the reference application's values for the
results to agree. They are stated once, here, in their natural order.
"""

# Alert thresholds on a 0..100 risk score (low is kept but never used to raise).
RISK_THRESHOLDS = {"low": 25.0, "medium": 50.0, "high": 75.0, "critical": 90.0}
SEVERITY_LEVELS = ["low", "medium", "high", "critical"]
ALERTING_SEVERITIES = ["medium", "high", "critical"]

# Dashboard colour bands: > 75, (50, 75], <= 50.
RISK_BAND_HIGH = 75.0
RISK_BAND_MEDIUM = 50.0

MODEL_NAMES = ["LSTM", "XGBoost", "Prophet", "ARIMA", "Ensemble"]
ENSEMBLE = "Ensemble"
MODEL_VERSION = "1.0"
ALERT_TYPE = "cholera_risk"
ALERT_STATUSES = ["active", "acknowledged", "resolved"]

# Value domains of the line list.
AGE_GROUPS = ["0-5", "6-17", "18-59", "60+"]
GENDERS = ["M", "F"]
OUTCOMES = ["recovered", "died", "ongoing"]

# Seasons by month number.
RAINY_MONTHS = [3, 4, 5, 9, 10, 11]
DRY_MONTHS = [12, 1, 2, 6, 7, 8]

# Feature engineering of the training panel.
PANEL_LAGS = [1, 7, 14, 21]
PANEL_ROLLS = [7, 14, 30]
MODEL_ROLLS = [7, 14]
SEQUENCE_LENGTH = 14
TRAIN_FRACTION = 0.8
LOOKBACK_DAYS = 365
TIME_SERIES_DAYS = 90
FEATURES_USED = {"rainfall_lag": 7, "temperature_lag": 14, "cases_lag": 21, "water_extent_lag": 7}

# Forecast defaults.
DEFAULT_SCORE = 50.0
DEFAULT_HORIZON_WEEKS = 8
CI_LOWER_FACTOR = 0.8
CI_UPPER_FACTOR = 1.2
MIN_DAYS = 30
MIN_COMPLETENESS = 0.5
GATE_COLUMNS = ["date", "cases_count", "rainfall_mm", "temperature_celsius"]
BOOST_TREES = 100
BOOST_DEPTH = 6
BOOST_RATE = 0.1
SEED = 42

# Data quality rules.
ROW_COUNT_RANGE = (1, 10000)
CLIMATE_RANGES = {
    "rainfall_mm": (0.0, 200.0),
    "temperature_celsius": (15.0, 40.0),
    "humidity_percent": (0.0, 100.0),
}
CLIMATE_MOSTLY = 0.95
PREDICTION_RANGES = {
    "prediction_horizon_weeks": (1, 24),
    "risk_score": (0.0, 100.0),
    "confidence_interval_lower": (0.0, 100.0),
    "confidence_interval_upper": (0.0, 100.0),
}
CASES_COLUMNS = ["id", "case_id", "district_code", "facility_code", "case_date",
                 "age_group", "gender", "case_status", "lab_confirmed", "outcome"]
CLIMATE_COLUMNS = ["id", "district_code", "date", "rainfall_mm",
                   "temperature_celsius", "humidity_percent", "data_source"]
PREDICTION_COLUMNS = ["id", "district_code", "prediction_date", "prediction_horizon_weeks",
                      "risk_score", "confidence_interval_lower", "confidence_interval_upper",
                      "model_name", "model_version", "features_used"]
AUDIT_COLUMNS = ["created_at", "updated_at"]

# Retention.
RETENTION_DAYS = 365
RETENTION_ALERT_STATUSES = ["active", "acknowledged"]

# Paging and report sizes.
PAGE_SIZE = 100
RECENT_PREDICTIONS = 10
TOP_DISTRICTS = 10
TOP_RECENT_RISK = 20
HISTOGRAM_BINS = 20
RECENT_DAYS = 30
ALERT_WINDOW_DAYS = 7
