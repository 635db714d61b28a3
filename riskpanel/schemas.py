"""Table schemas of the engine.

Measures are held as DOUBLE inside the engine (the forecasting and rolling
arithmetic is floating point anyway); the declared storage precision of each
column is kept in ``DECLARED`` and enforced by the ``dq_fits_type`` rule and by
``conform`` at the sinks, instead of by the column type.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, B, DT, TS = (T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(),
                         T.BooleanType(), T.DateType(), T.TimestampNTZType())


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


DISTRICTS = _st(("id", L), ("district_code", S), ("district_name", S), ("region", S),
                ("population", I), ("geometry", S), ("created_at", TS), ("updated_at", TS))
FACILITIES = _st(("id", L), ("facility_code", S), ("facility_name", S), ("district_code", S),
                 ("facility_type", S), ("latitude", D), ("longitude", D), ("geometry", S),
                 ("created_at", TS), ("updated_at", TS))
CASES = _st(("id", L), ("case_id", S), ("district_code", S), ("facility_code", S),
            ("case_date", DT), ("age_group", S), ("gender", S), ("case_status", S),
            ("lab_confirmed", B), ("outcome", S), ("created_at", TS), ("updated_at", TS))
CLIMATE = _st(("id", L), ("district_code", S), ("date", DT), ("rainfall_mm", D),
              ("temperature_celsius", D), ("humidity_percent", D), ("data_source", S),
              ("created_at", TS), ("updated_at", TS))
WATER = _st(("id", L), ("district_code", S), ("date", DT), ("water_area_sqkm", D),
            ("flood_risk_score", D), ("data_source", S), ("created_at", TS), ("updated_at", TS))
PREDICTIONS = _st(("id", L), ("district_code", S), ("prediction_date", DT),
                  ("prediction_horizon_weeks", I), ("risk_score", D),
                  ("confidence_interval_lower", D), ("confidence_interval_upper", D),
                  ("model_name", S), ("model_version", S), ("features_used", S),
                  ("created_at", TS), ("updated_at", TS))
ALERTS = _st(("id", L), ("alert_id", S), ("district_code", S), ("alert_type", S),
             ("severity", S), ("risk_score", D), ("prediction_horizon_weeks", I),
             ("triggered_at", TS), ("acknowledged_at", TS), ("acknowledged_by", S),
             ("status", S), ("created_at", TS), ("updated_at", TS))
MODEL_RUNS = _st(("run_id", S), ("district_code", S), ("model_name", S), ("as_of", DT),
                 ("params", T.MapType(S, S)), ("metrics", T.MapType(S, D)))

TABLES = {
    "districts": DISTRICTS,
    "health_facilities": FACILITIES,
    "cases": CASES,
    "climate_data": CLIMATE,
    "water_extent": WATER,
    "risk_predictions": PREDICTIONS,
    "alerts": ALERTS,
}

# Unique keys (besides the surrogate id) of each table.
KEYS = {
    "districts": ["district_code"],
    "health_facilities": ["facility_code"],
    "cases": ["case_id"],
    "climate_data": ["district_code", "date"],
    "water_extent": ["district_code", "date"],
    "risk_predictions": ["district_code", "prediction_date", "prediction_horizon_weeks", "model_name"],
    "alerts": ["alert_id"],
}

# Columns that may not be null.
REQUIRED = {
    "districts": ["district_code", "district_name"],
    "health_facilities": ["facility_code", "facility_name"],
    "cases": ["case_id", "case_date"],
    "climate_data": ["date"],
    "water_extent": ["date"],
    "risk_predictions": ["prediction_date", "prediction_horizon_weeks"],
    "alerts": ["alert_id"],
}

# Foreign keys: (child table, child column, parent table, parent column).
FOREIGN_KEYS = [
    ("health_facilities", "district_code", "districts", "district_code"),
    ("cases", "district_code", "districts", "district_code"),
    ("cases", "facility_code", "health_facilities", "facility_code"),
    ("climate_data", "district_code", "districts", "district_code"),
    ("water_extent", "district_code", "districts", "district_code"),
    ("risk_predictions", "district_code", "districts", "district_code"),
    ("alerts", "district_code", "districts", "district_code"),
]

# Declared storage types: ("string", length) or ("decimal", precision, scale).
DECLARED = {
    "districts": {"district_code": ("string", 20), "district_name": ("string", 100),
                  "region": ("string", 50)},
    "health_facilities": {"facility_code": ("string", 50), "facility_name": ("string", 200),
                          "district_code": ("string", 20), "facility_type": ("string", 50),
                          "latitude": ("decimal", 10, 8), "longitude": ("decimal", 11, 8)},
    "cases": {"case_id": ("string", 50), "district_code": ("string", 20),
              "facility_code": ("string", 50), "age_group": ("string", 20),
              "gender": ("string", 10), "case_status": ("string", 20), "outcome": ("string", 20)},
    "climate_data": {"district_code": ("string", 20), "rainfall_mm": ("decimal", 8, 2),
                     "temperature_celsius": ("decimal", 5, 2), "humidity_percent": ("decimal", 5, 2),
                     "data_source": ("string", 50)},
    "water_extent": {"district_code": ("string", 20), "water_area_sqkm": ("decimal", 12, 4),
                     "flood_risk_score": ("decimal", 5, 2), "data_source": ("string", 50)},
    "risk_predictions": {"district_code": ("string", 20), "risk_score": ("decimal", 5, 2),
                         "confidence_interval_lower": ("decimal", 5, 2),
                         "confidence_interval_upper": ("decimal", 5, 2),
                         "model_name": ("string", 50), "model_version": ("string", 20)},
    "alerts": {"alert_id": ("string", 50), "district_code": ("string", 20),
               "alert_type": ("string", 50), "severity": ("string", 20),
               "risk_score": ("decimal", 5, 2), "acknowledged_by": ("string", 100),
               "status": ("string", 20)},
}

# Record shapes accepted on ingest (API create records): field -> (type, required, default).
CREATE_RECORDS = {
    "districts": [("district_code", S, True, None), ("district_name", S, True, None),
                  ("region", S, False, None), ("population", I, False, None)],
    "health_facilities": [("facility_code", S, True, None), ("facility_name", S, True, None),
                          ("district_code", S, True, None), ("facility_type", S, False, None),
                          ("latitude", D, False, None), ("longitude", D, False, None)],
    "cases": [("case_id", S, True, None), ("district_code", S, True, None),
              ("facility_code", S, False, None), ("case_date", DT, True, None),
              ("age_group", S, False, None), ("gender", S, False, None),
              ("case_status", S, False, None), ("lab_confirmed", B, False, False),
              ("outcome", S, False, None)],
    "climate_data": [("district_code", S, True, None), ("date", DT, True, None),
                     ("rainfall_mm", D, False, None), ("temperature_celsius", D, False, None),
                     ("humidity_percent", D, False, None), ("data_source", S, False, None)],
    "water_extent": [("district_code", S, True, None), ("date", DT, True, None),
                     ("water_area_sqkm", D, False, None), ("flood_risk_score", D, False, None),
                     ("data_source", S, False, None)],
    "risk_predictions": [("district_code", S, True, None), ("prediction_date", DT, True, None),
                         ("prediction_horizon_weeks", I, True, None), ("risk_score", D, False, None),
                         ("confidence_interval_lower", D, False, None),
                         ("confidence_interval_upper", D, False, None),
                         ("model_name", S, True, None), ("model_version", S, False, None),
                         ("features_used", S, False, None)],
    "alerts": [("alert_id", S, True, None), ("district_code", S, True, None),
               ("alert_type", S, True, None), ("severity", S, True, None),
               ("risk_score", D, False, None), ("prediction_horizon_weeks", I, False, None),
               ("status", S, False, "active")],
}


def record_schema(table: str) -> T.StructType:
    """Struct type of a create record (all fields nullable for PERMISSIVE parsing)."""
    return _st(*[(n, t) for n, t, _, _ in CREATE_RECORDS[table]])


def response_columns(table: str) -> list[str]:
    """Columns of a read (response) shape: id, the record fields, audit stamps."""
    return ["id"] + [n for n, _, _, _ in CREATE_RECORDS[table]] + ["created_at", "updated_at"]
