"""Scalar functions (2.8) applied over the bound tables."""

from pyspark.sql import functions as F

from riskpanel import config as C
from riskpanel.catalog.base import register
from riskpanel.functions import scalar as X
from riskpanel.operators.windows import latest_prediction
from riskpanel.plans.reports import dashboard_summary, summary_cards


@register("calendar_parts", "X1", """
SELECT DISTINCT case_date AS date, isodow(case_date) - 1 AS day_of_week, month(case_date) AS month,
       year(case_date) AS year FROM cases""")
def q_calendar_parts(t):
    """Day of week (Monday 0), month and year of every case date."""
    d = t.cases.select(F.col("case_date").alias("date")).distinct()
    return d.select("date", *[c.alias(n) for n, c in X.calendar_parts("date").items()])


@register("season_flags", "X2", """
SELECT DISTINCT case_date AS date,
  CASE WHEN month(case_date) IN (3,4,5,9,10,11) THEN 1 ELSE 0 END AS is_rainy_season,
  CASE WHEN month(case_date) IN (12,1,2,6,7,8) THEN 1 ELSE 0 END AS is_dry_season FROM cases""")
def q_season_flags(t):
    """Rainy and dry season flags of every case date."""
    d = t.cases.select(F.col("case_date").alias("date")).distinct()
    return d.select("date", *[c.alias(n) for n, c in X.season_flags(F.month("date")).items()])


SEV_SQL = """CASE WHEN coalesce({s}, 0.0) >= {c} THEN 'critical' WHEN coalesce({s}, 0.0) >= {h} THEN 'high'
  WHEN coalesce({s}, 0.0) >= {m} THEN 'medium' ELSE 'low' END"""


def sev_sql(s, th=None):
    th = th or C.RISK_THRESHOLDS
    return SEV_SQL.format(s=s, c=th["critical"], h=th["high"], m=th["medium"])


@register("severity", "X3", f"SELECT id, risk_score, {sev_sql('risk_score')} AS severity FROM risk_predictions")
def q_severity(t):
    """Severity level of every prediction's score."""
    return t.predictions.select("id", "risk_score", X.severity("risk_score").alias("severity"))


TH = X.thresholds(critical=95.0, high=80.0)


@register("thresholds", "X4", f"SELECT id, risk_score, {sev_sql('risk_score', TH)} AS severity FROM risk_predictions")
def q_thresholds(t):
    """Severity with overridden thresholds (critical 95, high 80)."""
    return t.predictions.select("id", "risk_score", X.severity("risk_score", TH).alias("severity"))


@register("risk_band", "X5", """
SELECT id, risk_score, CASE WHEN risk_score > 75.0 THEN 'high' WHEN risk_score > 50.0 THEN 'medium'
  WHEN risk_score IS NOT NULL THEN 'low' END AS risk_band FROM risk_predictions""")
def q_risk_band(t):
    """Dashboard colour band of every prediction."""
    return t.predictions.select("id", "risk_score", X.risk_band("risk_score").alias("risk_band"))


@register("clamp", "X6", """
SELECT id, greatest(0.0, least(100.0, coalesce(confidence_interval_upper, 50.0))) AS clamped_upper
FROM risk_predictions""", ["clamped_upper"])
def q_clamp(t):
    """Upper interval bounds clamped into 0..100 (null -> 50 first)."""
    return t.predictions.select("id", X.clamp("confidence_interval_upper").alias("clamped_upper"))


@register("interval_20pct", "X7", """
SELECT id, floor(risk_score * 80.0::DOUBLE + 0.500001::DOUBLE) / 100.0::DOUBLE AS lower,
       floor(risk_score * 120.0::DOUBLE + 0.500001::DOUBLE) / 100.0::DOUBLE AS upper FROM risk_predictions""",
          ["lower", "upper"])
def q_interval_20pct(t):
    """0.8x and 1.2x of every score at 2 decimals, not clamped."""
    lo, hi = X.interval_bounds("risk_score")
    return t.predictions.select("id", lo.alias("lower"), hi.alias("upper"))


@register("fallback", "X8", """
WITH p_ AS (SELECT * EXCLUDE (rn_) FROM (SELECT district_code, risk_score, row_number() OVER (
  PARTITION BY district_code ORDER BY prediction_date DESC, id DESC) AS rn_ FROM risk_predictions
  WHERE model_name = 'ARIMA' AND prediction_horizon_weeks = 12) WHERE rn_ = 1)
SELECT d.district_code, coalesce(p_.risk_score, 50.0) AS score, p_.risk_score IS NULL AS fallback
FROM districts d LEFT JOIN p_ USING (district_code)""", ["score"])
def q_fallback(t):
    """Latest ARIMA horizon-12 score per district; none -> 50.0 with a flag."""
    p = latest_prediction(t.predictions.filter((F.col("model_name") == "ARIMA")
                                               & (F.col("prediction_horizon_weeks") == 12)))
    j = t.districts.select("district_code").join(p.select("district_code", "risk_score"), "district_code", "left")
    return j.select("district_code", X.fallback("risk_score").alias("score"),
                    X.fallback_flag("risk_score").alias("fallback"))


@register("null_to_zero", "X9", """
SELECT d.district_code, coalesce(w.area, 0) AS water_area_total FROM districts d
LEFT JOIN (SELECT district_code, sum(water_area_sqkm) AS area FROM water_extent GROUP BY 1) w USING (district_code)""",
          ["water_area_total"])
def q_null_to_zero(t):
    """Total water area per district; districts without water rows give 0."""
    w = t.water.groupBy("district_code").agg(F.sum("water_area_sqkm").alias("area"))
    j = t.districts.select("district_code").join(w, "district_code", "left")
    return j.select("district_code", X.null_to_zero("area").alias("water_area_total"))


@register("date_shift", "X10", """
SELECT id, prediction_date, CAST(prediction_date + INTERVAL (prediction_horizon_weeks * 7) DAY AS DATE) AS target_date,
       CAST(prediction_date - INTERVAL 7 DAY AS DATE) AS week_before FROM risk_predictions""")
def q_date_shift(t):
    """Target date (date + 7 x horizon) and the date a week before, per prediction."""
    return t.predictions.select("id", "prediction_date",
                                X.date_shift("prediction_date", weeks=F.col("prediction_horizon_weeks")).alias("target_date"),
                                X.date_shift("prediction_date", days=-7).alias("week_before"))


@register("to_date", "X11", "SELECT id, CAST(triggered_at AS DATE) AS triggered_date FROM alerts")
def q_to_date(t):
    """Alert time stamps as dates."""
    return t.alerts.select("id", X.to_date_col("triggered_at").alias("triggered_date"))


@register("features_json", "X12", """
SELECT id, CAST(json_extract(features_used, '$.rainfall_lag') AS INTEGER) AS rainfall_lag,
       CAST(json_extract(features_used, '$.temperature_lag') AS INTEGER) AS temperature_lag,
       CAST(json_extract(features_used, '$.cases_lag') AS INTEGER) AS cases_lag,
       CAST(json_extract(features_used, '$.water_extent_lag') AS INTEGER) AS water_extent_lag,
       features_used = '{"rainfall_lag":7,"temperature_lag":14,"cases_lag":21,"water_extent_lag":7}' AS is_default
FROM risk_predictions""")
def q_features_json(t):
    """features_used parsed as MAP<STRING,INT> and read back; compared with the default document."""
    m = X.features_map("features_used")
    return t.predictions.select("id", *[m.getItem(k).alias(k) for k in C.FEATURES_USED],
                                (F.col("features_used") == X.features_json()).alias("is_default"))


@register("alert_id", "X13", """
SELECT id, substr(sha256(concat_ws('|', district_code, CAST(prediction_date AS VARCHAR),
       CAST(prediction_horizon_weeks AS VARCHAR), model_name)), 1, 32) AS alert_key FROM risk_predictions""")
def q_alert_id(t):
    """Deterministic alert key: sha-256 of (district, date, horizon, model)."""
    return t.predictions.select("id", X.alert_id("district_code", "prediction_date",
                                                 "prediction_horizon_weeks", "model_name").alias("alert_key"))


@register("display_format", "X14", """
WITH top_ AS (SELECT risk_score FROM risk_predictions ORDER BY prediction_date DESC, id DESC LIMIT 10),
s_ AS (SELECT 'total_districts' AS metric, CAST(count(*) AS DOUBLE) AS value FROM districts
  UNION ALL SELECT 'total_cases', CAST(count(*) AS DOUBLE) FROM cases
  UNION ALL SELECT 'active_alerts', CAST(count_if(status = 'active') AS DOUBLE) FROM alerts
  UNION ALL SELECT 'avg_risk_score', coalesce(avg(CASE WHEN risk_score <> 0 THEN risk_score END), 0.0) FROM top_)
SELECT metric, CASE WHEN metric = 'avg_risk_score'
  THEN printf('%.1f', floor(value * 10.0::DOUBLE + 0.500001::DOUBLE) / 10.0::DOUBLE)
  ELSE format('{:,.0f}', value) END AS text FROM s_""")
def q_display_format(t):
    """Dashboard card texts: thousands separators and one-decimal score."""
    return summary_cards(dashboard_summary(t.districts, t.cases, t.alerts, t.predictions))


@register("iso_text", "X15", """
SELECT id, CAST(prediction_date AS VARCHAR) AS date_text, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS stamp_text
FROM risk_predictions""")
def q_iso_text(t):
    """Prediction date as ISO text and creation stamp as 'yyyy-MM-dd HH:mm:ss'."""
    return t.predictions.select("id", X.iso_text("prediction_date").alias("date_text"),
                                X.display_stamp("created_at").alias("stamp_text"))
