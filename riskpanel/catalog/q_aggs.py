"""Aggregations (2.4) and composed statistics."""

from pyspark.sql import functions as F

from riskpanel import config as C
from riskpanel.catalog.base import CASES_AS_OF, EVENTS_AS_OF_TS, minus, register
from riskpanel.catalog.sqlparts import calendar
from riskpanel.operators import aggregates as A
from riskpanel.plans import reports as R
from riskpanel.plans.panel import raw_panel, training_panel

R30 = minus(CASES_AS_OF, 30)
R30_TS = minus(EVENTS_AS_OF_TS, 30)
Y1 = minus(CASES_AS_OF, 365)


@register("daily_cases", "A1", """
SELECT district_code, case_date AS date, count(*) AS cases_count FROM cases GROUP BY ALL""")
def q_daily_cases(t):
    """Cases per district and day over the whole line list."""
    return A.daily_cases(t.cases)


@register("cases_timeline", "A1", f"""
SELECT case_date AS date, count(*) AS cases_count FROM cases
WHERE case_date >= DATE '{R30}' GROUP BY ALL""")
def q_cases_timeline(t):
    """National cases per day, last 30 days (the dashboard timeline)."""
    return A.national_daily_cases(t.cases, CASES_AS_OF, 30)


@register("total_count", "A2", "SELECT count(*) AS total FROM cases")
def q_total_count(t):
    """Row count of the line list."""
    return A.total_count(t.cases)


@register("status_counts", "A3", """
SELECT count(*) AS total_alerts, count_if(status = 'active') AS active_alerts,
       count_if(status = 'acknowledged') AS acknowledged_alerts,
       count_if(status = 'resolved') AS resolved_alerts FROM alerts""")
def q_status_counts(t):
    """Alerts in total and per status, one pass."""
    return A.status_counts(t.alerts)


@register("severity_counts", "A4", """
SELECT s.severity, count(a.id) AS n_alerts
FROM (VALUES ('low'), ('medium'), ('high'), ('critical')) s(severity)
LEFT JOIN alerts a ON a.severity = s.severity AND a.status = 'active'
GROUP BY s.severity""")
def q_severity_counts(t):
    """Active alerts per severity, zero-filled over the four levels."""
    return A.severity_counts(t.alerts)


@register("recent_count", "A5", f"""
SELECT count_if(case_date >= DATE '{R30}') AS recent FROM cases""")
def q_recent_count(t):
    """Cases of the last 30 days (no upper bound, as in the application)."""
    return A.recent_count(t.cases, "case_date", CASES_AS_OF, 30)


@register("recent_climate_avg", "A6", f"""
SELECT district_code, coalesce(avg(rainfall_mm), 0.0) AS avg_rainfall_30d,
       coalesce(avg(temperature_celsius), 0.0) AS avg_temperature_30d, coalesce(avg(humidity_percent), 0.0) AS avg_humidity_30d
FROM climate_data WHERE date >= DATE '{R30}' GROUP BY district_code""",
          ["avg_rainfall_30d", "avg_temperature_30d", "avg_humidity_30d"])
def q_recent_climate_avg(t):
    """Mean rainfall, temperature, humidity of the last 30 days per district."""
    return A.recent_climate_avg(t.climate, CASES_AS_OF, 30)


@register("cases_by_region", "A7", f"""
SELECT d.region, count(*) AS case_count FROM cases c JOIN districts d USING (district_code)
WHERE c.case_date >= DATE '{R30}' GROUP BY d.region""")
def q_cases_by_region(t):
    """Recent cases per region."""
    return A.cases_by_region(t.cases, t.districts, CASES_AS_OF, 30)


@register("district_name_counts", "A8", f"""
SELECT d.district_name, count(*) AS case_count FROM cases c JOIN districts d USING (district_code)
WHERE c.case_date >= DATE '{R30}' GROUP BY d.district_name""")
def q_district_name_counts(t):
    """Recent cases per district name."""
    return A.district_name_counts(t.cases, t.districts, CASES_AS_OF, 30)


@register("date_extent", "A9", """
SELECT district_code, min(date) AS start_date, max(date) AS end_date FROM climate_data
GROUP BY district_code""")
def q_date_extent(t):
    """First and last climate date per district."""
    return A.date_extent(t.climate, "date")


@register("case_quality_stats", "A10", """
SELECT district_code, count(*) AS total_cases, count_if(lab_confirmed) AS lab_confirmed_cases,
       min(case_date) AS start_date, max(case_date) AS end_date FROM cases GROUP BY district_code""")
def q_case_quality_stats(t):
    """Cases, lab-confirmed cases and date range per district."""
    return A.case_quality_stats(t.cases)


@register("climate_quality_stats", "A11", """
SELECT district_code, count(*) AS total_records, avg(rainfall_mm) AS avg_rainfall,
       avg(temperature_celsius) AS avg_temperature, avg(humidity_percent) AS avg_humidity,
       min(date) AS start_date, max(date) AS end_date FROM climate_data GROUP BY district_code""",
          ["avg_rainfall", "avg_temperature", "avg_humidity"])
def q_climate_quality_stats(t):
    """Climate records, means and date range per district."""
    return A.climate_quality_stats(t.climate)


@register("prediction_quality_stats", "A12", """
SELECT district_code, count(*) AS total_predictions, avg(risk_score) AS avg_risk_score,
       min(prediction_date) AS start_date, max(prediction_date) AS end_date
FROM risk_predictions GROUP BY district_code""", ["avg_risk_score"])
def q_prediction_quality_stats(t):
    """Predictions, mean score and date range per district."""
    return A.prediction_quality_stats(t.predictions)


@register("model_distribution", "A13", """
SELECT district_code, model_name, count(*) AS n_predictions FROM risk_predictions GROUP BY ALL""")
def q_model_distribution(t):
    """Predictions per model name per district."""
    return A.model_distribution(t.predictions)


@register("completeness", "A14", f"""
WITH cal_ AS ({calendar(Y1, CASES_AS_OF)}),
daily_ AS (SELECT district_code, case_date AS date, count(*) AS cases_count FROM cases
           WHERE case_date BETWEEN DATE '{Y1}' AND DATE '{CASES_AS_OF}' GROUP BY ALL),
clim_ AS (SELECT district_code, date, avg(rainfall_mm) AS rainfall_mm,
                 avg(temperature_celsius) AS temperature_celsius FROM climate_data
          WHERE date BETWEEN DATE '{Y1}' AND DATE '{CASES_AS_OF}' GROUP BY ALL),
j_ AS (SELECT * FROM cal_ LEFT JOIN daily_ USING (district_code, date)
       LEFT JOIN clim_ USING (district_code, date))
SELECT district_code, count(*) AS n_rows,
       avg(CAST(date IS NOT NULL AS DOUBLE)) AS date_completeness,
       avg(CAST(cases_count IS NOT NULL AS DOUBLE)) AS cases_count_completeness,
       avg(CAST(rainfall_mm IS NOT NULL AS DOUBLE)) AS rainfall_mm_completeness,
       avg(CAST(temperature_celsius IS NOT NULL AS DOUBLE)) AS temperature_celsius_completeness,
       least(avg(CAST(date IS NOT NULL AS DOUBLE)), avg(CAST(cases_count IS NOT NULL AS DOUBLE)),
             avg(CAST(rainfall_mm IS NOT NULL AS DOUBLE)),
             avg(CAST(temperature_celsius IS NOT NULL AS DOUBLE))) AS min_completeness
FROM j_ GROUP BY district_code""",
          ["date_completeness", "cases_count_completeness", "rainfall_mm_completeness",
           "temperature_celsius_completeness", "min_completeness"])
def q_completeness(t):
    """Share of non-null gate columns per district on the calendar before filling."""
    return A.completeness(raw_panel(t.cases, t.climate, t.districts, CASES_AS_OF), C.GATE_COLUMNS)


@register("risk_histogram", "A15", """
SELECT CAST(least(floor(risk_score / 5.0::DOUBLE), 19) AS INTEGER) AS bin, count(*) AS n_predictions,
       0.0::DOUBLE + CAST(least(floor(risk_score / 5.0::DOUBLE), 19) AS INTEGER) * 5.0::DOUBLE AS bin_start,
       0.0::DOUBLE + CAST(least(floor(risk_score / 5.0::DOUBLE), 19) AS INTEGER) * 5.0::DOUBLE
         + 5.0::DOUBLE AS bin_end
FROM risk_predictions WHERE model_name = 'Ensemble' AND risk_score IS NOT NULL GROUP BY ALL""",
          ["bin_start", "bin_end"])
def q_risk_histogram(t):
    """Histogram of Ensemble scores in 20 bins of width 5."""
    return A.risk_histogram(t.predictions)


@register("avg_recent_risk", "A16", """
WITH top_ AS (SELECT risk_score FROM risk_predictions ORDER BY prediction_date DESC, id DESC LIMIT 10)
SELECT coalesce(avg(CASE WHEN risk_score <> 0 THEN risk_score END), 0.0) AS avg_risk_score FROM top_""",
          ["avg_risk_score"])
def q_avg_recent_risk(t):
    """Mean non-zero score of the ten latest predictions."""
    return A.avg_recent_risk(t.predictions)


@register("ensemble_mean", "A17", """
SELECT district_code, prediction_horizon_weeks, avg(risk_score) AS ensemble_score,
       count(risk_score) AS n_models
FROM risk_predictions WHERE model_name <> 'Ensemble' GROUP BY ALL""", ["ensemble_score"])
def q_ensemble_mean(t):
    """Mean of the four model scores per district and horizon."""
    base = t.predictions.filter(F.col("model_name") != C.ENSEMBLE)
    return A.ensemble_mean(base)


from riskpanel.catalog.sqlparts import panel_sql  # noqa: E402

FIT_SQL = f"""
WITH s_ AS (SELECT district_code, CAST(cases_count AS DOUBLE) AS y, CAST(cases_lag_7 AS DOUBLE) AS yhat,
                   row_number() OVER (PARTITION BY district_code ORDER BY date) AS rn_,
                   count(*) OVER (PARTITION BY district_code) AS n_ FROM ({panel_sql()}) p_),
t_ AS (SELECT * FROM s_ WHERE rn_ > floor(0.8 * n_) AND yhat IS NOT NULL),
g_ AS (SELECT district_code, avg(abs(y - yhat)) AS mae, avg((y - yhat) * (y - yhat)) AS mse,
              sum((y - yhat) * (y - yhat)) AS sse, avg(y) AS ybar, sum(y * y) AS syy, count(y) AS n
       FROM t_ GROUP BY 1)
SELECT district_code, mae, mse, n,
  1.0 - sse / CASE WHEN syy - n * ybar * ybar > 1e-12 THEN syy - n * ybar * ybar END AS r2 FROM g_"""


@register("fit_metrics", "A18", FIT_SQL, ["mae", "mse", "r2"])
def q_fit_metrics(t):
    """MAE, MSE, R^2 per district of the seasonal-naive forecast (value a week
    before) over the panel's last 20 % of days."""
    from riskpanel.operators.windows import chrono_split
    p = chrono_split(training_panel(t.cases, t.climate, t.water, t.districts, CASES_AS_OF))
    test = p.filter(~F.col("is_train") & F.col("cases_lag_7").isNotNull())
    return A.fit_metrics(test.select("district_code", F.col("cases_count").cast("double").alias("y"),
                                     F.col("cases_lag_7").cast("double").alias("yhat")))


@register("district_statistics", "A19", f"""
WITH c_ AS (SELECT district_code, count(*) AS total_cases,
                   count_if(case_date >= DATE '{R30}') AS recent_cases_30d FROM cases GROUP BY ALL),
k_ AS (SELECT district_code, avg(rainfall_mm) AS r, avg(temperature_celsius) AS t,
              avg(humidity_percent) AS h FROM climate_data WHERE date >= DATE '{R30}' GROUP BY ALL)
SELECT d.district_code, d.district_name, d.region, d.population,
       coalesce(c_.total_cases, 0) AS total_cases, coalesce(c_.recent_cases_30d, 0) AS recent_cases_30d,
       coalesce(k_.r, 0.0) AS avg_rainfall_30d, coalesce(k_.t, 0.0) AS avg_temperature_30d,
       coalesce(k_.h, 0.0) AS avg_humidity_30d
FROM districts d LEFT JOIN c_ USING (district_code) LEFT JOIN k_ USING (district_code)""",
          ["avg_rainfall_30d", "avg_temperature_30d", "avg_humidity_30d"])
def q_district_statistics(t):
    """Statistics card of every district in one job."""
    return R.district_statistics(t.districts, t.cases, t.climate, CASES_AS_OF)


@register("national_statistics", "A20", f"""
WITH rc_ AS (SELECT c.*, d.region, d.district_name FROM cases c JOIN districts d USING (district_code)
             WHERE c.case_date >= DATE '{R30}'),
nm_ AS (SELECT district_name, count(*) AS c FROM rc_ GROUP BY 1)
SELECT 'total_districts' AS metric, CAST(NULL AS VARCHAR) AS label, count(*) AS value,
       CAST(NULL AS INTEGER) AS rank FROM districts
UNION ALL SELECT 'total_cases', NULL, count(*), NULL FROM cases
UNION ALL SELECT 'recent_cases_30d', NULL, count_if(case_date >= DATE '{R30}'), NULL FROM cases
UNION ALL SELECT 'cases_by_region', region, count(*), NULL FROM rc_ GROUP BY region
UNION ALL SELECT * FROM (SELECT 'top_affected_districts', district_name, c,
       CAST(row_number() OVER (ORDER BY c DESC, district_name) AS INTEGER) FROM nm_
       ORDER BY c DESC, district_name LIMIT 10)""")
def q_national_statistics(t):
    """National totals, recent cases by region and the ten most affected districts."""
    return R.national_statistics(t.districts, t.cases, CASES_AS_OF)


@register("alert_statistics", "A21", f"""
SELECT count(*) AS total_alerts, count_if(status = 'active') AS active_alerts,
       count_if(status = 'acknowledged') AS acknowledged_alerts,
       count_if(status = 'resolved') AS resolved_alerts,
       count_if(status = 'active' AND severity = 'low') AS low_active,
       count_if(status = 'active' AND severity = 'medium') AS medium_active,
       count_if(status = 'active' AND severity = 'high') AS high_active,
       count_if(status = 'active' AND severity = 'critical') AS critical_active,
       count_if(triggered_at >= TIMESTAMP '{R30_TS}') AS recent_alerts_30d FROM alerts""")
def q_alert_statistics(t):
    """Alert counts by status, active by severity and of the last 30 days."""
    return R.alert_statistics(t.alerts, EVENTS_AS_OF_TS, 30)


DASH_SQL = """
WITH top_ AS (SELECT *, CAST(row_number() OVER (ORDER BY prediction_date DESC, id DESC) AS INTEGER) AS rn_
              FROM risk_predictions QUALIFY rn_ <= 10),
cards_ AS (
SELECT 'total_districts' AS metric, CAST(count(*) AS DOUBLE) AS value FROM districts
UNION ALL SELECT 'total_cases', CAST(count(*) AS DOUBLE) FROM cases
UNION ALL SELECT 'active_alerts', CAST(count_if(status = 'active') AS DOUBLE) FROM alerts
UNION ALL SELECT 'avg_risk_score', coalesce(avg(CASE WHEN risk_score <> 0 THEN risk_score END), 0.0)
FROM top_)
SELECT metric, CAST(NULL AS INTEGER) AS rank, CAST(NULL AS VARCHAR) AS label, value FROM cards_
UNION ALL SELECT 'recent_prediction', rn_, concat_ws('|', district_code, CAST(prediction_horizon_weeks AS VARCHAR),
       model_name, CAST(prediction_date AS VARCHAR)), risk_score FROM top_"""


@register("dashboard_summary", "A22", DASH_SQL, ["value"])
def q_dashboard_summary(t):
    """Dashboard cards (districts, cases, active alerts, mean recent risk) and the ten latest predictions."""
    return R.dashboard_summary(t.districts, t.cases, t.alerts, t.predictions)
