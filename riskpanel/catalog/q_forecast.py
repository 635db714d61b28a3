"""Forecast queries (P2, P3, P6; P4, P5 rows-only)."""

import datetime as _dt

from riskpanel import config as C
from riskpanel.catalog.base import CASES_AS_OF, minus, register
from riskpanel.catalog.sqlparts import calendar
from riskpanel.functions.scalar import clamp, fallback_flag
from riskpanel.operators.forecast import arima_111_forecast, seasonal_trend_forecast
from riskpanel.plans.panel import training_panel
from riskpanel.plans.predictions import predict

H = C.DEFAULT_HORIZON_WEEKS
Y1 = minus(CASES_AS_OF, C.LOOKBACK_DAYS)
TARGET = _dt.date.fromisoformat(CASES_AS_OF) + _dt.timedelta(days=7 * H)

SERIES_SQL = f"""series_ AS (
  SELECT c.district_code, c.date, CAST(coalesce(d.n, 0) AS DOUBLE) AS y FROM ({calendar(Y1, CASES_AS_OF)}) c
  LEFT JOIN (SELECT district_code, case_date AS date, count(*) AS n FROM cases
             WHERE case_date BETWEEN DATE '{Y1}' AND DATE '{CASES_AS_OF}' GROUP BY ALL) d
  USING (district_code, date))"""


def _solve_sql(m, a, b, t1, t2, s11, s12, s22):
    det = f"nullif({s11} * {s22} - {s12} * {s12}, 0)"
    return f"({t1} * {s22} - {t2} * {s12}) / {det} AS {a}, ({t2} * {s11} - {t1} * {s12}) / {det} AS {b}"


def _clip_sql(c):
    return f"CASE WHEN {c} IS NOT NULL THEN greatest(-0.99, least(0.99, {c})) END"


ARIMA_RAW_SQL = f"""
WITH {SERIES_SQL},
s1_ AS (SELECT *, y - lag(y, 1) OVER (PARTITION BY district_code ORDER BY date) AS d FROM series_),
s2_ AS (SELECT *, lag(d, 1) OVER w AS x1, lag(d, 2) OVER w AS x2 FROM s1_
        WINDOW w AS (PARTITION BY district_code ORDER BY date)),
s3_ AS (SELECT *, (d IS NOT NULL AND x1 IS NOT NULL AND x2 IS NOT NULL) AS ok1 FROM s2_),
m1_ AS (SELECT district_code, sum(CASE WHEN ok1 THEN x1 * x1 END) AS s11, sum(CASE WHEN ok1 THEN x1 * x2 END) AS s12,
        sum(CASE WHEN ok1 THEN x2 * x2 END) AS s22, sum(CASE WHEN ok1 THEN d * x1 END) AS t1,
        sum(CASE WHEN ok1 THEN d * x2 END) AS t2 FROM s3_ GROUP BY 1),
c1_ AS (SELECT district_code, {_solve_sql('m1_', 'b1', 'b2', 't1', 't2', 's11', 's12', 's22')} FROM m1_),
s4_ AS (SELECT s3_.*, CASE WHEN ok1 THEN d - b1 * x1 - b2 * x2 END AS e FROM s3_ JOIN c1_ USING (district_code)),
s5_ AS (SELECT *, lag(e, 1) OVER (PARTITION BY district_code ORDER BY date) AS el FROM s4_),
s6_ AS (SELECT *, (d IS NOT NULL AND x1 IS NOT NULL AND el IS NOT NULL) AS ok2 FROM s5_),
m2_ AS (SELECT district_code, sum(CASE WHEN ok2 THEN x1 * x1 END) AS s11, sum(CASE WHEN ok2 THEN x1 * el END) AS s12,
        sum(CASE WHEN ok2 THEN el * el END) AS s22, sum(CASE WHEN ok2 THEN d * x1 END) AS t1,
        sum(CASE WHEN ok2 THEN d * el END) AS t2 FROM s6_ GROUP BY 1),
c2r_ AS (SELECT district_code, {_solve_sql('m2_', 'phi', 'theta', 't1', 't2', 's11', 's12', 's22')} FROM m2_),
c2_ AS (SELECT district_code, {_clip_sql('phi')} AS phi, {_clip_sql('theta')} AS theta FROM c2r_),
last_ AS (SELECT * FROM s6_ QUALIFY row_number() OVER (PARTITION BY district_code ORDER BY date DESC) = 1)
SELECT district_code, DATE '{CASES_AS_OF}' AS prediction_date, {H} AS prediction_horizon_weeks, 'ARIMA' AS model_name,
  y + (phi * d + theta * e) * (1.0 - power(phi, {7 * H}.0)) / (1.0 - phi) AS raw_score
FROM last_ JOIN c2_ USING (district_code)"""

TW, TM = TARGET.weekday(), TARGET.month
SEASONAL_RAW_SQL = f"""
WITH {SERIES_SQL},
s1_ AS (SELECT *, CAST(datediff('day', min(date) OVER (PARTITION BY district_code), date) AS DOUBLE) AS t,
        min(date) OVER (PARTITION BY district_code) AS d0 FROM series_),
c_ AS (SELECT district_code, regr_slope(y, t) AS b, regr_intercept(y, t) AS a, min(d0) AS d0 FROM s1_ GROUP BY 1),
s2_ AS (SELECT s1_.*, greatest(a + b * t, 1e-6) AS trend, isodow(date) - 1 AS wd, month(date) AS mo
        FROM s1_ JOIN c_ USING (district_code)),
wi_ AS (SELECT district_code, wd, sum(y) / nullif(sum(trend), 0) AS wi FROM s2_ GROUP BY ALL),
s3_ AS (SELECT s2_.*, wi FROM s2_ JOIN wi_ USING (district_code, wd)),
mi_ AS (SELECT district_code, mo, sum(y) / nullif(sum(trend * wi), 0) AS mi FROM s3_ GROUP BY ALL)
SELECT c_.district_code, DATE '{CASES_AS_OF}' AS prediction_date, {H} AS prediction_horizon_weeks,
  'Prophet' AS model_name,
  greatest(a + b * CAST(datediff('day', d0, DATE '{TARGET}') AS DOUBLE), 1e-6) * wi_.wi * mi_.mi AS raw_score
FROM c_ LEFT JOIN wi_ ON wi_.district_code = c_.district_code AND wi_.wd = {TW}
LEFT JOIN mi_ ON mi_.district_code = c_.district_code AND mi_.mo = {TM}"""


def _final_sql(raw_sql):
    return f"""SELECT *, greatest(0.0, least(100.0, coalesce(raw_score, 50.0))) AS risk_score,
  raw_score IS NULL AS fallback FROM ({raw_sql})"""


def _final(df):
    return df.withColumn("risk_score", clamp("raw_score")).withColumn("fallback", fallback_flag("raw_score"))


def _series(t):
    """The 366-day daily case series of every district (the panel's cases_count)."""
    from riskpanel.plans.panel import case_series
    return case_series(t.cases, t.districts, CASES_AS_OF)


@register("arima_111_forecast", "P3", _final_sql(ARIMA_RAW_SQL), ["raw_score", "risk_score"])
def q_arima(t):
    """ARIMA(1,1,1) (Hannan-Rissanen) 8 weeks ahead for every district, clamped, 50 on failure."""
    return _final(arima_111_forecast(_series(t), CASES_AS_OF, H))


@register("seasonal_trend_forecast", "P2", _final_sql(SEASONAL_RAW_SQL), ["raw_score", "risk_score"])
def q_seasonal(t):
    """Trend x weekday x month forecast 8 weeks ahead for every district, clamped, 50 on failure."""
    return _final(seasonal_trend_forecast(_series(t), CASES_AS_OF, H))


ENSEMBLE_SQL = f"""
WITH m_ AS (SELECT district_code, prediction_date, prediction_horizon_weeks, model_name,
              greatest(0.0, least(100.0, coalesce(raw_score, 50.0))) AS risk_score, raw_score IS NULL AS fallback
            FROM ({SEASONAL_RAW_SQL}) UNION ALL
            SELECT district_code, prediction_date, prediction_horizon_weeks, model_name,
              greatest(0.0, least(100.0, coalesce(raw_score, 50.0))), raw_score IS NULL FROM ({ARIMA_RAW_SQL})),
r_ AS (SELECT * FROM m_ UNION ALL
       SELECT district_code, prediction_date, prediction_horizon_weeks, 'Ensemble', avg(risk_score), false
       FROM m_ GROUP BY district_code, prediction_date, prediction_horizon_weeks)
SELECT district_code, prediction_date, prediction_horizon_weeks, risk_score,
  floor(risk_score * 80.0::DOUBLE + 0.500001::DOUBLE) / 100.0::DOUBLE AS confidence_interval_lower,
  floor(risk_score * 120.0::DOUBLE + 0.500001::DOUBLE) / 100.0::DOUBLE AS confidence_interval_upper,
  model_name, '1.0' AS model_version,
  '{{"rainfall_lag":7,"temperature_lag":14,"cases_lag":21,"water_extent_lag":7}}' AS features_used, fallback
FROM r_"""


Y15 = minus(CASES_AS_OF, 14)


@register("short_series_forecast", "P3", f"""
SELECT district_code, DATE '{CASES_AS_OF}' AS prediction_date, {H} AS prediction_horizon_weeks, m_.model_name,
  CAST(NULL AS DOUBLE) AS raw_score, 50.0 AS risk_score, true AS fallback
FROM districts CROSS JOIN (SELECT unnest(['ARIMA', 'Prophet']) AS model_name) m_""", ["raw_score", "risk_score"])
def q_short_series(t):
    """Both statistical models on the last 15 days only: fewer than 30 days score 50."""
    from riskpanel.operators.forecast import statistical_forecasts
    from riskpanel.plans.panel import case_series
    return _final(statistical_forecasts(case_series(t.cases, t.districts, CASES_AS_OF, days=14), CASES_AS_OF, H))


ARIMA_FIT_SQL = ARIMA_RAW_SQL[:ARIMA_RAW_SQL.index("last_ AS (")].rstrip().rstrip(",") + """
SELECT district_code, y, y - d + phi * x1 + theta * el AS yhat FROM s6_ JOIN c2_ USING (district_code) WHERE ok2"""
SEASONAL_FIT_SQL = SEASONAL_RAW_SQL[:SEASONAL_RAW_SQL.index("SELECT c_.district_code, DATE")] + """
SELECT s3_.district_code, y, trend * wi * mi AS yhat FROM s3_ JOIN mi_ USING (district_code, mo)"""
FIT_METRICS_SQL = f"""
SELECT 'ARIMA' AS model_name, district_code, avg(abs(y - yhat)) AS mae, avg((y - yhat) * (y - yhat)) AS mse
FROM ({ARIMA_FIT_SQL}) GROUP BY district_code
UNION ALL SELECT 'Prophet', district_code, avg(abs(y - yhat)), avg((y - yhat) * (y - yhat))
FROM ({SEASONAL_FIT_SQL}) GROUP BY district_code"""


@register("ensemble_predictions", "P6", ENSEMBLE_SQL,
          ["risk_score", "confidence_interval_lower", "confidence_interval_upper"])
def q_ensemble_predictions(t):
    """Prediction rows of the two statistical models and their Ensemble mean."""
    return predict(None, CASES_AS_OF, H, learned=False, series=_series(t))


def _panel(t):
    return training_panel(t.cases, t.climate, t.water, t.districts, CASES_AS_OF)


@register("boosted_forecast", "P4", None)
def q_boosted(t):
    """Gradient-boosted trees of every district (100 trees, depth 6, rate 0.1) on its
    panel features; score of each district's last day, clamped, 50 on failure."""
    from riskpanel.operators.learn import boosted_forecast
    return _final(boosted_forecast(_panel(t), CASES_AS_OF, H))


@register("sequence_forecast", "P5", None)
def q_sequence(t):
    """Pooled linear model on 14 days x 4 features; score of each district's last
    window, clamped, 50 where a district has no training window."""
    from riskpanel.operators.learn import sequence_forecast
    return _final(sequence_forecast(_panel(t), CASES_AS_OF, H))


@register("ensemble_predictions_full", "P6", None)
def q_ensemble_full(t):
    """Prediction rows of all four models and their Ensemble mean."""
    return predict(_panel(t), CASES_AS_OF, H, learned=True)
