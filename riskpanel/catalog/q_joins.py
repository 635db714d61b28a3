"""Joins (2.3)."""

from pyspark.sql import functions as F

from riskpanel import config as C
from riskpanel.catalog.base import CASES_AS_OF, EVENTS_AS_OF, EVENTS_AS_OF_TS, minus, register
from riskpanel.catalog.sqlparts import calendar
from riskpanel.operators import aggregates as A
from riskpanel.operators import joins as J
from riskpanel.operators import predicates as P

Y1 = minus(CASES_AS_OF, 365)


@register("cases_with_district", "J1", """
SELECT c.*, d.district_name, d.region, d.population FROM cases c JOIN districts d USING (district_code)""")
def q_cases_with_district(t):
    """Every case with its district's name, region and population."""
    return J.cases_with_district(t.cases, t.districts)


@register("calendar_left_join", "J2", f"""
WITH cal_ AS ({calendar(Y1, CASES_AS_OF)}),
daily_ AS (SELECT district_code, case_date AS date, count(*) AS cases_count FROM cases
           WHERE case_date BETWEEN DATE '{Y1}' AND DATE '{CASES_AS_OF}' GROUP BY ALL)
SELECT cal_.district_code, cal_.date, daily_.cases_count, k.rainfall_mm, k.temperature_celsius,
       k.humidity_percent, w.water_area_sqkm, w.flood_risk_score
FROM cal_ LEFT JOIN daily_ USING (district_code, date)
LEFT JOIN (SELECT district_code, date, avg(rainfall_mm) AS rainfall_mm, avg(temperature_celsius) AS temperature_celsius,
                  avg(humidity_percent) AS humidity_percent FROM climate_data
           WHERE date BETWEEN DATE '{Y1}' AND DATE '{CASES_AS_OF}' GROUP BY ALL) k USING (district_code, date)
LEFT JOIN (SELECT district_code, date, avg(water_area_sqkm) AS water_area_sqkm, avg(flood_risk_score) AS flood_risk_score
           FROM water_extent WHERE date BETWEEN DATE '{Y1}' AND DATE '{CASES_AS_OF}' GROUP BY ALL) w
USING (district_code, date)""",
          ["rainfall_mm", "temperature_celsius", "humidity_percent", "water_area_sqkm", "flood_risk_score"])
def q_calendar_left_join(t):
    """Calendar of every district left-joined to daily cases, climate and water
    (each side one row per district-day; no fill)."""
    from riskpanel.plans.panel import CLIMATE_MEASURES, WATER_MEASURES, one_per_day
    cal = J.calendar_cross(t.districts, Y1, CASES_AS_OF)
    daily = A.daily_cases(t.cases, Y1, CASES_AS_OF)
    clim = one_per_day(t.climate, CLIMATE_MEASURES, Y1, CASES_AS_OF)
    wat = one_per_day(t.water, WATER_MEASURES, Y1, CASES_AS_OF)
    return J.calendar_left_join(cal, daily, clim, wat)


@register("regressor_left_join", "J3", f"""
WITH cal_ AS ({calendar(Y1, CASES_AS_OF)}),
daily_ AS (SELECT district_code, case_date AS date, count(*) AS cases_count FROM cases
           WHERE case_date BETWEEN DATE '{Y1}' AND DATE '{CASES_AS_OF}' GROUP BY ALL),
s_ AS (SELECT district_code, date, coalesce(cases_count, 0) AS y FROM cal_ LEFT JOIN daily_ USING (district_code, date)),
j_ AS (SELECT s_.*, k.rainfall_mm FROM s_ LEFT JOIN
       (SELECT district_code, date, avg(rainfall_mm) AS rainfall_mm FROM climate_data
        WHERE rainfall_mm IS NOT NULL AND date BETWEEN DATE '{Y1}' AND DATE '{CASES_AS_OF}' GROUP BY ALL) k
       USING (district_code, date))
SELECT district_code, date, y,
       coalesce(rainfall_mm, avg(rainfall_mm) OVER (PARTITION BY district_code)) AS rainfall_mm FROM j_""",
          ["rainfall_mm"])
def q_regressor_left_join(t):
    """Daily series (ds, y) with rainfall as regressor, gaps filled with the district mean."""
    cal = J.calendar_cross(t.districts, Y1, CASES_AS_OF)
    s = J.calendar_left_join(cal, A.daily_cases(t.cases, Y1, CASES_AS_OF)) \
        .select("district_code", "date", F.coalesce("cases_count", F.lit(0)).alias("y"))
    climate = P.filter_date_range(t.climate, "date", Y1, CASES_AS_OF)
    return J.regressor_left_join(s, climate, "rainfall_mm")


@register("suppress_existing", "J4", f"""
SELECT p.* FROM risk_predictions p
WHERE p.prediction_date >= DATE '{minus(EVENTS_AS_OF, 7)}' AND p.model_name = 'Ensemble'
AND NOT EXISTS (SELECT 1 FROM alerts a WHERE a.district_code = p.district_code
  AND a.prediction_horizon_weeks = p.prediction_horizon_weeks AND a.status = 'active'
  AND a.triggered_at >= TIMESTAMP '{minus(EVENTS_AS_OF_TS, 7)}')""")
def q_suppress_existing(t):
    """Recent Ensemble predictions with no active alert for the same district and
    horizon in the last 7 days."""
    recent = P.trailing_days(t.predictions, "prediction_date", EVENTS_AS_OF, 7) \
        .filter(F.col("model_name") == C.ENSEMBLE)
    since = P.trailing_since(EVENTS_AS_OF_TS, 7, "timestamp")
    return J.suppress_existing(recent, t.alerts, since)


@register("orphans", "J5", """
SELECT c.* FROM cases c WHERE c.facility_code IS NOT NULL
AND NOT EXISTS (SELECT 1 FROM health_facilities f WHERE f.facility_code = c.facility_code)""")
def q_orphans(t):
    """Cases whose facility code has no facility (foreign-key check)."""
    return J.orphans(t.cases, t.facilities, "facility_code", "facility_code")


@register("existing_keys", "J6", """
SELECT DISTINCT district_code FROM risk_predictions p
WHERE EXISTS (SELECT 1 FROM districts d WHERE d.district_code = p.district_code)""")
def q_existing_keys(t):
    """Which district codes used by predictions exist as districts."""
    return J.existing_keys(P.list_keys(t.predictions), t.districts)


@register("calendar_cross", "J7", calendar(Y1, CASES_AS_OF))
def q_calendar_cross(t):
    """Every district x every day of the look-back (no cross join: explode(sequence))."""
    return J.calendar_cross(t.districts, Y1, CASES_AS_OF)


@register("facility_cases", "J8", """
WITH n_ AS (SELECT facility_code, count(*) AS n_cases FROM cases GROUP BY 1)
SELECT f.facility_code, f.facility_name, f.district_code, d.district_name,
       coalesce(n_.n_cases, 0) AS n_cases
FROM health_facilities f LEFT JOIN districts d USING (district_code) LEFT JOIN n_ USING (facility_code)""")
def q_facility_cases(t):
    """Each facility with its district and number of cases."""
    return J.facility_cases(t.facilities, t.cases, t.districts)


@register("district_rollup", "J9", """
SELECT d.district_code, d.district_name, d.region,
  coalesce((SELECT count(*) FROM health_facilities x WHERE x.district_code = d.district_code), 0) AS n_facilities,
  coalesce((SELECT count(*) FROM cases x WHERE x.district_code = d.district_code), 0) AS n_cases,
  coalesce((SELECT count(*) FROM climate_data x WHERE x.district_code = d.district_code), 0) AS n_climate,
  coalesce((SELECT count(*) FROM water_extent x WHERE x.district_code = d.district_code), 0) AS n_water,
  coalesce((SELECT count(*) FROM risk_predictions x WHERE x.district_code = d.district_code), 0) AS n_predictions,
  coalesce((SELECT count(*) FROM alerts x WHERE x.district_code = d.district_code), 0) AS n_alerts
FROM districts d""")
def q_district_rollup(t):
    """Every district with counts of all its related tables (pre-aggregated sides)."""
    return J.district_rollup(t.districts, t.facilities, t.cases, t.climate, t.water,
                             t.predictions, t.alerts)


@register("risk_map_layer", "J10", """
WITH p_ AS (SELECT district_code, prediction_date, risk_score,
       row_number() OVER (PARTITION BY district_code ORDER BY prediction_date DESC, id DESC) AS rn
       FROM risk_predictions WHERE prediction_horizon_weeks = 8 AND model_name = 'Ensemble')
SELECT d.district_code, d.district_name, d.region, d.geometry, p_.prediction_date, p_.risk_score
FROM districts d LEFT JOIN (SELECT * FROM p_ WHERE rn = 1) p_ USING (district_code)""")
def q_risk_map_layer(t):
    """Every district with its latest Ensemble prediction for horizon 8."""
    return J.risk_map_layer(t.districts, t.predictions, 8, C.ENSEMBLE)
