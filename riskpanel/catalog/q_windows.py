"""Window operators (2.5) and the panels built on them."""

from pyspark.sql import functions as F

from riskpanel import config as C
from riskpanel.catalog.base import CASES_AS_OF, EVENTS_AS_OF, register
from riskpanel.catalog.sqlparts import PANEL_DOUBLES, calendar, panel_sql
from riskpanel.plans.panel import time_series, training_panel


@register("training_panel", "P0", panel_sql(), PANEL_DOUBLES)
def q_training_panel(t):
    """Flagship: 366-day filled feature panel of every district."""
    return training_panel(t.cases, t.climate, t.water, t.districts, CASES_AS_OF)


@register("time_series", "P1", f"""
WITH cal_ AS ({calendar('2001-05-03', CASES_AS_OF)}),
daily_ AS (SELECT district_code, case_date AS date, count(*) AS cases_count FROM cases
           WHERE case_date BETWEEN DATE '2001-05-03' AND DATE '{CASES_AS_OF}' GROUP BY ALL),
clim_ AS (SELECT district_code, date, avg(rainfall_mm) AS rainfall_mm,
                 avg(temperature_celsius) AS temperature_celsius, avg(humidity_percent) AS humidity_percent
          FROM climate_data WHERE date BETWEEN DATE '2001-05-03' AND DATE '{CASES_AS_OF}' GROUP BY ALL)
SELECT c.district_code, c.date, coalesce(d.cases_count, 0) AS cases_count,
       coalesce(cl.rainfall_mm, 0.0) AS rainfall_mm,
       coalesce(cl.temperature_celsius, 0.0) AS temperature_celsius,
       coalesce(cl.humidity_percent, 0.0) AS humidity_percent
FROM cal_ c LEFT JOIN daily_ d USING (district_code, date) LEFT JOIN clim_ cl USING (district_code, date)
""", ["rainfall_mm", "temperature_celsius", "humidity_percent"])
def q_time_series(t):
    """90-day zero-filled series (cases + climate) of every district."""
    return time_series(t.cases, t.climate, t.districts, CASES_AS_OF, C.TIME_SERIES_DAYS)


# ---- the window operators on their own --------------------------------------

from riskpanel.operators import windows as Wn  # noqa: E402
from riskpanel.catalog.base import minus  # noqa: E402

T90 = minus(CASES_AS_OF, 90)
TS_SQL = f"""(WITH cal_ AS ({calendar(T90, CASES_AS_OF)}),
daily_ AS (SELECT district_code, case_date AS date, count(*) AS cases_count FROM cases
           WHERE case_date BETWEEN DATE '{T90}' AND DATE '{CASES_AS_OF}' GROUP BY ALL),
clim_ AS (SELECT district_code, date, avg(rainfall_mm) AS rainfall_mm,
                 avg(temperature_celsius) AS temperature_celsius, avg(humidity_percent) AS humidity_percent
          FROM climate_data WHERE date BETWEEN DATE '{T90}' AND DATE '{CASES_AS_OF}' GROUP BY ALL)
SELECT c.district_code, c.date, coalesce(d.cases_count, 0) AS cases_count,
       coalesce(cl.rainfall_mm, 0.0) AS rainfall_mm,
       coalesce(cl.temperature_celsius, 0.0) AS temperature_celsius,
       coalesce(cl.humidity_percent, 0.0) AS humidity_percent
FROM cal_ c LEFT JOIN daily_ d USING (district_code, date) LEFT JOIN clim_ cl USING (district_code, date))"""
PANEL_SQL = f"({panel_sql()})"
SRC3 = {"cases": "cases_count", "rainfall": "rainfall_mm", "temperature": "temperature_celsius"}
SRC4 = {"rainfall_mm": "rainfall_mm", "temperature_celsius": "temperature_celsius",
        "cases_count": "cases_count", "water_area_sqkm": "water_area_sqkm"}


def _ts(t):
    return time_series(t.cases, t.climate, t.districts, CASES_AS_OF, 90)


def _panel(t):
    return training_panel(t.cases, t.climate, t.water, t.districts, CASES_AS_OF)


def _lag_sql(src, lags):
    return ", ".join(f"lag({c}, {k}) OVER (PARTITION BY district_code ORDER BY date) AS {p}_lag_{k}"
                     for p, c in src.items() for k in lags)


def _roll_sql(src, ns, strict=False):
    out = []
    for p, c in src.items():
        for n in ns:
            w = f"OVER (PARTITION BY district_code ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
            e = f"avg({c}) {w}"
            if strict:
                e = f"CASE WHEN count({c}) {w} >= {n} THEN avg({c}) {w} END"
            out.append(f"{e} AS {p}_roll_{n}")
    return ", ".join(out)


@register("lags", "W1", f"""
SELECT district_code, date, {_lag_sql(SRC3, C.PANEL_LAGS)} FROM {TS_SQL} s_""",
          [f"{p}_lag_{k}" for p in ("rainfall", "temperature") for k in C.PANEL_LAGS])
def q_lags(t):
    """Lags 1, 7, 14, 21 of cases, rainfall, temperature on the 90-day series."""
    s = _ts(t)
    return s.select("district_code", "date", *[c.alias(n) for n, c in
                                               Wn.lag_columns(SRC3, C.PANEL_LAGS).items()])


@register("lags_model", "W2", f"""
SELECT district_code, date, {_lag_sql(SRC4, C.PANEL_LAGS)} FROM {PANEL_SQL} p_""",
          [f"{p}_lag_{k}" for p in ("rainfall_mm", "temperature_celsius", "water_area_sqkm")
           for k in C.PANEL_LAGS])
def q_lags_model(t):
    """Lags 1, 7, 14, 21 of rainfall, temperature, cases and water area on the panel."""
    p = _panel(t)
    return p.select("district_code", "date", *[c.alias(n) for n, c in
                                               Wn.lag_columns(SRC4, C.PANEL_LAGS).items()])


@register("rolling_mean", "W3", f"""
SELECT district_code, date, {_roll_sql(SRC3, C.PANEL_ROLLS)} FROM {TS_SQL} s_""",
          [f"{p}_roll_{n}" for p in SRC3 for n in C.PANEL_ROLLS])
def q_rolling_mean(t):
    """Means over 7, 14, 30 rows with min_periods=1 on the 90-day series."""
    s = _ts(t)
    return s.select("district_code", "date", *[c.alias(n) for n, c in
                                               Wn.rolling_columns(SRC3, C.PANEL_ROLLS).items()])


@register("rolling_mean_strict", "W4", f"""
SELECT district_code, date, {_roll_sql(SRC4, C.MODEL_ROLLS, True)} FROM {PANEL_SQL} p_""",
          [f"{p}_roll_{n}" for p in SRC4 for n in C.MODEL_ROLLS])
def q_rolling_mean_strict(t):
    """Means over 7 and 14 rows, null until the window is full, on the panel."""
    p = _panel(t)
    return p.select("district_code", "date", *[c.alias(n) for n, c in
                                               Wn.rolling_columns(SRC4, C.MODEL_ROLLS, strict=True).items()])


@register("mean_fill", "W5", f"""
WITH cal_ AS ({calendar(minus(CASES_AS_OF, 365), CASES_AS_OF)}),
j_ AS (SELECT cal_.district_code, cal_.date, k.rainfall_mm, k.temperature_celsius, k.humidity_percent
       FROM cal_ LEFT JOIN (
         SELECT district_code, date, avg(rainfall_mm) AS rainfall_mm, avg(temperature_celsius) AS temperature_celsius,
                avg(humidity_percent) AS humidity_percent FROM climate_data
         WHERE date BETWEEN DATE '{minus(CASES_AS_OF, 365)}' AND DATE '{CASES_AS_OF}' GROUP BY ALL) k
       USING (district_code, date))
SELECT district_code, date,
  coalesce(rainfall_mm, avg(rainfall_mm) OVER (PARTITION BY district_code)) AS rainfall_mm,
  coalesce(temperature_celsius, avg(temperature_celsius) OVER (PARTITION BY district_code)) AS temperature_celsius,
  coalesce(humidity_percent, avg(humidity_percent) OVER (PARTITION BY district_code)) AS humidity_percent
FROM j_""", ["rainfall_mm", "temperature_celsius", "humidity_percent"])
def q_mean_fill(t):
    """Calendar climate with gaps filled by the district's mean (all-null stays null)."""
    from riskpanel.operators.joins import calendar_cross, calendar_left_join
    from riskpanel.plans.panel import CLIMATE_MEASURES, one_per_day
    start = minus(CASES_AS_OF, 365)
    cal = calendar_cross(t.districts, start, CASES_AS_OF)
    j = calendar_left_join(cal, one_per_day(t.climate, CLIMATE_MEASURES, start, CASES_AS_OF))
    return Wn.mean_fill(j, ["rainfall_mm", "temperature_celsius", "humidity_percent"])


SEQ_FEATURES = ["rainfall_mm", "temperature_celsius", "cases_count", "water_area_sqkm"]
SEQ_COLS = [f"{f}_t{i}" for i in range(C.SEQUENCE_LENGTH) for f in SEQ_FEATURES]


def _seq_sql():
    n = C.SEQUENCE_LENGTH
    lags = ", ".join(
        f"coalesce(CAST(lag({f}, {n - i}) OVER w AS DOUBLE), 0.0) AS {f}_t{i}"
        for i in range(n) for f in SEQ_FEATURES)
    return (f"SELECT district_code, date, cases_count, {', '.join(SEQ_COLS)} FROM ("
            f"SELECT district_code, date, cases_count, {lags}, row_number() OVER w AS rn_ "
            f"FROM {PANEL_SQL} p_ WINDOW w AS (PARTITION BY district_code ORDER BY date)) WHERE rn_ > {n}")


@register("sequence_window", "W6", _seq_sql(), SEQ_COLS)
def q_sequence_window(t):
    """For each panel day after the 14th: the 14 previous days x 4 features
    (array of structs, nulls as 0), flattened oldest first into 56 columns."""
    p = _panel(t)
    s = Wn.sequence_window(p.select("district_code", "date", *SEQ_FEATURES), SEQ_FEATURES, C.SEQUENCE_LENGTH)
    flat = [F.col("seq")[i][f].alias(f"{f}_t{i}") for i in range(C.SEQUENCE_LENGTH) for f in SEQ_FEATURES]
    return s.select("district_code", "date", F.col("cases_count").cast("long").alias("cases_count"), *flat)


@register("chrono_split", "W7", f"""
SELECT district_code, date,
  row_number() OVER (PARTITION BY district_code ORDER BY date)
    <= floor(0.8 * count(*) OVER (PARTITION BY district_code)) AS is_train FROM {PANEL_SQL} p_""")
def q_chrono_split(t):
    """First 80 % of each district's panel days train, the rest test."""
    return Wn.chrono_split(_panel(t).select("district_code", "date"))


@register("last_row", "W8", f"""
SELECT * EXCLUDE (rn_) FROM (SELECT *, row_number() OVER (PARTITION BY district_code ORDER BY date DESC) AS rn_
               FROM {PANEL_SQL} p_) WHERE rn_ = 1""", PANEL_DOUBLES)
def q_last_row(t):
    """Latest panel row (feature vector) of each district."""
    return Wn.last_row(_panel(t))


@register("first_per_key", "W9", f"""
SELECT * EXCLUDE (rn_) FROM (SELECT *, row_number() OVER (PARTITION BY district_code,
  prediction_horizon_weeks ORDER BY id) AS rn_ FROM risk_predictions
  WHERE model_name = 'Ensemble' AND prediction_date >= DATE '{minus(EVENTS_AS_OF, 7)}') WHERE rn_ = 1""")
def q_first_per_key(t):
    """First recent Ensemble prediction (by id) per district and horizon."""
    from riskpanel.operators.predicates import trailing_days
    p = trailing_days(t.predictions, "prediction_date", EVENTS_AS_OF, 7).filter(F.col("model_name") == C.ENSEMBLE)
    return Wn.first_per_key(p, ["district_code", "prediction_horizon_weeks"])


@register("difference", "W10", f"""
SELECT district_code, date, cases_count,
  cases_count - lag(cases_count, 1) OVER (PARTITION BY district_code ORDER BY date) AS cases_count_diff
FROM {PANEL_SQL} p_""")
def q_difference(t):
    """First difference of daily cases on the panel."""
    return Wn.difference(_panel(t).select("district_code", "date", "cases_count"), "cases_count")


@register("latest_prediction", "W11", """
SELECT * EXCLUDE (rn_) FROM (SELECT *, row_number() OVER (PARTITION BY district_code, model_name,
  prediction_horizon_weeks ORDER BY prediction_date DESC, id DESC) AS rn_ FROM risk_predictions) WHERE rn_ = 1""")
def q_latest_prediction(t):
    """Latest prediction per district, model and horizon."""
    return Wn.latest_prediction(t.predictions)
