"""Shared DuckDB SQL fragments of the oracle queries."""

from riskpanel import config as C
from riskpanel.catalog.base import CASES_AS_OF


def calendar(start: str, end: str, source: str = "districts") -> str:
    return (f"SELECT district_code, CAST(unnest(generate_series(TIMESTAMP '{start}', "
            f"TIMESTAMP '{end}', INTERVAL 1 DAY)) AS DATE) AS date FROM {source}")


def panel_sql(as_of: str = CASES_AS_OF, start: str = "2000-08-01") -> str:
    """P0 in DuckDB: calendar, joins, fill, lags, rolling means, seasons."""
    lags = []
    for k in C.PANEL_LAGS:
        for p, c in (("cases", "cases_count"), ("rainfall", "rainfall_mm"),
                     ("temperature", "temperature_celsius")):
            lags.append(f"lag({c}, {k}) OVER w AS {p}_lag_{k}")
    rolls = []
    for n in C.PANEL_ROLLS:
        for p, c in (("cases", "cases_count"), ("rainfall", "rainfall_mm"),
                     ("temperature", "temperature_celsius")):
            rolls.append(f"avg({c}) OVER (PARTITION BY district_code ORDER BY date "
                         f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS {p}_roll_{n}")
    rainy = ",".join(map(str, C.RAINY_MONTHS))
    dry = ",".join(map(str, C.DRY_MONTHS))
    fill = ",\n".join(
        f"coalesce({c}, avg({c}) OVER (PARTITION BY district_code)) AS {c}"
        for c in ("rainfall_mm", "temperature_celsius", "humidity_percent", "water_area_sqkm"))
    return f"""
WITH cal_ AS ({calendar(start, as_of)}),
daily_ AS (SELECT district_code, case_date AS date, count(*) AS cases_count FROM cases
           WHERE case_date BETWEEN DATE '{start}' AND DATE '{as_of}' GROUP BY ALL),
clim_ AS (SELECT district_code, date, avg(rainfall_mm) AS rainfall_mm,
                 avg(temperature_celsius) AS temperature_celsius, avg(humidity_percent) AS humidity_percent
          FROM climate_data WHERE date BETWEEN DATE '{start}' AND DATE '{as_of}' GROUP BY ALL),
wat_ AS (SELECT district_code, date, avg(water_area_sqkm) AS water_area_sqkm,
                avg(flood_risk_score) AS flood_risk_score FROM water_extent
         WHERE date BETWEEN DATE '{start}' AND DATE '{as_of}' GROUP BY ALL),
j_ AS (SELECT c.district_code, c.date, coalesce(d.cases_count, 0) AS cases_count,
              cl.rainfall_mm, cl.temperature_celsius, cl.humidity_percent, w.water_area_sqkm,
              coalesce(w.flood_risk_score, 0.0) AS flood_risk_score
       FROM cal_ c LEFT JOIN daily_ d USING (district_code, date)
       LEFT JOIN clim_ cl USING (district_code, date) LEFT JOIN wat_ w USING (district_code, date)),
f_ AS (SELECT district_code, date, cases_count, {fill}, flood_risk_score FROM j_)
SELECT district_code, date, cases_count, rainfall_mm, temperature_celsius, humidity_percent,
       water_area_sqkm, flood_risk_score, isodow(date) - 1 AS day_of_week, month(date) AS month,
       year(date) AS year,
       {", ".join(lags)},
       {", ".join(rolls)},
       CASE WHEN month(date) IN ({rainy}) THEN 1 ELSE 0 END AS is_rainy_season,
       CASE WHEN month(date) IN ({dry}) THEN 1 ELSE 0 END AS is_dry_season
FROM f_ WINDOW w AS (PARTITION BY district_code ORDER BY date)
"""


PANEL_DOUBLES = (
    ["rainfall_mm", "temperature_celsius", "humidity_percent", "water_area_sqkm", "flood_risk_score"]
    + [f"{p}_lag_{k}" for k in C.PANEL_LAGS for p in ("rainfall", "temperature")]
    + [f"{p}_roll_{n}" for n in C.PANEL_ROLLS for p in ("cases", "rainfall", "temperature")]
)
