"""Joins. No side is forced: the planner broadcasts a side only within its size
threshold, and AQE re-plans on the sizes found at run time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel.operators.predicates import trailing_days

def cases_with_district(cases: DataFrame, districts: DataFrame, as_of=None, days=None) -> DataFrame:
    """Inner equi-join of cases to their district (optionally trailing window)."""
    c = cases if as_of is None else trailing_days(cases, "case_date", as_of, days)
    d = districts.select("district_code", "district_name", "region", "population")
    return c.join(d, "district_code", "inner")


def calendar_cross(districts: DataFrame, start, end, key: str = "district_code") -> DataFrame:
    """Every district x every date start..end inclusive, without a cross join."""
    return districts.select(
        key, F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"),
                                  F.expr("INTERVAL 1 DAY"))).alias("date"))


def calendar_left_join(calendar: DataFrame, *sides: DataFrame,
                       keys=("district_code", "date")) -> DataFrame:
    """calendar left-join each side on (district_code, date)."""
    out = calendar
    for s in sides:
        out = out.join(s, list(keys), "left")
    return out


def regressor_left_join(series: DataFrame, regressor: DataFrame, column: str,
                        keys=("district_code", "date")) -> DataFrame:
    """series left-join regressor, then fill gaps with the district's mean. The
    regressor is reduced to one row per key (the mean of repeated readings), so
    it never multiplies rows."""
    from pyspark.sql import Window as W
    one = regressor.dropna(subset=[column]).groupBy(*keys).agg(F.avg(column).alias(column))
    j = series.join(one, list(keys), "left")
    w = W.partitionBy(keys[0])
    return j.withColumn(column, F.coalesce(F.col(column), F.avg(column).over(w)))


def suppress_existing(preds: DataFrame, alerts: DataFrame, since_ts,
                      keys=("district_code", "prediction_horizon_weeks")) -> DataFrame:
    """Predictions with no active alert for the same keys triggered since ``since_ts``.
    The alert side is reduced to distinct keys first (combined map-side), so
    many alerts of one district ship as one row per task."""
    live = alerts.filter((F.col("status") == "active") & (F.col("triggered_at") >= since_ts)) \
        .select(*keys).distinct()
    return preds.join(live, list(keys), "left_anti")


def orphans(child: DataFrame, parent: DataFrame, child_col: str, parent_col: str) -> DataFrame:
    """FK check: rows whose non-null key has no parent."""
    p = parent.select(F.col(parent_col).alias(child_col)).distinct()
    return child.filter(F.col(child_col).isNotNull()).join(p, child_col, "left_anti")


def existing_keys(keys: DataFrame, table: DataFrame, key: str = "district_code") -> DataFrame:
    """Which of the given keys exist in the table (table side reduced to distinct keys)."""
    return keys.join(table.select(key).distinct(), key, "left_semi")


def facility_cases(facilities: DataFrame, cases: DataFrame, districts: DataFrame) -> DataFrame:
    """Each facility with its district and its case count (pre-aggregated)."""
    per_fac = cases.groupBy("facility_code").agg(F.count(F.lit(1)).alias("n_cases"))
    d = districts.select("district_code", "district_name")
    return (facilities.select("facility_code", "facility_name", "district_code")
            .join(d, "district_code", "left")
            .join(per_fac, "facility_code", "left")
            .withColumn("n_cases", F.coalesce("n_cases", F.lit(0))))


def district_rollup(districts: DataFrame, facilities: DataFrame, cases: DataFrame,
                    climate: DataFrame, water: DataFrame, preds: DataFrame,
                    alerts: DataFrame) -> DataFrame:
    """District with counts of every related table: each side aggregated to one
    row per district first, so no many-to-many join happens."""
    def cnt(df, name):
        return df.groupBy("district_code").agg(F.count(F.lit(1)).alias(name))
    out = districts.select("district_code", "district_name", "region")
    for df, name in [(facilities, "n_facilities"), (cases, "n_cases"), (climate, "n_climate"),
                     (water, "n_water"), (preds, "n_predictions"), (alerts, "n_alerts")]:
        out = out.join(cnt(df, name), "district_code", "left")
    return out.fillna(0, subset=["n_facilities", "n_cases", "n_climate", "n_water",
                                 "n_predictions", "n_alerts"])


def risk_map_layer(districts: DataFrame, preds: DataFrame, horizon: int, model: str) -> DataFrame:
    """Each district with its latest prediction for the chosen horizon and model."""
    from riskpanel.operators.windows import latest_prediction
    p = latest_prediction(preds.filter((F.col("prediction_horizon_weeks") == horizon)
                                       & (F.col("model_name") == model)))
    return (districts.select("district_code", "district_name", "region", "geometry")
            .join(p.select("district_code", "prediction_date", "risk_score"), "district_code", "left"))
