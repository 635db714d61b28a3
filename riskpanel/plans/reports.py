"""Composed statistics: district, national, alert and dashboard summaries.

All districts are computed in one job: each fact table is aggregated to one
row per district first (partial aggregation before the shuffle), then joined
to the district dimension. Single-row summaries are returned in long form
(metric, value) built by ``unionByName`` of one-row aggregates, never by
joining or collecting.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel import config as C
from riskpanel.operators.aggregates import (avg_recent_risk, recent_climate_avg,
                                            severity_counts, status_counts)
from riskpanel.operators.predicates import recent_predictions, trailing_since


def district_statistics(districts: DataFrame, cases: DataFrame, climate: DataFrame, as_of,
                        days: int = C.RECENT_DAYS, district_code: str | None = None) -> DataFrame:
    """One row per district: name, region, population, total and recent cases,
    recent climate means (null -> 0)."""
    if district_code is not None:
        districts = districts.filter(F.col("district_code") == district_code)
        cases = cases.filter(F.col("district_code") == district_code)
        climate = climate.filter(F.col("district_code") == district_code)
    since = trailing_since(as_of, days)
    cnt = cases.groupBy("district_code").agg(
        F.count(F.lit(1)).alias("total_cases"),
        F.count_if(F.col("case_date") >= since).alias("recent_cases_30d"))
    clim = recent_climate_avg(climate, as_of, days)
    out = (districts.select("district_code", "district_name", "region", "population")
           .join(cnt, "district_code", "left").join(clim, "district_code", "left"))
    return out.select(
        "district_code", "district_name", "region", "population",
        F.coalesce("total_cases", F.lit(0)).alias("total_cases"),
        F.coalesce("recent_cases_30d", F.lit(0)).alias("recent_cases_30d"),
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in
          ("avg_rainfall_30d", "avg_temperature_30d", "avg_humidity_30d")])


def national_statistics(districts: DataFrame, cases: DataFrame, as_of, days: int = C.RECENT_DAYS,
                        top: int = C.TOP_DISTRICTS) -> DataFrame:
    """Totals, recent cases, recent cases by region and the top districts by name,
    as rows (metric, label, value, rank).

    One lazy pass over the cases: counts per district (combined map-side),
    joined once to the districts, each district's counts exploded to the totals,
    its region and its name, and one aggregate over those few rows; a window
    over the per-name rows (bounded by the number of district names) ranks the
    top ``top``. Cases whose district is unknown count in the totals only, as in
    the application."""
    from pyspark.sql import Window as W
    since = trailing_since(as_of, days)
    per = cases.groupBy("district_code").agg(F.count(F.lit(1)).alias("n"),
                                              F.count_if(F.col("case_date") >= since).alias("recent"))
    dims = districts.select("district_code", "district_name", "region", F.lit(1).alias("one"))
    # full join: districts without cases count as districts, cases without a district in the totals
    joined = per.join(dims, "district_code", "full_outer")
    known = F.col("one").isNotNull() & (F.col("recent") > 0)

    def row(metric, label, value):
        return F.struct(F.lit(metric).alias("metric"), label.cast("string").alias("label"),
                        F.coalesce(value, F.lit(0)).cast("long").alias("value"))
    none = F.lit(None).cast("string")
    always = F.array(row("total_districts", none, F.col("one")), row("total_cases", none, F.col("n")),
                     row("recent_cases_30d", none, F.col("recent")))
    some = F.array(row("cases_by_region", F.col("region"), F.col("recent")),
                   row("top_affected_districts", F.col("district_name"), F.col("recent")))
    rows = joined.select(F.explode(F.when(known, F.concat(always, some)).otherwise(always)).alias("r")).select("r.*")
    # the totals exist even without any district or case
    zero = districts.sparkSession.createDataFrame([(m, None, 0) for m in ("total_districts", "total_cases", "recent_cases_30d")],
                                                  "metric string, label string, value long")
    g = rows.unionByName(zero).groupBy("metric", "label").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(W.partitionBy("metric").orderBy(F.col("value").desc(), F.col("label")))
    return (g.withColumn("rank", F.when(F.col("metric") == "top_affected_districts", rank).cast("int"))
            .filter((F.col("metric") != "top_affected_districts") | (F.col("rank") <= top))
            .select("metric", "label", "value", "rank"))


def alert_statistics(alerts: DataFrame, as_of_ts, days: int = C.RECENT_DAYS) -> DataFrame:
    """One row: status counts, active alerts per severity, alerts of the last n days."""
    act = F.col("status") == "active"
    since = trailing_since(as_of_ts, days, "timestamp")
    return alerts.agg(
        F.count(F.lit(1)).alias("total_alerts"),
        F.count_if(act).alias("active_alerts"),
        F.count_if(F.col("status") == "acknowledged").alias("acknowledged_alerts"),
        F.count_if(F.col("status") == "resolved").alias("resolved_alerts"),
        *[F.count_if(act & (F.col("severity") == s)).alias(f"{s}_active") for s in C.SEVERITY_LEVELS],
        F.count_if(F.col("triggered_at") >= since).alias("recent_alerts_30d"))


def dashboard_summary(districts: DataFrame, cases: DataFrame, alerts: DataFrame,
                      preds: DataFrame) -> DataFrame:
    """The dashboard's summary as rows (metric, rank, label, value): the cards
    (rank and label null), then the ten latest predictions as 'recent_prediction',
    newest first, with their score and 'district|horizon|model|date' as label."""
    def one(df, name, col):
        return df.select(F.lit(name).alias("metric"), F.lit(None).cast("int").alias("rank"),
                         F.lit(None).cast("string").alias("label"), col.cast("double").alias("value"))
    from pyspark.sql import Window as W
    latest = recent_predictions(preds)  # ten rows
    newest = W.orderBy(F.col("prediction_date").desc(), F.col("id").desc())
    text = F.concat_ws("|", "district_code", F.col("prediction_horizon_weeks").cast("string"), "model_name",
                       F.col("prediction_date").cast("string"))
    parts = [
        one(districts.agg(F.count(F.lit(1)).alias("v")), "total_districts", F.col("v")),
        one(cases.agg(F.count(F.lit(1)).alias("v")), "total_cases", F.col("v")),
        one(alerts.agg(F.count_if(F.col("status") == "active").alias("v")), "active_alerts", F.col("v")),
        one(avg_recent_risk(preds), "avg_risk_score", F.col("avg_risk_score")),
        latest.select(F.lit("recent_prediction").alias("metric"), F.row_number().over(newest).cast("int").alias("rank"),
                      text.alias("label"), F.col("risk_score").cast("double").alias("value")),
    ]
    return reduce(DataFrame.unionByName, parts)


def summary_cards(summary: DataFrame) -> DataFrame:
    """Display text of the dashboard cards: counts with thousands separators,
    the average risk with one decimal."""
    from riskpanel.functions.scalar import display_count, display_score
    return summary.filter(F.col("metric") != "recent_prediction").select("metric", F.when(F.col("metric") == "avg_risk_score",
                                           display_score("value"))
                          .otherwise(display_count("value")).alias("text"))


__all__ = ["district_statistics", "national_statistics", "alert_statistics",
           "dashboard_summary", "summary_cards", "status_counts", "severity_counts"]
