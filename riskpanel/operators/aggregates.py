"""Aggregates. Each is one pass (partial aggregation before the shuffle) and
handles all districts at once; conditional counts use ``count_if`` instead of
one query per condition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel import config as C
from riskpanel.operators.predicates import trailing_days


def _ci(cond):
    return F.count_if(cond)


def daily_cases(cases: DataFrame, start=None, end=None, key="district_code") -> DataFrame:
    """Cases per (district, day), optionally start..end inclusive."""
    c = cases
    if start is not None:
        c = c.filter(F.col("case_date") >= F.lit(start).cast("date"))
    if end is not None:
        c = c.filter(F.col("case_date") <= F.lit(end).cast("date"))
    keys = ([key] if key else []) + ["case_date"]
    return (c.groupBy(*keys).agg(F.count(F.lit(1)).alias("cases_count"))
            .withColumnRenamed("case_date", "date"))


def national_daily_cases(cases: DataFrame, as_of, days: int = C.RECENT_DAYS) -> DataFrame:
    """Timeline: cases per day for the whole country, last ``days`` days."""
    return daily_cases(trailing_days(cases, "case_date", as_of, days), key=None)


def total_count(df: DataFrame, name: str = "total") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def status_counts(alerts: DataFrame) -> DataFrame:
    return alerts.agg(F.count(F.lit(1)).alias("total_alerts"),
                      _ci(F.col("status") == "active").alias("active_alerts"),
                      _ci(F.col("status") == "acknowledged").alias("acknowledged_alerts"),
                      _ci(F.col("status") == "resolved").alias("resolved_alerts"))


def severity_counts(alerts: DataFrame) -> DataFrame:
    """Active alerts per severity, zero-filled over the four levels (one pass)."""
    act = F.col("status") == "active"
    row = alerts.agg(*[_ci(act & (F.col("severity") == s)).alias(s) for s in C.SEVERITY_LEVELS])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(s).alias("severity"), F.col(s).alias("n_alerts")) for s in C.SEVERITY_LEVELS
    ])).alias("x")).select("x.*")


def recent_count(df: DataFrame, column: str, as_of, days: int = C.RECENT_DAYS,
                 column_type: str = "date", name: str = "recent") -> DataFrame:
    from riskpanel.operators.predicates import trailing_since
    return df.agg(_ci(F.col(column) >= trailing_since(as_of, days, column_type)).alias(name))


def recent_climate_avg(climate: DataFrame, as_of, days: int = C.RECENT_DAYS,
                       key="district_code") -> DataFrame:
    """Mean rainfall/temperature/humidity over the last ``days`` days; null -> 0."""
    c = trailing_days(climate, "date", as_of, days)
    return c.groupBy(key).agg(*[F.coalesce(F.avg(m), F.lit(0.0)).alias(a) for m, a in (
        ("rainfall_mm", "avg_rainfall_30d"), ("temperature_celsius", "avg_temperature_30d"),
        ("humidity_percent", "avg_humidity_30d"))])


def cases_by_region(cases: DataFrame, districts: DataFrame, as_of, days: int = C.RECENT_DAYS) -> DataFrame:
    """Recent cases per region: aggregate cases per district first, then join the
    (small) district table and re-aggregate, so the join sees one row a district."""
    per = trailing_days(cases, "case_date", as_of, days).groupBy("district_code") \
        .agg(F.count(F.lit(1)).alias("n"))
    return (per.join(districts.select("district_code", "region"), "district_code", "inner")
            .groupBy("region").agg(F.sum("n").alias("case_count")))


def district_name_counts(cases: DataFrame, districts: DataFrame, as_of,
                         days: int = C.RECENT_DAYS) -> DataFrame:
    """Recent cases per district *name* (namesakes merge, as in the application)."""
    per = trailing_days(cases, "case_date", as_of, days).groupBy("district_code") \
        .agg(F.count(F.lit(1)).alias("n"))
    return (per.join(districts.select("district_code", "district_name"), "district_code", "inner")
            .groupBy("district_name").agg(F.sum("n").alias("case_count")))


def date_extent(df: DataFrame, column: str, key="district_code") -> DataFrame:
    return df.groupBy(key).agg(F.min(column).alias("start_date"), F.max(column).alias("end_date"))


def case_quality_stats(cases: DataFrame, key="district_code") -> DataFrame:
    return cases.groupBy(key).agg(F.count(F.lit(1)).alias("total_cases"),
                                  _ci(F.col("lab_confirmed")).alias("lab_confirmed_cases"),
                                  F.min("case_date").alias("start_date"),
                                  F.max("case_date").alias("end_date"))


def climate_quality_stats(climate: DataFrame, key="district_code") -> DataFrame:
    return climate.groupBy(key).agg(F.count(F.lit(1)).alias("total_records"),
                                    F.avg("rainfall_mm").alias("avg_rainfall"),
                                    F.avg("temperature_celsius").alias("avg_temperature"),
                                    F.avg("humidity_percent").alias("avg_humidity"),
                                    F.min("date").alias("start_date"),
                                    F.max("date").alias("end_date"))


def prediction_quality_stats(preds: DataFrame, key="district_code") -> DataFrame:
    return preds.groupBy(key).agg(F.count(F.lit(1)).alias("total_predictions"),
                                  F.avg("risk_score").alias("avg_risk_score"),
                                  F.min("prediction_date").alias("start_date"),
                                  F.max("prediction_date").alias("end_date"))


def model_distribution(preds: DataFrame, key="district_code") -> DataFrame:
    """Value counts of model name per district (tidy; map it only at a sink)."""
    keys = ([key] if key else []) + ["model_name"]
    return preds.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_predictions"))


def model_distribution_map(preds: DataFrame, key="district_code") -> DataFrame:
    """Sink form: one MAP<model, count> per district (bounded by the 5 names)."""
    md = model_distribution(preds, key)
    return md.groupBy(key).agg(F.map_from_entries(F.collect_list(
        F.struct("model_name", "n_predictions"))).alias("model_distribution"))


def completeness(df: DataFrame, columns, key="district_code") -> DataFrame:
    """Share of non-null values per column, and the smallest share."""
    aggs = [F.avg(F.col(c).isNotNull().cast("double")).alias(f"{c}_completeness") for c in columns]
    out = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"), *aggs)
    return out.withColumn("min_completeness", F.least(*[F.col(f"{c}_completeness") for c in columns]))


def risk_histogram(preds: DataFrame, model: str = C.ENSEMBLE, bins: int = C.HISTOGRAM_BINS,
                   lo: float = 0.0, hi: float = 100.0) -> DataFrame:
    """Histogram of one model's scores: fixed-width bins on lo..hi; the top edge
    belongs to the last bin."""
    width = (hi - lo) / bins
    s = preds.filter((F.col("model_name") == model) & F.col("risk_score").isNotNull())
    b = F.least(F.floor((F.col("risk_score") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return (s.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n_predictions"))
            .withColumn("bin_start", F.lit(lo) + F.col("bin") * F.lit(width))
            .withColumn("bin_end", F.col("bin_start") + F.lit(width)))


def avg_recent_risk(preds: DataFrame, n: int = C.RECENT_PREDICTIONS) -> DataFrame:
    """Mean of the non-zero, non-null scores among the n latest predictions."""
    from riskpanel.operators.predicates import recent_predictions
    top = recent_predictions(preds, n)
    return top.agg(F.coalesce(F.avg(F.when(F.col("risk_score") != 0, F.col("risk_score"))),
                              F.lit(0.0)).alias("avg_risk_score"))


def ensemble_mean(scores: DataFrame, keys=("district_code", "prediction_horizon_weeks"),
                  score: str = "risk_score", out: str = "ensemble_score") -> DataFrame:
    """Simple mean of model scores per key (long form input)."""
    return scores.groupBy(*keys).agg(F.avg(score).alias(out), F.count(score).alias("n_models"))


def fit_metrics(df: DataFrame, y: str = "y", yhat: str = "yhat", keys=("district_code",)) -> DataFrame:
    """MAE, MSE and R^2 per group (R^2 null when y is constant)."""
    e = F.col(y) - F.col(yhat)
    g = df.groupBy(*keys).agg(F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
                              F.sum(e * e).alias("_sse"), F.avg(y).alias("_ybar"),
                              F.sum(F.col(y) * F.col(y)).alias("_syy"), F.count(y).alias("n"))
    sst = F.col("_syy") - F.col("n") * F.col("_ybar") * F.col("_ybar")
    return (g.withColumn("r2", F.lit(1.0) - F.try_divide(F.col("_sse"), F.when(sst > 1e-12, sst)))
            .drop("_sse", "_ybar", "_syy"))
