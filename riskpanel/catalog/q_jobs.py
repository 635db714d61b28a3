"""The daily prediction run (P12, A24) and the weekly training run."""

from pyspark.sql import functions as F

from riskpanel import config as C
from riskpanel.catalog.base import CASES_AS_OF, minus, register
from riskpanel.catalog.q_forecast import ENSEMBLE_SQL, FIT_METRICS_SQL
from riskpanel.catalog.q_quality import _gate_sql
from riskpanel.catalog.q_scalars import sev_sql
from riskpanel.catalog.sqlparts import panel_sql
from riskpanel.plans.jobs import TrainingRequest, daily_job, stored_daily_job, weekly_training
from riskpanel.session import scratch_path


@register("daily_job", "P12", None)
def q_daily_job(t):
    """Daily job: gate, all four forecasters + ensemble, upsert, alerts,
    retention; returns the run summary (districts, successes, failures,
    alerts generated, deletions)."""
    return daily_job(t, CASES_AS_OF).summary


@register("weekly_training", "P13", None)
def q_weekly_training(t):
    """Weekly training: fit the boosted-tree, seasonal and ARIMA models for all gated
    districts; one model-run row (params, metrics) per district and model."""
    return weekly_training(t, CASES_AS_OF)


PASSED = f"(SELECT district_code FROM ({_gate_sql('(' + panel_sql() + ')', 'post_fill')}) WHERE passed)"
GATED_FIT_SQL = f"SELECT * FROM ({FIT_METRICS_SQL}) WHERE district_code IN {PASSED}"
GATED_RUN_SQL = f"SELECT * FROM ({ENSEMBLE_SQL}) WHERE district_code IN {PASSED}"


def _statistical_runs(t, path=None):
    from functools import reduce
    from pyspark.sql import DataFrame
    return reduce(DataFrame.unionByName, [
        weekly_training(t, CASES_AS_OF, TrainingRequest(m), metrics_path=path) for m in ("Prophet", "ARIMA")])


@register("training_request", "P14", GATED_FIT_SQL, ["mae", "mse"])
def q_training_request(t):
    """Training requests for the two statistical models: in-sample MAE and MSE per district."""
    runs = _statistical_runs(t)
    return runs.select("model_name", "district_code", F.col("metrics")["mae"].alias("mae"), F.col("metrics")["mse"].alias("mse"))


@register("write_metrics", "S14", f"""
SELECT model_name, count(*) AS n_runs, avg(mae) AS mae, avg(mse) AS mse FROM ({GATED_FIT_SQL}) GROUP BY 1""", ["mae", "mse"])
def q_write_metrics(t):
    """Model runs appended to the metrics table by two training requests, read back per model."""
    path = scratch_path(t.spark, "model-runs")
    _statistical_runs(t, path)
    return t.spark.read.parquet(path).groupBy("model_name").agg(
        F.count(F.lit(1)).alias("n_runs"), F.avg(F.col("metrics")["mae"]).alias("mae"),
        F.avg(F.col("metrics")["mse"]).alias("mse"))


KEEP_FROM = minus(CASES_AS_OF, C.RETENTION_DAYS)
SINCE = minus(CASES_AS_OF, 7)
_KEYS = "district_code, prediction_date, prediction_horizon_weeks, model_name"
SUMMARY_SQL = f"""
WITH run_ AS ({GATED_RUN_SQL}),
old_ AS (SELECT district_code, prediction_date, prediction_horizon_weeks, model_name, risk_score
         FROM risk_predictions o WHERE NOT EXISTS (SELECT 1 FROM run_ n WHERE n.district_code = o.district_code
           AND n.prediction_date = o.prediction_date AND n.prediction_horizon_weeks = o.prediction_horizon_weeks
           AND n.model_name = o.model_name)),
all_ AS (SELECT {_KEYS}, risk_score FROM run_ UNION ALL SELECT * FROM old_),
cand_ AS (SELECT * FROM all_ p WHERE prediction_date >= DATE '{SINCE}' AND model_name = 'Ensemble'
  AND NOT EXISTS (SELECT 1 FROM alerts a WHERE a.district_code = p.district_code AND a.status = 'active'
    AND a.prediction_horizon_weeks = p.prediction_horizon_weeks AND a.triggered_at >= TIMESTAMP '{SINCE} 00:00:00')),
new_ AS (SELECT DISTINCT district_code, prediction_horizon_weeks FROM (SELECT *, {sev_sql('risk_score')} AS severity FROM cand_)
         WHERE severity IN ('medium', 'high', 'critical'))
SELECT 'total_districts' AS metric, (SELECT count(*) FROM districts) AS value
UNION ALL SELECT 'successful_predictions', (SELECT count(DISTINCT district_code) FROM run_)
UNION ALL SELECT 'failed_predictions', (SELECT count(*) FROM districts) - (SELECT count(DISTINCT district_code) FROM run_)
UNION ALL SELECT 'alerts_generated', (SELECT count(*) FROM new_)
UNION ALL SELECT 'old_predictions_deleted', (SELECT count(*) FROM all_ WHERE prediction_date < DATE '{KEEP_FROM}')
UNION ALL SELECT 'old_alerts_deleted', (SELECT count(*) FROM alerts
  WHERE triggered_at < TIMESTAMP '{KEEP_FROM} 00:00:00' AND status IN ('active', 'acknowledged'))"""


@register("daily_job_statistical", "A24", SUMMARY_SQL)
def q_daily_job_statistical(t):
    """The daily job with the two statistical models: all six metrics of its summary."""
    return daily_job(t, CASES_AS_OF, learned=False).summary


@register("daily_job_stored", "P12", f"""
WITH run_ AS ({GATED_RUN_SQL})
SELECT (SELECT count(*) FROM run_) AS run_rows, (SELECT count(*) FROM run_) AS run_rows_after_second,
       (SELECT count(*) FROM run_) AS distinct_keys, true AS same_alerts""")
def q_daily_job_stored(t):
    """The daily run stored twice: the second leaves the same prediction and alert rows."""
    from riskpanel.sources.files import read_snapshot
    base = scratch_path(t.spark, "daily-state")
    rows, alerts = [], []
    for _ in range(2):
        stored_daily_job(t.spark, t, base, CASES_AS_OF, learned=False)
        p = read_snapshot(t.spark, f"{base}/risk_predictions", "risk_predictions") \
            .filter(F.col("prediction_date") == F.lit(CASES_AS_OF).cast("date"))
        rows.append(p)
        alerts.append(read_snapshot(t.spark, f"{base}/alerts", "alerts").select("alert_id", "status"))
    same = alerts[0].exceptAll(alerts[1]).isEmpty() and alerts[1].exceptAll(alerts[0]).isEmpty()
    keys = rows[1].select("district_code", "prediction_date", "prediction_horizon_weeks", "model_name").distinct()
    return rows[0].agg(F.count(F.lit(1)).alias("run_rows")).select(
        "run_rows", F.lit(rows[1].count()).alias("run_rows_after_second"), F.lit(keys.count()).alias("distinct_keys"),
        F.lit(same).alias("same_alerts"))
