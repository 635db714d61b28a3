"""Alert generation and table-state operators."""

from pyspark.sql import functions as F

from riskpanel.catalog.base import EVENTS_AS_OF, EVENTS_AS_OF_TS, DISTRICT, minus, register
from riskpanel.catalog.q_scalars import sev_sql
from riskpanel.functions.scalar import ntz_lit
from riskpanel.operators import state as S

D7 = minus(EVENTS_AS_OF, 7)
T7 = minus(EVENTS_AS_OF_TS, 7)
TS = EVENTS_AS_OF_TS

CAND_SQL = f"""SELECT * FROM risk_predictions WHERE prediction_date >= DATE '{D7}' AND model_name = 'Ensemble'"""


@register("alert_candidates", "P8", CAND_SQL)
def q_alert_candidates(t):
    """Ensemble predictions of the last 7 days (the alert job's input)."""
    return S.alert_candidates(t.predictions, EVENTS_AS_OF)


GEN_SQL = f"""
WITH cand_ AS ({CAND_SQL}),
fresh_ AS (SELECT * FROM cand_ p WHERE NOT EXISTS (SELECT 1 FROM alerts a
  WHERE a.district_code = p.district_code AND a.prediction_horizon_weeks = p.prediction_horizon_weeks
  AND a.status = 'active' AND a.triggered_at >= TIMESTAMP '{T7}')),
r_ AS (SELECT * FROM (SELECT *, {sev_sql('risk_score')} AS severity FROM fresh_)
       WHERE severity IN ('medium', 'high', 'critical')),
one_ AS (SELECT * EXCLUDE (rn_) FROM (SELECT *, row_number() OVER (
  PARTITION BY district_code, prediction_horizon_weeks ORDER BY id) AS rn_ FROM r_) WHERE rn_ = 1)
SELECT id AS prediction_id,
  substr(sha256(concat_ws('|', district_code, CAST(prediction_horizon_weeks AS VARCHAR),
         CAST(prediction_date AS VARCHAR), CAST(id AS VARCHAR), '@TS@')), 1, 32) AS alert_id,
  district_code, 'cholera_risk' AS alert_type, severity, risk_score, prediction_horizon_weeks,
  TIMESTAMP '@TS@' AS triggered_at, CAST(NULL AS TIMESTAMP) AS acknowledged_at,
  CAST(NULL AS VARCHAR) AS acknowledged_by, 'active' AS status,
  TIMESTAMP '@TS@' AS created_at, TIMESTAMP '@TS@' AS updated_at FROM one_"""
GEN_AT = GEN_SQL
GEN_SQL = GEN_AT.replace("@TS@", TS)
AFTERNOON = TS[:10] + " 15:00:00"


@register("generate_alerts", "P8", GEN_SQL)
def q_generate_alerts(t):
    """New alerts: recent Ensemble predictions without an active alert for the same
    district and horizon, severity medium or worse, at most one per key."""
    return S.generate_alerts(t.predictions, t.alerts, EVENTS_AS_OF, EVENTS_AS_OF_TS)


@register("generate_alerts_afternoon", "P8", GEN_AT.replace("@TS@", AFTERNOON))
def q_generate_alerts_afternoon(t):
    """The same run at 15:00: suppression looks back whole days, only stamps and ids differ."""
    return S.generate_alerts(t.predictions, t.alerts, EVENTS_AS_OF, AFTERNOON)


ALERT_COLS = ["id", "alert_id", "district_code", "alert_type", "severity", "risk_score",
              "prediction_horizon_weeks", "triggered_at"]


def _update_sql(hit: str, sets: dict) -> str:
    cols = []
    for c in ALERT_COLS + ["acknowledged_at", "acknowledged_by", "status", "created_at"]:
        cols.append(f"CASE WHEN hit_ THEN {sets[c]} ELSE {c} END AS {c}" if c in sets else c)
    changed = " OR ".join(f"({sets[c]}) IS DISTINCT FROM {c}" for c in sets)
    cols.append(f"CASE WHEN hit_ AND ({changed}) THEN TIMESTAMP '{TS}' ELSE updated_at END AS updated_at")
    return f"SELECT {', '.join(cols)} FROM (SELECT *, coalesce({hit}, false) AS hit_ FROM alerts)"


@register("acknowledge_alert", "P9", _update_sql(
    "status = 'active' AND severity = 'critical'",
    {"acknowledged_at": f"TIMESTAMP '{TS}'", "acknowledged_by": "'duty_officer'", "status": "'acknowledged'"}))
def q_acknowledge_alert(t):
    """Acknowledge every active critical alert (who, when, status), set-based."""
    actions = t.alerts.filter((F.col("status") == "active") & (F.col("severity") == "critical")) \
        .select("alert_id", F.lit("duty_officer").alias("acknowledged_by"))
    return S.acknowledge(t.alerts, actions, EVENTS_AS_OF_TS)


@register("resolve_alert", "P10", _update_sql(
    f"status = 'acknowledged' AND triggered_at < TIMESTAMP '{T7}'", {"status": "'resolved'"}))
def q_resolve_alert(t):
    """Resolve acknowledged alerts older than 7 days, set-based."""
    ids = t.alerts.filter((F.col("status") == "acknowledged") & (F.col("triggered_at") < ntz_lit(T7)))
    return S.resolve(t.alerts, ids.select("alert_id"), EVENTS_AS_OF_TS)


@register("touch_updated_at", "P11", _update_sql(f"district_code = '{DISTRICT}'", {"status": "'active'"}))
def q_touch_updated_at(t):
    """Set one district's alerts active: only rows whose value changes get updated_at."""
    upd = t.alerts.filter(F.col("district_code") == DISTRICT).select("alert_id", F.lit("active").alias("status"))
    return S.apply_updates(t.alerts, upd, "alert_id", EVENTS_AS_OF_TS)


KEYS = "district_code, prediction_date, prediction_horizon_weeks, model_name"


@register("upsert_predictions", "P7", f"""
WITH new_ AS (SELECT * FROM risk_predictions WHERE prediction_date >= DATE '{D7}'),
nd_ AS (SELECT * EXCLUDE (rn_) FROM (SELECT *, row_number() OVER (PARTITION BY {KEYS} ORDER BY id DESC) AS rn_
        FROM new_) WHERE rn_ = 1)
SELECT * FROM nd_ UNION ALL
SELECT o.* FROM risk_predictions o WHERE NOT EXISTS (SELECT 1 FROM nd_ n WHERE n.district_code = o.district_code
  AND n.prediction_date = o.prediction_date AND n.prediction_horizon_weeks = o.prediction_horizon_weeks
  AND n.model_name = o.model_name)""")
def q_upsert_predictions(t):
    """Upsert the last week's prediction batch into the prediction table by its
    unique key (duplicates in the batch: last id wins)."""
    new = t.predictions.filter(F.col("prediction_date") >= F.lit(D7).cast("date"))
    return S.upsert(t.predictions, new, ["district_code", "prediction_date", "prediction_horizon_weeks", "model_name"])


@register("retain", "U2", f"""
SELECT 'old_predictions_deleted' AS metric, count_if(prediction_date < DATE '{D7}') AS value FROM risk_predictions
UNION ALL SELECT 'predictions_kept', count_if(NOT coalesce(prediction_date < DATE '{D7}', false)) FROM risk_predictions
UNION ALL SELECT 'old_alerts_deleted', count_if(triggered_at < TIMESTAMP '{T7}' AND status IN ('active', 'acknowledged')) FROM alerts
UNION ALL SELECT 'alerts_kept', count_if(NOT coalesce(triggered_at < TIMESTAMP '{T7}' AND status IN ('active', 'acknowledged'), false)) FROM alerts""")
def q_retain(t):
    """Retention with 7 days kept: deleted and kept counts of predictions and alerts."""
    from functools import reduce
    from pyspark.sql import DataFrame
    _, _, pc, ac = S.retain(t.predictions, t.alerts, EVENTS_AS_OF, 7)
    parts = [pc.select(F.lit(c).alias("metric"), F.col(c).cast("long").alias("value")) for c in pc.columns]
    parts += [ac.select(F.lit(c).alias("metric"), F.col(c).cast("long").alias("value")) for c in ac.columns]
    return reduce(DataFrame.unionByName, parts)
