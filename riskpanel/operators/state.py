"""Table state: alert generation, upserts, status changes and retention.

Parquet has no UPDATE/DELETE, so every change is a set-based rewrite that
returns the new table as a DataFrame; ``sources.files.write_snapshot`` writes
it to a new folder (never over a path that is being read).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel import config as C
from riskpanel.functions.scalar import alert_id, ntz_lit, severity
from riskpanel.operators.joins import suppress_existing
from riskpanel.operators.predicates import trailing_days, trailing_since
from riskpanel.operators.windows import first_per_key

ALERT_KEYS = ["district_code", "prediction_horizon_weeks"]


def alert_candidates(preds: DataFrame, as_of, days: int = C.ALERT_WINDOW_DAYS,
                     model: str = C.ENSEMBLE) -> DataFrame:
    """Ensemble predictions of the last ``days`` days (no upper bound)."""
    return trailing_days(preds, "prediction_date", as_of, days).filter(F.col("model_name") == model)


def generate_alerts(preds: DataFrame, alerts: DataFrame, as_of, as_of_ts,
                    days: int = C.ALERT_WINDOW_DAYS, thresholds: dict | None = None,
                    order_by=("id",)) -> DataFrame:
    """New alert rows from recent Ensemble predictions.

    candidates -> drop those with an active alert for the same (district, horizon)
    triggered since the day as_of - days (anti-join; the bound is a date, so the
    hour of the run does not move it) -> severity of the score (null -> 0)
    -> keep medium/high/critical -> at most one per (district, horizon): the
    first by ``order_by`` -> alert rows stamped ``as_of_ts``. The id hashes the
    prediction and the stamp: a later run that raises the same prediction again
    gets another id, a repeated run the same one.
    """
    cand = alert_candidates(preds, as_of, days)
    since = trailing_since(_day(as_of), days, "timestamp")
    fresh = suppress_existing(cand, alerts, since, ALERT_KEYS)
    sev = fresh.withColumn("severity", severity("risk_score", thresholds))
    raising = sev.filter(F.col("severity").isin(C.ALERTING_SEVERITIES))
    one = first_per_key(raising, ALERT_KEYS, order_by)
    ts = ntz_lit(as_of_ts)
    return one.select(
        F.col("id").alias("prediction_id"),
        alert_id("district_code", "prediction_horizon_weeks", "prediction_date", "id", ts).alias("alert_id"),
        "district_code", F.lit(C.ALERT_TYPE).alias("alert_type"), "severity",
        F.col("risk_score").cast("double").alias("risk_score"), "prediction_horizon_weeks",
        ts.alias("triggered_at"), F.lit(None).cast("timestamp_ntz").alias("acknowledged_at"),
        F.lit(None).cast("string").alias("acknowledged_by"), F.lit("active").alias("status"),
        ts.alias("created_at"), ts.alias("updated_at"))


def _day(as_of):
    """The calendar day of a date, datetime or ISO text, as ISO text."""
    return str(as_of)[:10]


def append_alerts(alerts: DataFrame, new_alerts: DataFrame) -> DataFrame:
    """The alert table after adding generated alerts; ids continue after the
    current maximum (one scalar read back, not a table). Alerts whose alert_id
    the table already has (a repeated run) are not added again."""
    from pyspark.sql import Window as W
    new_alerts = new_alerts.join(alerts.select("alert_id"), "alert_id", "left_anti")
    top = alerts.agg(F.max("id")).first()[0] or 0
    # numbering runs over the generated frame only: at most one row per
    # (district, horizon), so bounded by the key space, not by the data
    numbered = new_alerts.withColumn("id", (F.lit(int(top)) + F.row_number().over(
        W.orderBy("prediction_id"))).cast("long"))
    return alerts.unionByName(numbered.select(*alerts.columns))


def upsert(old: DataFrame, new: DataFrame, keys, order: str = "id") -> DataFrame:
    """New rows replace old rows with the same key; within the new batch the
    last row by ``order`` wins (a max_by aggregate, so repeated copies of one
    key are combined per task before the shuffle)."""
    from riskpanel.operators.windows import pick_per_key
    newest = pick_per_key(new, keys, order, latest=True)
    kept = old.join(newest.select(*keys), list(keys), "left_anti")
    return newest.unionByName(kept)


def apply_updates(table: DataFrame, updates: DataFrame, key: str, as_of_ts,
                  stamp: str = "updated_at") -> DataFrame:
    """Set-based UPDATE: ``updates`` has ``key`` plus the columns to set. Rows
    whose values really change get ``stamp = as_of_ts`` (P11). Several updates of
    one key count as one, the largest row, so no table row is multiplied."""
    set_cols = [c for c in updates.columns if c != key]
    one = updates.groupBy(key).agg(F.max(F.struct(*set_cols)).alias("_u"))
    u = one.select(key, *[F.col("_u")[c].alias(f"_new_{c}") for c in set_cols], F.lit(True).alias("_hit"))
    j = table.join(u, key, "left")
    changed = F.lit(False)
    for c in set_cols:
        changed = changed | (F.col("_hit") & ~F.col(c).eqNullSafe(F.col(f"_new_{c}")))
    changed = F.coalesce(changed, F.lit(False))
    out = []
    for c in table.columns:
        if c in set_cols:
            out.append(F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c))
        elif c == stamp:
            out.append(F.when(changed, ntz_lit(as_of_ts)).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def unknown_ids(actions: DataFrame, table: DataFrame, key: str = "alert_id") -> DataFrame:
    """Actions naming ids that do not exist (the application's 'not found')."""
    return actions.join(table.select(key), key, "left_anti")


def acknowledge(alerts: DataFrame, actions: DataFrame, as_of_ts) -> DataFrame:
    """actions(alert_id, acknowledged_by[, acted_at]) -> status acknowledged,
    who, when. Of several actions on one alert the latest ``acted_at`` counts
    (without that column, or at equal times, the greatest name)."""
    when = F.col("acted_at") if "acted_at" in actions.columns else F.lit(0)
    last = actions.groupBy("alert_id").agg(F.max(F.struct(when.alias("t"), F.col("acknowledged_by").alias("who"))).alias("m"))
    a = last.select(
        "alert_id", F.col("m.who").alias("acknowledged_by"),
        ntz_lit(as_of_ts).alias("acknowledged_at"),
        F.lit("acknowledged").alias("status"))
    return apply_updates(alerts, a, "alert_id", as_of_ts)


def resolve(alerts: DataFrame, ids: DataFrame, as_of_ts) -> DataFrame:
    """P10: ids(alert_id) -> status resolved."""
    a = ids.select("alert_id").distinct().withColumn("status", F.lit("resolved"))
    return apply_updates(alerts, a, "alert_id", as_of_ts)


def retain(preds: DataFrame, alerts: DataFrame, as_of, days: int = C.RETENTION_DAYS,
           statuses=tuple(C.RETENTION_ALERT_STATUSES)):
    """Drop predictions dated before as_of - days and old alerts whose status
    is in ``statuses``. Returns (kept predictions, kept alerts, counts row)."""
    cut_d = trailing_since(as_of, days)
    cut_t = trailing_since(as_of, days, "timestamp")
    drop_p = F.coalesce(F.col("prediction_date") < cut_d, F.lit(False))
    drop_a = F.coalesce((F.col("triggered_at") < cut_t) & F.col("status").isin(list(statuses)), F.lit(False))
    kept_p = preds.filter(~drop_p)
    kept_a = alerts.filter(~drop_a)
    pc = preds.agg(F.count_if(drop_p).alias("old_predictions_deleted"),
                   F.count_if(~drop_p).alias("predictions_kept"))
    ac = alerts.agg(F.count_if(drop_a).alias("old_alerts_deleted"),
                    F.count_if(~drop_a).alias("alerts_kept"))
    return kept_p, kept_a, pc, ac


def models_to_rows(wide: DataFrame, keys, models=tuple(C.MODEL_NAMES), value: str = "risk_score") -> DataFrame:
    """One column per model -> one row per model (nulls dropped)."""
    return wide.unpivot(list(keys), list(models), "model_name", value).filter(F.col(value).isNotNull())
