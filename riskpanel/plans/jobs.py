"""The daily prediction run and the weekly training run.

One driver function builds one DataFrame graph: the panel is built once and
checkpointed (the application builds it twice per district), the gate's
reason column replaces counted exceptions, and every step is set-based over
all districts. Any scheduler can call ``daily_job`` / ``weekly_training``.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel import config as C
from riskpanel.functions.scalar import ntz_lit
from riskpanel.operators.quality import panel_gate
from riskpanel.operators.state import append_alerts, generate_alerts, retain, upsert
from riskpanel.plans.panel import training_panel
from riskpanel.plans.predictions import predict

PRED_KEYS = ["district_code", "prediction_date", "prediction_horizon_weeks", "model_name"]


@dataclass
class DailyRunResult:
    panel: DataFrame
    gate: DataFrame
    new_predictions: DataFrame
    predictions: DataFrame
    new_alerts: DataFrame
    alerts: DataFrame
    summary: DataFrame


def _cut(df: DataFrame) -> DataFrame:
    from riskpanel.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _prediction_rows(new: DataFrame, existing: DataFrame, as_of_ts) -> DataFrame:
    """Prediction rows in the table's schema; ids continue after the current maximum."""
    from pyspark.sql import Window as W
    top = existing.agg(F.max("id")).first()[0] or 0
    ts = ntz_lit(as_of_ts)
    # one row per (district, model) of this run: bounded by the key space
    numbered = new.withColumn("id", (F.lit(int(top)) + F.row_number().over(
        W.orderBy("district_code", "model_name"))).cast("long"))
    return numbered.select(*[F.col(c) for c in ("id", "district_code", "prediction_date",
                                                "prediction_horizon_weeks", "risk_score",
                                                "confidence_interval_lower", "confidence_interval_upper",
                                                "model_name", "model_version", "features_used")],
                           ts.alias("created_at"), ts.alias("updated_at"))


def predict_and_alert(cases, climate, water, districts, predictions, alerts, as_of, as_of_ts=None,
                        horizon_weeks: int = C.DEFAULT_HORIZON_WEEKS, district_codes=None,
                        learned: bool = True, retention_days: int = C.RETENTION_DAYS,
                        min_days: int = C.MIN_DAYS, gate_stage: str = "post_fill",
                        **model_params) -> DailyRunResult:
    """Gate -> forecasts + ensemble -> upsert -> alerts -> retention -> summary.

    gate_stage="post_fill" checks the filled panel, as the application does (a
    filled calendar always has every day, so sparse districts pass);
    "pre_fill" checks the calendar before filling, where they fail."""
    as_of_d = as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of))
    as_of_ts = as_of_ts or _dt.datetime.combine(as_of_d, _dt.time())
    panel = _cut(training_panel(cases, climate, water, districts, as_of_d, district_code=district_codes))
    if gate_stage == "pre_fill":
        from riskpanel.plans.panel import raw_panel
        gated_input = raw_panel(cases, climate, districts, as_of_d)
        if district_codes is not None:
            codes = [district_codes] if isinstance(district_codes, str) else list(district_codes)
            gated_input = gated_input.filter(F.col("district_code").isin(codes))
    elif gate_stage == "post_fill":
        gated_input = panel
    else:
        raise ValueError(gate_stage)
    gate = panel_gate(gated_input, min_days=min_days, stage=gate_stage)
    ok_panel = panel.join(gate.filter("passed").select("district_code"), "district_code", "left_semi")
    new = _cut(predict(ok_panel, as_of_d, horizon_weeks, learned=learned, **model_params))
    rows = _prediction_rows(new, predictions, as_of_ts)
    preds = upsert(predictions, rows, PRED_KEYS)
    # candidates are the stored predictions of the last days, those of this run included
    fresh = _cut(generate_alerts(preds, alerts, as_of_d, as_of_ts))
    all_alerts = append_alerts(alerts, fresh)
    kept_p, kept_a, pc, ac = retain(preds, all_alerts, as_of_d, retention_days)

    def metric(df, name, col):
        return df.select(F.lit(name).alias("metric"), col.cast("long").alias("value"))
    summary = reduce(DataFrame.unionByName, [
        metric(gate.agg(F.count(F.lit(1)).alias("v")), "total_districts", F.col("v")),
        metric(gate.agg(F.count_if("passed").alias("v")), "successful_predictions", F.col("v")),
        metric(gate.agg(F.count_if(~F.col("passed")).alias("v")), "failed_predictions", F.col("v")),
        metric(fresh.agg(F.count(F.lit(1)).alias("v")), "alerts_generated", F.col("v")),
        metric(pc, "old_predictions_deleted", F.col("old_predictions_deleted")),
        metric(ac, "old_alerts_deleted", F.col("old_alerts_deleted")),
    ])
    return DailyRunResult(panel, gate, new, kept_p, fresh, kept_a, summary)


def daily_job(tables, as_of, as_of_ts=None, **kw) -> DailyRunResult:
    """The daily run at 8 weeks."""
    return predict_and_alert(tables.cases, tables.climate, tables.water, tables.districts,
                               tables.predictions, tables.alerts, as_of, as_of_ts,
                               horizon_weeks=C.DEFAULT_HORIZON_WEEKS, **kw)


#: What the weekly run trains; LSTM only on request.
WEEKLY_MODELS = ("XGBoost", "Prophet", "ARIMA")


def stored_daily_job(spark, tables, base: str, as_of, as_of_ts=None, **kw) -> DailyRunResult:
    """The daily run against stored state: predictions and alerts are read from
    their current snapshots under ``base`` (the given tables before the first),
    and the new ones stored as the next versions. Storing the same run twice
    leaves the same rows: predictions are replaced by key, alerts by id."""
    from riskpanel.sources.files import current_version, read_snapshot, replace_table
    paths = {"risk_predictions": f"{base}/risk_predictions", "alerts": f"{base}/alerts"}
    given = {"risk_predictions": tables.predictions, "alerts": tables.alerts}
    now = {n: given[n] if current_version(spark, p) is None else read_snapshot(spark, p, n) for n, p in paths.items()}
    run = predict_and_alert(tables.cases, tables.climate, tables.water, tables.districts,
                            now["risk_predictions"], now["alerts"], as_of, as_of_ts, **kw)
    replace_table(run.predictions, paths["risk_predictions"], "risk_predictions")
    replace_table(run.alerts, paths["alerts"], "alerts")
    return run


@dataclass
class TrainingRequest:
    """Which model ("all": the weekly set), which districts, which dates."""
    model_name: str = "all"
    district_codes: list | None = None
    start_date: _dt.date | None = None
    end_date: _dt.date | None = None

    def models(self) -> tuple[str, ...]:
        if self.model_name == "all":
            return WEEKLY_MODELS
        if self.model_name not in C.MODEL_NAMES or self.model_name == C.ENSEMBLE:
            raise ValueError(f"unknown model: {self.model_name}")
        return (self.model_name,)


def weekly_training(tables, as_of, request: TrainingRequest | None = None,
                    horizon_weeks: int = C.DEFAULT_HORIZON_WEEKS, metrics_path: str | None = None,
                    **params) -> DataFrame:
    """Fit the requested models for all gated districts and return
    model-run rows (S14); ``metrics_path`` also appends them to that table.

    The panel covers ``start_date`` (default: one look-back before the end) to
    ``end_date`` (default: as_of), however long that is. Learned models report
    MAE, MSE and R^2 on held-out days, the statistical ones MAE and MSE on the
    days they were fitted to, as the application logs them."""
    from riskpanel.operators.forecast import arima_111_fitted, seasonal_trend_fitted, series_from_panel
    from riskpanel.operators.learn import boosted_forecast, model_runs, sequence_forecast
    from riskpanel.operators.aggregates import fit_metrics
    req = request or TrainingRequest()
    models = req.models()
    as_day = lambda d: d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d)[:10])
    end = as_day(req.end_date or as_of)
    start = as_day(req.start_date) if req.start_date else end - _dt.timedelta(days=C.LOOKBACK_DAYS)
    panel = _cut(training_panel(tables.cases, tables.climate, tables.water, tables.districts, end,
                                days=(end - start).days, district_code=req.district_codes))
    gate = panel_gate(panel)
    panel = panel.join(gate.filter("passed").select("district_code"), "district_code", "left_semi")
    runs = []
    for name in models:
        extra = params.get({"XGBoost": "boosted", "LSTM": "sequence"}.get(name, name), {})
        if name == "XGBoost":
            _, m = boosted_forecast(panel, as_of, horizon_weeks, with_metrics=True, **extra)
            logged = {"n_estimators": extra.get("trees", C.BOOST_TREES), "max_depth": extra.get("depth", C.BOOST_DEPTH)}
        elif name == "LSTM":
            _, m = sequence_forecast(panel, as_of, horizon_weeks, with_metrics=True, **extra)
            logged = {"seq_length": C.SEQUENCE_LENGTH}
        else:
            fitted = seasonal_trend_fitted if name == "Prophet" else arima_111_fitted
            m = fit_metrics(fitted(series_from_panel(panel))).withColumn("r2", F.lit(None).cast("double"))
            logged = {"order": "(1,1,1)"} if name == "ARIMA" else {}
        runs.append(model_runs(m, name, as_of, {**logged, "horizon_weeks": horizon_weeks}))
    out = reduce(DataFrame.unionByName, runs)
    if metrics_path:
        from riskpanel.sources.files import write_metrics
        out = _cut(out)
        write_metrics(out, metrics_path)
    return out
