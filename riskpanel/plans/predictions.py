"""Model scores -> fallback, clamp -> ensemble mean -> prediction rows.

Models are plain functions ``(series_or_panel, as_of, horizon_weeks) -> long
frame`` with ``raw_score``; adding a model means adding one such function.
Each model's score is fallen back (50.0 when it produced nothing) and clamped
into 0..100 before the mean, as the application does per model.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel import config as C
from riskpanel.functions.scalar import clamp, fallback_flag, features_json, interval_bounds
from riskpanel.operators.forecast import series_from_panel, statistical_forecasts

KEYS = ["district_code", "prediction_date", "prediction_horizon_weeks"]


def statistical_models(panel: DataFrame, as_of, horizon_weeks: int, series: DataFrame | None = None) -> list[DataFrame]:
    """P2 and P3 on the daily case series (taken from the panel unless given)."""
    s = series if series is not None else series_from_panel(panel)
    return [statistical_forecasts(s, as_of, horizon_weeks)]


def learned_models(panel: DataFrame, as_of, horizon_weeks: int, **params) -> list[DataFrame]:
    from riskpanel.operators.learn import boosted_forecast, sequence_forecast
    return [sequence_forecast(panel, as_of, horizon_weeks, **params.get("sequence", {})),
            boosted_forecast(panel, as_of, horizon_weeks, **params.get("boosted", {}))]


def finalize_scores(raw: DataFrame) -> DataFrame:
    """Per model: fallback flag, then score = clamp(fallback(raw))."""
    return raw.select(*KEYS, "model_name", clamp("raw_score").alias("risk_score"),
                      fallback_flag("raw_score").alias("fallback"))


def ensemble_predictions(model_outputs: list[DataFrame]) -> DataFrame:
    """Union the per-model rows, add the Ensemble mean, and shape prediction rows."""
    scores = finalize_scores(reduce(DataFrame.unionByName, model_outputs))
    # one pass: per key the model rows (at most one per model, so the list is
    # bounded by the number of models) plus their mean as the Ensemble row;
    # reusing ``scores`` twice would run every model twice
    per_key = scores.groupBy(*KEYS).agg(
        F.collect_list(F.struct("model_name", "risk_score", "fallback")).alias("m"),
        F.avg("risk_score").alias("ens"))
    ens_row = F.struct(F.lit(C.ENSEMBLE).alias("model_name"), F.col("ens").alias("risk_score"),
                       F.lit(False).alias("fallback"))
    rows = per_key.select(*KEYS, F.explode(F.concat("m", F.array(ens_row))).alias("r")).select(*KEYS, "r.*")
    lo, hi = interval_bounds("risk_score")
    return rows.select(*KEYS, "risk_score", lo.alias("confidence_interval_lower"),
                       hi.alias("confidence_interval_upper"), "model_name",
                       F.lit(C.MODEL_VERSION).alias("model_version"),
                       features_json().alias("features_used"), "fallback")


def predict(panel: DataFrame | None, as_of, horizon_weeks: int = C.DEFAULT_HORIZON_WEEKS,
            learned: bool = True, series: DataFrame | None = None, **params) -> DataFrame:
    """All forecasters (statistical, and learned unless disabled) + ensemble.
    The statistical models only need the case series: pass ``series`` to skip
    the panel's feature columns when ``learned`` is off."""
    outs = statistical_models(panel, as_of, horizon_weeks, series)
    if learned:
        outs += learned_models(panel, as_of, horizon_weeks, **params)
    return ensemble_predictions(outs)
