"""Learned forecasters.

The application fits one small model per district in a Python loop. The boosted
trees here are one model a district too, all fitted in one grouped job, a
district in one task; the sequence model is one ``pyspark.ml`` fit pooled over
all districts.

mode="nowcast" (default) reproduces the application: the label is the
current day's count and the features include columns built from it, so the
"forecast" is for the last known day. mode="direct" trains on the count
7*h days ahead and drops same-day target features.
"""

from __future__ import annotations

import datetime as _dt

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskpanel import config as C
from riskpanel.operators.aggregates import fit_metrics
from riskpanel.operators.boosting import boosted_scores
from riskpanel.operators.windows import chrono_split, lag_columns, rolling_columns, sequence_window
from riskpanel.session import ship_package

MODEL_BASE = ["rainfall_mm", "temperature_celsius", "cases_count", "water_area_sqkm"]


def _as_date(d):
    return d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d))


def _label(panel: DataFrame, horizon_weeks: int, mode: str) -> DataFrame:
    if mode == "nowcast":
        return panel.withColumn("label", F.col("cases_count").cast("double"))
    if mode == "direct":
        w = W.partitionBy("district_code").orderBy("date")
        return panel.withColumn("label", F.lead("cases_count", 7 * horizon_weeks).over(w).cast("double"))
    raise ValueError(mode)


def boosted_features(panel: DataFrame) -> tuple[DataFrame, list[str]]:
    """Panel + lags 1/7/14/21 and strict 7/14 rolling means of the four model
    columns; every feature null -> 0."""
    src = {c: c for c in MODEL_BASE}
    extra = {}
    extra.update(lag_columns(src, C.PANEL_LAGS))
    extra.update(rolling_columns(src, C.MODEL_ROLLS, strict=True))
    df = panel.withColumns(extra)
    feats = [c for c in df.columns if c not in ("district_code", "date", "cases_count")]
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in feats}), feats


def _cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared ``spark.checkpoint.dir``: the fits
    pass over their input many times, and a lost executor must not replay the
    window lineage of the panel."""
    from riskpanel.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _last_rows(df: DataFrame) -> DataFrame:
    w = W.partitionBy("district_code").orderBy(F.col("date").desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def _out(pred: DataFrame, as_of, horizon_weeks, model_name) -> DataFrame:
    return pred.select("district_code", F.lit(_as_date(as_of)).alias("prediction_date"),
                       F.lit(int(horizon_weeks)).alias("prediction_horizon_weeks"),
                       F.lit(model_name).alias("model_name"),
                       F.col("prediction").cast("double").alias("raw_score"))


def _no_scores(panel: DataFrame, as_of, horizon_weeks, model_name, with_metrics: bool):
    """Null scores for every district (50.0 downstream): nothing to train on."""
    out = _out(panel.select("district_code").distinct().withColumn("prediction", F.lit(None).cast("double")),
               as_of, horizon_weeks, model_name)
    if not with_metrics:
        return out
    none = panel.limit(0).select("district_code", F.lit(None).cast("double").alias("y"), F.lit(None).cast("double").alias("yhat"))
    return out, fit_metrics(none)


def boosted_rows(df: DataFrame, feats: list[str], trees: int, depth: int, rate: float) -> DataFrame:
    """(district_code, date, label, is_train, yhat): every day of every district, scored by that district's own
    model; a district without a training day has null scores.

    A group is one district's calendar, so its size does not depend on the
    number of cases. Fits take far longer than their few rows suggest, hence
    the fixed number of partitions, which adaptive execution leaves alone.
    """
    spark = df.sparkSession
    ship_package(spark)
    spread = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)

    def fit(days: pa.Table) -> pa.Table:
        days = days.sort_by("date")
        x = np.array(days.column("x").to_pylist(), dtype=float).reshape(days.num_rows, len(feats))
        label = days.column("label").to_numpy()
        train = days.column("is_train").to_numpy() & ~np.isnan(label)
        yhat = boosted_scores(x, np.nan_to_num(label), train, trees, depth, rate) if train.any() else np.full(len(x), np.nan)
        return days.drop_columns("x").append_column("yhat", pa.array(yhat, from_pandas=True))

    return (df.select("district_code", "date", "label", "is_train", F.array(*feats).alias("x"))
            .repartition(spread, "district_code").groupBy("district_code")
            .applyInArrow(fit, "district_code string, date date, label double, is_train boolean, yhat double"))


def boosted_forecast(panel: DataFrame, as_of, horizon_weeks: int = C.DEFAULT_HORIZON_WEEKS,
                     trees: int = C.BOOST_TREES, depth: int = C.BOOST_DEPTH, rate: float = C.BOOST_RATE,
                     mode: str = "nowcast", with_metrics: bool = False):
    """Gradient-boosted trees on the panel features, one model a district,
    all in one job: the first 80 % of a district's days train its model, the
    score is the prediction of its last day (and, with_metrics, MAE/MSE/R^2 on
    the other 20 %). Nothing is drawn at random."""
    df, feats = boosted_features(panel)
    if mode == "direct":
        feats = [f for f in feats if not (f.startswith("cases_roll") or f.startswith("cases_count_roll"))]
    scored = boosted_rows(chrono_split(_label(df, horizon_weeks, mode)), feats, trees, depth, rate)
    if with_metrics:
        scored = _cut(scored)  # read twice
    last = scored.groupBy("district_code").agg(F.max_by("yhat", "date").alias("prediction"))
    out = _out(last, as_of, horizon_weeks, "XGBoost")
    if not with_metrics:
        return out
    test = scored.filter(~F.col("is_train") & F.col("label").isNotNull() & F.col("yhat").isNotNull())
    return out, fit_metrics(test.select("district_code", F.col("label").alias("y"), "yhat"))


def sequence_features(panel: DataFrame, seq: int = C.SEQUENCE_LENGTH) -> DataFrame:
    """W6 flattened: the 14 previous days x 4 features as one 56-long vector."""
    s = sequence_window(panel.select("district_code", "date", *MODEL_BASE), MODEL_BASE, seq)
    flat = F.flatten(F.transform("seq", lambda r: F.array(*[r[c] for c in MODEL_BASE])))
    return s.withColumn("features", array_to_vector(flat)).drop("seq")


def sequence_forecast(panel: DataFrame, as_of, horizon_weeks: int = C.DEFAULT_HORIZON_WEEKS,
                      seq: int = C.SEQUENCE_LENGTH, reg: float = 0.01, elastic: float = 0.0,
                      mode: str = "nowcast", with_metrics: bool = False):
    """P5: ridge regression on the flattened 14-day x 4-feature window (stands
    in for the recurrent network); with L2 only it is solved from one pass of
    normal equations. Districts with no training window get null
    (hence the 50.0 fallback downstream), as a too-short series does."""
    s = sequence_features(panel, seq)
    s = _cut(chrono_split(_label(s, horizon_weeks, mode)))
    train = s.filter(F.col("is_train") & F.col("label").isNotNull())
    if train.isEmpty():
        return _no_scores(panel, as_of, horizon_weeks, "LSTM", with_metrics)
    lr = LinearRegression(featuresCol="features", labelCol="label", regParam=reg,
                          elasticNetParam=elastic, standardization=True,
                          solver="normal" if elastic == 0.0 else "auto")
    model = lr.fit(train)
    trained = train.select("district_code").distinct()
    last = _last_rows(s).join(trained, "district_code", "left_semi")
    pred = model.transform(last)
    keys = panel.select("district_code").distinct()
    out = _out(keys.join(pred.select("district_code", "prediction"), "district_code", "left"),
               as_of, horizon_weeks, "LSTM")
    if not with_metrics:
        return out
    test = model.transform(s.filter(~F.col("is_train") & F.col("label").isNotNull()))
    return out, fit_metrics(test.select("district_code", F.col("label").alias("y"), F.col("prediction").alias("yhat")))


def model_runs(metrics: DataFrame, model_name: str, as_of, params: dict) -> DataFrame:
    """S14 rows: (run_id, district_code, model_name, as_of, params MAP, metrics MAP)."""
    from riskpanel.functions.scalar import alert_id
    pmap = F.create_map(*[x for k, v in params.items() for x in (F.lit(k), F.lit(str(v)))])
    mmap = F.create_map(*[x for k in ("mae", "mse", "r2") for x in (F.lit(k), F.col(k))])
    return metrics.select(alert_id(F.lit(model_name), F.lit(str(_as_date(as_of))), "district_code").alias("run_id"),
                          "district_code", F.lit(model_name).alias("model_name"),
                          F.lit(_as_date(as_of)).alias("as_of"), pmap.alias("params"), mmap.alias("metrics"))
