"""Forecasters as set-based jobs over all districts.

Input is a daily series per district (``district_code, date, y``), e.g. the
training panel's ``cases_count``; output is long:
``(district_code, prediction_date, prediction_horizon_weeks, model_name, raw_score)``.

P2 and P3 use only window aggregates over one ``partitionBy(district_code)``:
after the single exchange on the district key the whole fit is a chain of
Window nodes on co-partitioned data (no join, no collect). The per-district
partitions hold one row a day of the look-back, whatever the case volume.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel import config as C

PHI_CLIP = 0.99


def _as_date(d):
    return d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d))


def _solve2_sql(s11, s12, s22, t1, t2):
    """Least squares of d on two regressors from moment sums (no intercept)."""
    det = f"CASE WHEN ({s11}) * ({s22}) - ({s12}) * ({s12}) <> 0 THEN ({s11}) * ({s22}) - ({s12}) * ({s12}) END"
    return (f"try_divide(({t1}) * ({s22}) - ({t2}) * ({s12}), {det})",
            f"try_divide(({t2}) * ({s11}) - ({t1}) * ({s12}), {det})")


def _clip_sql(c: str, lim: float = PHI_CLIP) -> str:
    """Clip into [-lim, lim]; a null stays null (least/greatest would skip it)."""
    return f"CASE WHEN {c} IS NOT NULL THEN greatest(-{lim}D, least({lim}D, {c})) END"


def _arima_fit(series: DataFrame, y: str, key: str) -> DataFrame:
    """The series with its differences, residuals and the fitted phi and theta.

    d_t = y_t - y_(t-1); stage 1 regresses d on (d_(t-1), d_(t-2)) and keeps the
    residual e; stage 2 regresses d on (d_(t-1), e_(t-1)) for (phi, theta), both
    clipped to +-0.99. Every step is a window over one ``PARTITION BY district``
    (SQL text)."""
    k = f"`{key}`"
    wo = f"OVER (PARTITION BY {k} ORDER BY date)"
    wa = f"OVER (PARTITION BY {k})"

    def msum(expr, ok):
        return f"sum(CASE WHEN {ok} THEN {expr} END) {wa}"

    s = series.selectExpr(k, "date", f"CAST(`{y}` AS DOUBLE) AS y")
    s = s.selectExpr("*", f"lag(y, 1) {wo} AS lag_y")
    s = s.selectExpr("*", "y - lag_y AS d")
    s = s.selectExpr("*", f"lag(d, 1) {wo} AS x1", f"lag(d, 2) {wo} AS x2")
    s = s.selectExpr("*", "d IS NOT NULL AND x1 IS NOT NULL AND x2 IS NOT NULL AS ok1")
    b1, b2 = _solve2_sql(msum("x1 * x1", "ok1"), msum("x1 * x2", "ok1"), msum("x2 * x2", "ok1"),
                         msum("d * x1", "ok1"), msum("d * x2", "ok1"))
    s = s.selectExpr("*", f"{b1} AS b1", f"{b2} AS b2")
    s = s.selectExpr("*", "CASE WHEN ok1 THEN d - b1 * x1 - b2 * x2 END AS e")
    s = s.selectExpr("*", f"lag(e, 1) {wo} AS el")
    s = s.selectExpr("*", "d IS NOT NULL AND x1 IS NOT NULL AND el IS NOT NULL AS ok2")
    phi, theta = _solve2_sql(msum("x1 * x1", "ok2"), msum("x1 * el", "ok2"), msum("el * el", "ok2"),
                             msum("d * x1", "ok2"), msum("d * el", "ok2"))
    return s.selectExpr("*", f"{_clip_sql(phi)} AS phi", f"{_clip_sql(theta)} AS theta",
                        f"row_number() OVER (PARTITION BY {k} ORDER BY date DESC) AS _rn",
                        f"count(1) {wa} AS n_days")


def arima_111_forecast(series: DataFrame, as_of, horizon_weeks: int = C.DEFAULT_HORIZON_WEEKS,
                       y: str = "y", key: str = "district_code") -> DataFrame:
    """ARIMA(1,1,1) without constant, fitted by Hannan-Rissanen.

    The value H = 7h days ahead is
    y_T + (phi d_T + theta e_T) (1 - phi^H) / (1 - phi). Singular moments and
    series of fewer than 30 days give null."""
    last = _arima_fit(series, y, key).where("_rn = 1").selectExpr(f"`{key}`", f"{_arima_value(horizon_weeks)} AS raw_score")
    return _long(last, as_of, horizon_weeks, "ARIMA", key)


def arima_111_fitted(series: DataFrame, y: str = "y", key: str = "district_code") -> DataFrame:
    """(key, date, y, yhat): one-step fitted values of P3 on its own series, from the
    first day with a fitted residual; none for series of fewer than 30 days."""
    return _arima_fit(series, y, key).where(f"ok2 AND n_days >= {C.MIN_DAYS}").selectExpr(
        f"`{key}`", "date", "y", "lag_y + phi * x1 + theta * el AS yhat")


def _seasonal_fit(series: DataFrame, y: str, key: str) -> DataFrame:
    """The series with its trend and its weekday and month indices (wi, mi);
    columns that are there already stay."""
    k = f"`{key}`"
    wa = f"OVER (PARTITION BY {k})"
    if y != "y" or dict(series.dtypes)["y"] != "double":
        series = series.selectExpr(k, "date", f"CAST(`{y}` AS DOUBLE) AS y")
    s = series.selectExpr("*", f"min(date) {wa} AS d0")
    s = s.selectExpr("*", "CAST(datediff(date, d0) AS DOUBLE) AS t")
    s = s.selectExpr("*", f"regr_slope(y, t) {wa} AS b", f"regr_intercept(y, t) {wa} AS a",
                     "weekday(date) AS wd", "month(date) AS mo")
    s = s.selectExpr("*", "greatest(a + b * t, 1e-6D) AS trend")
    s = s.selectExpr("*", f"try_divide(sum(y) OVER (PARTITION BY {k}, wd), sum(trend) OVER (PARTITION BY {k}, wd)) AS wi")
    s = s.selectExpr("*", f"sum(trend * wi) OVER (PARTITION BY {k}, mo) AS _den",
                     f"sum(y) OVER (PARTITION BY {k}, mo) AS _num")
    return s.selectExpr("*", "try_divide(_num, CASE WHEN _den <> 0 THEN _den END) AS mi",
                        f"count(y) {wa} AS n_values")


def seasonal_trend_forecast(series: DataFrame, as_of, horizon_weeks: int = C.DEFAULT_HORIZON_WEEKS,
                            y: str = "y", key: str = "district_code") -> DataFrame:
    """Multiplicative trend x weekday x month by ratio to trend.

    trend = max(a + b t, 1e-6) from least squares on t = days since the first day;
    weekday index = sum(y) / sum(trend) per weekday; month index =
    sum(y) / sum(trend * weekday index) per month; the forecast at as_of + 7h is
    trend x both indices of that day. Regressors held at their mean add nothing
    to the point forecast, so none is used. A zero denominator, and fewer than
    30 days with a value, give null."""
    g = _seasonal_fit(series, y, key).groupBy(key).agg(*_seasonal_parts(as_of, horizon_weeks))
    return _long(g.selectExpr(f"`{key}`", f"{SEASONAL_VALUE} AS raw_score"), as_of, horizon_weeks, "Prophet", key)


def _seasonal_parts(as_of, horizon_weeks: int) -> list:
    """Aggregates of a fitted series that the forecast of P2 is made of."""
    target = _as_date(as_of) + _dt.timedelta(days=7 * int(horizon_weeks))
    trend = f"greatest(a + b * CAST(datediff(DATE'{target}', d0) AS DOUBLE), 1e-6D)"
    return [F.expr(x) for x in (f"first({trend}) AS trend_f", "first(n_values) AS n_values",
                                f"max(CASE WHEN wd = {target.weekday()} THEN wi END) AS wi_f",
                                f"max(CASE WHEN mo = {target.month} THEN mi END) AS mi_f")]


SEASONAL_VALUE = f"CASE WHEN n_values >= {C.MIN_DAYS} THEN trend_f * wi_f * mi_f END"


def _arima_value(horizon_weeks: int) -> str:
    h = float(7 * int(horizon_weeks))
    return (f"CASE WHEN n_days >= {C.MIN_DAYS} THEN "
            f"y + (phi * d + theta * e) * (1.0D - power(phi, {h}D)) / (1.0D - phi) END")


def statistical_forecasts(series: DataFrame, as_of, horizon_weeks: int = C.DEFAULT_HORIZON_WEEKS,
                          y: str = "y", key: str = "district_code") -> DataFrame:
    """P2 and P3 in one pass: the windows of both models run over one frame, so
    the series is computed and shuffled once; one aggregate per district, two rows."""
    fitted = _seasonal_fit(_arima_fit(series, y, key), "y", key)
    g = fitted.groupBy(key).agg(*_seasonal_parts(as_of, horizon_weeks), F.expr(
        f"max(CASE WHEN _rn = 1 THEN {_arima_value(horizon_weeks)} END) AS arima"))
    rows = g.selectExpr(f"`{key}`", f"stack(2, 'Prophet', {SEASONAL_VALUE}, 'ARIMA', arima) AS (model_name, raw_score)")
    return rows.select(key, F.lit(_as_date(as_of)).alias("prediction_date"),
                       F.lit(int(horizon_weeks)).alias("prediction_horizon_weeks"), "model_name", "raw_score")


def seasonal_trend_fitted(series: DataFrame, y: str = "y", key: str = "district_code") -> DataFrame:
    """(key, date, y, yhat): fitted values of P2 on its own series; none for series
    of fewer than 30 days with a value."""
    return _seasonal_fit(series, y, key).where(f"y IS NOT NULL AND n_values >= {C.MIN_DAYS}").selectExpr(
        f"`{key}`", "date", "y", "trend * wi * mi AS yhat")


def _long(df: DataFrame, as_of, horizon_weeks: int, model: str, key: str) -> DataFrame:
    return df.select(key, F.lit(_as_date(as_of)).alias("prediction_date"),
                     F.lit(int(horizon_weeks)).alias("prediction_horizon_weeks"),
                     F.lit(model).alias("model_name"), F.col("raw_score").cast("double").alias("raw_score"))


def series_from_panel(panel: DataFrame, key: str = "district_code") -> DataFrame:
    return panel.select(key, "date", F.col("cases_count").cast("double").alias("y"))
