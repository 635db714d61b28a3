import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskpanel.functions.scalar import clamp, fallback_flag
from riskpanel.operators.forecast import arima_111_forecast, seasonal_trend_forecast
from riskpanel.plans.predictions import ensemble_predictions

AS_OF = dt.date(2024, 3, 31)


def _series(spark, values, key="D1"):
    start = AS_OF - dt.timedelta(days=len(values) - 1)
    return spark.createDataFrame([(key, start + dt.timedelta(days=i), float(v)) for i, v in enumerate(values)],
                                 "district_code string, date date, y double")


def _score(df):
    return df.select(clamp("raw_score").alias("s"), fallback_flag("raw_score").alias("f")).first()


def test_arima_all_zero_series_falls_back(spark):
    r = _score(arima_111_forecast(_series(spark, [0] * 91), AS_OF, 8))
    assert r.s == 50.0 and r.f


def test_arima_is_finite_and_in_range(spark):
    import random
    rnd = random.Random(42)
    vals = [max(0, int(10 + 5 * rnd.gauss(0, 1))) for _ in range(91)]
    r = _score(arima_111_forecast(_series(spark, vals), AS_OF, 8))
    assert 0.0 <= r.s <= 100.0 and not r.f


def test_seasonal_trend_follows_linear_trend(spark):
    vals = [10 + 0.1 * i for i in range(366)]
    raw = seasonal_trend_forecast(_series(spark, vals), AS_OF, 1).first().raw_score
    # 7 days past the end of a perfect line, indices close to 1
    assert raw == pytest.approx(10 + 0.1 * 372, rel=0.02)


def test_seasonal_all_zero_falls_back(spark):
    r = _score(seasonal_trend_forecast(_series(spark, [0] * 60), AS_OF, 4))
    assert r.s == 50.0 and r.f


def test_ensemble_is_mean_of_model_scores(spark):
    rows = [("D1", AS_OF, 8, m, s) for m, s in [("LSTM", 60.0), ("XGBoost", 55.0), ("Prophet", 65.0), ("ARIMA", 50.0)]]
    df = spark.createDataFrame(rows, "district_code string, prediction_date date, prediction_horizon_weeks int, "
                                     "model_name string, raw_score double")
    out = {r.model_name: r for r in ensemble_predictions([df]).collect()}
    assert out["Ensemble"].risk_score == 57.5
    assert out["Ensemble"].confidence_interval_lower == 46.0 and out["Ensemble"].confidence_interval_upper == 69.0
    assert len(out) == 5


def _panel_like(spark, n, key="D1"):
    start = AS_OF - dt.timedelta(days=n - 1)
    rows = [(key, start + dt.timedelta(days=i), int(3 + (i % 7)), 10.0 + i % 3, 25.0, 50.0, 1.0, 0.0)
            for i in range(n)]
    return spark.createDataFrame(rows, "district_code string, date date, cases_count long, rainfall_mm double, "
                                       "temperature_celsius double, humidity_percent double, "
                                       "water_area_sqkm double, flood_risk_score double")


def test_sequence_model_short_series_gives_default(spark):
    from riskpanel.operators.learn import sequence_forecast
    # 15 days: one window, none for training in that district -> 50.0
    short = _panel_like(spark, 15, "S1")
    longer = _panel_like(spark, 60, "L1")
    out = sequence_forecast(short.unionByName(longer), AS_OF, 8)
    got = {r.district_code: r for r in out.select("district_code", clamp("raw_score").alias("s"),
                                                  fallback_flag("raw_score").alias("f")).collect()}
    assert got["S1"].s == 50.0 and got["S1"].f
    assert 0.0 <= got["L1"].s <= 100.0 and not got["L1"].f


def test_boosted_is_repeatable_and_bounded(spark):
    from riskpanel.operators.learn import boosted_forecast
    p = _panel_like(spark, 90)
    a = boosted_forecast(p, AS_OF, 8, trees=5, depth=3).select(clamp("raw_score")).first()[0]
    b = boosted_forecast(p, AS_OF, 8, trees=5, depth=3).select(clamp("raw_score")).first()[0]
    assert a == b and 0.0 <= a <= 100.0


def test_boosted_learns_constant_series(spark):
    from riskpanel.operators.learn import boosted_forecast
    p = _panel_like(spark, 60).withColumn("cases_count", F.lit(7).cast("long"))
    raw = boosted_forecast(p, AS_OF, 8, trees=10, depth=3).first().raw_score
    assert raw == pytest.approx(7.0, abs=0.01)


def test_direct_mode_uses_future_label(spark):
    from riskpanel.operators.learn import boosted_forecast, sequence_forecast
    p = _panel_like(spark, 120)
    a = boosted_forecast(p, AS_OF, 1, trees=5, depth=3, mode="direct").first().raw_score
    b = sequence_forecast(p, AS_OF, 1, mode="direct").first().raw_score
    assert a is not None and b is not None
    with pytest.raises(ValueError):
        boosted_forecast(p, AS_OF, 1, trees=2, depth=2, mode="bogus")


@pytest.mark.parametrize("model", [arima_111_forecast, seasonal_trend_forecast])
def test_fewer_than_30_days_fall_back(spark, model):
    assert _score(model(_series(spark, [3 + i % 7 for i in range(29)]), AS_OF, 0)).s == 50.0
    assert not _score(model(_series(spark, [3 + i % 7 for i in range(30)]), AS_OF, 0)).f


def test_one_pass_equals_the_single_models(spark):
    from riskpanel.operators.forecast import statistical_forecasts
    s = _series(spark, [5 + (i * 7) % 11 for i in range(200)]).unionByName(_series(spark, [1] * 10, "D2"))
    single = arima_111_forecast(s, AS_OF, 4).unionByName(seasonal_trend_forecast(s, AS_OF, 4))
    key = lambda df: {(r.district_code, r.model_name): r.raw_score for r in df.collect()}
    assert key(statistical_forecasts(s, AS_OF, 4)) == pytest.approx(key(single))


def test_a_lone_short_district_scores_the_default(spark):
    from riskpanel.operators.learn import boosted_forecast, sequence_forecast
    short = _panel_like(spark, 15)
    r = _score(sequence_forecast(short, AS_OF, 8))
    assert r.s == 50.0
    assert 0.0 <= _score(boosted_forecast(short, AS_OF, 8, trees=2, depth=2)).s <= 100.0
    none = short.limit(0)
    for f in (sequence_forecast, boosted_forecast):
        assert f(none, AS_OF, 8).count() == 0


def test_boosting_holds_with_500_districts(spark):
    from riskpanel.operators.learn import boosted_forecast
    one = _panel_like(spark, 10)
    many = one.drop("district_code").crossJoin(spark.range(500).select(F.format_string("K%03d", "id").alias("district_code")))
    out = boosted_forecast(many, AS_OF, 8, trees=2, depth=2)
    assert out.count() == 500 and out.filter("raw_score IS NULL OR isnan(raw_score)").count() == 0


def _plain_boosting(x, y, train, trees, depth, rate):
    """Predictions of all rows, by loops over rows, features and cuts."""
    def mids(f):
        v = sorted({x[i][f] for i in train})
        return [(a + b) / 2 for a, b in zip(v, v[1:])]
    places = [mids(f) for f in range(len(x[0]))]

    def grow(rows, level, rest):
        g, n = sum(rest[i] for i in rows), len(rows)
        tried = []
        for f, at in enumerate(places):
            for c in at:
                left = [i for i in rows if x[i][f] <= c]
                if level < depth and 0 < len(left) < n:
                    gl = sum(rest[i] for i in left)
                    tried.append((gl * gl / (len(left) + 1) + (g - gl) ** 2 / (n - len(left) + 1) - g * g / (n + 1), f, c))
        best = max((t[0] for t in tried), default=0)
        if best <= 1e-6:
            return rate * g / (n + 1)
        _, f, c = next(t for t in tried if t[0] >= best - 1e-9 * best)
        return (f, c, grow([i for i in rows if x[i][f] <= c], level + 1, rest),
                grow([i for i in rows if x[i][f] > c], level + 1, rest))

    def read(tree, row):
        while isinstance(tree, tuple):
            tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
        return tree
    score = [sum(y[i] for i in train) / len(train)] * len(x)
    for _ in range(trees):
        tree = grow(train, 0, {i: y[i] - score[i] for i in train})
        score = [s + read(tree, r) for s, r in zip(score, x)]
    return score


def test_every_district_has_the_trees_of_a_plain_loop(spark):
    import random

    from riskpanel.operators.learn import boosted_features, boosted_forecast
    rnd = random.Random(5)
    start = AS_OF - dt.timedelta(days=59)
    rows = [(d, start + dt.timedelta(days=i), rnd.randrange(20) + (40 if d == "B" else 0), rnd.random() * 9,
             20 + rnd.random(), 50.0, rnd.random(), 0.0) for d, n in (("A", 60), ("B", 45), ("C", 1)) for i in range(n)]
    panel = spark.createDataFrame(rows, _panel_like(spark, 1).schema)
    out, metrics = boosted_forecast(panel, AS_OF, 8, trees=6, depth=3, with_metrics=True)
    got, fit = {r.district_code: r.raw_score for r in out.collect()}, {r.district_code: r.mae for r in metrics.collect()}
    assert got["C"] is None and set(fit) == {"A", "B"}  # one day: nothing to train on
    df, feats = boosted_features(panel)
    for d, n in (("A", 60), ("B", 45)):
        days = df.filter(F.col("district_code") == d).orderBy("date").collect()
        x, y = [[r[f] for f in feats] for r in days], [float(r.cases_count) for r in days]
        want = _plain_boosting(x, y, list(range(int(0.8 * n))), 6, 3, 0.1)
        assert got[d] == pytest.approx(want[-1], rel=1e-9)
        held = range(int(0.8 * n), n)
        assert fit[d] == pytest.approx(sum(abs(y[i] - want[i]) for i in held) / len(held), rel=1e-9)
