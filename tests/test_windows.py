import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskpanel.operators import windows as W


def _series(spark, values, key="D1"):
    start = dt.date(2024, 1, 1)
    rows = [(key, start + dt.timedelta(days=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "district_code string, date date, y double")


def test_rolling_min_periods_one_has_no_nulls(spark):
    # 31 daily counts 1..31, windows 7 and 14 with min_periods=1: 31 values, none null
    df = _series(spark, [float(i) for i in range(1, 32)])
    out = W.rolling_mean(df, {"y": "y"}, [7, 14]).orderBy("date").collect()
    assert len(out) == 31
    assert all(r.y_roll_7 is not None and r.y_roll_14 is not None for r in out)
    assert out[0].y_roll_7 == 1.0 and out[-1].y_roll_7 == sum(range(25, 32)) / 7


def test_strict_rolling_is_null_until_full(spark):
    df = _series(spark, [1.0, None, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0])
    out = W.rolling_mean_strict(df, {"y": "y"}, [3]).orderBy("date").collect()
    got = [r.y_roll_3 for r in out]
    assert got[:4] == [None, None, None, None]
    assert got[4] == 4.0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(0, 50)), min_size=1, max_size=40))
def test_lag_and_rolling_match_python_loop(spark, values):
    vals = [None if v is None else float(v) for v in values]
    df = _series(spark, vals)
    df = W.lags(df, {"y": "y"}, [1, 7])
    df = W.rolling_mean(df, {"y": "y"}, [7])
    out = df.orderBy("date").collect()
    for i, r in enumerate(out):
        assert r.y_lag_1 == (vals[i - 1] if i >= 1 else None)
        assert r.y_lag_7 == (vals[i - 7] if i >= 7 else None)
        window = [v for v in vals[max(0, i - 6): i + 1] if v is not None]
        exp = sum(window) / len(window) if window else None
        assert (r.y_roll_7 is None and exp is None) or abs(r.y_roll_7 - exp) < 1e-9


def test_mean_fill_keeps_all_null_column(spark):
    df = spark.createDataFrame([("A", 1.0, None), ("A", None, None), ("B", None, None)],
                               "district_code string, a double, b double")
    out = {(r.district_code, r.a) for r in W.mean_fill(df, ["a", "b"]).collect()}
    assert out == {("A", 1.0), ("B", None)}


def test_sequence_window_drops_short_history(spark):
    df = _series(spark, [float(i) for i in range(20)]).withColumnRenamed("y", "cases_count")
    s = W.sequence_window(df, ["cases_count"], 14).orderBy("date").collect()
    assert len(s) == 6
    assert [x.cases_count for x in s[0].seq] == [float(i) for i in range(14)]


def test_chrono_split_floor(spark):
    df = _series(spark, [1.0] * 15)
    out = W.chrono_split(df).filter("is_train").count()
    assert out == 12


def test_first_per_key_and_latest(spark):
    df = spark.createDataFrame([(3, "D1", 8, dt.date(2024, 1, 2)), (1, "D1", 8, dt.date(2024, 1, 1)),
                                (2, "D1", 4, dt.date(2024, 1, 3))],
                               "id long, district_code string, prediction_horizon_weeks int, prediction_date date")
    first = W.first_per_key(df, ["district_code", "prediction_horizon_weeks"]).orderBy("id").collect()
    assert [r.id for r in first] == [1, 2]
    latest = W.latest_prediction(df.withColumn("model_name", F.lit("ARIMA"))).orderBy("id").collect()
    assert [r.id for r in latest] == [2, 3]
