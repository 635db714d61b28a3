import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskpanel.operators import state as S
from riskpanel.sources.bindings import EVENTS_AS_OF, EVENTS_AS_OF_TS


def test_alert_from_score_80(spark, tables):
    # one Ensemble prediction scoring 80.0 -> one 'high' alert
    p = spark.createDataFrame([(1, "D001", EVENTS_AS_OF, 8, 80.0, "Ensemble")],
                              "id long, district_code string, prediction_date date, "
                              "prediction_horizon_weeks int, risk_score double, model_name string")
    out = S.generate_alerts(p, tables.alerts.limit(0), EVENTS_AS_OF, EVENTS_AS_OF_TS).collect()
    assert len(out) == 1 and out[0].severity == "high" and out[0].status == "active"


def test_generate_alerts_twice_adds_nothing(spark, tables):
    new = S.generate_alerts(tables.predictions, tables.alerts, EVENTS_AS_OF, EVENTS_AS_OF_TS)
    n = new.count()
    assert n > 0
    after = S.append_alerts(tables.alerts, new)
    assert after.count() == tables.alerts.count() + n
    again = S.generate_alerts(tables.predictions, after, EVENTS_AS_OF, EVENTS_AS_OF_TS)
    assert again.count() == 0


def test_at_most_one_alert_per_key(spark, tables):
    new = S.generate_alerts(tables.predictions, tables.alerts, EVENTS_AS_OF, EVENTS_AS_OF_TS)
    assert new.groupBy("district_code", "prediction_horizon_weeks").count().filter("count > 1").count() == 0
    assert new.filter(F.col("severity") == "low").count() == 0


def test_upsert_last_id_wins(spark):
    schema = "id long, k string, v double"
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], schema)
    new = spark.createDataFrame([(3, "a", 10.0), (4, "a", 11.0), (5, "c", 5.0)], schema)
    got = {r.k: r.v for r in S.upsert(old, new, ["k"]).collect()}
    assert got == {"a": 11.0, "b": 2.0, "c": 5.0}


def test_acknowledge_and_unknown_ids(spark, tables):
    ids = [r.alert_id for r in tables.alerts.filter("status = 'active'").limit(2).collect()]
    actions = spark.createDataFrame([(ids[0], "ann"), ("A-missing", "bob")], "alert_id string, acknowledged_by string")
    out = S.acknowledge(tables.alerts, actions, EVENTS_AS_OF_TS)
    r = out.filter(F.col("alert_id") == ids[0]).first()
    assert r.status == "acknowledged" and r.acknowledged_by == "ann"
    assert r.acknowledged_at == EVENTS_AS_OF_TS and r.updated_at == EVENTS_AS_OF_TS
    assert out.count() == tables.alerts.count()
    assert [x.alert_id for x in S.unknown_ids(actions, tables.alerts).collect()] == ["A-missing"]


def test_updated_at_only_when_changed(spark, tables):
    active = tables.alerts.filter("status = 'active'").first()
    upd = spark.createDataFrame([(active.alert_id, "active")], "alert_id string, status string")
    r = S.apply_updates(tables.alerts, upd, "alert_id", EVENTS_AS_OF_TS).filter(
        F.col("alert_id") == active.alert_id).first()
    assert r.updated_at == active.updated_at


@settings(max_examples=10, deadline=None)
@given(st.integers(0, 40))
def test_retain_keeps_plus_drops_is_all(spark, tables, days):
    kp, ka, pc, ac = S.retain(tables.predictions, tables.alerts, EVENTS_AS_OF, days)
    p, a = pc.first(), ac.first()
    assert p.old_predictions_deleted + p.predictions_kept == tables.predictions.count()
    assert kp.count() == p.predictions_kept
    assert a.old_alerts_deleted + a.alerts_kept == tables.alerts.count() == ka.count() + a.old_alerts_deleted


def test_models_to_rows(spark):
    wide = spark.createDataFrame([("D1", 8, 1.0, None, 3.0, 4.0, 5.0)],
                                 "district_code string, h int, LSTM double, XGBoost double, Prophet double, "
                                 "ARIMA double, Ensemble double")
    rows = S.models_to_rows(wide, ["district_code", "h"]).collect()
    assert sorted(r.model_name for r in rows) == ["ARIMA", "Ensemble", "LSTM", "Prophet"]


def test_daily_run_gate_stages(spark, tables):
    """Post-fill (the application's gate) only districts whose climate column is
    entirely missing fail (sf0.001 has 15 without climate rows); pre-fill the
    unfilled calendar is judged, so at least those fail too. Predictions are
    made for passing districts only, and the summary counts the failures."""
    from pyspark.sql import functions as F
    from riskpanel.plans.jobs import predict_and_alert
    args = (tables.cases, tables.climate, tables.water, tables.districts, tables.predictions,
            tables.alerts, "2001-08-01")
    post = predict_and_alert(*args, learned=False)
    pre = predict_and_alert(*args, learned=False, gate_stage="pre_fill")
    with_climate = {r.district_code for r in tables.climate.filter(
        F.col("date").between(F.lit("2000-08-01").cast("date"), F.lit("2001-08-01").cast("date")))
        .select("district_code").distinct().collect()}
    post_ok = {r.district_code for r in post.gate.filter("passed").collect()}
    assert post_ok == with_climate and 0 < len(post_ok) < 25
    assert {r.reason for r in post.gate.filter("NOT passed").collect()} == {"low_completeness"}
    pre_ok = {r.district_code for r in pre.gate.filter("passed").collect()}
    assert pre_ok <= post_ok
    for run, ok in ((post, post_ok), (pre, pre_ok)):
        s = {r.metric: r.value for r in run.summary.collect()}
        assert s["failed_predictions"] == 25 - len(ok) and s["successful_predictions"] == len(ok)
        assert {r.district_code for r in run.new_predictions.select("district_code").distinct().collect()} == ok


def test_raise_acknowledge_rerun_gives_new_ids_that_fit(spark, tables):
    from riskpanel.operators.quality import fits_type_report
    alerts = tables.alerts.limit(0)
    first = S.generate_alerts(tables.predictions, alerts, EVENTS_AS_OF, f"{EVENTS_AS_OF} 09:00:00")
    table = S.append_alerts(alerts, first)
    assert S.append_alerts(table, first).count() == table.count()  # a repeated run adds nothing
    actions = table.select("alert_id", F.lit("ann").alias("acknowledged_by"))
    table = S.acknowledge(table, actions, f"{EVENTS_AS_OF} 10:00:00")
    again = S.generate_alerts(tables.predictions, table, EVENTS_AS_OF, f"{EVENTS_AS_OF} 15:00:00")
    table = S.append_alerts(table, again)
    assert table.count() == 2 * first.count() == table.select("alert_id").distinct().count() > 0
    assert fits_type_report({"alerts": table}).filter("column_name = 'alert_id' AND violations > 0").count() == 0


def test_suppression_looks_back_whole_days(spark, tables):
    p = tables.predictions.filter("model_name = 'Ensemble' AND risk_score >= 50").orderBy(F.desc("prediction_date")).limit(1)
    row = p.first()
    live = tables.alerts.limit(1).select(*[
        F.lit(row.district_code).alias(c) if c == "district_code"
        else F.lit(row.prediction_horizon_weeks).alias(c) if c == "prediction_horizon_weeks"
        else F.lit("active").alias(c) if c == "status"
        else F.lit("2024-01-23 09:00:00").cast("timestamp_ntz").alias(c) if c == "triggered_at" else F.col(c)
        for c in tables.alerts.columns])
    p = p.withColumn("prediction_date", F.lit("2024-01-30").cast("date"))
    for hour in ("00:00:00", "15:00:00"):
        assert S.generate_alerts(p, live, "2024-01-30", f"2024-01-30 {hour}").count() == 0
    assert S.generate_alerts(p, live, "2024-01-31", "2024-01-31 00:00:00").count() == 1


def test_updates_of_one_key_do_not_multiply_rows(spark, tables):
    i = tables.alerts.first().alert_id
    upd = spark.createDataFrame([(i, "active"), (i, "resolved")], "alert_id string, status string")
    out = S.apply_updates(tables.alerts, upd, "alert_id", EVENTS_AS_OF_TS)
    assert out.count() == tables.alerts.count() and out.filter(F.col("alert_id") == i).first().status == "resolved"


def test_the_latest_action_wins(spark, tables):
    i = tables.alerts.filter("status = 'active'").first().alert_id
    acts = spark.createDataFrame([(i, "zoe", 1), (i, "ann", 2)], "alert_id string, acknowledged_by string, acted_at int")
    assert S.acknowledge(tables.alerts, acts, EVENTS_AS_OF_TS).filter(F.col("alert_id") == i).first().acknowledged_by == "ann"


def test_unknown_models_are_refused(tables):
    import pytest as _pytest
    from riskpanel.plans.jobs import TrainingRequest
    assert TrainingRequest().models() == ("XGBoost", "Prophet", "ARIMA") and TrainingRequest("LSTM").models() == ("LSTM",)
    for name in ("Ensemble", "Oracle", ""):
        with _pytest.raises(ValueError):
            TrainingRequest(name).models()


def test_training_covers_the_requested_start(spark, tables):
    import datetime as _dt
    from riskpanel.plans.jobs import TrainingRequest, weekly_training
    long = weekly_training(tables, "2001-08-01", TrainingRequest("Prophet", ["D003", "D007"], _dt.date(1999, 8, 1)))
    short = weekly_training(tables, "2001-08-01", TrainingRequest("Prophet", ["D003", "D007"]))
    a, b = ({r.district_code: r.metrics["mae"] for r in x.collect()} for x in (long, short))
    assert a and (not b or a != b)
