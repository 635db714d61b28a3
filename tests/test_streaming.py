from pyspark.sql import functions as F

from riskpanel.operators.aggregates import daily_cases
from riskpanel.operators.state import generate_alerts
from riskpanel.session import scratch_path
from riskpanel.sources.bindings import EVENTS_AS_OF, EVENTS_AS_OF_TS
from riskpanel.streaming import streams as St


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_daily_counts_equal_batch_on_closed_days(spark, tables):
    src = scratch_path(spark, "t-src")
    tables.cases.write.parquet(src)
    out, ck = scratch_path(spark, "t-out"), scratch_path(spark, "t-ck")
    St.run_daily_case_counts(spark, src, out, ck).awaitTermination()
    streamed = St.read_daily_counts(spark, out)
    last = tables.cases.agg(F.max("case_date")).first()[0]
    batch = daily_cases(tables.cases).filter(F.col("date") <= F.date_sub(F.lit(last), 2))
    assert _rows(streamed.select("district_code", "date", "cases_count")) == \
        _rows(batch.select("district_code", "date", "cases_count"))


def test_stream_ingest_drops_repeats(spark, tables):
    src = scratch_path(spark, "t-json")
    rec = tables.cases.select(F.to_json(F.struct("case_id", "district_code",
                                                 F.date_format("case_date", "yyyy-MM-dd").alias("case_date"))).alias("v"))
    rec.unionAll(rec.limit(5)).write.text(src)
    out, bad, ck = scratch_path(spark, "t-ing"), scratch_path(spark, "t-ing-bad"), scratch_path(spark, "t-ing-ck")
    St.stream_ingest_cases(spark, src, out, bad, ck).awaitTermination()
    got = St.read_ingested(spark, out)
    assert got.count() == tables.cases.count() == got.select("case_id").distinct().count()
    assert spark.read.parquet(bad).agg(F.sum("n_rows")).first()[0] == 5


def test_stream_ingest_keeps_late_records_and_accounts_for_every_row(spark, tmp_dir):
    import os
    src, out, bad, ck = (os.path.join(tmp_dir, x) for x in ("src", "out", "bad", "ck"))

    def feed(*records):
        spark.createDataFrame([(r,) for r in records], "value string").coalesce(1).write.mode("append").text(src)
        St.stream_ingest_cases(spark, src, out, bad, ck).awaitTermination()

    def case(i, day):
        return f'{{"case_id":"{i}","district_code":"D1","case_date":"{day}"}}'
    feed(case("A", "2024-06-01"), case("B", "2024-06-01"), case("B", "2024-06-02"))
    feed(case("C", "2024-01-01"), case("A", "2024-06-03"), "nonsense")
    feed(case("C", "2024-01-01"))
    rows = {r.case_id: str(r.case_date) for r in St.read_ingested(spark, out).collect()}
    assert rows == {"A": "2024-06-01", "B": "2024-06-01", "C": "2024-01-01"}
    assert spark.read.parquet(bad).agg(F.sum("n_rows")).first()[0] == 4


def test_daily_counts_count_late_rows(spark, tmp_dir):
    import datetime as dt
    import os
    from riskpanel import schemas
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("src", "out", "ck"))
    for days in ([10, 12, 14], [5, 13], [20]):
        rows = [(i, f"C{d}", "D1", None, dt.date(2024, 1, d), *[None] * 7) for i, d in enumerate(days)]
        spark.createDataFrame(rows, schemas.CASES).write.mode("append").parquet(src)
        St.run_daily_case_counts(spark, src, out, ck).awaitTermination()
    got = {r.date.day: (r.cases_count, r.late_cases) for r in St.read_daily_counts(spark, out).collect()}
    assert got == {5: (1, 1), 10: (1, 0), 12: (1, 0), 13: (1, 0), 14: (1, 0)}


def test_stream_alerts_equal_batch(spark, tables):
    preds, alerts = scratch_path(spark, "t-p"), scratch_path(spark, "t-a")
    tables.predictions.write.parquet(preds)
    tables.alerts.write.parquet(alerts)
    out, ck = scratch_path(spark, "t-na"), scratch_path(spark, "t-na-ck")
    St.run_stream_alerts(spark, preds, alerts, out, ck, EVENTS_AS_OF, EVENTS_AS_OF_TS).awaitTermination()
    streamed = spark.read.parquet(out)
    batch = generate_alerts(tables.predictions, tables.alerts, EVENTS_AS_OF, EVENTS_AS_OF_TS)
    assert _rows(streamed.select("alert_id", "severity")) == _rows(batch.select("alert_id", "severity"))


def test_stream_daily_counts_drop_rows_later_than_watermark(spark, tmp_dir):
    import datetime as dt
    import os
    import time
    from riskpanel import schemas
    src = os.path.join(tmp_dir, "src")

    def batch(days, name):
        rows = [(i, f"C{name}{i}", "D1", None, d, None, None, None, None, None, None, None)
                for i, d in enumerate(days)]
        spark.createDataFrame(rows, schemas.CASES).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)  # distinct modification times keep the file order

    base = dt.date(2024, 1, 10)
    batch([base + dt.timedelta(days=i) for i in range(11)], "a")          # days 10..20
    batch([base + dt.timedelta(days=8)], "b")                             # day 18: in time
    # Spark filters late rows against the watermark of the previous batch, so
    # the late row comes in the third batch: day 5 < 19 (= 20 - 1 day)
    batch([dt.date(2024, 1, 5)], "c")
    out, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")
    q = (St.daily_case_counts(spark.readStream.schema(schemas.CASES).option("maxFilesPerTrigger", 1).parquet(src))
         .writeStream.outputMode("append").format("parquet").option("path", out)
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    got = {str(r.date): r.cases_count for r in spark.read.parquet(out).collect()}
    assert "2024-01-05" not in got              # later than the watermark: dropped
    assert got["2024-01-18"] == 2               # on time in the second batch: counted
    assert "2024-01-19" not in got              # window ends after the last watermark: still open


def test_stream_alerts_suppress_across_batches(spark, tables, tmp_dir):
    import os
    import time
    preds, alerts = os.path.join(tmp_dir, "p"), os.path.join(tmp_dir, "a")
    mid = tables.predictions.approxQuantile("id", [0.5], 0.0)[0]
    tables.predictions.filter(F.col("id") < mid).coalesce(1).write.parquet(preds)
    time.sleep(1.1)
    tables.predictions.filter(F.col("id") >= mid).coalesce(1).write.mode("append").parquet(preds)
    tables.alerts.write.parquet(alerts)
    out, ck = os.path.join(tmp_dir, "o"), os.path.join(tmp_dir, "ck")
    q = St.run_stream_alerts(spark, preds, alerts, out, ck, EVENTS_AS_OF, EVENTS_AS_OF_TS, max_files_per_trigger=1)
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 2
    streamed = spark.read.parquet(out)
    batch = generate_alerts(tables.predictions, tables.alerts, EVENTS_AS_OF, EVENTS_AS_OF_TS)
    assert streamed.groupBy("district_code", "prediction_horizon_weeks").count().filter("count > 1").count() == 0
    assert _rows(streamed.select("alert_id")) == _rows(batch.select("alert_id"))


def test_stream_days_do_not_depend_on_session_time_zone(spark, tables):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        src = scratch_path(spark, "tz-src")
        tables.cases.write.parquet(src)
        out, ck = scratch_path(spark, "tz-out"), scratch_path(spark, "tz-ck")
        St.run_daily_case_counts(spark, src, out, ck).awaitTermination()
        streamed = St.read_daily_counts(spark, out)
        last = tables.cases.agg(F.max("case_date")).first()[0]
        batch = daily_cases(tables.cases).filter(F.col("date") <= F.date_sub(F.lit(last), 2))
        assert _rows(streamed.select("district_code", "date", "cases_count")) == \
            _rows(batch.select("district_code", "date", "cases_count"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_many_batches_are_read_from_few_runs(spark, tmp_dir):
    import datetime as dt
    from riskpanel.streaming.runs import Runs
    schema = St.PARTIAL_COUNT
    out = f"{tmp_dir}/runs"
    runs = St._count_runs(spark, out)
    day = dt.date(2024, 1, 1)
    for e in range(50):
        runs.add(spark.createDataFrame([("D1", day, 1, None), (f"D{e % 3}", day, 2, None)], schema).coalesce(1), e)
        assert len(runs.live()) <= 3 * 3
        assert [x for a, b in runs.live() for x in range(a, b + 1)] == list(range(e + 1))
    assert runs.live() == [(0, 15), (16, 31), (32, 47), (48, 48), (49, 49)]
    got = {r["district_code"]: r["n"] for r in runs.read().groupBy("district_code").agg(F.sum("cases_count").alias("n")).collect()}
    assert got == {"D0": 34, "D1": 50 + 34, "D2": 32}
    runs.add(spark.createDataFrame([("D1", day, 99, None)], schema), 20)  # a replay of a merged batch
    runs.add(spark.createDataFrame([("D1", day, 1, None), ("D1", day, 2, None)], schema), 49)  # and of the last
    assert {r[0]: r[1] for r in runs.read().groupBy("district_code").agg(F.sum("cases_count")).collect()} == got
    assert runs.read(before=16).agg(F.sum("cases_count")).first()[0] == 16 * 3
    assert Runs(spark, f"{tmp_dir}/none", schema).read().count() == 0


def test_a_batch_reads_the_buckets_of_its_ids_only(spark, tmp_dir):
    src, out, bad, ck = (f"{tmp_dir}/{x}" for x in ("src", "out", "bad", "ck"))
    held = spark.createDataFrame([("H1",)], "case_id string")

    def feed(*ids):
        spark.createDataFrame([(f'{{"case_id":"{i}","district_code":"D1","case_date":"2024-06-01"}}',) for i in ids],
                              "value string").coalesce(1).write.mode("append").text(src)
        St.stream_ingest_cases(spark, src, out, bad, ck, held).awaitTermination()

    feed(*[f"C{i}" for i in range(300)])
    feed("C5", "N1", "H1")
    assert St.read_ingested(spark, out).count() == 301
    assert {r["record"][12:14]: r["reason"] for r in spark.read.parquet(bad).collect()} == {
        "C5": "case_id already stored", "H1": "case_id already stored"}
    ids = spark.read.schema(St.STORED_ID).parquet(f"{out}_ids/run=0-0")
    few = St.stored_ids(ids, spark.createDataFrame([("C5",)], "case_id string"))
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [(bucket" in plan or "bucket#" in plan.split("PartitionFilters")[1][:60]
    assert 0 < few.count() < 20


def test_alerts_read_the_folders_of_a_week(spark, tables, tmp_dir):
    import datetime as dt
    preds, alerts, out, ck = (f"{tmp_dir}/{x}" for x in ("p", "a", "o", "ck"))
    tables.alerts.limit(0).write.parquet(alerts)
    row = tables.predictions.filter("model_name = 'Ensemble'").limit(1)
    raised = []
    for k, day in enumerate((1, 4, 8, 9, 20)):
        row.withColumn("id", F.lit(1000 + k).cast("long")).withColumn("risk_score", F.lit(95.0).cast(row.schema["risk_score"].dataType)) \
            .withColumn("prediction_date", F.lit(dt.date(2024, 3, day))).select(*row.columns).write.mode("append").parquet(preds)
        St.run_stream_alerts(spark, preds, alerts, out, ck).awaitTermination()
        raised = sorted(str(r["triggered_at"])[:10] for r in spark.read.parquet(out).collect())
    # an alert of the 1st suppresses up to the 8th; that of the 9th is out of the 20th's week
    assert raised == ["2024-03-01", "2024-03-09", "2024-03-20"]
