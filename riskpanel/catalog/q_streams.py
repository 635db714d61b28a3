"""Streaming queries (2.11): the stream runs to completion on files written
from the bound tables (availableNow trigger) and its sink is read back."""

from pyspark.sql import functions as F

from riskpanel.catalog.base import CASES_AS_OF, EVENTS_AS_OF, EVENTS_AS_OF_TS, minus, register
from riskpanel.catalog.q_state import GEN_SQL
from riskpanel.session import scratch_path
from riskpanel.streaming import streams as St


@register("stream_daily_cases", "R2", """
SELECT district_code, case_date AS date, count(*) AS cases_count FROM cases
WHERE case_date < (SELECT max(case_date) FROM cases) - INTERVAL 1 DAY GROUP BY ALL""")
def q_stream_daily_cases(t):
    """Daily counts per district from a file stream of cases (closed days only)."""
    sp = t.spark
    src = scratch_path(sp, "cases-stream-src")
    t.cases.write.parquet(src)
    out, ck = scratch_path(sp, "daily-stream-out"), scratch_path(sp, "daily-stream-ck")
    St.run_daily_case_counts(sp, src, out, ck).awaitTermination()
    return St.read_daily_counts(sp, out).drop("late_cases")


@register("stream_daily_cases_state", "R2", """
SELECT district_code, case_date AS date, count(*) AS cases_count FROM cases
WHERE case_date < (SELECT max(case_date) FROM cases) - INTERVAL 1 DAY GROUP BY ALL""")
def q_stream_daily_cases_state(t):
    """The same from Spark's own state: event-time windows closed by the watermark."""
    sp = t.spark
    src, out, ck = (scratch_path(sp, f"state-stream-{x}") for x in ("src", "out", "ck"))
    t.cases.write.parquet(src)
    stream = sp.readStream.schema(t.cases.schema).parquet(src)
    (St.daily_case_counts(stream).writeStream.outputMode("append").format("parquet").option("path", out)
     .option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination())
    return sp.read.schema(St.DAY_COUNT).parquet(out)


@register("stream_daily_cases_many", "R2", """
WITH d_ AS (SELECT district_code, case_date AS date, count(*) AS cases_count FROM cases GROUP BY ALL)
SELECT * FROM d_ WHERE date < (SELECT max(case_date) FROM cases) - INTERVAL 1 DAY""")
def q_stream_daily_cases_many(t):
    """Daily counts kept over many micro-batches in levelled runs."""
    sp = t.spark
    src, out, ck = (scratch_path(sp, f"many-stream-{x}") for x in ("src", "out", "ck"))
    t.cases.repartition(9).write.parquet(src)
    St.run_daily_case_counts(sp, src, out, ck, max_files_per_trigger=1).awaitTermination()
    return St.read_daily_counts(sp, out).drop("late_cases")


SPLIT = minus(CASES_AS_OF, 120)


@register("stream_daily_cases_late", "R2", f"""
WITH d_ AS (SELECT district_code, case_date AS date, count(*) AS cases_count FROM cases GROUP BY ALL)
SELECT *, CASE WHEN date < DATE '{SPLIT}' THEN cases_count ELSE 0 END AS late_cases
FROM d_ WHERE date < (SELECT max(case_date) FROM cases) - INTERVAL 1 DAY""")
def q_stream_daily_cases_late(t):
    """The same with the older cases arriving in a later micro-batch than the newer
    ones: all are counted, and those of closed days are told apart as late."""
    sp = t.spark
    src = scratch_path(sp, "cases-late-src")
    cut = F.lit(SPLIT).cast("date")
    out, ck = scratch_path(sp, "late-stream-out"), scratch_path(sp, "late-stream-ck")
    for part in (t.cases.filter(F.col("case_date") >= cut), t.cases.filter(F.col("case_date") < cut)):
        part.write.mode("append").parquet(src)
        St.run_daily_case_counts(sp, src, out, ck).awaitTermination()
    return St.read_daily_counts(sp, out)


@register("stream_ingest_cases", "R1", """
SELECT case_id, district_code, facility_code, case_date, age_group, gender, case_status,
       coalesce(lab_confirmed, false) AS lab_confirmed, outcome FROM cases""")
def q_stream_ingest_cases(t):
    """JSON case records streamed from files, parsed, checked and stored once per id."""
    sp = t.spark
    src = scratch_path(sp, "cases-json-src")
    _case_json(t.cases).write.text(src)
    out, bad, ck = (scratch_path(sp, f"ingest-stream-{x}") for x in ("out", "bad", "ck"))
    St.stream_ingest_cases(sp, src, out, bad, ck).awaitTermination()
    return St.read_ingested(sp, out)


def _case_json(cases):
    return cases.select(F.to_json(F.struct(
        "case_id", "district_code", "facility_code", F.date_format("case_date", "yyyy-MM-dd").alias("case_date"),
        "age_group", "gender", "case_status", "lab_confirmed", "outcome")).alias("value"))


@register("stream_ingest_cases_batches", "R1", f"""
WITH n_ AS (SELECT case_id, case_date, id, CASE WHEN id % 13 = 0 THEN 'NOPE' ELSE district_code END AS district_code FROM cases),
ok_ AS (SELECT * FROM n_ WHERE district_code <> 'NOPE')
SELECT 'stored' AS result, 'stored' AS reason, count(*) AS n_rows FROM ok_ WHERE id % 5 <> 0
UNION ALL SELECT 'rejected', 'case_id already stored', count(*) FILTER (WHERE id % 5 = 0)
         + count(*) FILTER (WHERE case_date >= DATE '{SPLIT}') FROM ok_
UNION ALL SELECT 'rejected', 'unknown district', (SELECT count(*) FROM n_ WHERE district_code = 'NOPE')
         + (SELECT count(*) FROM n_ WHERE district_code = 'NOPE' AND case_date >= DATE '{SPLIT}')
UNION ALL SELECT 'rejected', 'invalid record', 3""")
def q_stream_ingest_cases_batches(t):
    """Several micro-batches: the newest cases first, then months-old ones with the
    newest repeated and broken lines, ids that the table holds already, and an
    unknown district: every input row is stored or rejected with a reason."""
    sp = t.spark
    src = scratch_path(sp, "cases-json-batches")
    out, bad, ck = (scratch_path(sp, f"ingest-batches-{x}") for x in ("out", "bad", "ck"))
    cases = t.cases.withColumn("district_code", F.when(F.col("id") % 13 == 0, "NOPE").otherwise(F.col("district_code")))
    held = cases.filter("id % 5 = 0")
    new = cases.filter(F.col("case_date") >= F.lit(SPLIT).cast("date"))
    broken = sp.range(3).select(F.concat(F.lit('{"case_id":'), F.col("id").cast("string")).alias("value"))
    for part in (_case_json(new), _case_json(cases.filter(F.col("case_date") < F.lit(SPLIT).cast("date")))
                 .unionByName(_case_json(new)).unionByName(broken)):
        part.write.mode("append").text(src)
        St.stream_ingest_cases(sp, src, out, bad, ck, held, t.districts).awaitTermination()
    stored = St.read_ingested(sp, out).agg(F.lit("stored").alias("result"), F.lit("stored").alias("reason"),
                                           F.count(F.lit(1)).alias("n_rows"))
    rejects = sp.read.parquet(bad).groupBy(F.lit("rejected").alias("result"), "reason").agg(F.sum("n_rows").alias("n_rows"))
    return stored.unionByName(rejects)


@register("stream_alerts", "R3", GEN_SQL)
def q_stream_alerts(t):
    """Alert generation run per micro-batch over a stream of predictions."""
    sp = t.spark
    preds, alerts = scratch_path(sp, "preds-stream-src"), scratch_path(sp, "alerts-snapshot")
    t.predictions.write.parquet(preds)
    t.alerts.write.parquet(alerts)
    out, ck = scratch_path(sp, "alerts-stream-out"), scratch_path(sp, "alerts-stream-ck")
    St.run_stream_alerts(sp, preds, alerts, out, ck, EVENTS_AS_OF, EVENTS_AS_OF_TS).awaitTermination()
    return sp.read.parquet(out).drop("day", "epoch")
