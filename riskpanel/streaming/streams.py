"""Streaming jobs.

Parquet time stamps come in as TIMESTAMP_NTZ, which ``withWatermark`` does not
accept, so event time is cast to TIMESTAMP (session zone UTC) first. Every
query keeps its checkpoint (offsets and state) in the shared checkpoint folder,
so a restarted driver or lost executor resumes from the last committed batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskpanel import config as C
from riskpanel import schemas
from riskpanel.operators.predicates import trailing_since
from riskpanel.operators.state import generate_alerts
from riskpanel.streaming.runs import Runs


def event_time(c, is_date: bool = False) -> F.Column:
    """Event time as TIMESTAMP. A DATE becomes its UTC midnight instant, so
    1-day windows (aligned to the epoch) are calendar days whatever the session
    time zone; a TIMESTAMP_NTZ is read in the session zone (UTC here)."""
    col = F.col(c) if isinstance(c, str) else c
    if is_date:
        return F.timestamp_seconds(F.unix_date(col).cast("long") * F.lit(86400))
    return col.cast("timestamp")


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


CASE_RECORD = T.StructType([T.StructField(n, t) for n, t, _, _ in schemas.CREATE_RECORDS["cases"]])
REJECT = T.StructType([T.StructField("record", T.StringType()), T.StructField("reason", T.StringType()),
                       T.StructField("n_rows", T.LongType())])


#: Buckets of the stored case ids, by a hash of the id.
ID_BUCKETS = 64
STORED_ID = T.StructType([T.StructField("case_id", T.StringType()), T.StructField("bucket", T.IntegerType())])


def id_bucket(c: str = "case_id") -> F.Column:
    return F.pmod(F.xxhash64(c), F.lit(ID_BUCKETS)).cast("int")


def stored_ids(ids: DataFrame, cases: DataFrame) -> DataFrame:
    """The bucketed ids (case_id, bucket) that some row of ``cases`` may have: only the buckets of its own ids are read."""
    held = [r[0] for r in cases.filter("case_id is not null").select(id_bucket().alias("b")).distinct().collect()]
    return ids.filter(F.col("bucket").isin(held))  # at most ID_BUCKETS numbers


def split_case_records(records: DataFrame, stored: DataFrame | None, districts: DataFrame | None = None):
    """JSON records (``value``) -> (cases to store, rejects with reason and count).

    Every input row is in one of the two: equal records are counted first, one
    of each is parsed; unparsable records, records without a required value, of
    an unknown district (if ``districts`` is given), of a case_id that ``stored``
    has, and all but the least text of a repeated case_id are rejects.
    """
    counted = records.groupBy("value").agg(F.count(F.lit(1)).alias("n_rows"))
    spec = schemas.CREATE_RECORDS["cases"]
    st = schemas.record_schema("cases").add("_corrupt_record", T.StringType(), True)
    parsed = counted.select("value", "n_rows", F.from_json("value", st, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("r"))
    bad = F.col("value").isNull() | F.col("r").isNull() | F.col("r._corrupt_record").isNotNull()
    for name, _, required, _ in spec:
        if required:
            bad = bad | F.col("r")[name].isNull()
    parsed = parsed.withColumn("case_id", F.col("r.case_id")) \
        .withColumn("reason", F.when(F.coalesce(bad, F.lit(True)), "invalid record"))
    if districts is not None:
        known = districts.select(F.col("district_code").alias("_d")).distinct()
        parsed = parsed.join(known, F.col("r.district_code") == F.col("_d"), "left").withColumn(
            "reason", F.coalesce("reason", F.when(F.col("_d").isNull(), "unknown district"))).drop("_d")
    if stored is not None:
        # of the stored table only the ids of this batch are kept, so it is scanned, not shuffled as a whole
        ids = stored.select(F.col("case_id").alias("_s")).join(
            parsed.select(F.col("case_id").alias("_s")).distinct(), "_s", "left_semi").distinct()
        parsed = parsed.join(ids, F.col("case_id") == F.col("_s"), "left").withColumn(
            "reason", F.coalesce("reason", F.when(F.col("_s").isNotNull(), "case_id already stored"))).drop("_s")
    first = parsed.filter("reason IS NULL").groupBy("case_id").agg(F.min("value").alias("_v")) \
        .select(F.col("case_id").alias("_c"), "_v")
    marked = parsed.join(first, (F.col("case_id") == F.col("_c")) & F.col("reason").isNull(), "left").withColumn(
        "kept", F.coalesce(F.col("reason").isNull() & (F.col("value") == F.col("_v")), F.lit(False)))
    good = marked.filter("kept").select(*[
        (F.coalesce(F.col("r")[n], F.lit(d)) if d is not None else F.col("r")[n]).alias(n) for n, _, _, d in spec])
    repeats = F.when(F.col("kept"), F.col("n_rows") - 1).otherwise(F.col("n_rows"))
    rejects = marked.withColumn("n_rows", repeats).filter("n_rows > 0").select(
        F.col("value").alias("record"), F.coalesce("reason", F.lit("repeated case_id")).alias("reason"),
        F.col("n_rows").cast("long").alias("n_rows"))
    return good, rejects


def stream_ingest_cases(spark: SparkSession, json_dir: str, table_path: str, rejects_path: str, checkpoint: str,
                        existing: DataFrame | None = None, districts: DataFrame | None = None,
                        max_files_per_trigger: int | None = None) -> StreamingQuery:
    """JSON case records arriving as files -> checked case rows in
    ``table_path``, everything else in ``rejects_path`` with reason and count.

    A case id is stored once, however late it comes. The ids stored so far are
    kept beside the table (``<table_path>_ids``) in hash buckets and levelled
    runs; a micro-batch reads the buckets of its own ids only, so no watermark
    drops a back-filled record and the table is not read again. The ids of
    ``existing`` are taken in when the stream first starts. Each batch writes its
    own ``epoch=<id>`` folder with overwrite, so a replayed batch replaces its
    own output."""
    reader = spark.readStream.schema("value STRING")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    ids = Runs(spark, f"{table_path}_ids", STORED_ID, partition_by="bucket")
    held = f"{table_path}_ids_existing"
    if existing is not None and not path_exists(spark, f"{held}/_SUCCESS"):
        existing.select("case_id", id_bucket().alias("bucket")).filter("case_id is not null") \
            .repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(held)

    def batch(records: DataFrame, epoch_id: int):
        known = ids.read(before=epoch_id)
        if existing is not None:
            known = known.unionByName(spark.read.schema(STORED_ID).parquet(held))
        arrived = records.groupBy("value").agg(F.count(F.lit(1)).alias("_n")).select(
            F.get_json_object("value", "$.case_id").alias("case_id"))
        good, rejects = split_case_records(records, stored_ids(known, arrived), districts)
        good.write.mode("overwrite").parquet(f"{table_path}/epoch={epoch_id}")
        rejects.write.mode("overwrite").parquet(f"{rejects_path}/epoch={epoch_id}")
        new = spark.read.schema(CASE_RECORD).parquet(f"{table_path}/epoch={epoch_id}")
        ids.add(new.select("case_id", id_bucket().alias("bucket")).repartition("bucket"), epoch_id)

    return (reader.text(json_dir).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_ingested(spark: SparkSession, table_path: str) -> DataFrame:
    """The rows that ``stream_ingest_cases`` stored, all epochs."""
    return spark.read.schema(CASE_RECORD).option("recursiveFileLookup", True).parquet(table_path)


DAY_COUNT = T.StructType([T.StructField("district_code", T.StringType()), T.StructField("date", T.DateType()),
                          T.StructField("cases_count", T.LongType())])


PARTIAL_COUNT = T.StructType([*DAY_COUNT.fields, T.StructField("before", T.DateType())])


def _count_runs(spark: SparkSession, out_path: str) -> Runs:
    """Partial counts by (district, day, newest day seen before the batch), which add up when runs are merged."""
    return Runs(spark, out_path, PARTIAL_COUNT, lambda df: df.groupBy("district_code", "date", "before").agg(
        F.sum("cases_count").alias("cases_count")))


def run_daily_case_counts(spark: SparkSession, cases_dir: str, out_path: str, checkpoint: str,
                          max_files_per_trigger: int | None = None) -> StreamingQuery:
    """R2: cases arriving as files -> counts per (district, day), kept as levelled
    runs of partial counts: a micro-batch adds its own, and full levels are
    merged, so the counts are read from a logarithmic number of runs however
    many batches there were. Nothing is dropped for coming late: each partial
    count knows the newest day seen before its batch, and ``read_daily_counts``
    adds them up."""
    reader = spark.readStream.schema(schemas.CASES)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    runs = _count_runs(spark, out_path)

    def batch(cases: DataFrame, epoch_id: int):
        newest = runs.read(before=epoch_id).agg(F.max("date")).first()[0]
        runs.add(cases.groupBy("district_code", F.col("case_date").alias("date")).agg(F.count(F.lit(1)).alias("cases_count"))
                 .withColumn("before", F.lit(newest).cast("date")), epoch_id)

    return (reader.parquet(cases_dir).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_daily_counts(spark: SparkSession, out_path: str, delay_days: int = 1) -> DataFrame:
    """(district_code, date, cases_count, late_cases) of the closed days.

    A day is closed when a case more than ``delay_days`` days after it has come
    in; ``late_cases`` are those that came in a batch after the one that closed
    their day. They are counted, and told apart, not dropped."""
    parts = _count_runs(spark, out_path).read()
    last = parts.agg(F.max("date").alias("last"))  # one row
    late = F.col("date") < F.date_sub("before", delay_days)
    return (parts.groupBy("district_code", "date").agg(
        F.sum("cases_count").alias("cases_count"),
        F.coalesce(F.sum(F.when(late, F.col("cases_count"))), F.lit(0)).alias("late_cases"))
        .join(F.broadcast(last), F.col("date") < F.date_sub("last", delay_days)).drop("last"))


def daily_case_counts(cases_stream: DataFrame, watermark: str = "1 day",
                      time_col: str = "case_date") -> DataFrame:
    """R2 with Spark's own state: running count per (district, day) by event time;
    in append mode a day is emitted once the watermark passes its end. Rows
    later than the watermark are not counted (the query's progress tells how
    many): use ``run_daily_case_counts`` where late rows matter."""
    s = cases_stream.withColumn("event_time", event_time(time_col, is_date=True)) \
        .withWatermark("event_time", watermark)
    day = F.date_from_unix_date(F.floor(F.unix_seconds(F.col("window.start")) / F.lit(86400)).cast("int"))
    return (s.groupBy(F.window("event_time", "1 day"), "district_code").agg(F.count(F.lit(1)).alias("cases_count"))
            .select("district_code", day.alias("date"), "cases_count"))


def run_stream_alerts(spark: SparkSession, preds_dir: str, alerts_path: str, new_alerts_path: str,
                      checkpoint: str, as_of=None, as_of_ts=None,
                      max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Predictions arriving -> alert generation per micro-batch against the
    alert table as it stands (its own earlier output included), so the 7-day
    suppression holds across batches. Batches run one after another.

    Each micro-batch writes its alerts to ``day=<as_of>/epoch=<id>`` with
    overwrite, so a batch that Spark replays after a failure replaces its own
    output instead of appending it twice; earlier epochs are read without the
    one being written. An alert suppresses others for a week, so a batch reads
    the folders of that many days and no older ones, however long the stream runs.

    Without ``as_of`` each batch runs as of the newest prediction date among the
    Ensemble predictions it brings, so a long-lived stream moves on with its data."""
    reader = spark.readStream.schema(schemas.PREDICTIONS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.parquet(preds_dir)

    cols = ["district_code", "prediction_horizon_weeks", "status", "triggered_at"]
    stored = T.StructType([*[f for f in schemas.TABLES["alerts"].fields if f.name in cols],
                           T.StructField("day", T.DateType()), T.StructField("epoch", T.IntegerType())])

    def batch(df: DataFrame, epoch_id: int):
        day = as_of or df.filter(F.col("model_name") == C.ENSEMBLE).agg(F.max("prediction_date")).first()[0]
        if day is None:
            return
        stamp = as_of_ts or f"{str(day)[:10]} 00:00:00"
        # only alerts that can still suppress one are read, from the table and from earlier epochs
        since = trailing_since(str(day)[:10], C.ALERT_WINDOW_DAYS)
        recent = F.col("triggered_at") >= trailing_since(str(day)[:10], C.ALERT_WINDOW_DAYS, "timestamp")
        alerts = spark.read.schema(schemas.TABLES["alerts"]).parquet(alerts_path).select(*cols)
        if path_exists(spark, new_alerts_path):
            earlier = spark.read.schema(stored).parquet(new_alerts_path).filter((F.col("day") >= since) & (F.col("epoch") < epoch_id))
            alerts = alerts.unionByName(earlier.select(*cols))
        alerts = alerts.filter(recent)
        (generate_alerts(df, alerts, str(day)[:10], stamp).write.mode("overwrite")
         .parquet(f"{new_alerts_path}/day={str(stamp)[:10]}/epoch={epoch_id}"))

    return (src.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
