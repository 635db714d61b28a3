"""File sources and sinks with fixed schemas (no schema inference).

CSV and JSON are read PERMISSIVE with a ``_corrupt_record`` column; rows that
do not parse or miss a required field go to a rejects frame instead of failing
the job. Writes go to folders under a base path; updates are written as a new
snapshot folder, which readers take as current once its write has finished
(they never see a half-written table, and no path is overwritten while read).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskpanel import schemas
from riskpanel.functions.scalar import ntz_lit
from riskpanel.sources.features import read_features
from riskpanel.sources.records import read_records

S, I, D, DT, B = T.StringType(), T.IntegerType(), T.DoubleType(), T.DateType(), T.BooleanType()

# Column layout of the CSV files the application imports.
CSV_LAYOUTS = {
    "districts": [("district_code", S), ("district_name", S), ("region", S), ("population", I),
                  ("latitude", D), ("longitude", D)],
    "cases": [("case_id", S), ("district_code", S), ("facility_code", S), ("case_date", DT),
              ("age_group", S), ("gender", S), ("case_status", S), ("lab_confirmed", B), ("outcome", S)],
    "climate_data": [("district_code", S), ("date", DT), ("rainfall_mm", D), ("temperature_celsius", D),
                     ("humidity_percent", D), ("data_source", S)],
    "water_extent": [("district_code", S), ("date", DT), ("water_area_sqkm", D), ("flood_risk_score", D),
                     ("data_source", S)],
    "health_facilities": [("facility_code", S), ("facility_name", S), ("district_code", S),
                          ("facility_type", S), ("latitude", D), ("longitude", D)],
}
CORRUPT = "_corrupt_record"


def csv_schema(table: str, with_corrupt: bool = True) -> T.StructType:
    fields = [T.StructField(n, t, True) for n, t in CSV_LAYOUTS[table]]
    if with_corrupt:
        fields.append(T.StructField(CORRUPT, S, True))
    return T.StructType(fields)


def _required(table: str) -> list[str]:
    return [c for c in schemas.REQUIRED.get(table, []) if c in dict(CSV_LAYOUTS.get(table, []))]


def read_csv(spark: SparkSession, path: str, table: str) -> tuple[DataFrame, DataFrame]:
    """CSV with header and the table's fixed layout.
    Returns (good rows, rejected rows with the raw record in _corrupt_record).

    Each record (``read_records``: quoted fields may hold line breaks, and are of
    any length) is split by ``from_csv`` into text fields plus a spare one;
    every field is then tested with ``try_cast``. A quote within a quoted field
    is doubled. A record with a field too few or too many, a value its column
    cannot hold, or a missing required value is rejected. Both frames are lazy
    plans over the file (no copy is made), and since the test is part of the
    filter it is not pruned away when few columns are read. The header is left out."""
    layout = CSV_LAYOUTS[table]
    names = [n for n, _ in layout]
    fields = T.StructType([T.StructField(n, S, True) for n in names] + [T.StructField("_spare", S, True)])
    # with a quote never closed or too many fields the last column swallows or drops text: count fields apart
    lines = read_records(spark, path).filter(F.trim("value") != "")
    parsed = lines.select("value", F.from_csv("value", fields.simpleString()[len("struct<"):-1].replace(":", " "),
                                              {"mode": "PERMISSIVE", "quote": '"', "escape": '"'}).alias("r"))
    is_header = F.lit(True)
    for n in names:
        is_header = is_header & (F.lower(F.trim(F.col("r")[n])) == n)
    parsed = parsed.filter(~F.coalesce(is_header, F.lit(False)))
    n_fields = F.size(F.split(F.regexp_replace("value", '"[^"]*"', "q"), ",", -1))  # a doubled quote: two runs
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    bad = (n_fields != len(names)) | (quotes % 2 == 1)
    typed = {}
    for n, t in layout:
        raw = F.col("r")[n]
        text = F.when(raw != "", raw)
        typed[n] = text if t == S else F.trim(text).try_cast(t)
        bad = bad | (text.isNotNull() & typed[n].isNull())
    for n in _required(table):
        bad = bad | typed[n].isNull()
    cols = [typed[n].alias(n) for n in names]
    good = parsed.filter(~bad).select(*cols)
    rejects = parsed.filter(bad).select(*cols, F.col("value").alias(CORRUPT))
    return good, rejects


def read_districts_csv(spark, path):
    return read_csv(spark, path, "districts")


def read_cases_csv(spark, path):
    return read_csv(spark, path, "cases")


def read_climate_csv(spark, path):
    return read_csv(spark, path, "climate_data")


def read_water_csv(spark, path):
    return read_csv(spark, path, "water_extent")


def read_facilities_csv(spark, path):
    return read_csv(spark, path, "health_facilities")


def merge_climate_files(rain: DataFrame, temp: DataFrame, hum: DataFrame,
                        keys=("district_code", "date")) -> DataFrame:
    """Rainfall, temperature and humidity from three files into one row per
    (district, date): two full outer joins, the source taken from the first file
    that has the row.

    (district, date) is the table's unique key, so each file is first reduced to
    one row per key (the mean of repeated readings, the first source name):
    repeated keys in two files would otherwise multiply in the outer join, and
    the reduction is combined map-side before the shuffle."""
    def one(df, measure, tag):
        return df.groupBy(*keys).agg(F.avg(measure).alias(measure), F.min("data_source").alias(tag))
    j = (one(rain, "rainfall_mm", "_s1").join(one(temp, "temperature_celsius", "_s2"), list(keys), "full_outer")
         .join(one(hum, "humidity_percent", "_s3"), list(keys), "full_outer"))
    return j.select(*keys, "rainfall_mm", "temperature_celsius", "humidity_percent",
                    F.coalesce("_s1", "_s2", "_s3").alias("data_source"))


def read_districts_geojson(spark: SparkSession, path: str) -> DataFrame:
    """A GeoJSON FeatureCollection -> one row a district, geometry kept as JSON text.

    The schema is fixed, so the columns do not vary with the file and no
    inference job runs: a missing property is null. A FeatureCollection is one
    JSON document; ``read_features`` cuts even a single large one in parallel."""
    props = T.StructType([T.StructField("district_code", S), T.StructField("district_name", S),
                          T.StructField("region", S), T.StructField("population", T.LongType())])
    feature = T.StructType([T.StructField("properties", props), T.StructField("geometry", S)])
    doc = read_features(spark, path).select(F.from_json("value", feature).alias("f"))
    return doc.select("f.properties.district_code", "f.properties.district_name", "f.properties.region",
                      F.col("f.properties.population").cast("int").alias("population"), "f.geometry")


def scan_table(spark: SparkSession, path: str, district_code: str | None = None) -> DataFrame:
    """Whole table, optionally one district (pushed down; pruned when the
    table is partitioned by district_code)."""
    df = spark.read.parquet(path)
    return df if district_code is None else df.filter(F.col("district_code") == district_code)


def ingest_json(records: DataFrame, table: str, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """JSON text records -> typed rows of the table's create record; missing
    optional fields take their default; unparsable records or ones missing a
    required field are returned apart."""
    spec = schemas.CREATE_RECORDS[table]
    st = schemas.record_schema(table).add(CORRUPT, S, True)
    parsed = records.select(F.from_json(F.col(value), st, {"mode": "PERMISSIVE",
                                                            "columnNameOfCorruptRecord": CORRUPT}).alias("r"),
                            F.col(value).alias("_raw"))
    flat = parsed.select("r.*", "_raw")
    bad = F.col(CORRUPT).isNotNull() | F.col("_raw").isNull()
    for name, _, required, _ in spec:
        if required:
            bad = bad | F.col(name).isNull()
    good = flat.filter(~bad).select(*[
        (F.coalesce(F.col(n), F.lit(d)) if d is not None else F.col(n)).alias(n) for n, _, _, d in spec])
    return good, flat.filter(bad).select(F.col("_raw").alias("record"))


def api_shape(df: DataFrame, table: str) -> DataFrame:
    """The read (response) projection of a table: id, record fields, stamps."""
    return df.select(*schemas.response_columns(table))


def conform(df: DataFrame, table: str) -> DataFrame:
    """Decimal columns rounded half up to their declared scale, as the declared
    DECIMAL columns store them (74.996 becomes 75.00)."""
    out = {}
    for c, spec in schemas.DECLARED[table].items():
        if spec[0] == "decimal" and c in df.columns:
            v, unit = F.abs(F.col(c)), F.lit(10.0 ** spec[2])
            out[c] = F.signum(c) * F.floor(v * unit + F.lit(0.500001)) / unit
    return df.withColumns(out) if out else df


def fits_declared(df: DataFrame, table: str):
    """Column: every value of the row fits its declared width or precision."""
    ok = F.lit(True)
    for c, spec in schemas.DECLARED[table].items():
        if c not in df.columns:
            continue
        if spec[0] == "string":
            ok = ok & F.coalesce(F.length(c) <= spec[1], F.lit(True))
        else:
            ok = ok & (F.col(c).isNull() | (F.abs(F.col(c)) < F.lit(10.0 ** (spec[1] - spec[2]))))
    return ok


def known_parents(df: DataFrame, table: str, parents: dict) -> tuple[DataFrame, list[str]]:
    """``df`` with one flag column per declared foreign key whose parent table is
    given: true where the key is null or the parent has it. Parents contribute
    their distinct keys, so no row is multiplied."""
    flags = []
    for i, (child, col, parent, pcol) in enumerate(schemas.FOREIGN_KEYS):
        if child != table or parent not in parents:
            continue
        keys = parents[parent].select(F.col(pcol).alias(f"_p{i}")).distinct()
        df = df.join(keys, F.col(col) == F.col(f"_p{i}"), "left") \
            .withColumn(f"_known{i}", F.col(col).isNull() | F.col(f"_p{i}").isNotNull()).drop(f"_p{i}")
        flags.append(f"_known{i}")
    return df, flags


def check_constraints(new: DataFrame, existing: DataFrame | None, table: str,
                      parents: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of ``new`` that keep the table's rules, and the rest: NOT NULL columns,
    declared widths, foreign keys into the given ``parents`` (table name ->
    frame) and the unique key.

    Key duplicates inside the batch keep the lowest id: the first id per key is
    an aggregate (combined map-side, so many copies of one key are one row per
    task) joined back null-safely; keys already present in ``existing`` are
    rejected by anti-join (no collect)."""
    keys = schemas.KEYS[table]
    columns = new.columns
    ok = reduce(lambda a, c: a & F.col(c).isNotNull(), schemas.REQUIRED[table], F.lit(True))
    ok = ok & fits_declared(new, table)
    new, flags = known_parents(new, table, parents or {})
    ok = reduce(lambda a, f: a & F.col(f), flags, ok)
    new = new.withColumn("_ok", ok)
    firsts = new.filter("_ok").groupBy(*keys).agg(F.min("id").alias("_first_id")).select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)], "_first_id")
    conds = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(keys)]
    marked = new.join(firsts, reduce(lambda a, b: a & b, conds), "left").select(
        *columns, (F.col("_ok") & F.coalesce(F.col("id") == F.col("_first_id"), F.lit(False))).alias("_keep"))
    good = marked.filter("_keep").drop("_keep")
    bad = marked.filter("NOT _keep").drop("_keep")
    if existing is not None:
        clash = good.join(existing.select(*keys), keys, "left_semi")
        good = good.join(existing.select(*keys), keys, "left_anti")
        bad = bad.unionByName(clash)
    return good, bad


def append_rows(new: DataFrame, path: str, table: str, existing: DataFrame | None = None,
                parents: dict | None = None) -> DataFrame:
    """Constraint-checked append, decimals stored at their declared scale;
    returns the rejected rows."""
    good, bad = check_constraints(new, existing, table, parents)
    conform(good, table).write.mode("append").parquet(path)
    return bad


def import_csv(spark: SparkSession, csv_path: str, table_path: str, table: str, as_of_ts,
               existing: DataFrame | None = None, parents: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """CSV with header -> checked append into the table; new ids are
    unique and above the existing maximum (not contiguous: numbering is done
    per task, with no single-partition window). Returns (parse rejects,
    constraint rejects)."""
    good, rejects = read_csv(spark, csv_path, table)
    top = 0 if existing is None else (existing.agg(F.max("id")).first()[0] or 0)
    stamp = ntz_lit(as_of_ts)
    # numbering is per file import; the import is one bounded file batch
    rows = good.withColumn("id", (F.lit(int(top)) + F.monotonically_increasing_id() + 1).cast("long"))
    full = rows.select(*[F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in schemas.TABLES[table].fields if f.name not in ("created_at", "updated_at")],
                       stamp.alias("created_at"), stamp.alias("updated_at"))
    bad = append_rows(full, table_path, table, existing, parents)
    return rejects, bad


def write_snapshot(df: DataFrame, base: str, version: int) -> str:
    """Write a table version to ``base/v=<n>``; the caller reads it back only
    after the write finished, so no path is overwritten while being read."""
    path = f"{base}/v={version:06d}"
    df.write.mode("errorifexists").parquet(path)
    return path


def current_version(spark: SparkSession, base: str) -> int | None:
    """The latest finished snapshot: the highest ``v=<n>`` whose write left its
    ``_SUCCESS`` mark (the committer writes it last, so a version becomes current
    at once and a broken write never does)."""
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(base)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return None
    found = [s.getPath() for s in fs.listStatus(top)]
    done = [int(p.getName()[2:]) for p in found if p.getName().startswith("v=")
            and fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return max(done, default=None)


def read_snapshot(spark: SparkSession, base: str, table: str) -> DataFrame:
    """The current version of a table; empty before its first snapshot."""
    v = current_version(spark, base)
    if v is None:
        return spark.createDataFrame([], schemas.TABLES[table])
    return spark.read.schema(schemas.TABLES[table]).parquet(f"{base}/v={v:06d}")


def replace_table(df: DataFrame, base: str, table: str) -> int:
    """Store ``df`` as the next version of a table, decimals at their declared
    scale; returns the version."""
    v = (current_version(df.sparkSession, base) or 0) + 1
    write_snapshot(conform(df, table).select(*[f.name for f in schemas.TABLES[table].fields]), base, v)
    return v


def create_tables(spark: SparkSession, base: str, tables=None) -> dict:
    """An empty parquet table with the schema of every engine table."""
    out = {}
    for name in tables or schemas.TABLES:
        p = f"{base}/{name}"
        spark.createDataFrame([], schemas.TABLES[name]).write.mode("ignore").parquet(p)
        out[name] = p
    return out


def drop_tables(spark: SparkSession, base: str, tables=None) -> None:
    """Remove the tables' folders through the cluster file system."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name in tables or schemas.TABLES:
        p = jvm.org.apache.hadoop.fs.Path(f"{base}/{name}")
        p.getFileSystem(conf).delete(p, True)


def write_metrics(runs: DataFrame, path: str) -> None:
    """Append model-run rows (run id, district, model, params, metrics)."""
    runs.select(*[f.name for f in schemas.MODEL_RUNS.fields]).write.mode("append").parquet(path)
