"""Sources and sinks (2.1): each query writes a bound table in the format the
source reads (to the shared checkpoint folder) and reads it back through the
library's reader."""

from pyspark.sql import functions as F

from riskpanel import schemas
from riskpanel.catalog.base import CASES_AS_OF, DISTRICT, EVENTS_AS_OF_TS, minus, register
from riskpanel.session import scratch_path
from riskpanel.sources import files as Fs

R30 = minus(CASES_AS_OF, 30)


def _csv_roundtrip(t, table, frame):
    cols = [n for n, _ in Fs.CSV_LAYOUTS[table]]
    types = dict(Fs.CSV_LAYOUTS[table])
    src = frame.select(*[F.col(c) if c in frame.columns else F.lit(None).cast(types[c]).alias(c) for c in cols])
    path = scratch_path(t.spark, f"{table}-csv")
    src.write.option("header", True).csv(path)
    good, _ = Fs.read_csv(t.spark, path, table)
    return good


def _csv_sql(table, source, cols_null=()):
    cols = [n for n, _ in Fs.CSV_LAYOUTS[table]]
    return "SELECT " + ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" if c in cols_null else c for c in cols) + \
        f" FROM {source}"


@register("read_districts_csv", "S1", _csv_sql("districts", "districts", ("latitude", "longitude")))
def q_read_districts_csv(t):
    """Districts through a header CSV with the fixed layout."""
    return _csv_roundtrip(t, "districts", t.districts)


@register("read_cases_csv", "S2", _csv_sql("cases", "cases"))
def q_read_cases_csv(t):
    """The case line list through a header CSV with the fixed layout."""
    return _csv_roundtrip(t, "cases", t.cases)


@register("read_climate_csv", "S3", _csv_sql("climate_data", "climate_data"),
          ["rainfall_mm", "temperature_celsius", "humidity_percent"])
def q_read_climate_csv(t):
    """Combined climate through a header CSV with the fixed layout."""
    return _csv_roundtrip(t, "climate_data", t.climate)


@register("read_water_csv", "S5", _csv_sql("water_extent", "water_extent"), ["water_area_sqkm", "flood_risk_score"])
def q_read_water_csv(t):
    """Water extent through a header CSV with the fixed layout."""
    return _csv_roundtrip(t, "water_extent", t.water)


@register("read_facilities_csv", "S6", _csv_sql("health_facilities", "health_facilities"))
def q_read_facilities_csv(t):
    """Health facilities through a header CSV with the fixed layout."""
    return _csv_roundtrip(t, "health_facilities", t.facilities)


@register("read_csv_line_breaks", "S6", """
SELECT facility_code, facility_name || chr(10) || 'Annex "B", ' || repeat(facility_code, 400) AS facility_name,
       length(facility_name || chr(10) || 'Annex "B", ' || repeat(facility_code, 400)) AS name_length FROM health_facilities
UNION ALL SELECT 'rejected', 'stray', (SELECT count(*) FROM health_facilities WHERE id % 3 = 0)""")
def q_read_csv_line_breaks(t):
    """Facilities whose names hold line breaks, doubled quotes, commas and thousands of
    characters, with broken records between them: names read, records rejected."""
    path = scratch_path(t.spark, "facilities-line-breaks")
    name = F.concat("facility_name", F.lit('\nAnnex "B", '), F.repeat("facility_code", F.lit(400)))
    quoted = F.concat(F.lit('"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"'))
    cols = [n for n, _ in Fs.CSV_LAYOUTS["health_facilities"]]
    line = F.concat_ws(",", *[quoted if c == "facility_name" else F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    broken = F.when(F.col("id") % 3 == 0, F.concat(F.lit("\nstray,"), "facility_code", F.lit(",only,four"))).otherwise("")
    t.facilities.select(F.concat(line, broken)).write.text(path)
    good, bad = Fs.read_facilities_csv(t.spark, path)
    return good.select("facility_code", "facility_name", F.length("facility_name").cast("long").alias("name_length")).unionByName(
        bad.agg(F.lit("rejected").alias("facility_code"), F.min(F.substring_index("_corrupt_record", ",", 1)).alias("facility_name"),
                F.count(F.lit(1)).alias("name_length")))


D_RAIN = minus(CASES_AS_OF, 100)
D_TEMP = minus(CASES_AS_OF, 400)


@register("merge_climate_files", "S4", f"""
WITH r_ AS (SELECT district_code, date, avg(rainfall_mm) AS rainfall_mm, min(data_source) AS data_source
            FROM climate_data WHERE date < DATE '{D_RAIN}' GROUP BY ALL),
t_ AS (SELECT district_code, date, avg(temperature_celsius) AS temperature_celsius, min(data_source) AS data_source
       FROM climate_data WHERE date > DATE '{D_TEMP}' GROUP BY ALL),
h_ AS (SELECT district_code, date, avg(humidity_percent) AS humidity_percent, min(data_source) AS data_source
       FROM climate_data GROUP BY ALL)
SELECT district_code, date, rainfall_mm, temperature_celsius, humidity_percent,
       coalesce(r_.data_source, t_.data_source, h_.data_source) AS data_source
FROM r_ FULL OUTER JOIN t_ USING (district_code, date) FULL OUTER JOIN h_ USING (district_code, date)""",
          ["rainfall_mm", "temperature_celsius", "humidity_percent"])
def q_merge_climate_files(t):
    """Rainfall, temperature and humidity files (each covering other dates) merged
    by (district, date) through CSV round trips."""
    c = t.climate
    parts = {}
    for name, frame in (("rain", c.filter(F.col("date") < F.lit(D_RAIN).cast("date"))),
                        ("temp", c.filter(F.col("date") > F.lit(D_TEMP).cast("date"))),
                        ("hum", c)):
        path = scratch_path(t.spark, f"climate-{name}")
        frame.select("district_code", "date", "rainfall_mm", "temperature_celsius", "humidity_percent",
                     "data_source").write.option("header", True).csv(path)
        parts[name] = Fs.read_csv(t.spark, path, "climate_data")[0]
    return Fs.merge_climate_files(parts["rain"], parts["temp"], parts["hum"])


@register("scan_table", "S8", f"SELECT * FROM cases WHERE district_code = '{DISTRICT}'")
def q_scan_table(t):
    """One district of the case table stored partitioned by district (partition pruning)."""
    path = scratch_path(t.spark, "cases-by-district")
    t.cases.repartition("district_code").write.partitionBy("district_code").parquet(path)
    return Fs.scan_table(t.spark, path, DISTRICT)


@register("ingest_json", "S11", """
SELECT case_id, district_code, facility_code, case_date, age_group, gender, case_status,
       coalesce(lab_confirmed, false) AS lab_confirmed, outcome FROM cases""")
def q_ingest_json(t):
    """Case records as JSON text parsed into typed rows with defaults (rejects apart)."""
    rec = t.cases.select(F.to_json(F.struct("case_id", "district_code", "facility_code",
                                            F.date_format("case_date", "yyyy-MM-dd").alias("case_date"),
                                            "age_group", "gender", "case_status", "lab_confirmed",
                                            "outcome")).alias("value"))
    good, _ = Fs.ingest_json(rec, "cases")
    return good


@register("append_rows", "S9", "SELECT * FROM cases")
def q_append_rows(t):
    """Cases of the last 30 days appended (constraint-checked) to a table holding the older ones."""
    path = scratch_path(t.spark, "cases-append")
    old = t.cases.filter(F.col("case_date") < F.lit(R30).cast("date"))
    new = t.cases.filter(F.col("case_date") >= F.lit(R30).cast("date"))
    old.write.parquet(path)
    existing = t.spark.read.parquet(path)
    Fs.append_rows(new, path, "cases", existing)
    return t.spark.read.parquet(path)


@register("import_csv", "S10", """
SELECT case_id, district_code, facility_code, case_date, age_group, gender, case_status, lab_confirmed, outcome
FROM cases""")
def q_import_csv(t):
    """A CSV of the last 30 days' cases imported into a table holding the older ones."""
    path = scratch_path(t.spark, "cases-import")
    t.cases.filter(F.col("case_date") < F.lit(R30).cast("date")).write.parquet(path)
    csv = scratch_path(t.spark, "cases-import-csv")
    cols = [n for n, _ in Fs.CSV_LAYOUTS["cases"]]
    t.cases.filter(F.col("case_date") >= F.lit(R30).cast("date")).select(*cols) \
        .write.option("header", True).csv(csv)
    Fs.import_csv(t.spark, csv, path, "cases", EVENTS_AS_OF_TS, t.spark.read.parquet(path))
    return t.spark.read.parquet(path).select(*cols)


@register("read_api_shapes", "S12", """
SELECT id, case_id, district_code, facility_code, case_date, age_group, gender, case_status, lab_confirmed,
       outcome, created_at, updated_at FROM cases""")
def q_read_api_shapes(t):
    """The response projection of the case table, generated from its record schema."""
    return Fs.api_shape(t.cases, "cases")


SHAPES_SQL = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, count(*) AS n_rows, count({schemas.CREATE_RECORDS[name][0][0]}) AS n_keys, "
    f"{len(schemas.response_columns(name))} AS n_columns FROM {name}" for name in sorted(schemas.TABLES))


@register("read_api_shapes_all", "S12", SHAPES_SQL)
def q_read_api_shapes_all(t):
    """The response projection of each of the seven tables: rows, keys and columns it returns."""
    from functools import reduce
    from pyspark.sql import DataFrame
    parts = []
    for name in sorted(schemas.TABLES):
        shape = Fs.api_shape(getattr(t, name), name)
        parts.append(shape.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
                               F.count(schemas.CREATE_RECORDS[name][0][0]).alias("n_keys"),
                               F.lit(len(shape.columns)).alias("n_columns")))
    return reduce(DataFrame.unionByName, parts)


@register("read_districts_geojson", "S7", "SELECT district_code, district_name, region, population, geometry FROM districts")
def q_read_districts_geojson(t):
    """Districts written as one GeoJSON FeatureCollection per region and read back."""
    path = scratch_path(t.spark, "districts-geojson")
    feature = F.struct(F.lit("Feature").alias("type"),
                       F.struct("district_code", "district_name", "region", "population").alias("properties"),
                       F.col("geometry").alias("geometry"))
    docs = t.districts.groupBy("region").agg(F.collect_list(feature).alias("features")) \
        .select(F.lit("FeatureCollection").alias("type"), "features")
    docs.write.option("maxRecordsPerFile", 1).json(path)  # a GeoJSON file is one document
    return Fs.read_districts_geojson(t.spark, path)


@register("read_geojson_one_file", "S7", """
SELECT district_code, district_name || ' "}],[{ ' || chr(10) AS district_name, region, population, geometry FROM districts""")
def q_read_geojson_one_file(t):
    """All districts in one FeatureCollection without line breaks, their names full of
    brackets and quotes, read by several tasks."""
    path = scratch_path(t.spark, "districts-one-geojson")
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(
        "district_code", F.concat("district_name", F.lit(' "}],[{ \n')).alias("district_name"), "region", "population").alias("properties"),
        F.col("geometry").alias("geometry"))
    # one text file needs one row; the districts are a dimension table
    t.districts.select(F.to_json(feature).alias("f")).agg(F.concat(
        F.lit('{"type":"FeatureCollection","crs":{"features":[{"type":"no"}]},"features":['),
        F.concat_ws(",", F.collect_list("f")), F.lit('],"bbox":[0,1]}')).alias("value")).write.text(path)
    return Fs.read_districts_geojson(t.spark, path)


@register("append_rows_checked", "S9", """
WITH n_ AS (SELECT * REPLACE (CASE WHEN id % 7 = 0 THEN 'NOPE' WHEN id % 11 = 0 THEN repeat('x', 30)
                              ELSE district_code END AS district_code) FROM cases)
SELECT case_id, district_code, 'stored' AS result FROM n_ WHERE district_code IN (SELECT district_code FROM districts)
  AND (facility_code IS NULL OR facility_code IN (SELECT facility_code FROM health_facilities))
UNION ALL
SELECT case_id, district_code, 'rejected' FROM n_ WHERE NOT (district_code IN (SELECT district_code FROM districts)
  AND (facility_code IS NULL OR facility_code IN (SELECT facility_code FROM health_facilities)))""")
def q_append_rows_checked(t):
    """All cases, some given an unknown or too long district, appended with foreign
    keys and widths checked: what is stored and what is rejected."""
    path = scratch_path(t.spark, "cases-append-fk")
    code = F.when(F.col("id") % 7 == 0, "NOPE").when(F.col("id") % 11 == 0, F.repeat(F.lit("x"), 30)) \
        .otherwise(F.col("district_code"))
    new = t.cases.withColumn("district_code", code)
    bad = Fs.append_rows(new, path, "cases", None, {"districts": t.districts, "health_facilities": t.facilities})
    stored = t.spark.read.parquet(path)
    return stored.select("case_id", "district_code", F.lit("stored").alias("result")).unionByName(
        bad.select("case_id", "district_code", F.lit("rejected").alias("result")))


@register("create_drop_tables", "S13", "\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, {len(schemas.TABLES[n].fields)} AS n_columns, "
    f"(SELECT count(*) FROM {n}) AS n_rows, true AS dropped" for n in sorted(schemas.TABLES)))
def q_create_drop_tables(t):
    """Create every table, fill it with the bound rows, count them, and drop all again."""
    from functools import reduce
    from pyspark.sql import DataFrame
    from riskpanel.streaming.streams import path_exists
    base = scratch_path(t.spark, "all-tables")
    paths = Fs.create_tables(t.spark, base)
    counts = []
    for n in sorted(paths):
        getattr(t, n).select(*schemas.TABLES[n].fieldNames()).write.mode("append").parquet(paths[n])
        counts.append(t.spark.read.schema(schemas.TABLES[n]).parquet(paths[n]).agg(
            F.lit(n).alias("table_name"), F.lit(len(schemas.TABLES[n].fields)).alias("n_columns"),
            F.count(F.lit(1)).alias("n_rows")))
    from riskpanel.session import checkpoint_dir
    checkpoint_dir(t.spark)
    out = reduce(DataFrame.unionByName, counts).checkpoint(eager=True)
    Fs.drop_tables(t.spark, base)
    gone = [n for n in paths if not path_exists(t.spark, paths[n])]
    return out.withColumn("dropped", F.col("table_name").isin(gone))
