import json
import os

from pyspark.sql import functions as F

from riskpanel import schemas
from riskpanel.sources import files as Fs


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_districts_csv_with_rejects(spark, tmp_dir):
    p = os.path.join(tmp_dir, "d.csv")
    _write(p, "district_code,district_name,region,population,latitude,longitude\n"
              "Q01,Northfield,Upland,41250,1.25,30.5\n"
              "Q02,Riverside,Upland,notanumber,1.5,30.75\n"
              "Q03,\"Lake, west\",Shore,77,2.0,31.0\n"
              "Q04,Too,many,5,1.0,2.0,3.0\n"
              "Q05,Too few,4\n"
              ",Nameless,East,1,0,0\n")
    good, bad = Fs.read_districts_csv(spark, p)
    g = {r.district_code: r for r in good.collect()}
    assert sorted(g) == ["Q01", "Q03"] and g["Q01"].population == 41250 and g["Q03"].district_name == "Lake, west"
    assert good.count() == 2 and bad.count() == 4  # also when a count needs no column
    assert sorted(r._corrupt_record.split(",")[0] for r in bad.collect()) == ["", "Q02", "Q04", "Q05"]


def test_cases_and_climate_csv(spark, tmp_dir):
    p = os.path.join(tmp_dir, "c.csv")
    _write(p, "case_id,district_code,facility_code,case_date,age_group,gender,case_status,lab_confirmed,outcome\n"
              "X77,Q01,FX,2023-11-02,5-17,F,probable,true,admitted\n")
    good, _ = Fs.read_cases_csv(spark, p)
    r = good.first()
    assert str(r.case_date) == "2023-11-02" and r.lab_confirmed is True
    q = os.path.join(tmp_dir, "k.csv")
    _write(q, "district_code,date,rainfall_mm,temperature_celsius,humidity_percent,data_source\n"
              "Q01,2023-11-02,3.25,19.5,61.0,gauge\n")
    assert Fs.read_climate_csv(spark, q)[0].first().rainfall_mm == 3.25


def test_merge_three_climate_files(spark):
    schema = "district_code string, date string, rainfall_mm double, temperature_celsius double, " \
             "humidity_percent double, data_source string"
    r = spark.createDataFrame([("A", "2024-01-01", 1.0, None, None, "rain")], schema)
    t = spark.createDataFrame([("A", "2024-01-01", None, 20.0, None, "temp"),
                               ("A", "2024-01-02", None, 21.0, None, "temp")], schema)
    h = spark.createDataFrame([("B", "2024-01-01", None, None, 50.0, "hum")], schema)
    out = {(x.district_code, x.date): x for x in Fs.merge_climate_files(r, t, h).collect()}
    assert len(out) == 3
    assert out[("A", "2024-01-01")].rainfall_mm == 1.0 and out[("A", "2024-01-01")].temperature_celsius == 20.0
    assert out[("A", "2024-01-01")].data_source == "rain" and out[("B", "2024-01-01")].data_source == "hum"


def test_geojson_districts(spark, tmp_dir):
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"district_code": "Q01", "district_name": "Northfield", "region": "Upland",
                                           "population": 41250},
         "geometry": {"type": "Point", "coordinates": [30.5, 1.25]}},
        {"type": "Feature", "properties": {"district_code": "Q02"}, "geometry": None}]}
    p = os.path.join(tmp_dir, "d.geojson")
    _write(p, json.dumps(doc, indent=2))
    rows = Fs.read_districts_geojson(spark, p)
    assert rows.columns == ["district_code", "district_name", "region", "population", "geometry"]
    r = rows.first()
    assert r.district_code == "Q01" and r.population == 41250 and '"Point"' in r.geometry
    assert [x.region for x in rows.collect()] == ["Upland", None]


def test_one_geojson_file_in_several_tasks(spark, tmp_dir):
    import random
    r = random.Random(2)
    odd = ["}", "{", "[", "]", '"', "\\", "\\\\", '\\"', "features", '"features":[{', "\n", "é"]
    features = [{"type": "Feature", "properties": {"district_code": "".join(r.choice(odd) for _ in range(r.randrange(9))),
                                                   "district_name": str(i), "extra": [{"features": [{"a": 1}]}] * r.randrange(3)},
                 "geometry": {"type": "Polygon", "coordinates": [[[i, j] for j in range(r.choice([1, 2, 60]))]], "m": {}}}
                for i in range(60)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        for case, (indent, ascii_) in enumerate([(None, True), (1, False)]):
            docs = [{"type": "FeatureCollection", "crs": {"features": [{"properties": {"district_name": "no"}}]},
                     "other": [{"properties": {}}], "features": features[:50], "bbox": [1, {"features": [{}]}]},
                    {"features": features[50:], "last": [{"properties": {}}]}, {"features": []}]
            folder = os.path.join(tmp_dir, f"g{case}")
            for k, d in enumerate(docs):
                _write(os.path.join(folder, f"{k}.geojson"), json.dumps(d, indent=indent, ensure_ascii=ascii_))
            for size in ("300b", "64m"):
                spark.conf.set("spark.sql.files.maxPartitionBytes", size)
                spark.conf.set("spark.sql.files.openCostInBytes", "0")
                got = {x.district_name: (x.district_code, json.loads(x.geometry)) for x in
                       Fs.read_districts_geojson(spark, folder).collect()}
                assert got == {f["properties"]["district_name"]: (f["properties"]["district_code"], f["geometry"]) for f in features}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def test_ingest_json_defaults_and_rejects(spark):
    recs = spark.createDataFrame([
        ('{"case_id":"C1","district_code":"Q01","case_date":"2024-01-15"}',),
        ('{"case_id":"C2","district_code":"Q01"}',),
        ('not json',)], "value string")
    good, bad = Fs.ingest_json(recs, "cases")
    g = good.collect()
    assert len(g) == 1 and g[0].lab_confirmed is False
    assert bad.count() == 2
    a, _ = Fs.ingest_json(spark.createDataFrame([('{"alert_id":"A1","district_code":"K","alert_type":"x",'
                                                  '"severity":"high"}',)], "value string"), "alerts")
    assert a.first().status == "active"


def test_check_constraints_and_append(spark, tmp_dir, tables):
    path = os.path.join(tmp_dir, "cases")
    old = tables.cases.limit(10)
    old.write.parquet(path)
    existing = spark.read.parquet(path)
    new = tables.cases.limit(12).unionByName(tables.cases.limit(1).withColumn("case_date", F.lit(None).cast("date")))
    bad = Fs.append_rows(new, path, "cases", existing)
    assert spark.read.parquet(path).count() == 12
    assert bad.count() == 11


def test_import_csv(spark, tmp_dir, tables):
    table = os.path.join(tmp_dir, "cases")
    tables.cases.limit(5).write.parquet(table)
    csv = os.path.join(tmp_dir, "new.csv")
    _write(csv, "case_id,district_code,facility_code,case_date,age_group,gender,case_status,lab_confirmed,outcome\n"
                "CX1,D001,F1,2023-11-02,5-17,F,probable,true,admitted\n"
                "CX2,D001,F1,bad-date,5-17,F,probable,true,admitted\n")
    rejects, bad = Fs.import_csv(spark, csv, table, "cases", "2024-02-01 10:00:00", spark.read.parquet(table))
    assert rejects.count() == 1 and bad.count() == 0
    t = spark.read.parquet(table)
    assert t.count() == 6 and t.filter("case_id = 'CX1'").first().id > 0


def test_create_drop_tables_and_metrics(spark, tmp_dir):
    paths = Fs.create_tables(spark, tmp_dir)
    for name, p in paths.items():
        df = spark.read.parquet(p)
        assert df.count() == 0 and df.columns == schemas.TABLES[name].fieldNames()
    Fs.drop_tables(spark, tmp_dir)
    assert not any(os.path.exists(p) for p in paths.values())
    runs = spark.createDataFrame([("r1", "D1", "XGBoost", None, {"a": "1"}, {"mae": 1.0})], schemas.MODEL_RUNS)
    mp = os.path.join(tmp_dir, "runs")
    Fs.write_metrics(runs, mp)
    Fs.write_metrics(runs, mp)
    assert spark.read.parquet(mp).count() == 2


def test_api_shape(tables):
    assert Fs.api_shape(tables.cases, "cases").columns == schemas.response_columns("cases")


def test_merge_reduces_repeated_keys(spark):
    schema = "district_code string, date string, rainfall_mm double, temperature_celsius double, " \
             "humidity_percent double, data_source string"
    r = spark.createDataFrame([("A", "d1", 1.0, None, None, "r1"), ("A", "d1", 3.0, None, None, "r2")], schema)
    t = spark.createDataFrame([("A", "d1", None, 20.0, None, "t")] * 3, schema)
    h = spark.createDataFrame([("A", "d1", None, None, 50.0, "h")], schema)
    out = Fs.merge_climate_files(r, t, h).collect()
    assert len(out) == 1 and out[0].rainfall_mm == 2.0 and out[0].data_source == "r1"


def test_append_rejects_unknown_parents_and_wide_values(spark, tmp_dir, tables):
    path = os.path.join(tmp_dir, "cases")
    rows = tables.cases.limit(6).collect()
    changed = [rows[0].asDict() | {"district_code": "NOPE"}, rows[1].asDict() | {"case_status": "x" * 21},
               rows[2].asDict() | {"facility_code": None}, rows[3].asDict() | {"facility_code": "NOPE"},
               rows[4].asDict() | {"facility_code": None, "district_code": None}]
    new = spark.createDataFrame([tuple(r[c] for c in tables.cases.columns) for r in changed], schemas.CASES)
    bad = Fs.append_rows(new, path, "cases", None, {"districts": tables.districts, "health_facilities": tables.facilities})
    assert sorted(r.id for r in bad.collect()) == sorted(r["id"] for r in (changed[0], changed[1], changed[3]))
    assert spark.read.parquet(path).count() == 2


def test_conform_stores_the_declared_scale(spark):
    df = spark.createDataFrame([(1, 74.996), (2, -0.125), (3, None)], "id long, risk_score double")
    assert [r.risk_score for r in Fs.conform(df, "risk_predictions").orderBy("id").collect()] == [75.0, -0.13, None]


def test_snapshots_become_current_when_finished(spark, tmp_dir, tables):
    base = os.path.join(tmp_dir, "alerts")
    assert Fs.read_snapshot(spark, base, "alerts").count() == 0
    assert Fs.replace_table(tables.alerts.limit(3), base, "alerts") == 1
    assert Fs.replace_table(tables.alerts.limit(2), base, "alerts") == 2
    os.makedirs(os.path.join(base, "v=000009"))  # a write that never finished
    assert Fs.current_version(spark, base) == 2 and Fs.read_snapshot(spark, base, "alerts").count() == 2
