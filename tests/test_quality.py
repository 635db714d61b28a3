import datetime as dt

from riskpanel import config as C
from riskpanel.operators import aggregates as A
from riskpanel.operators import quality as Q
from riskpanel.operators.quality import Rule


def _days(n):
    return [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(n)]


def test_completeness_detects_missing_rainfall(spark):
    # 30 days, 6 rainfall values missing: completeness 0.8 < 0.9; complete data > 0.9
    rows = [("D1", d, 1, None if i < 6 else 10.0, 25.0) for i, d in enumerate(_days(30))]
    df = spark.createDataFrame(rows, "district_code string, date date, cases_count long, "
                                     "rainfall_mm double, temperature_celsius double")
    r = A.completeness(df, C.GATE_COLUMNS).first()
    assert abs(r.rainfall_mm_completeness - 0.8) < 1e-12 and r.min_completeness < 0.9
    full = df.fillna({"rainfall_mm": 1.0})
    assert A.completeness(full, C.GATE_COLUMNS).first().min_completeness > 0.9


def test_between_rule_with_mostly(spark):
    rows = [("D1", 10.0, 25.0, 50.0), ("D1", 250.0, 10.0, 50.0), ("D1", 5.0, 30.0, 120.0), ("D1", None, 20.0, 40.0)]
    df = spark.createDataFrame(rows, "district_code string, rainfall_mm double, temperature_celsius double, "
                                     "humidity_percent double")
    rules = [Rule("between", c, rng, C.CLIMATE_MOSTLY) for c, rng in C.CLIMATE_RANGES.items()]
    out = {r.column_name: r for r in Q.evaluate_suite(df, "climate_data", rules).collect()}
    assert out["rainfall_mm"].evaluated == 3 and out["rainfall_mm"].unexpected == 1
    assert not out["rainfall_mm"].success          # 2/3 < 0.95
    assert out["temperature_celsius"].unexpected == 1
    assert not out["humidity_percent"].success


def test_unique_counts_every_copy(spark):
    rows = [("D1", "C1"), ("D1", "C1"), ("D1", "C2"), ("D2", "C1"), ("D1", None)]
    df = spark.createDataFrame(rows, "district_code string, case_id string")
    out = {r.district_code: r for r in Q.unique_rule(df, "case_id").collect()}
    assert (out["D1"].evaluated, out["D1"].unexpected, out["D1"].success) == (3, 2, False)
    assert out["D2"].success


def test_columns_and_type_rules(tables):
    assert Q.columns_match(tables.cases, C.CASES_COLUMNS)
    assert not Q.columns_match(tables.cases.drop("outcome"), C.CASES_COLUMNS)
    assert Q.type_matches(tables.cases, "case_date", "date")
    assert not Q.type_matches(tables.cases, "case_id", "date")


def test_row_count_rule_sees_empty_districts(spark, tables):
    r = {x.district_code: x for x in Q.row_count_rule(tables.cases.filter("district_code = 'D001'"),
                                                       tables.districts).collect()}
    assert r["D000"].n_rows == 0 and not r["D000"].success
    assert r["D001"].success


def test_district_without_data_is_valid(spark, tables):
    empty = tables.cases.limit(0)
    out = Q.validate_districts(tables.districts, {"cases": empty}).collect()
    assert all(r.overall_validation_success and r.tables_checked == 0 for r in out)


def test_gate_post_fill_vs_pre_fill(spark):
    rows = [("D1", d, 1 if i % 2 else None, None, 20.0) for i, d in enumerate(_days(40))]
    df = spark.createDataFrame(rows, "district_code string, date date, cases_count long, "
                                     "rainfall_mm double, temperature_celsius double")
    pre = Q.panel_gate(df, stage="pre_fill").first()
    assert not pre.passed and pre.reason == "low_completeness"
    short = Q.panel_gate(df.limit(10)).first()
    assert short.reason == "insufficient_days"
    post = Q.panel_gate(df.fillna({"cases_count": 0, "rainfall_mm": 1.0})).first()
    assert post.passed and post.reason is None


def test_quality_report_parts(tables):
    from riskpanel.api import quality_report
    rules, per_district, summary = quality_report(tables.districts, tables.cases, tables.climate, tables.predictions)
    s = summary.first()
    assert s.total_validated == tables.districts.count() == per_district.count()
    assert s.successful_validations + s.failed_validations == s.total_validated
    assert set(r.table_name for r in rules.select("table_name").distinct().collect()) == \
        {"cases", "climate_data", "risk_predictions"}
