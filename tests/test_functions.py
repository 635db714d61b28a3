import datetime as dt

from pyspark.sql import functions as F

from riskpanel import config as C
from riskpanel.functions import scalar as X


def test_severity_levels(spark):
    df = spark.createDataFrame([(95.0,), (80.0,), (60.0,), (30.0,), (None,)], "s double")
    got = [r[0] for r in df.select(X.severity("s")).collect()]
    assert got == ["critical", "high", "medium", "low", "low"]


def test_thresholds_override_and_read_back(spark):
    th = X.thresholds(critical=95.0, high=80.0)
    assert th["critical"] == 95.0 and th["high"] == 80.0 and th["medium"] == 50.0
    assert C.RISK_THRESHOLDS["critical"] == 90.0  # the defaults are untouched
    df = spark.createDataFrame([(92.0,), (85.0,)], "s double")
    assert [r[0] for r in df.select(X.severity("s", th)).collect()] == ["high", "high"]


def test_risk_band_edges(spark):
    df = spark.createDataFrame([(75.01,), (75.0,), (50.01,), (50.0,), (None,)], "s double")
    assert [r[0] for r in df.select(X.risk_band("s")).collect()] == ["high", "medium", "medium", "low", None]


def test_clamp_fallback_and_bounds(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (140.0,), (42.5,), (float("nan"),)], "s double")
    rows = df.select(X.clamp("s").alias("c"), X.fallback_flag("s").alias("f")).collect()
    assert [r.c for r in rows] == [50.0, 0.0, 100.0, 42.5, 50.0]
    assert [r.f for r in rows] == [True, False, False, False, True]


def test_interval_bounds_not_clamped(spark):
    df = spark.createDataFrame([(80.0,), (90.0,), (33.33,)], "s double")
    lo, hi = X.interval_bounds("s")
    rows = df.select(lo.alias("lo"), hi.alias("hi")).collect()
    assert [(r.lo, r.hi) for r in rows] == [(64.0, 96.0), (72.0, 108.0), (26.66, 40.0)]


def test_calendar_parts_monday_zero(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 7),)], "d date")
    parts = X.calendar_parts("d")
    rows = df.select(*[c.alias(n) for n, c in parts.items()]).collect()
    assert [r.day_of_week for r in rows] == [0, 6]
    assert rows[0].month == 1 and rows[0].year == 2024


def test_season_flags(spark):
    df = spark.range(1, 13).select(F.col("id").cast("int").alias("m"))
    rows = df.select("m", *[c.alias(n) for n, c in X.season_flags("m").items()]).collect()
    for r in rows:
        assert r.is_rainy_season == (1 if r.m in C.RAINY_MONTHS else 0)
        assert r.is_dry_season == (1 - r.is_rainy_season)


def test_features_json_round_trip(spark):
    df = spark.range(1).select(X.features_json().alias("j"))
    m = df.select(X.features_map("j").alias("m")).first().m
    assert m == C.FEATURES_USED


def test_alert_id_deterministic(spark):
    df = spark.createDataFrame([("D001", 8)], "d string, h int")
    a = df.select(X.alert_id("d", "h")).first()[0]
    b = df.select(X.alert_id("d", "h")).first()[0]
    assert a == b and len(a) == 32


def test_display_formats(spark):
    df = spark.createDataFrame([(12345.0, 57.25)], "n double, s double")
    r = df.select(X.display_count("n").alias("n"), X.display_score("s").alias("s")).first()
    assert r.n == "12,345" and r.s == "57.3"


def test_r4_tie_safe(spark):
    df = spark.createDataFrame([(0.12345,), (1.00005,), (2.0,)], "x double")
    assert [r[0] for r in df.select(X.r4("x")).collect()] == [0.1235, 1.0001, 2.0]


def test_panel_fill_rules(tables):
    """Cases and flood score fill with 0; measures with the district mean; a
    district with no climate rows keeps null measures (sf0.001 has such districts)."""
    from pyspark.sql import functions as F
    from riskpanel.plans.panel import training_panel
    p = training_panel(tables.cases, tables.climate, tables.water, tables.districts, "2001-08-01")
    assert p.filter(F.col("cases_count").isNull() | F.col("flood_risk_score").isNull()).count() == 0
    per = p.groupBy("district_code").agg(F.count("rainfall_mm").alias("n"), F.count("*").alias("rows")).collect()
    assert all(r.rows == 366 for r in per)
    assert all(r.n in (0, 366) for r in per)
    assert any(r.n == 0 for r in per) and any(r.n == 366 for r in per)


def test_district_statistics_zero_fill(tables):
    from riskpanel.plans.reports import district_statistics
    rows = district_statistics(tables.districts, tables.cases, tables.climate, "2001-08-01").collect()
    assert len(rows) == 25
    assert all(r.avg_rainfall_30d is not None and r.total_cases is not None for r in rows)


def test_panel_is_one_row_per_day_with_repeated_readings(tables):
    """Copies of a (district, day) in both climate and water do not multiply."""
    from pyspark.sql import functions as F
    from riskpanel.plans.panel import training_panel
    clim = tables.climate.unionByName(tables.climate).unionByName(tables.climate)
    wat = tables.water.unionByName(tables.water)
    p = training_panel(tables.cases, clim, wat, tables.districts, "2001-08-01")
    base = training_panel(tables.cases, tables.climate, tables.water, tables.districts, "2001-08-01")
    assert p.count() == base.count() == 25 * 366
    a = p.agg(F.sum("rainfall_mm"), F.sum("water_area_sqkm")).first()
    b = base.agg(F.sum("rainfall_mm"), F.sum("water_area_sqkm")).first()
    assert abs(a[0] - b[0]) < 1e-6 and abs(a[1] - b[1]) < 1e-6


def test_national_statistics_unknown_district_counts_in_totals_only(spark, tables):
    import datetime as dt
    from pyspark.sql import functions as F
    from riskpanel.plans.reports import national_statistics
    stray = tables.cases.limit(1).select(
        *[F.lit("ZZZ").alias(c) if c == "district_code" else
          (F.lit(dt.date(2001, 7, 30)).alias(c) if c == "case_date" else F.col(c)) for c in tables.cases.columns])
    base = {(r.metric, r.label): r.value for r in national_statistics(tables.districts, tables.cases, "2001-08-01").collect()}
    more = {(r.metric, r.label): r.value for r in
            national_statistics(tables.districts, tables.cases.unionByName(stray), "2001-08-01").collect()}
    assert more[("total_cases", None)] == base[("total_cases", None)] + 1
    assert more[("recent_cases_30d", None)] == base[("recent_cases_30d", None)] + 1
    region = {k: v for k, v in base.items() if k[0] == "cases_by_region"}
    assert {k: v for k, v in more.items() if k[0] == "cases_by_region"} == region
    assert sum(region.values()) == base[("recent_cases_30d", None)]
