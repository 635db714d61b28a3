"""Plan properties that matter at scale, read from the physical plans."""

import pytest

from riskpanel.catalog import REGISTRY, run

SF = "/root/testdata/sf0.001"
# queries whose building runs jobs of their own (file round trips, streams, model fits)
EAGER = {e.name for e in REGISTRY.values() if e.section[0] in "SR" and e.section != "A24"} | {
    "boosted_forecast", "sequence_forecast", "ensemble_predictions_full", "daily_job", "weekly_training",
    "daily_job_statistical", "daily_job_stored", "training_request", "write_metrics", "quality_report"}


def plan(spark, name):
    return run(name, spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - EAGER))
def test_no_cross_product_or_nested_loop(spark, name):
    p = plan(spark, name)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_panel_pushes_date_range_into_scan(spark):
    p = plan(spark, "training_panel")
    assert "GreaterThanOrEqual(o_orderdate" in p and "LessThan(o_orderdate" in p
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in p


def test_latest_per_key_combines_before_exchange(spark):
    p = plan(spark, "latest_prediction")
    assert "partial_max_by" in p and "row_number" not in p


def test_rule_suite_is_one_scan(spark):
    p = plan(spark, "dq_cases_suite")
    assert p.count("FileScan parquet") == 2   # orders and customer, each read once
    assert p.count("Exchange hashpartitioning") == 2


def test_district_scan_prunes_partitions(spark):
    p = plan(spark, "scan_table")
    assert "PartitionFilters: [isnotnull(district_code" in p and "(district_code#" in p


def test_no_broadcast_is_forced(spark, tables):
    from riskpanel.operators.joins import cases_with_district
    logical = cases_with_district(tables.cases, tables.districts)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in logical


def scans(spark, name):
    """Planned scans and exchanges, with broadcast joins off and nothing reused."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(spark, name)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    return p.count("FileScan parquet"), p.count("Exchange hashpartitioning")


def test_ensemble_reads_its_series_once(spark):
    both, one = scans(spark, "ensemble_predictions"), scans(spark, "arima_111_forecast")
    assert both[0] == one[0] and both[1] <= one[1] + 1


def test_national_statistics_scan_the_cases_once(spark):
    assert scans(spark, "national_statistics")[0] <= 4  # cases (orders, customer), districts (customer or nation)


def test_foreign_keys_are_counted_before_they_are_joined(spark):
    p = plan(spark, "fk_orphans")
    assert "partial_count" in p
