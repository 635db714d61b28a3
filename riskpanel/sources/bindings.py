"""Engine tables derived from the driver's TPC-H-like parquet files.

These only give rows in the engine's schemas; no job's work happens here.
Rules (fixed, shared with the DuckDB oracle in ``riskpanel.oracle``):

  districts          nation x region; code D%03d of n_nationkey; population 1000*(key+1)
  health_facilities  supplier; code F<suppkey>; district from s_nationkey
  cases              orders x customer; case id C<orderkey>; district from c_nationkey;
                     age group by priority digit 1..4 (5 -> null); gender by orderkey%3;
                     status F confirmed else suspected; outcome F/P/O recovered/died/ongoing;
                     facility F<orderkey % 110>
  climate_data       lineitem x supplier per (nation, ship date): mean quantity,
                     15 + 2.5 * mean(discount cents), 10 * mean(tax cents)
  water_extent       the same on return flag R: quantity sum / 10 and line count
  risk_predictions   events other than 'error'; district D%03d of user_id%25, horizon
                     4*(1+id%3), score ((id*7919) % 10001) / 100, model by id%5
  alerts             'error' events with user_id%3=0; status by id%4
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpanel import config as C
from riskpanel.functions.scalar import code, interval_bounds, severity

# as_of dates of the driver data: last order date, last event day.
CASES_AS_OF = _dt.date(2001, 8, 1)
EVENTS_AS_OF = _dt.date(2024, 1, 30)
EVENTS_AS_OF_TS = _dt.datetime(2024, 1, 30, 0, 0, 0)
N_DISTRICTS_EVENTS = 25
FACILITY_MODULUS = 110


# Schemas of the driver's parquet files, given explicitly so that reading a
# table starts no schema-inference job.
DRIVER_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def _r(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(DRIVER_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _no_stamp():
    return F.lit(None).cast("timestamp_ntz")


def districts(spark, sf_dir) -> DataFrame:
    n = _r(spark, sf_dir, "nation")
    r = _r(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey, "left")
            .select(F.col("n_nationkey").cast("long").alias("id"),
                    code("D", "n_nationkey", 3).alias("district_code"),
                    F.col("n_name").alias("district_name"),
                    F.col("r_name").alias("region"),
                    ((F.col("n_nationkey") + 1) * 1000).cast("int").alias("population"),
                    F.lit(None).cast("string").alias("geometry"),
                    _no_stamp().alias("created_at"), _no_stamp().alias("updated_at")))


def health_facilities(spark, sf_dir) -> DataFrame:
    s = _r(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("id"),
                    code("F", "s_suppkey").alias("facility_code"),
                    F.col("s_name").alias("facility_name"),
                    code("D", "s_nationkey", 3).alias("district_code"),
                    F.lit(None).cast("string").alias("facility_type"),
                    F.lit(None).cast("double").alias("latitude"),
                    F.lit(None).cast("double").alias("longitude"),
                    F.lit(None).cast("string").alias("geometry"),
                    _no_stamp().alias("created_at"), _no_stamp().alias("updated_at"))


def cases(spark, sf_dir) -> DataFrame:
    o = _r(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                           "o_orderdate", "o_orderpriority")
    c = _r(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    digit = F.substring("o_orderpriority", 1, 1)
    g = F.col("o_orderkey") % 3
    st = F.col("o_orderstatus")
    return j.select(
        F.col("o_orderkey").alias("id"),
        code("C", "o_orderkey").alias("case_id"),
        code("D", "c_nationkey", 3).alias("district_code"),
        code("F", F.col("o_orderkey") % FACILITY_MODULUS).alias("facility_code"),
        F.to_date("o_orderdate").alias("case_date"),
        F.when(digit == "1", C.AGE_GROUPS[0]).when(digit == "2", C.AGE_GROUPS[1])
         .when(digit == "3", C.AGE_GROUPS[2]).when(digit == "4", C.AGE_GROUPS[3]).alias("age_group"),
        F.when(g == 0, "M").when(g == 1, "F").alias("gender"),
        F.when(st == "F", "confirmed").otherwise("suspected").alias("case_status"),
        (st == "F").alias("lab_confirmed"),
        F.when(st == "F", "recovered").when(st == "P", "died").when(st == "O", "ongoing").alias("outcome"),
        F.col("o_orderdate").alias("created_at"), F.col("o_orderdate").alias("updated_at"))


def _shipments(spark, sf_dir, returned_only: bool) -> DataFrame:
    li = _r(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity", "l_discount",
                                              "l_tax", "l_returnflag", "l_shipdate")
    if returned_only:
        li = li.filter(F.col("l_returnflag") == "R")
    s = _r(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return li.join(s, li.l_suppkey == s.s_suppkey, "inner").withColumn("d", F.to_date("l_shipdate"))


def climate_data(spark, sf_dir) -> DataFrame:
    j = _shipments(spark, sf_dir, False)
    n = F.count(F.lit(1))
    g = j.groupBy("s_nationkey", "d").agg(
        (F.sum(F.round("l_quantity").cast("int")) / n).alias("rainfall_mm"),
        (F.lit(15.0) + F.lit(2.5) * F.sum(F.round(F.col("l_discount") * 100).cast("int")) / n)
        .alias("temperature_celsius"),
        (F.lit(10.0) * F.sum(F.round(F.col("l_tax") * 100).cast("int")) / n).alias("humidity_percent"))
    return g.select(
        (F.col("s_nationkey").cast("long") * 100000 + F.datediff("d", F.lit("1970-01-01"))).alias("id"),
        code("D", "s_nationkey", 3).alias("district_code"),
        F.col("d").alias("date"), "rainfall_mm", "temperature_celsius", "humidity_percent",
        F.lit("station").alias("data_source"),
        _no_stamp().alias("created_at"), _no_stamp().alias("updated_at"))


def water_extent(spark, sf_dir) -> DataFrame:
    j = _shipments(spark, sf_dir, True)
    g = j.groupBy("s_nationkey", "d").agg(
        (F.sum(F.round("l_quantity").cast("int")) / F.lit(10.0)).alias("water_area_sqkm"),
        F.count(F.lit(1)).cast("double").alias("flood_risk_score"))
    return g.select(
        (F.col("s_nationkey").cast("long") * 100000 + F.datediff("d", F.lit("1970-01-01"))).alias("id"),
        code("D", "s_nationkey", 3).alias("district_code"),
        F.col("d").alias("date"), "water_area_sqkm", "flood_risk_score",
        F.lit("satellite").alias("data_source"),
        _no_stamp().alias("created_at"), _no_stamp().alias("updated_at"))


def _event_keys(e: DataFrame) -> DataFrame:
    cents = (F.col("event_id") * 7919) % 10001
    model_idx = F.col("event_id") % 5
    model = F.element_at(F.array(*[F.lit(m) for m in C.MODEL_NAMES]), (model_idx + 1).cast("int"))
    return e.select(
        "event_id", "ts",
        code("D", F.col("user_id") % N_DISTRICTS_EVENTS, 3).alias("district_code"),
        (F.lit(4) * (F.lit(1) + F.col("event_id") % 3)).cast("int").alias("prediction_horizon_weeks"),
        (cents / F.lit(100.0)).alias("risk_score"),
        model.alias("model_name"))


def risk_predictions(spark, sf_dir) -> DataFrame:
    e = _r(spark, sf_dir, "events").filter(F.col("event_type") != "error")
    k = _event_keys(e)
    lo, hi = interval_bounds("risk_score")
    return k.select(
        F.col("event_id").alias("id"), "district_code",
        F.to_date("ts").alias("prediction_date"), "prediction_horizon_weeks", "risk_score",
        lo.alias("confidence_interval_lower"), hi.alias("confidence_interval_upper"),
        "model_name", F.lit(C.MODEL_VERSION).alias("model_version"),
        F.lit('{"rainfall_lag":7,"temperature_lag":14,"cases_lag":21,"water_extent_lag":7}')
        .alias("features_used"),
        F.col("ts").alias("created_at"), F.col("ts").alias("updated_at"))


def alerts(spark, sf_dir) -> DataFrame:
    e = _r(spark, sf_dir, "events").filter((F.col("event_type") == "error") & (F.col("user_id") % 3 == 0))
    k = _event_keys(e.select("event_id", "ts", "user_id"))
    s = F.col("event_id") % 4
    return k.select(
        F.col("event_id").alias("id"), code("A", "event_id").alias("alert_id"), "district_code",
        F.lit(C.ALERT_TYPE).alias("alert_type"), severity("risk_score").alias("severity"),
        "risk_score", "prediction_horizon_weeks", F.col("ts").alias("triggered_at"),
        F.lit(None).cast("timestamp_ntz").alias("acknowledged_at"),
        F.lit(None).cast("string").alias("acknowledged_by"),
        F.when(s == 0, "acknowledged").when(s == 1, "resolved").otherwise("active").alias("status"),
        F.col("ts").alias("created_at"), F.col("ts").alias("updated_at"))


BUILDERS = {
    "districts": districts,
    "health_facilities": health_facilities,
    "cases": cases,
    "climate_data": climate_data,
    "water_extent": water_extent,
    "risk_predictions": risk_predictions,
    "alerts": alerts,
}


@dataclass
class Tables:
    """Lazily built engine tables over one scale-factor folder."""

    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict)

    def __getattr__(self, name):
        if name.startswith("_") or name not in BUILDERS:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = BUILDERS[name](self.spark, self.sf_dir)
        return self._cache[name]

    @property
    def climate(self):
        return self.climate_data

    @property
    def water(self):
        return self.water_extent

    @property
    def predictions(self):
        return self.risk_predictions

    @property
    def facilities(self):
        return self.health_facilities


_BOUND: dict = {}


def bind(spark: SparkSession, sf_dir: str) -> Tables:
    """The bound tables of one folder; the (lazy, uncached) DataFrames are built
    once per session and folder and reused by every query."""
    key = (id(spark), sf_dir)
    t = _BOUND.get(key)
    if t is None or t.spark is not spark:
        t = _BOUND[key] = Tables(spark, sf_dir)
    return t
