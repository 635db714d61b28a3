"""The bindings of ``riskpanel.sources.bindings`` written as DuckDB SQL.

``with_bindings(sql)`` prefixes a query with CTEs named like the engine tables,
so an oracle query reads ``cases``, ``climate_data`` ... exactly as the Spark
side does. Literals are typed as DOUBLE so both engines do the same float math.
"""

BINDING_CTES = r"""
districts AS (
  SELECT CAST(n.n_nationkey AS BIGINT) AS id, printf('D%03d', n.n_nationkey) AS district_code,
         n.n_name AS district_name, r.r_name AS region,
         CAST((n.n_nationkey + 1) * 1000 AS INTEGER) AS population,
         CAST(NULL AS VARCHAR) AS geometry,
         CAST(NULL AS TIMESTAMP) AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
health_facilities AS (
  SELECT s_suppkey AS id, 'F' || CAST(s_suppkey AS VARCHAR) AS facility_code,
         s_name AS facility_name, printf('D%03d', s_nationkey) AS district_code,
         CAST(NULL AS VARCHAR) AS facility_type, CAST(NULL AS DOUBLE) AS latitude,
         CAST(NULL AS DOUBLE) AS longitude, CAST(NULL AS VARCHAR) AS geometry,
         CAST(NULL AS TIMESTAMP) AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at
  FROM supplier),
cases AS (
  SELECT o.o_orderkey AS id, 'C' || CAST(o.o_orderkey AS VARCHAR) AS case_id,
         printf('D%03d', c.c_nationkey) AS district_code,
         'F' || CAST(o.o_orderkey % 110 AS VARCHAR) AS facility_code,
         CAST(o.o_orderdate AS DATE) AS case_date,
         CASE substr(o.o_orderpriority, 1, 1) WHEN '1' THEN '0-5' WHEN '2' THEN '6-17'
              WHEN '3' THEN '18-59' WHEN '4' THEN '60+' END AS age_group,
         CASE o.o_orderkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END AS gender,
         CASE WHEN o.o_orderstatus = 'F' THEN 'confirmed' ELSE 'suspected' END AS case_status,
         (o.o_orderstatus = 'F') AS lab_confirmed,
         CASE o.o_orderstatus WHEN 'F' THEN 'recovered' WHEN 'P' THEN 'died'
              WHEN 'O' THEN 'ongoing' END AS outcome,
         o.o_orderdate AS created_at, o.o_orderdate AS updated_at
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
shipments_ AS (
  SELECT s.s_nationkey, CAST(l.l_shipdate AS DATE) AS d, l.l_quantity, l.l_discount, l.l_tax,
         l.l_returnflag
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey),
climate_data AS (
  SELECT CAST(s_nationkey AS BIGINT) * 100000 + datediff('day', DATE '1970-01-01', d) AS id,
         printf('D%03d', s_nationkey) AS district_code, d AS date,
         sum(CAST(round(l_quantity) AS INTEGER)) / count(*) AS rainfall_mm,
         15.0::DOUBLE + 2.5::DOUBLE * sum(CAST(round(l_discount * 100) AS INTEGER)) / count(*)
           AS temperature_celsius,
         10.0::DOUBLE * sum(CAST(round(l_tax * 100) AS INTEGER)) / count(*) AS humidity_percent,
         'station' AS data_source,
         CAST(NULL AS TIMESTAMP) AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at
  FROM shipments_ GROUP BY s_nationkey, d),
water_extent AS (
  SELECT CAST(s_nationkey AS BIGINT) * 100000 + datediff('day', DATE '1970-01-01', d) AS id,
         printf('D%03d', s_nationkey) AS district_code, d AS date,
         sum(CAST(round(l_quantity) AS INTEGER)) / 10.0::DOUBLE AS water_area_sqkm,
         CAST(count(*) AS DOUBLE) AS flood_risk_score,
         'satellite' AS data_source,
         CAST(NULL AS TIMESTAMP) AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at
  FROM shipments_ WHERE l_returnflag = 'R' GROUP BY s_nationkey, d),
event_keys_ AS (
  SELECT event_id, ts, event_type, user_id,
         printf('D%03d', user_id % 25) AS district_code,
         CAST(4 * (1 + event_id % 3) AS INTEGER) AS prediction_horizon_weeks,
         ((event_id * 7919) % 10001) / 100.0::DOUBLE AS risk_score,
         ['LSTM', 'XGBoost', 'Prophet', 'ARIMA', 'Ensemble'][CAST(event_id % 5 AS INTEGER) + 1]
           AS model_name
  FROM events),
risk_predictions AS (
  SELECT event_id AS id, district_code, CAST(ts AS DATE) AS prediction_date,
         prediction_horizon_weeks, risk_score,
         floor(risk_score * 80.0::DOUBLE + 0.500001::DOUBLE) / 100.0::DOUBLE
           AS confidence_interval_lower,
         floor(risk_score * 120.0::DOUBLE + 0.500001::DOUBLE) / 100.0::DOUBLE
           AS confidence_interval_upper,
         model_name, '1.0' AS model_version,
         '{"rainfall_lag":7,"temperature_lag":14,"cases_lag":21,"water_extent_lag":7}'
           AS features_used,
         ts AS created_at, ts AS updated_at
  FROM event_keys_ WHERE event_type <> 'error'),
alerts AS (
  SELECT event_id AS id, 'A' || CAST(event_id AS VARCHAR) AS alert_id, district_code,
         'cholera_risk' AS alert_type,
         CASE WHEN risk_score >= 90.0 THEN 'critical' WHEN risk_score >= 75.0 THEN 'high'
              WHEN risk_score >= 50.0 THEN 'medium' ELSE 'low' END AS severity,
         risk_score, prediction_horizon_weeks, ts AS triggered_at,
         CAST(NULL AS TIMESTAMP) AS acknowledged_at, CAST(NULL AS VARCHAR) AS acknowledged_by,
         CASE event_id % 4 WHEN 0 THEN 'acknowledged' WHEN 1 THEN 'resolved' ELSE 'active' END
           AS status,
         ts AS created_at, ts AS updated_at
  FROM event_keys_ WHERE event_type = 'error' AND user_id % 3 = 0)
"""


def with_bindings(sql: str) -> str:
    """Prefix ``sql`` (which may start with its own WITH list) with the binding CTEs."""
    body = sql.strip()
    if body[:4].upper() == "WITH":
        return "WITH " + BINDING_CTES.strip() + ",\n" + body[4:].lstrip()
    return "WITH " + BINDING_CTES.strip() + "\n" + body
