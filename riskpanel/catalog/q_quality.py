"""Data-quality queries (2.9). The oracle SQL is written from the same rule
list, so both engines evaluate the same rules independently."""

from riskpanel import config as C
from riskpanel.catalog.base import CASES_AS_OF, register
from riskpanel.catalog.sqlparts import calendar, panel_sql
from riskpanel.operators import quality as Q
from riskpanel.operators.quality import Rule
from riskpanel.plans.panel import raw_panel, training_panel


def _lit(v):
    return "'" + str(v) + "'" if isinstance(v, str) else str(v)


def _sql_counters(r: Rule, i: int) -> str:
    c = r.column
    if r.kind == "row_count":
        return f"count(*) AS e{i}, CAST(NULL AS BIGINT) AS u{i}"
    if r.kind == "not_null":
        return f"count(*) AS e{i}, count_if({c} IS NULL) AS u{i}"
    if r.kind == "equals":
        wanted = _lit(r.args[0]) if r.args else "district_code"
        return f"count({c}) AS e{i}, count_if({c} <> {wanted}) AS u{i}"
    if r.kind == "in_set":
        vals = ", ".join(_lit(v) for v in r.args)
        return f"count({c}) AS e{i}, count_if({c} IS NOT NULL AND {c} NOT IN ({vals})) AS u{i}"
    if r.kind == "between":
        lo, hi = r.args
        return f"count({c}) AS e{i}, count_if({c} IS NOT NULL AND NOT ({c} BETWEEN {lo} AND {hi})) AS u{i}"
    raise ValueError(r.kind)


def _sql_success(r: Rule) -> str:
    if r.kind == "row_count":
        return f"evaluated BETWEEN {r.args[0]} AND {r.args[1]}"
    if r.kind == "not_null":
        return "unexpected = 0"
    return f"(evaluated = 0 OR CAST(evaluated - unexpected AS DOUBLE) >= {r.mostly}::DOUBLE * CAST(evaluated AS DOUBLE))"


def suite_sql(table: str, rules, source: str | None = None) -> str:
    """DuckDB rule rows of a suite (a SELECT, no trailing semicolon)."""
    src = source or table
    data = [(i, r) for i, r in enumerate(rules) if r.kind not in ("columns", "type", "unique")]
    sels = []
    if data:
        agg = f"(SELECT district_code, {', '.join(_sql_counters(r, i) for i, r in data)} FROM {src} GROUP BY district_code)"
        for i, r in data:
            col = _lit(r.column) if r.column else "CAST(NULL AS VARCHAR)"
            sels.append(f"SELECT district_code, {i} AS rule_idx, '{r.name}' AS rule, {col} AS column_name, "
                        f"CAST(evaluated AS BIGINT) AS evaluated, CAST(unexpected AS BIGINT) AS unexpected, "
                        f"{_sql_success(r)} AS success FROM (SELECT district_code, e{i} AS evaluated, "
                        f"u{i} AS unexpected FROM {agg} a_)")
    for i, r in enumerate(rules):
        col = _lit(r.column) if r.column else "CAST(NULL AS VARCHAR)"
        if r.kind in ("columns", "type"):
            sels.append(f"SELECT DISTINCT district_code, {i} AS rule_idx, '{r.name}' AS rule, {col} AS column_name, "
                        f"CAST(NULL AS BIGINT) AS evaluated, CAST(NULL AS BIGINT) AS unexpected, true AS success "
                        f"FROM {src}")
        if r.kind == "unique":
            sels.append(f"""SELECT p_.district_code, {i} AS rule_idx, '{r.name}' AS rule, {col} AS column_name,
  CAST(coalesce(u_.ev, 0) AS BIGINT) AS evaluated, CAST(coalesce(u_.un, 0) AS BIGINT) AS unexpected,
  coalesce(u_.un, 0) = 0 AS success
FROM (SELECT DISTINCT district_code FROM {src}) p_ LEFT JOIN
  (SELECT district_code, sum(c) AS ev, coalesce(sum(CASE WHEN c > 1 THEN c END), 0) AS un
   FROM (SELECT district_code, {r.column}, count(*) AS c FROM {src} WHERE {r.column} IS NOT NULL GROUP BY ALL)
   GROUP BY district_code) u_ USING (district_code)""")
    body = "\nUNION ALL\n".join(sels)
    return f"""SELECT '{table}' AS table_name, district_code, rule_idx, rule, column_name, evaluated, unexpected,
  CASE WHEN evaluated = 0 THEN NULL ELSE unexpected * 100.0::DOUBLE / evaluated END AS unexpected_pct, success
FROM ({body}) s_"""


PCT = ["unexpected_pct"]


def _suite_query(name, section, table, rules, attr):
    def q(t):
        return Q.evaluate_suite(getattr(t, attr), table, rules)
    kinds = ", ".join(sorted({r.kind for r in rules}))
    q.__doc__ = f"Rule rows ({kinds}) of the {table} table for every district that has rows."
    return register(name, section, suite_sql(table, rules), PCT)(q)


_suite_query("dq_cases_suite", "D9", "cases", Q.CASES_SUITE, "cases")
_suite_query("dq_climate_suite", "D10", "climate_data", Q.CLIMATE_SUITE, "climate_data")
_suite_query("dq_predictions_suite", "D11", "risk_predictions", Q.PREDICTIONS_SUITE, "risk_predictions")
_suite_query("dq_not_null", "D4", "risk_predictions",
             [r for r in Q.PREDICTIONS_SUITE if r.kind == "not_null"], "risk_predictions")
_suite_query("dq_equals", "D5", "climate_data",
             [r for r in Q.CLIMATE_SUITE if r.kind == "equals"], "climate_data")
_suite_query("dq_in_set", "D7", "cases", [r for r in Q.CASES_SUITE if r.kind == "in_set"], "cases")
_suite_query("dq_between", "D8", "climate_data",
             [r for r in Q.CLIMATE_SUITE if r.kind == "between"], "climate_data")


@register("dq_row_count", "D1", """
SELECT d.district_code, coalesce(n.n_rows, 0) AS n_rows, coalesce(n.n_rows, 0) BETWEEN 1 AND 10000 AS success
FROM districts d LEFT JOIN (SELECT district_code, count(*) AS n_rows FROM cases GROUP BY 1) n
USING (district_code)""")
def q_dq_row_count(t):
    """Cases per district within 1..10000; districts with no cases are seen (and fail)."""
    return Q.row_count_rule(t.cases, t.districts)


@register("dq_unique", "D3", f"""
SELECT district_code, evaluated, unexpected, success FROM ({suite_sql('cases', [Rule('unique', 'case_id')])})""")
def q_dq_unique(t):
    """case_id unique within each district; every copy of a repeated id counts."""
    return Q.unique_rule(t.cases, "case_id")


ALL_SUITES_SQL = "\nUNION ALL\n".join([
    suite_sql("cases", Q.CASES_SUITE), suite_sql("climate_data", Q.CLIMATE_SUITE),
    suite_sql("risk_predictions", Q.PREDICTIONS_SUITE)])

DISTRICT_SQL = f"""
WITH r_ AS ({ALL_SUITES_SQL}),
pt_ AS (SELECT district_code, table_name, bool_and(success) AS ok FROM r_ GROUP BY ALL),
pd_ AS (SELECT district_code, count(*) AS tables_checked, count_if(ok) AS tables_passed FROM pt_ GROUP BY 1)
SELECT d.district_code, coalesce(pd_.tables_checked, 0) AS tables_checked,
       coalesce(pd_.tables_passed, 0) AS tables_passed,
       coalesce(pd_.tables_checked, 0) = coalesce(pd_.tables_passed, 0) AS overall_validation_success
FROM districts d LEFT JOIN pd_ USING (district_code)"""


def _validate(t):
    return Q.validate_districts(t.districts, {"cases": t.cases, "climate_data": t.climate,
                                              "risk_predictions": t.predictions})


@register("dq_district", "D12", DISTRICT_SQL)
def q_dq_district(t):
    """Per district: suites run, suites passed, overall success (no data = valid)."""
    return _validate(t)


@register("dq_report", "D13", f"SELECT * FROM ({ALL_SUITES_SQL})", PCT)
def q_dq_report(t):
    """Every rule row of the three suites for all districts in one report."""
    from functools import reduce
    from pyspark.sql import DataFrame
    return reduce(DataFrame.unionByName, [
        Q.evaluate_suite(t.cases, "cases"), Q.evaluate_suite(t.climate, "climate_data"),
        Q.evaluate_suite(t.predictions, "risk_predictions")])


@register("quality_summary", "A23", f"""
WITH x_ AS ({DISTRICT_SQL})
SELECT count(*) AS total_validated, count_if(overall_validation_success) AS successful_validations,
       count_if(NOT overall_validation_success) AS failed_validations FROM x_""")
def q_quality_summary(t):
    """Validated, successful and failed districts of the quality report."""
    return Q.quality_summary(_validate(t))


def _gate_sql(src: str, stage: str) -> str:
    cols = C.GATE_COLUMNS
    comps = [f"avg(CAST({c} IS NOT NULL AS DOUBLE))" for c in cols]
    days = "count(*)" if stage == "post_fill" else (
        "count(CASE WHEN coalesce(CAST(cases_count AS DOUBLE), rainfall_mm, temperature_celsius) IS NOT NULL THEN 1 END)")
    return f"""
WITH g_ AS (SELECT district_code, {days} AS n_days, least({', '.join(comps)}) AS min_completeness
            FROM {src} GROUP BY 1)
SELECT district_code, n_days, min_completeness, '{stage}' AS stage,
  CASE WHEN n_days < {C.MIN_DAYS} THEN 'insufficient_days'
       WHEN min_completeness < {C.MIN_COMPLETENESS} THEN 'low_completeness' END AS reason,
  NOT (n_days < {C.MIN_DAYS} OR min_completeness < {C.MIN_COMPLETENESS}) AS passed FROM g_"""


Y1 = "2000-08-01"
RAW_SQL = f"""(WITH cal_ AS ({calendar(Y1, CASES_AS_OF)}),
daily_ AS (SELECT district_code, case_date AS date, count(*) AS cases_count FROM cases
           WHERE case_date BETWEEN DATE '{Y1}' AND DATE '{CASES_AS_OF}' GROUP BY ALL),
clim_ AS (SELECT district_code, date, avg(rainfall_mm) AS rainfall_mm,
                 avg(temperature_celsius) AS temperature_celsius, avg(humidity_percent) AS humidity_percent
          FROM climate_data WHERE date BETWEEN DATE '{Y1}' AND DATE '{CASES_AS_OF}' GROUP BY ALL)
SELECT * FROM cal_ LEFT JOIN daily_ USING (district_code, date) LEFT JOIN clim_ USING (district_code, date))"""


@register("panel_gate", "D14", _gate_sql(f"({panel_sql()})", "post_fill"), ["min_completeness"])
def q_panel_gate(t):
    """Gate on the filled panel (the application's check): days, columns, completeness."""
    return Q.panel_gate(training_panel(t.cases, t.climate, t.water, t.districts, CASES_AS_OF))


@register("panel_gate_pre_fill", "D14", _gate_sql(RAW_SQL, "pre_fill"), ["min_completeness"])
def q_panel_gate_pre_fill(t):
    """The same gate on the calendar before filling, where sparse districts fail."""
    return Q.panel_gate(raw_panel(t.cases, t.climate, t.districts, CASES_AS_OF), stage="pre_fill")


def _tables(t):
    return {"districts": t.districts, "health_facilities": t.facilities, "cases": t.cases,
            "climate_data": t.climate, "water_extent": t.water, "risk_predictions": t.predictions,
            "alerts": t.alerts}


def _uk_sql():
    from riskpanel import schemas
    parts = []
    for name, keys in schemas.KEYS.items():
        k = ", ".join(keys)
        parts.append(f"SELECT '{name}' AS table_name, count(*) AS duplicate_keys, coalesce(sum(c), 0) AS duplicate_rows "
                     f"FROM (SELECT {k}, count(*) AS c FROM {name} GROUP BY {k} HAVING count(*) > 1)")
    return "\nUNION ALL\n".join(parts)


def _counts_sql(spec):
    parts = []
    for name, cols in spec.items():
        for c, expr in cols.items():
            parts.append(f"SELECT '{name}' AS table_name, '{c}' AS column_name, count_if({expr}) AS violations FROM {name}")
    return "\nUNION ALL\n".join(parts)


def _req_sql():
    from riskpanel import schemas
    return _counts_sql({n: {c: f"{c} IS NULL" for c in cols} for n, cols in schemas.REQUIRED.items()})


def _fits_sql():
    from riskpanel import schemas
    spec = {}
    for n, cols in schemas.DECLARED.items():
        spec[n] = {c: (f"length({c}) > {s[1]}" if s[0] == "string"
                       else f"{c} IS NOT NULL AND TRY_CAST({c} AS DECIMAL({s[1]},{s[2]})) IS NULL")
                   for c, s in cols.items()}
    return _counts_sql(spec)


@register("dq_unique_key", "D15", _uk_sql())
def q_dq_unique_key(t):
    """Per table: keys that occur more than once and the rows they cover."""
    return Q.unique_key_report(_tables(t))


@register("dq_required", "D16", _req_sql())
def q_dq_required(t):
    """Per table: nulls in each NOT NULL column."""
    return Q.required_report(_tables(t))


@register("dq_fits_type", "D17", _fits_sql())
def q_dq_fits_type(t):
    """Per table: values that overflow the declared text length or decimal precision."""
    return Q.fits_type_report(_tables(t))


def _fk_sql():
    from riskpanel import schemas
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS table_name, '{col}' AS column_name, '{p}' AS parent_table, count(*) AS orphans "
        f"FROM {c} x WHERE x.{col} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} y WHERE y.{pc} = x.{col})"
        for c, col, p, pc in schemas.FOREIGN_KEYS)


@register("fk_orphans", "J5", _fk_sql())
def q_fk_orphans(t):
    """Orphan rows of every declared foreign key."""
    return Q.foreign_key_report(_tables(t))


_suite_query("dq_equals_value", "D5", "risk_predictions",
             [Rule("equals", "model_name", ("Ensemble",)), Rule("equals", "prediction_horizon_weeks", (8,), 0.2)],
             "risk_predictions")
_suite_query("dq_unique_two", "D3", "cases", [Rule("unique", "case_id"), Rule("unique", "facility_code")], "cases")


def _schema_rules_sql(rows):
    return "\nUNION ALL\n".join(
        f"SELECT DISTINCT '{name}' AS table_name, district_code, '{r.name}' AS rule, "
        f"{_lit(r.column) if r.column else 'CAST(NULL AS VARCHAR)'} AS column_name, {str(ok).lower()} AS success FROM {name}"
        for name, r, ok in rows)


SCHEMA_RULES = [("cases", Rule("columns", None, tuple(C.CASES_COLUMNS)), False),
                ("cases", Rule("type", "case_date", ("date",)), False),
                ("cases", Rule("type", "lab_confirmed", ("boolean",)), True),
                ("cases", Rule("type", "missing", ("date",)), False)]


@register("dq_columns_and_types", "D2", _schema_rules_sql(SCHEMA_RULES))
def q_dq_columns_and_types(t):
    """The column-list and type rules on a case table with one column dropped and
    the case date as text: what must fail fails (D2, D6)."""
    from pyspark.sql import functions as F
    wrong = t.cases.drop("gender").withColumn("case_date", F.col("case_date").cast("string"))
    return Q.evaluate_suite(wrong, "cases", [r for _, r, _ in SCHEMA_RULES]).select(
        "table_name", "district_code", "rule", "column_name", "success")


@register("model_features", "F12", """
SELECT district_code, count(*) AS n_days, count(cases_roll_7) AS n_cases_roll_7, 32 AS n_features FROM ("""
          + panel_sql() + """) GROUP BY 1""")
def q_model_features(t):
    """The feature columns of the panel (all but the keys' date and the target), used to
    select the training frame: rows and non-null values per district."""
    from pyspark.sql import functions as F
    from riskpanel.operators.predicates import model_features
    panel = training_panel(t.cases, t.climate, t.water, t.districts, CASES_AS_OF)
    feats = model_features(panel)
    return panel.select(*feats).groupBy("district_code").agg(
        F.count(F.lit(1)).alias("n_days"), F.count("cases_roll_7").alias("n_cases_roll_7"),
        F.lit(len(feats)).alias("n_features"))


STATS_SQL = f"""
WITH r_ AS ({ALL_SUITES_SQL}),
s_ AS (
SELECT 'cases' AS table_name, district_code, min(case_date) AS start_date, max(case_date) AS end_date,
       count(*) AS total_records, count_if(lab_confirmed) AS lab_confirmed_cases, CAST(NULL AS DOUBLE) AS avg_rainfall,
       CAST(NULL AS DOUBLE) AS avg_temperature, CAST(NULL AS DOUBLE) AS avg_humidity, CAST(NULL AS DOUBLE) AS avg_risk_score,
       CAST(NULL AS VARCHAR) AS model_distribution FROM cases GROUP BY district_code
UNION ALL SELECT 'climate_data', district_code, min(date), max(date), count(*), NULL, avg(rainfall_mm),
       avg(temperature_celsius), avg(humidity_percent), NULL, NULL FROM climate_data GROUP BY district_code
UNION ALL SELECT 'risk_predictions', p.district_code, min(prediction_date), max(prediction_date), count(*), NULL, NULL, NULL, NULL,
       avg(risk_score), any_value(m.d) FROM risk_predictions p LEFT JOIN (
         SELECT district_code, '{{' || string_agg('"' || model_name || '":' || n, ',' ORDER BY model_name) || '}}' AS d
         FROM (SELECT district_code, model_name, count(*) AS n FROM risk_predictions WHERE model_name IS NOT NULL GROUP BY ALL)
         GROUP BY district_code) m ON m.district_code = p.district_code GROUP BY p.district_code)
SELECT r_.*, s_.* EXCLUDE (table_name, district_code) FROM r_ LEFT JOIN s_ USING (table_name, district_code)"""


@register("quality_report", "D13", STATS_SQL, PCT + ["avg_rainfall", "avg_temperature", "avg_humidity", "avg_risk_score"])
def q_quality_report(t):
    """The report's rule rows with each suite's statistics beside them."""
    rules, _, _ = Q.quality_report(t.districts, t.cases, t.climate, t.predictions)
    return rules
