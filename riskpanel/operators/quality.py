"""Data-quality rules as set-based Spark jobs.

A rule row is ``(table_name, district_code, rule, column_name, evaluated, unexpected,
unexpected_pct, success)``. Every rule of a suite is evaluated for all
districts in **one** grouped aggregate (two counters per rule), then unpivoted
to rule rows; column-list and type rules read the schema only (no job).

Semantics: a column rule ignores nulls (except not-null) and passes when the
share of expected values among the non-null ones is at least ``mostly``
(default 1.0); a column that is entirely null passes.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskpanel import config as C
from riskpanel import schemas


@dataclass(frozen=True)
class Rule:
    kind: str            # row_count | columns | unique | not_null | equals | type | in_set | between
    column: str | None = None
    args: tuple = ()
    mostly: float = 1.0

    @property
    def name(self) -> str:
        return {"row_count": "expect_table_row_count_to_be_between",
                "columns": "expect_table_columns_to_match_ordered_list",
                "unique": "expect_column_values_to_be_unique",
                "not_null": "expect_column_values_to_not_be_null",
                "equals": "expect_column_values_to_equal",
                "type": "expect_column_values_to_be_of_type",
                "in_set": "expect_column_values_to_be_in_set",
                "between": "expect_column_values_to_be_between"}[self.kind]


CASES_SUITE = [
    Rule("row_count", None, C.ROW_COUNT_RANGE),
    Rule("columns", None, tuple(C.CASES_COLUMNS)),
    Rule("unique", "case_id"),
    Rule("not_null", "district_code"), Rule("equals", "district_code"),
    Rule("not_null", "case_date"), Rule("type", "case_date", ("date",)),
    Rule("type", "lab_confirmed", ("boolean",)),
    Rule("in_set", "age_group", tuple(C.AGE_GROUPS)),
    Rule("in_set", "gender", tuple(C.GENDERS)),
    Rule("in_set", "outcome", tuple(C.OUTCOMES)),
]
CLIMATE_SUITE = [
    Rule("columns", None, tuple(C.CLIMATE_COLUMNS)),
    Rule("not_null", "district_code"), Rule("equals", "district_code"),
    Rule("not_null", "date"), Rule("type", "date", ("date",)),
] + [Rule("between", c, rng, C.CLIMATE_MOSTLY) for c, rng in C.CLIMATE_RANGES.items()]
PREDICTIONS_SUITE = [
    Rule("columns", None, tuple(C.PREDICTION_COLUMNS)),
    Rule("not_null", "district_code"), Rule("equals", "district_code"),
    Rule("not_null", "prediction_date"), Rule("type", "prediction_date", ("date",)),
    Rule("not_null", "prediction_horizon_weeks"),
    Rule("between", "prediction_horizon_weeks", C.PREDICTION_RANGES["prediction_horizon_weeks"]),
    Rule("not_null", "risk_score"),
    Rule("between", "risk_score", C.PREDICTION_RANGES["risk_score"]),
    Rule("between", "confidence_interval_lower", C.PREDICTION_RANGES["confidence_interval_lower"]),
    Rule("between", "confidence_interval_upper", C.PREDICTION_RANGES["confidence_interval_upper"]),
    Rule("not_null", "model_name"), Rule("in_set", "model_name", tuple(C.MODEL_NAMES)),
]
SUITES = {"cases": CASES_SUITE, "climate_data": CLIMATE_SUITE, "risk_predictions": PREDICTIONS_SUITE}

_TYPES = {"date": (T.DateType, T.TimestampType, T.TimestampNTZType), "boolean": (T.BooleanType,)}


def columns_match(df: DataFrame, expected, ignore=tuple(C.AUDIT_COLUMNS)) -> bool:
    """The ordered column list (audit stamps ignored) equals the expected list."""
    return [c for c in df.columns if c not in ignore] == list(expected)


def type_matches(df: DataFrame, column: str, kind: str) -> bool:
    """The column exists and has the type."""
    f = {x.name: x.dataType for x in df.schema.fields}.get(column)
    return f is not None and isinstance(f, _TYPES[kind])


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _sql_lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "\\'") + "'"
    return repr(float(v)) + "D" if isinstance(v, float) else str(v)


def _counters(rule: Rule, i: int, key: str) -> list[str]:
    """Two aggregate expressions per rule: evaluated and unexpected counts."""
    c = _q(rule.column) if rule.column else None
    if rule.kind == "row_count":
        return [f"count(1) AS e{i}", f"CAST(NULL AS BIGINT) AS u{i}"]
    if rule.kind == "not_null":
        return [f"count(1) AS e{i}", f"count_if({c} IS NULL) AS u{i}"]
    if rule.kind == "equals":
        wanted = _sql_lit(rule.args[0]) if rule.args else _q(key)
        return [f"count({c}) AS e{i}", f"count_if({c} <> {wanted}) AS u{i}"]
    if rule.kind == "in_set":
        vals = ", ".join(_sql_lit(v) for v in rule.args)
        return [f"count({c}) AS e{i}", f"count_if({c} IS NOT NULL AND NOT {c} IN ({vals})) AS u{i}"]
    if rule.kind == "between":
        lo, hi = rule.args
        return [f"count({c}) AS e{i}",
                f"count_if({c} IS NOT NULL AND NOT ({c} BETWEEN {_sql_lit(lo)} AND {_sql_lit(hi)})) AS u{i}"]
    raise ValueError(rule.kind)


def _success(rule: Rule) -> str:
    if rule.kind == "row_count":
        lo, hi = rule.args
        return f"evaluated BETWEEN {lo} AND {hi}"
    if rule.kind == "not_null":
        return "unexpected = 0"
    return (f"(evaluated = 0 OR CAST(evaluated - unexpected AS DOUBLE) >= "
            f"{float(rule.mostly)!r}D * CAST(evaluated AS DOUBLE))")


def evaluate_suite(df: DataFrame, table: str, rules=None, key: str = "district_code") -> DataFrame:
    """All rules of a suite for every district present in ``df`` (empty tables
    produce no rows, as the application skips them).

    One scan: a grouped aggregate computes two counters per rule (with a
    uniqueness rule it is two-level: per (district, value), then per district,
    both levels combined map-side); ``stack`` unpivots the counters into rule
    rows; the schema rules' rows reuse the same aggregate. Expressions are SQL
    text, so building the plan costs a few calls to the JVM whatever the rules."""
    rules = rules if rules is not None else SUITES[table]
    k = _q(key)
    data_rules = [(i, r) for i, r in enumerate(rules) if r.kind not in ("columns", "type", "unique")]
    uniq = [(i, r) for i, r in enumerate(rules) if r.kind == "unique"]
    counters = [x for i, r in data_rules for x in _counters(r, i, key)]
    if len(uniq) == 1:
        ucol = uniq[0][1].column
        uq = _q(ucol)
        lvl1 = df.groupBy(key, ucol).agg(F.expr("count(1) AS _n"), *[F.expr(x) for x in counters])
        outer = [f"sum(e{i}) AS e{i}" for i, _ in data_rules]
        outer += [f"CAST(NULL AS BIGINT) AS u{i}" if r.kind == "row_count" else f"sum(u{i}) AS u{i}"
                  for i, r in data_rules]
        i = uniq[0][0]
        outer += [f"coalesce(sum(CASE WHEN {uq} IS NOT NULL THEN _n END), 0) AS e{i}",
                  f"coalesce(sum(CASE WHEN {uq} IS NOT NULL AND _n > 1 THEN _n END), 0) AS u{i}"]
        agg = lvl1.groupBy(key).agg(*[F.expr(x) for x in outer])
    else:
        agg = df.groupBy(key).agg(*[F.expr(x) for x in counters]) if counters else df.select(key).distinct()
        for i, r in uniq:  # several unique columns: each has its own grouping by value
            per_value = df.groupBy(key, r.column).agg(F.expr("count(1) AS _n"))
            c = _q(r.column)
            one = per_value.groupBy(F.col(key).alias(f"_k{i}")).agg(
                F.expr(f"coalesce(sum(CASE WHEN {c} IS NOT NULL THEN _n END), 0) AS e{i}"),
                F.expr(f"coalesce(sum(CASE WHEN {c} IS NOT NULL AND _n > 1 THEN _n END), 0) AS u{i}"))
            agg = agg.join(one, F.col(key).eqNullSafe(F.col(f"_k{i}")), "left").drop(f"_k{i}")

    cells = []
    for i, r in enumerate(rules):
        name, col = _sql_lit(r.name), (_sql_lit(r.column) if r.column else "CAST(NULL AS STRING)")
        if r.kind in ("columns", "type"):
            ok = columns_match(df, r.args) if r.kind == "columns" else type_matches(df, r.column, r.args[0])
            cells.append(f"{i}, {name}, {col}, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), {str(ok).lower()}")
        elif r.kind == "unique":
            cells.append(f"{i}, {name}, {col}, CAST(e{i} AS BIGINT), CAST(u{i} AS BIGINT), u{i} = 0")
        else:
            e, u = f"CAST(e{i} AS BIGINT)", f"CAST(u{i} AS BIGINT)"
            succ = _success(r).replace("evaluated", e).replace("unexpected", u)
            cells.append(f"{i}, {name}, {col}, {e}, {u}, {succ}")
    long = agg.selectExpr(k, f"stack({len(cells)}, {', '.join(cells)}) "
                             f"AS (rule_idx, rule, column_name, evaluated, unexpected, success)")
    return long.selectExpr(f"{_sql_lit(table)} AS table_name", k, "rule_idx", "rule", "column_name",
                           "evaluated", "unexpected",
                           "try_divide(CAST(unexpected AS DOUBLE) * 100.0D, CAST(evaluated AS DOUBLE)) AS unexpected_pct",
                           "success")


def unique_rule(df: DataFrame, column: str, key: str = "district_code") -> DataFrame:
    """Values of ``column`` that occur more than once within a district; every
    copy counts as unexpected. Two-level aggregate: partial counts per value are
    combined map-side, so a value repeated in a third of all rows is one group
    row per task, not one hot task."""
    per_value = df.filter(F.col(column).isNotNull()).groupBy(key, column).agg(F.count(F.lit(1)).alias("c"))
    agg = per_value.groupBy(key).agg(F.sum("c").alias("evaluated"),
                                     F.coalesce(F.sum(F.when(F.col("c") > 1, F.col("c"))), F.lit(0)).alias("unexpected"))
    present = df.select(key).distinct()
    return (present.join(agg, key, "left")
            .select(key, F.coalesce("evaluated", F.lit(0)).cast("long").alias("evaluated"),
                    F.coalesce("unexpected", F.lit(0)).cast("long").alias("unexpected"))
            .withColumn("success", F.col("unexpected") == 0))


def row_count_rule(df: DataFrame, districts: DataFrame, lo: int = C.ROW_COUNT_RANGE[0],
                   hi: int = C.ROW_COUNT_RANGE[1], key: str = "district_code") -> DataFrame:
    """D1 on its own: rows per district, districts with no rows included (0 fails)."""
    n = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return (districts.select(key).join(n, key, "left")
            .select(key, F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
            .withColumn("success", F.col("n_rows").between(lo, hi)))


def validate_districts(districts: DataFrame, tables: dict, key: str = "district_code") -> DataFrame:
    """One row per district: suites run, suites passed, overall success
    (all passed; a district with no data at all is valid, as in the application)."""
    rows = reduce(DataFrame.unionByName, [evaluate_suite(df, name) for name, df in tables.items()])
    return district_results(districts, rows, key)


def district_results(districts: DataFrame, rows: DataFrame, key: str = "district_code") -> DataFrame:
    """D12 from rule rows that are already there."""
    per_table = rows.groupBy(key, "table_name").agg(F.bool_and("success").alias("ok"))
    per_district = per_table.groupBy(key).agg(F.count(F.lit(1)).alias("tables_checked"),
                                              F.count_if("ok").alias("tables_passed"))
    return (districts.select(key).join(per_district, key, "left")
            .select(key, F.coalesce("tables_checked", F.lit(0)).alias("tables_checked"),
                    F.coalesce("tables_passed", F.lit(0)).alias("tables_passed"))
            .withColumn("overall_validation_success", F.col("tables_checked") == F.col("tables_passed")))


def quality_summary(district_rows: DataFrame) -> DataFrame:
    """Validated, successful and failed districts."""
    return district_rows.agg(F.count(F.lit(1)).alias("total_validated"),
                             F.count_if("overall_validation_success").alias("successful_validations"),
                             F.count_if(~F.col("overall_validation_success")).alias("failed_validations"))


def panel_gate(panel: DataFrame, min_days: int = C.MIN_DAYS, min_completeness: float = C.MIN_COMPLETENESS,
               required=tuple(C.GATE_COLUMNS), key: str = "district_code", stage: str = "post_fill") -> DataFrame:
    """Per district: enough days, required columns present, completeness.

    Pass the filled panel as "post_fill" (what the application checks: every day
    counts) or the calendar before filling as "pre_fill": there a day counts
    only if one of the required measurements was observed on it."""
    missing = [c for c in required if c not in panel.columns]
    present = [c for c in required if c in panel.columns]
    measured = [c for c in present if c not in (key, "date")]
    if stage == "pre_fill" and measured:
        n_days = F.count_if(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in measured]))
    else:
        n_days = F.count(F.lit(1))
    aggs = [n_days.alias("n_days")]
    aggs += [F.avg(F.col(c).isNotNull().cast("double")).alias(f"_c{i}") for i, c in enumerate(present)]
    g = panel.groupBy(key).agg(*aggs)
    comp = F.least(*[F.col(f"_c{i}") for i in range(len(present))]) if len(present) > 1 else \
        (F.col("_c0") if present else F.lit(None).cast("double"))
    g = g.withColumn("min_completeness", comp)
    reason = (F.when(F.col("n_days") < min_days, F.lit("insufficient_days"))
              .when(F.lit(bool(missing)), F.lit("missing_columns"))
              .when(F.col("min_completeness") < min_completeness, F.lit("low_completeness")))
    return g.select(key, "n_days", "min_completeness", F.lit(stage).alias("stage"),
                    reason.alias("reason"), reason.isNull().alias("passed"))


def unique_key_report(tables: dict) -> DataFrame:
    """Per table, keys that occur more than once and the rows they cover."""
    parts = []
    for name, df in tables.items():
        keys = schemas.KEYS[name]
        g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > 1)
        parts.append(g.agg(F.count(F.lit(1)).alias("duplicate_keys"),
                           F.coalesce(F.sum("c"), F.lit(0)).alias("duplicate_rows"))
                     .select(F.lit(name).alias("table_name"), "duplicate_keys", "duplicate_rows"))
    return reduce(DataFrame.unionByName, parts)


def _long_report(df: DataFrame, name: str, counters: dict) -> DataFrame:
    row = df.agg(*[v.alias(f"k{i}") for i, v in enumerate(counters.values())])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"),
                 F.col(f"k{i}").cast("long").alias("violations"))
        for i, c in enumerate(counters)])).alias("r")).select("r.*")


def required_report(tables: dict) -> DataFrame:
    """Null count of every NOT NULL column, one pass per table."""
    return reduce(DataFrame.unionByName, [
        _long_report(df, name, {c: F.count_if(F.col(c).isNull()) for c in schemas.REQUIRED[name]})
        for name, df in tables.items()])


def fits_type_report(tables: dict) -> DataFrame:
    """Values too long for the declared text length or out of the declared
    decimal precision (``try_cast`` gives null on overflow)."""
    parts = []
    for name, df in tables.items():
        counters = {}
        for c, spec in schemas.DECLARED[name].items():
            if c not in df.columns:
                continue
            if spec[0] == "string":
                counters[c] = F.count_if(F.length(c) > spec[1])
            else:
                counters[c] = F.count_if(F.col(c).isNotNull()
                                         & F.col(c).try_cast(f"decimal({spec[1]},{spec[2]})").isNull())
        parts.append(_long_report(df, name, counters))
    return reduce(DataFrame.unionByName, parts)


def foreign_key_report(tables: dict) -> DataFrame:
    """J5 over every declared foreign key: orphan rows per (table, column).

    One pass per child table: its rows are first counted per combination of
    foreign-key values (combined map-side, so a hot key is one row per task),
    the few counted rows are joined to each parent's distinct keys, and a
    single aggregate sums the counts whose non-null key found no parent."""
    by_child: dict = {}
    for child, col, parent, pcol in schemas.FOREIGN_KEYS:
        by_child.setdefault(child, []).append((col, parent, pcol))
    parts = []
    for child, fks in by_child.items():
        cols = sorted({c for c, _, _ in fks})
        df = tables[child].groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
        counters = []
        for i, (col, parent, pcol) in enumerate(fks):
            keys = tables[parent].select(F.col(pcol).alias(f"_pk{i}")).distinct() \
                .withColumn(f"_hit{i}", F.lit(True))
            df = df.join(keys, F.col(col) == F.col(f"_pk{i}"), "left")
            missing = F.col(col).isNotNull() & F.col(f"_hit{i}").isNull()
            counters.append(F.coalesce(F.sum(F.when(missing, F.col("_n"))), F.lit(0)).alias(f"o{i}"))
        row = df.agg(*counters)
        parts.append(row.select(F.explode(F.array(*[
            F.struct(F.lit(child).alias("table_name"), F.lit(col).alias("column_name"),
                     F.lit(parent).alias("parent_table"), F.col(f"o{i}").cast("long").alias("orphans"))
            for i, (col, parent, _) in enumerate(fks)])).alias("r")).select("r.*"))
    return reduce(DataFrame.unionByName, parts)


def validate_cases(cases: DataFrame) -> DataFrame:
    """Rule rows of the case suite for every district."""
    return evaluate_suite(cases, "cases")


def validate_climate(climate: DataFrame) -> DataFrame:
    """Rule rows of the climate suite for every district."""
    return evaluate_suite(climate, "climate_data")


def validate_predictions(preds: DataFrame) -> DataFrame:
    """Rule rows of the prediction suite for every district."""
    return evaluate_suite(preds, "risk_predictions")


def quality_report(districts: DataFrame, cases: DataFrame, climate: DataFrame, preds: DataFrame):
    """(rule rows of all suites with the suites' statistics, one row per
    district, the summary row). The tables are scanned once for the rule rows
    and once for the statistics; rule rows are saved (districts x rules), and
    the district rows and the summary are derived from them."""
    from riskpanel.session import checkpoint_dir
    checkpoint_dir(districts.sparkSession)
    tables = {"cases": cases, "climate_data": climate, "risk_predictions": preds}
    rules = reduce(DataFrame.unionByName, [suite_with_statistics(df, name) for name, df in tables.items()])
    rules = rules.checkpoint(eager=True)
    per_district = district_results(districts, rules)
    return rules, per_district, quality_summary(per_district)


STATISTICS = ["start_date", "end_date", "total_records", "lab_confirmed_cases", "avg_rainfall",
              "avg_temperature", "avg_humidity", "avg_risk_score", "model_distribution"]


def suite_statistics(df: DataFrame, table: str, key: str = "district_code") -> DataFrame:
    """The statistics that go with a suite's result, one row per district: date
    extent and row count, and the table's own means or counts (null where a
    column belongs to another table; the model distribution as JSON text,
    models in order)."""
    date = {"cases": "case_date", "climate_data": "date", "risk_predictions": "prediction_date"}[table]
    own = {"cases": {"lab_confirmed_cases": F.count_if(F.col("lab_confirmed")) if "lab_confirmed" in df.columns else None},
           "climate_data": {"avg_rainfall": F.avg("rainfall_mm"), "avg_temperature": F.avg("temperature_celsius"),
                            "avg_humidity": F.avg("humidity_percent")} if table == "climate_data" else {},
           "risk_predictions": {"avg_risk_score": F.avg("risk_score")} if table == "risk_predictions" else {}}[table]
    types = {"start_date": "date", "end_date": "date", "total_records": "long", "lab_confirmed_cases": "long",
             "model_distribution": "string"}
    aggs = {"start_date": F.min(date), "end_date": F.max(date), "total_records": F.count(F.lit(1)), **own}
    out = df.groupBy(key).agg(*[v.alias(k) for k, v in aggs.items() if v is not None])
    if table == "risk_predictions":
        from riskpanel.operators.aggregates import model_distribution
        m = model_distribution(df, key).filter(F.col("model_name").isNotNull()).groupBy(key).agg(
            F.array_sort(F.collect_list(F.struct("model_name", "n_predictions"))).alias("_m"))
        text = F.to_json(F.map_from_entries("_m"))
        out = out.join(m, key, "left").withColumn("model_distribution", text).drop("_m")
    return out.select(key, *[(F.col(c) if c in out.columns else F.lit(None)).cast(types.get(c, "double")).alias(c)
                             for c in STATISTICS])


def suite_with_statistics(df: DataFrame, table: str, rules=None, key: str = "district_code") -> DataFrame:
    """Rule rows of a suite, each with its district's statistics beside it."""
    return evaluate_suite(df, table, rules, key).join(suite_statistics(df, table, key), key, "left")
