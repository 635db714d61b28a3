"""Query registration, output rounding and the oracle SQL wrapper."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riskpanel.oracle_bindings import with_bindings
from riskpanel.sources.bindings import Tables, bind

# Fixed parameters of the registered queries (the driver data's "today").
CASES_AS_OF = "2001-08-01"
EVENTS_AS_OF = "2024-01-30"
EVENTS_AS_OF_TS = "2024-01-30 00:00:00"
DISTRICT = "D007"


@dataclass
class Entry:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None
    doubles: tuple
    section: str
    doc: str


REGISTRY: dict[str, Entry] = {}


def register(name: str, section: str, sql: str | None = None, doubles=()):
    """Register ``fn(tables) -> DataFrame`` under ``name`` with its oracle SQL.

    ``doubles``: the computed DOUBLE output columns; both sides round them with
    the tie-safe 4-decimal rule.
    """
    def deco(fn):
        REGISTRY[name] = Entry(name, fn, sql, tuple(doubles), section, (fn.__doc__ or "").strip())
        return fn
    return deco


def round_doubles(df: DataFrame) -> DataFrame:
    """The tie-safe 4-decimal rounding (``r4``) of every DOUBLE output column,
    written as one ``selectExpr`` (one call to the JVM for the whole list)."""
    exprs, changed = [], False
    for f in df.schema.fields:
        q = "`" + f.name.replace("`", "``") + "`"
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            exprs.append(f"floor({q} * 1e4D + 0.500001D) / 1e4D AS {q}")
            changed = True
        else:
            exprs.append(q)
    return df.selectExpr(*exprs) if changed else df


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(REGISTRY[name].build(bind(spark, sf_dir)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: (lambda spark, sf_dir, _n=n: run(_n, spark, sf_dir)) for n in REGISTRY}


def _count_if_to_filter(sql: str) -> str:
    """DuckDB's count_if gives NULL on empty or all-null input where Spark gives
    0; ``count(*) FILTER (WHERE e)`` counts like Spark."""
    out, i, tok = [], 0, "count_if("
    while True:
        j = sql.find(tok, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(tok)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j])
        out.append("count(*) FILTER (WHERE " + _count_if_to_filter(sql[j + len(tok):k - 1]) + ")")
        i = k


def wrap_sql(sql: str, doubles) -> str:
    body = _count_if_to_filter(with_bindings(sql))
    if not doubles:
        return body
    rep = ", ".join(f"floor({c} * 1e4::DOUBLE + 0.500001::DOUBLE) / 1e4::DOUBLE AS {c}"
                    for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM (\n{body}\n) AS q_"


def oracle_sql() -> dict[str, str]:
    return {n: wrap_sql(e.sql, e.doubles) for n, e in REGISTRY.items() if e.sql}


def minus(day: str, n: int) -> str:
    """ISO date (or 'date time') n days before ``day``, for SQL literals."""
    import datetime as _dt
    if " " in day:
        return str(_dt.datetime.fromisoformat(day) - _dt.timedelta(days=n))
    return str(_dt.date.fromisoformat(day) - _dt.timedelta(days=n))
