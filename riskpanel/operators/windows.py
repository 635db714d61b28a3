"""Window operators, all partitioned by district (or the stated keys) and
ordered by date, ROWS frames only. Catalyst plans window expressions that
share a partition/order spec in one Window node, so adding lags and rolling
means costs one sort of each (small, calendar-bounded) district partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def by_date(key="district_code", order="date"):
    keys = [key] if isinstance(key, str) else list(key)
    return W.partitionBy(*keys).orderBy(order)


def lag_columns(columns: dict, lags, key="district_code", order="date") -> dict[str, Column]:
    """{out_prefix: source_col} -> {f'{prefix}_lag_{k}': lag(col, k)}."""
    w = by_date(key, order)
    return {f"{p}_lag_{k}": F.lag(c, k).over(w) for p, c in columns.items() for k in lags}


def lags(df: DataFrame, columns: dict, lag_list, key="district_code", order="date") -> DataFrame:
    return df.withColumns(lag_columns(columns, lag_list, key, order))


def rolling_columns(columns: dict, windows, key="district_code", order="date",
                    strict: bool = False) -> dict[str, Column]:
    """Mean over the last n rows including the current one.

    strict=False: pandas ``min_periods=1`` (mean of the non-null values present).
    strict=True: pandas default ``min_periods=n``: null until n non-null values.
    """
    base = by_date(key, order)
    out = {}
    for p, c in columns.items():
        for n in windows:
            w = base.rowsBetween(1 - n, 0)
            m = F.avg(c).over(w)
            out[f"{p}_roll_{n}"] = F.when(F.count(c).over(w) >= n, m) if strict else m
    return out


def rolling_mean(df: DataFrame, columns: dict, windows, key="district_code", order="date") -> DataFrame:
    return df.withColumns(rolling_columns(columns, windows, key, order))


def rolling_mean_strict(df: DataFrame, columns: dict, windows, key="district_code",
                        order="date") -> DataFrame:
    return df.withColumns(rolling_columns(columns, windows, key, order, strict=True))


def mean_fill(df: DataFrame, columns, key="district_code") -> DataFrame:
    """Fill nulls with the partition's mean; an all-null column stays null."""
    keys = [key] if isinstance(key, str) else list(key)
    w = W.partitionBy(*keys)
    return df.withColumns({c: F.coalesce(F.col(c), F.avg(c).over(w)) for c in columns})


def sequence_window(df: DataFrame, features, seq: int = 14, key="district_code",
                    order="date", out: str = "seq") -> DataFrame:
    """The ``seq`` rows before each row as ARRAY<STRUCT>; the first ``seq`` rows
    of each partition (no full history) are dropped. Nulls become 0 first."""
    w = by_date(key, order)
    frame = w.rowsBetween(-seq, -1)
    filled = df.withColumns({f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features})
    return (filled
            .withColumn(out, F.collect_list(F.struct(*[F.col(f) for f in features])).over(frame))
            .filter(F.size(out) == seq))


def chrono_split(df: DataFrame, frac: float = 0.8, key="district_code", order="date",
                 out: str = "is_train") -> DataFrame:
    """First floor(frac * n) rows of each partition are training rows."""
    keys = [key] if isinstance(key, str) else list(key)
    rn = F.row_number().over(by_date(keys, order))
    n = F.count(F.lit(1)).over(W.partitionBy(*keys))
    return df.withColumn(out, rn <= F.floor(F.lit(frac) * n))


def pick_per_key(df: DataFrame, keys, order, latest: bool = True) -> DataFrame:
    """One whole row per key: the one with the largest (latest=True) or
    smallest ``order`` tuple. Written as a ``max_by``/``min_by`` aggregate, not a
    ``row_number`` window: partial aggregation keeps one candidate per key in
    every task before the shuffle, so a key holding a third of all rows costs
    one row per task, not one task sorting that third."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order)
    others = [c for c in df.columns if c not in keys]
    pick = F.max_by if latest else F.min_by
    rec = F.struct(*[F.col(c) for c in others])
    agg = df.groupBy(*keys).agg(pick(rec, F.struct(*[F.col(c) for c in order])).alias("_r"))
    return agg.select(*keys, *[F.col("_r")[c].alias(c) for c in others]).select(*df.columns)


def last_row(df: DataFrame, key="district_code", order="date") -> DataFrame:
    """The latest row of each partition."""
    return pick_per_key(df, key, order, latest=True)


def first_per_key(df: DataFrame, keys, order=("id",)) -> DataFrame:
    """One row per key: the first by ``order``."""
    return pick_per_key(df, keys, order, latest=False)


def difference(df: DataFrame, column: str, key="district_code", order="date",
               out: str | None = None) -> DataFrame:
    """First difference y_t - y_(t-1) (null on the first row)."""
    return df.withColumn(out or f"{column}_diff", F.col(column) - F.lag(column, 1).over(by_date(key, order)))


def latest_prediction(preds: DataFrame,
                      keys=("district_code", "model_name", "prediction_horizon_weeks")) -> DataFrame:
    """Latest prediction per key by prediction_date, then id (skew-safe, see pick_per_key)."""
    return pick_per_key(preds, keys, ("prediction_date", "id"), latest=True)
