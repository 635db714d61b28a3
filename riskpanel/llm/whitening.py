"""Whitening of embeddings along the leading components, found by spectrum slicing.

The moments of the distinct vectors are summed in two distributed passes (sums,
then products of centred rows), so only one dimension x dimension matrix comes
to the driver. There the leading eigenvalues are isolated by inertia: the
factorisation of V - sI as L D L' has as many positive pivots as V has
eigenvalues above s, so halving an interval by that count leaves exactly one
eigenvalue (or one group closer together than rounding tells apart) in it.
Rayleigh quotient iteration then converges cubically, and counts just below and
just above the result certify its number. The same components serve all rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskpanel.llm.common import shipped, written

#: Least share of the trace that an eigenvalue must have to be one at all (below, it is rounding).
RANK = 1e-13


def usable(vec: str) -> Column:
    """True for vectors that are not null and hold no null and no non-finite component."""
    c = F.col(f"`{vec}`")
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(c.isNotNull() & ~bad, F.lit(False))


def count_above(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues of a symmetric matrix above ``shift``: positive pivots of L D L' of the shifted matrix.

    Symmetric elimination in the order of the largest remaining diagonal entry;
    where that entry is no safe pivot, a 2 x 2 pivot (which has one eigenvalue
    of each sign) is taken with the largest entry off the diagonal.
    """
    a = matrix - shift * np.eye(len(matrix))
    positive = 0
    while len(a):
        d = np.abs(np.diag(a))
        p = int(d.argmax())
        off = np.abs(a - np.diag(np.diag(a)))
        big = off.max()
        if d[p] >= 0.64 * big:
            if d[p] == 0:  # what is left is zero: eigenvalues equal to the shift
                return positive
            pivot, column = a[p, p], np.delete(a[:, p], p)
            positive += pivot > 0
            a = np.delete(np.delete(a, p, 0), p, 1) - np.outer(column, column) / pivot
        else:
            i, j = np.unravel_index(int(off.argmax()), off.shape)
            rest = np.delete(np.arange(len(a)), [i, j])
            block, columns = a[np.ix_([i, j], [i, j])], a[np.ix_(rest, [i, j])]
            positive += 1
            a = a[np.ix_(rest, rest)] - columns @ np.linalg.solve(block, columns.T)
    return positive


def _refine(v: np.ndarray, low: float, high: float, found: list[np.ndarray], seed: int) -> tuple[float, np.ndarray]:
    """The eigenpair with its eigenvalue in (low, high], orthogonal to ``found``: Rayleigh quotient iteration."""
    n, scale = len(v), max(np.abs(v).max(), np.finfo(float).tiny)
    rng = np.random.Generator(np.random.PCG64(seed))
    basis = np.array(found).reshape(-1, n)

    def step(shift: float, x: np.ndarray) -> np.ndarray:
        try:
            y = np.linalg.solve(v - shift * np.eye(n), x)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
            y = np.linalg.solve(v - (shift + np.finfo(float).eps * scale) * np.eye(n), x)
        y /= np.linalg.norm(y)
        for _ in range(2):
            y = y - basis.T @ (basis @ y)
        return y / np.linalg.norm(y)

    x = step((low + high) / 2, rng.standard_normal(n))
    for _ in range(3):  # inverse iteration at the interval's middle: near the one eigenvalue in it
        x = step((low + high) / 2, x)
    best, value = np.inf, x @ v @ x
    for _ in range(30):
        y = step(value, x)
        now = y @ v @ y
        error = np.linalg.norm(v @ y - now * y)
        if not error < best:
            break
        best, x, value = error, y, now
    return float(value), x


def leading_components(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as rows) of the up to ``k`` largest positive eigenvalues, falling.

    Eigenvalues closer together than double precision resolves share an interval;
    their vectors are then made orthogonal to each other. Each number is
    certified: fewer eigenvalues than it lie above the value (within rounding),
    and as many at least above a little less.
    """
    n, trace = len(v), float(np.trace(v))
    values: list[float] = []
    vectors: list[np.ndarray] = []
    if n == 0 or not trace > 0:
        return np.zeros(0), np.zeros((0, n))
    radius = float(np.abs(v).sum(axis=1).max())
    tiny = RANK * trace
    rank = count_above(v, tiny)
    for number in range(1, min(k, rank) + 1):
        low, high, above = tiny, radius * 1.01, 0  # eigenvalue `number` lies in (low, high]; above: count over high
        count_low = rank
        while not (above == number - 1 and count_low == number and high - low < 0.05 * high):
            middle = (low + high) / 2
            if high - low <= 8 * np.finfo(float).eps * radius:
                break
            c = count_above(v, middle)
            if c >= number:
                low, count_low = middle, c
            else:
                high, above = middle, c
        value, x = _refine(v, low, high, vectors, number)
        slack = 64 * np.finfo(float).eps * radius * n
        if not (count_above(v, value + slack) < number <= count_above(v, value - slack)):
            value, x = _by_bisection(v, number, low, high, vectors)
        values.append(value)
        vectors.append(x)
    return np.array(values), np.array(vectors).reshape(len(values), n)


def _by_bisection(v: np.ndarray, number: int, low: float, high: float, found: list[np.ndarray]) -> tuple[float, np.ndarray]:
    """As ``_refine`` where its result is not certified: halve to the last bits by counts, then iterate there."""
    while high - low > 4 * np.finfo(float).eps * high:
        middle = (low + high) / 2
        if not low < middle < high:
            break
        if count_above(v, middle) >= number:
            low = middle
        else:
            high = middle
    value, x = _refine(v, low, high, found, 1000 + number)
    return (value, x) if abs(value - high) <= 1e-9 * high else (high, x)


def _fixed_point(df: DataFrame, id_col: str, vec: str, scale: int) -> DataFrame:
    """(id, x array<long>) of the usable rows: x = floor(scale * component)."""
    ok = df.filter(usable(vec))
    x = F.transform(F.col(f"`{vec}`"), lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))
    return ok.select(F.col(f"`{id_col}`").cast("long").alias("id"), x.alias("x"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _sums(fit: DataFrame, dim: int) -> list[int]:
    """Exact sums of each dimension: high and low halves are added apart, so that 64 bits hold them."""
    def run(batches):
        high, low = np.zeros(dim, np.int64), np.zeros(dim, np.int64)
        for b in batches:
            m = _matrix(b.column(0), dim)
            high += (m >> 32).sum(axis=0)
            low += (m & 0xFFFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim), pa.int32()), pa.array(high), pa.array(low)], ["at", "high", "low"])

    out = [0] * dim
    for r in shipped(fit).select("x").mapInArrow(run, "at int, high long, low long").groupBy("at").agg(
            F.sum(F.col("high").cast("decimal(38,0)")).alias("h"), F.sum(F.col("low").cast("decimal(38,0)")).alias("l")).collect():
        out[r["at"]] = (int(r["h"]) << 32) + int(r["l"])
    return out


def _total(fit: DataFrame, dim: int, rows_to_sums, width: int) -> np.ndarray:
    """Sum over the fit list of an array of ``width`` doubles that each task makes from its rows."""
    def run(batches):
        total = np.zeros(width)
        for b in batches:
            if b.num_rows:
                total += rows_to_sums(_matrix(b.column(0), dim)).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), pa.array(total)], ["at", "value"])

    parts = shipped(fit).select("x").mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))
    out = np.zeros(width)
    for r in parts.collect():  # at most one row for each entry of the matrix
        out[r["at"]] = r["value"]
    return out


class Whitening:
    """A fitted whitening: n and per-dimension sums of the fit list (exact), components, eigenvalues, trace, error."""

    def __init__(self, dim: int, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray, trace: float, error: float):
        self.dim, self.n, self.sums = dim, n, sums
        self.values, self.vectors, self.trace, self.error = values, vectors, trace, error
        self.mean = np.array([s / n for s in sums])  # true division of integers rounds once
        self.scaled = vectors / np.sqrt(values)[:, None] if len(values) else vectors


def fit_whitening(x: DataFrame, k: int) -> Whitening | None:
    """Fit on the distinct vectors of (x array<long>): None for an empty table.

    Vectors of the most frequent length take part (of equally frequent ones the
    longest); the distinct ones are found by a shuffle that combines copies first.
    """
    lengths = x.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim")).limit(1)
    dim = next((r["dim"] for r in lengths.collect()), 0)
    if dim == 0:
        return None
    fit = written(x.filter(F.size("x") == dim).groupBy("x").agg(F.lit(0).alias("_")).select("x"), "whitening-fit")
    n, sums = fit.count(), _sums(fit, dim)
    mean = np.array([s / n for s in sums])

    def products(m):
        c = m - mean
        return c.T @ c

    v = _total(fit, dim, products, dim * dim).reshape(dim, dim) / n
    v = (v + v.T) / 2
    values, vectors = leading_components(v, k)
    got = Whitening(dim, n, sums, values, vectors, float(np.trace(v)), 0.0)
    if len(values):
        kk = len(values)

        def whitened(m):
            w = (m - mean) @ got.scaled.T
            return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

        total = _total(fit, dim, whitened, kk + kk * kk)
        centre = total[:kk] / n
        covariance = total[kk:].reshape(kk, kk) / n - np.outer(centre, centre)  # centre is 0 but for rounding
        got.error = float(np.abs(covariance - np.eye(kk)).max())
    return got


def _deviation(x: np.ndarray, w: Whitening) -> list[int]:
    """Sum over dimensions of (n * x - S)^2, exact: in 64 bits where that cannot overflow, else in Python's integers."""
    most = max(int(np.abs(x).max(initial=0)), -int(x.min(initial=0)))
    reach = w.n * most + max(abs(s) for s in w.sums)
    if reach * reach * w.dim < 1 << 63:
        d = x * w.n - np.array(w.sums)
        return (d * d).sum(axis=1).tolist()
    return [sum((w.n * a - s) ** 2 for a, s in zip(row, w.sums)) for row in x.tolist()]


def whiten(df: DataFrame, id_col: str = "vec_id", vec: str = "embedding", k: int = 4, scale: int = 256) -> DataFrame:
    """One row per usable row of ``df`` and component up to ``k``, numbered from 1 by falling eigenvalue:

    (``id_col``, component, n, deviation, whitened, explained, identity_error).
    Components become integers floor(scale * c). n counts the distinct vectors,
    which alone are fitted, so copies have no weight; every row gets its values.
    deviation is decimal(38,0) (exact). explained is the eigenvalue's share of
    the trace; identity_error, one value for all, the largest difference between
    the covariance of the whitened distinct vectors and the identity. Vectors
    that are null, or hold a null or non-finite component, are left out, and so
    are vectors of another length than the most frequent one. There are no rows
    for components beyond the rank of the distinct vectors: none at all for an
    empty table or one distinct vector. Repeated and null ids each keep their
    rows; other columns of ``df`` are not used.
    """
    schema = ("id long, component int, n long, deviation decimal(38,0), whitened double, explained double, "
              "identity_error double")
    x = written(_fixed_point(df, id_col, vec, scale), "whitening-x")
    w = fit_whitening(x, k)
    rename = [F.col("id").alias(id_col), "component", "n", "deviation", "whitened", "explained", "identity_error"]
    if w is None or not len(w.values):
        return x.sparkSession.createDataFrame([], schema).select(*rename)
    names = ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches):
        kk = len(w.values)
        for b in batches:
            if not b.num_rows:
                continue
            m = _matrix(b.column(1), w.dim)
            score = (m - w.mean) @ w.scaled.T
            rows = np.repeat(np.arange(len(m)), kk)
            deviation = pa.array(_deviation(m, w), pa.decimal128(38, 0)) if len(m) else pa.array([], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows)), pa.array(np.tile(np.arange(1, kk + 1, dtype=np.int32), len(m))),
                 pa.array(np.full(len(rows), w.n)), deviation.take(pa.array(rows)), pa.array(score.ravel()),
                 pa.array(np.tile(w.values / w.trace, len(m))), pa.array(np.full(len(rows), w.error))], names)

    return shipped(x).filter(F.size("x") == w.dim).mapInArrow(run, schema).select(*rename)
