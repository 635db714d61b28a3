"""Approximate nearest neighbours with randomly rotated one-bit codes.

A shard stores, for each vector, the signs of its randomly rotated offset from
the shard's centre (packed bits) and two scalars: the offset's length and the
inner product of the rotated unit offset with its own signs. From these the
inner product with a query's rotated offset is estimated without bias, with a
known error bound. Vectors whose lower distance bound does not exceed the
query's current kth exact distance are reranked with the original vectors.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel.llm.vectors import Best, search, usable

#: Standard errors of the estimate that the bound allows for.
ERRORS = 1.9
SEED = 808
QUERIES = 256


@lru_cache(maxsize=4)
def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every process."""
    g = np.random.Generator(np.random.PCG64([SEED, dim])).standard_normal((dim, dim))
    q, r = np.linalg.qr(g)
    return q * np.sign(np.diag(r))


def build_codes(ids: np.ndarray, m: np.ndarray) -> tuple:
    """(ids, vectors, centre, packed signs, offset lengths, correction scalars)."""
    dim = m.shape[1]
    centre = m.mean(axis=0)
    offset = m - centre
    length = np.sqrt((offset ** 2).sum(axis=1))
    turned = (offset / np.maximum(length, 1e-300)[:, None]) @ rotation(dim)
    codes = np.packbits(turned >= 0, axis=1)
    correction = np.abs(turned).sum(axis=1) / np.sqrt(dim)
    return ids, m, centre, codes, length, np.maximum(correction, 1e-6)


def distance_bounds(index: tuple, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimates of the squared distances (queries x vectors) and how far below them the truth may lie."""
    _, m, centre, codes, length, correction = index
    dim = m.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float64) * 2 - 1
    offset = q - centre
    far = np.sqrt((offset ** 2).sum(axis=1))
    turned = (offset / np.maximum(far, 1e-300)[:, None]) @ rotation(dim)
    inner = (turned @ signs.T) / np.sqrt(dim) / correction[None, :]
    error = ERRORS * np.sqrt(np.maximum(1 - correction ** 2, 0)) / correction / np.sqrt(max(1, dim - 1))
    scale = 2 * far[:, None] * length[None, :]
    estimate = far[:, None] ** 2 + length[None, :] ** 2 - scale * inner
    return estimate, scale * error[None, :]


def visit_codes(index: tuple, query_ids: np.ndarray, q: np.ndarray, best: Best) -> None:
    """Estimate all distances of a shard, rerank what the bounds leave open."""
    ids, m = index[0], index[1]
    for s in range(0, len(q), QUERIES):
        at = np.arange(s, min(len(q), s + QUERIES))
        estimate, error = distance_bounds(index, q[at])
        own = query_ids[at][:, None] == ids[None, :]
        estimate[own] = np.inf
        # exact distances of the nearest by estimate set the mark that the others must reach
        few = min(len(ids), 2 * best.k)
        nearest = np.argpartition(estimate, few - 1, axis=1)[:, :few]
        for i, a in enumerate(at):
            first = nearest[i][~own[i, nearest[i]]]
            _rerank(best, a, q[a], ids[first], m[first])
            mark = best.kth()[a]
            rest = (estimate[i] - error[i] <= (np.inf if np.isneginf(mark) else mark * mark)) & ~own[i]
            rest[first] = False
            at_rest = np.flatnonzero(rest)
            if len(at_rest):
                _rerank(best, a, q[a], ids[at_rest], m[at_rest])


def _rerank(best: Best, a: int, q: np.ndarray, ids: np.ndarray, m: np.ndarray) -> None:
    if len(ids):
        best.add(np.array([a]), -np.sqrt(((m - q) ** 2).sum(axis=1))[None, :], ids[None, :])


def nearest_neighbours(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score) of the queries: rows of (vec_id, embedding) with vec_id divisible by ``every``.

    score is the Euclidean distance of the original vectors in double
    precision, nearest first, ties to the smaller id. Vectors that are null,
    empty, zero, or hold null or non-finite components take no part, nor do null
    ids; vectors of different dimensions are not compared; rows with the
    query's own id are no candidates. Rows repeated with one id are separate
    candidates and one query. Fewer candidates give fewer rows.
    """
    rows = vectors.filter(F.col("vec_id").isNotNull() & usable() & F.exists("embedding", lambda x: x != 0)).select(
        F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("v"))
    queries = rows.filter(F.col("id") % every == 0).dropDuplicates(["id"])
    found = search(queries, rows, k, build_codes, visit_codes)
    return found.withColumn("score", F.abs(F.col("score")))
