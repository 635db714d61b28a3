"""Exact top-k search by inner product: ball trees, branch and bound.

Each shard of vectors is a ball tree. For a query q, no vector of a node with
centre c and radius r has an inner product above q.c + |q| r. A block of
queries goes down a tree together: nodes are visited in order of their bounds,
with the queries whose bound reaches their current kth score; that score is
carried from shard to shard.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel.llm.vectors import Best, search, usable

LEAF = 128


def build_tree(ids: np.ndarray, m: np.ndarray) -> tuple:
    """(ids, matrix) in tree order; per node its centre, radius, span and children (-1: leaf)."""
    order = np.arange(len(ids))
    centre, radius, span, kids = [], [], [], []
    todo = [(0, len(ids), None)]
    while todo:
        lo, hi, parent = todo.pop()
        part = m[order[lo:hi]]
        c = part.mean(axis=0)
        far = np.sqrt(((part - c) ** 2).sum(axis=1))
        node = len(centre)
        centre.append(c)
        radius.append(far.max())
        span.append((lo, hi))
        kids.append([-1, -1])
        if parent is not None:
            kids[parent[0]][parent[1]] = node
        if hi - lo > LEAF and far.max() > 0:
            # split at the median along the line between two far points
            a = part[far.argmax()]
            b = part[((part - a) ** 2).sum(axis=1).argmax()]
            along = np.argsort(part @ (b - a), kind="stable")
            order[lo:hi] = order[lo:hi][along]
            mid = (lo + hi) // 2
            todo += [(lo, mid, (node, 0)), (mid, hi, (node, 1))]
    return (ids[order], m[order], np.array(centre), np.array(radius), np.array(span), np.array(kids))


def visit_tree(tree: tuple, query_ids: np.ndarray, q: np.ndarray, best: Best) -> None:
    """Branch and bound of a block of queries over one tree."""
    ids, m, centre, radius, span, kids = tree
    inner = q @ centre.T
    reach = np.sqrt((q ** 2).sum(axis=1))[:, None] * radius[None, :]
    bound = inner + reach
    bound += 1e-9 * (np.abs(inner) + reach) + 1e-6  # never below the true bound for rounding
    todo = [(0, np.arange(len(q)))]
    while todo:
        node, active = todo.pop()
        # an equal score may still win by a smaller id, so only smaller bounds are cut
        active = active[bound[active, node] >= best.kth()[active]]
        if not len(active):
            continue
        left, right = kids[node]
        if left >= 0:
            first, second = (left, right) if bound[active, left].sum() >= bound[active, right].sum() else (right, left)
            todo += [(second, active), (first, active)]
            continue
        lo, hi = span[node]
        for s in range(lo, hi, 4 * LEAF):  # a ball of equal vectors may be large
            e = min(hi, s + 4 * LEAF)
            score = q[active] @ m[s:e].T
            score[query_ids[active][:, None] == ids[None, s:e]] = -np.inf
            best.add(active, score, ids[s:e])


def exact_top_k(vectors: DataFrame, every: int = 50, k: int = 5, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score) of the queries: rows of (vec_id, embedding) with vec_id divisible by ``every``.

    Components count as floor(scale * x); score is their integer inner product.
    Vectors (and query ids) that are null, empty, or hold null or non-finite
    components take no part; vectors of different dimensions are not compared;
    rows with the query's own id are no candidates. Rows repeated with one id
    are separate candidates, and as queries they are answered once. Fewer
    candidates give fewer rows. Sums above 2**53 are rounded to doubles, and
    cut to the range of long.
    """
    rows = vectors.filter(F.col("vec_id").isNotNull() & usable()).select(
        F.col("vec_id").cast("long").alias("id"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("v"))
    queries = rows.filter(F.col("id") % every == 0).dropDuplicates(["id"])
    return search(queries, rows, k, build_tree, visit_tree, "long")
