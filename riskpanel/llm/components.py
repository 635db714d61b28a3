"""Connected components of an edge table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from riskpanel.llm.common import written


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _least(edges: DataFrame) -> DataFrame:
    """(n, m): the least v of each u; written, so that a join to it has plain tables on both sides."""
    return written(edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), "m"), "edges-least")


def _written_with_mark(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, written, and a fingerprint of their set taken by the same job."""
    seen = Observation()
    out = written(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")), "edges")
    got = seen.get
    return out, (got["n"], got["x"])


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (u, v): the least node it can reach.

    Alternates two steps until nothing changes: each node links its larger
    neighbours, then its smaller ones, to the least neighbour. Every step keeps
    connectivity and shortens paths, so a few rounds are enough (their number
    grows with the logarithm of the nodes). Minima are aggregated before the
    shuffle; a node with very many edges makes one side of a sort-merge join
    heavy, which adaptive execution can split. Edges of a node to itself say
    nothing; a node without another edge is no result row.
    """
    e, mark = _written_with_mark(edges.filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while mark[0]:
        both = _both(e)
        large = (both.filter("v > u").join(_least(both), F.col("u") == F.col("n"))
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        large = written(large, "edges-large")
        low = _least(large)
        small = (large.join(low, F.col("u") == F.col("n")).filter("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        e, now = _written_with_mark(
            small.unionByName(low.select(F.col("n").alias("u"), F.col("m").alias("v"))).distinct())
        if now == mark:
            break
        mark = now
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
