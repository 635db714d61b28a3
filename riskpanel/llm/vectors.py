"""Search of a query set against all vectors, in blocks.

Candidates are dealt to shards of bounded size, each indexed once; queries are
dealt to blocks. A task takes one block of queries and one group of shards,
reads the shards one after another and carries the block's best results along,
so each shard is searched with the kth score of all shards before it. A task
returns k rows per query, whatever it has read.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskpanel.llm.common import shipped, written

SHARD_ROWS, BLOCK_ROWS, GROUPS = 16_384, 4096, 16


def usable(vec: str = "embedding") -> Column:
    """True for vectors that are not null, not empty and have finite components only."""
    c = F.col(vec)
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(c.isNotNull() & (F.size(c) > 0) & ~bad, F.lit(False))


def _dealt(df: DataFrame, name: str, rows: int, least: int) -> tuple[DataFrame, int]:
    """Number rows (id, v) into parts of about ``rows``; repeated ids spread like others."""
    n = max(least, -(-df.count() // rows))
    return df.withColumn(name, F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(n))), n


def _packs(df: DataFrame, name: str, build: Callable[[np.ndarray, np.ndarray], tuple]) -> DataFrame:
    """(name, dim, pack): ``build(ids, matrix)`` of each part, as one binary value."""
    def run(key, table):
        dim = key[1].as_py()
        ids = table.column("id").to_numpy()
        flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        got = pickle.dumps(build(ids, flat.reshape(len(ids), dim)), protocol=5)
        return pa.table({name: pa.array([key[0].as_py()], pa.int64()), "dim": pa.array([dim], pa.int32()),
                         "pack": pa.array([got], pa.binary())})

    return shipped(df).withColumn("dim", F.size("v")).groupBy(name, "dim").applyInArrow(
        run, f"{name} long, dim int, pack binary")


class Best:
    """The k best (score, id) of each query so far: largest score first, then least id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.full((queries, k), -np.inf)
        self.id = np.full((queries, k), np.iinfo(np.int64).max)

    def kth(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, at: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Merge scores (queries ``at`` x candidates) of the candidates ``ids`` (one row, or one per query)."""
        ids = np.broadcast_to(ids, score.shape)
        s = np.concatenate([self.score[at], score], axis=1)
        i = np.concatenate([self.id[at], np.where(np.isneginf(score), np.iinfo(np.int64).max, ids)], axis=1)
        order = np.lexsort((i, -s), axis=1)[:, :self.k]
        self.score[at] = np.take_along_axis(s, order, axis=1)
        self.id[at] = np.take_along_axis(i, order, axis=1)


def search(queries: DataFrame, rows: DataFrame, k: int, build: Callable, visit: Callable,
           score_type: str = "double") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of each query, equal scores by least id.

    ``queries`` and ``rows`` are (id long, v array<double>); vectors of other
    dimensions than a query's, and rows with a query's own id, are no candidates.
    ``build(ids, matrix)`` indexes a shard; ``visit(state, query_ids, query_matrix,
    best)`` searches it, adding scores (larger is better) to ``best``.
    """
    dealt, _ = _dealt(rows, "shard", SHARD_ROWS, GROUPS)
    shards = written(_packs(dealt, "shard", build), "vector-shards")
    q, blocks = _dealt(queries, "block", BLOCK_ROWS, 1)
    packs = written(_packs(q, "block", lambda ids, m: (ids, m)), "vector-queries")
    left = (shards.withColumn("part", F.pmod("shard", F.lit(GROUPS)))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    right = packs.withColumnRenamed("pack", "queries") \
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(GROUPS - 1))))
    pairs = left.join(right.hint("shuffle_hash"), ["block", "part", "dim"]) \
        .select("block", "part", "dim", "shard", "pack", "queries")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for b in batches:
            for state, q in zip(b.column("pack"), b.column("queries")):
                if best is None:
                    ids, m = pickle.loads(q.as_py())
                    best = Best(len(ids), k)
                visit(pickle.loads(state.as_py()), ids, m, best)
        if best is not None:
            at, col = np.nonzero(~np.isneginf(best.score))
            yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(best.id[at, col]),
                                              pa.array(best.score[at, col])], ["query_id", "vec_id", "score"])

    part = shipped(pairs).groupBy("block", "part", "dim").applyInArrow(run, "query_id long, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (part.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id",
                    F.col("score").cast(score_type).alias("score")))
