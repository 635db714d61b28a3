"""Exact token counts from a histogram of encoded document lengths.

Texts are encoded once; documents are aggregated by encoded length. Sums over
the histogram from a length upwards (suffix sums) then answer, for every
context limit, how many documents exceed it, how many tokens there are in all
and how many stay when each document is truncated to the limit; prefix sums
give every quantile. The histogram has one row per distinct length, and its
running sums are taken in blocks of lengths, so no task holds all of it.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskpanel.llm.common import shipped, written


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str):
    """A tiktoken encoding from a rank file (one for each Python worker)."""
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encoded_lengths(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per row of ``docs``: the token count of its text (null or empty: 0).

    Special tokens' strings are ordinary text.
    """
    def run(batches):
        enc = encoder(path, pattern)
        for b in batches:
            out = [len(enc.encode_ordinary(t.as_py())) if t.is_valid else 0 for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], ["length"])

    return shipped(docs).select("text").mapInArrow(run, "length long")


def length_histogram(docs: DataFrame, path: str, pattern: str, block: int = 256) -> DataFrame:
    """One row per encoded length, ascending meaning in the columns, any row order:

    length, n_docs (documents of it), n_tokens (their tokens), docs_up_to (with
    at most it: quantiles), docs_over (longer ones), total_docs, total_tokens,
    kept_tokens (tokens left if each document is cut to this length) and
    quantile (docs_up_to / total_docs). For a limit that is no row's length,
    ``tokens_within`` has the formula. Empty input: no rows.
    """
    hist = written(encoded_lengths(docs, path, pattern).groupBy("length")
                   .agg(F.count(F.lit(1)).alias("n_docs"))
                   .withColumn("n_tokens", F.col("length") * F.col("n_docs"))
                   .withColumn("block", F.floor(F.col("length") / block)), "length-histogram")
    blocks = hist.groupBy("block").agg(F.sum("n_docs").alias("bd"), F.sum("n_tokens").alias("bt"))
    # one row per block of lengths: at most (longest text / block) rows
    after = Window.orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    over_all = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select("block", F.coalesce(F.sum("bd").over(after), F.lit(0)).alias("bd_after"),
                           F.coalesce(F.sum("bt").over(after), F.lit(0)).alias("bt_after"),
                           F.sum("bd").over(over_all).alias("total_docs"),
                           F.sum("bt").over(over_all).alias("total_tokens"))
    w = Window.partitionBy("block").orderBy("length").rowsBetween(1, Window.unboundedFollowing)
    out = (hist.withColumn("d", F.coalesce(F.sum("n_docs").over(w), F.lit(0)))
           .withColumn("t", F.coalesce(F.sum("n_tokens").over(w), F.lit(0)))
           .join(F.broadcast(blocks), "block")
           .withColumn("docs_over", F.col("d") + F.col("bd_after"))
           .withColumn("tokens_over", F.col("t") + F.col("bt_after")))
    return out.select(
        "length", "n_docs", "n_tokens", (F.col("total_docs") - F.col("docs_over")).alias("docs_up_to"), "docs_over",
        "total_docs", "total_tokens",
        (F.col("total_tokens") - F.col("tokens_over") + F.col("docs_over") * F.col("length")).alias("kept_tokens"),
        ((F.col("total_docs") - F.col("docs_over")) / F.col("total_docs")).alias("quantile"))


def tokens_within(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """(limit, kept_tokens, docs_cut) for any context limits, from the histogram alone."""
    aggs = []
    for x in limits:
        aggs += [F.coalesce(F.sum(F.least("length", F.lit(x)) * F.col("n_docs")), F.lit(0)).alias(f"k{x}"),
                 F.coalesce(F.sum(F.when(F.col("length") > x, F.col("n_docs"))), F.lit(0)).alias(f"c{x}")]
    one = histogram.agg(*aggs)
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(x).cast("long").alias("limit"), F.col(f"k{x}").cast("long").alias("kept_tokens"),
                 F.col(f"c{x}").cast("long").alias("docs_cut")) for x in limits])).alias("s")).select("s.*")
