"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet and rereads it as the next stage's docs.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpanel.llm import line_dedup, mixing, near_dedup, packing, toxicity
from riskpanel.llm.common import table, written
from riskpanel.llm.queries import _tokenizer

#: Words cannot be tokenized, and models not learned, in SQL.
ORACLE_SQL = None


#: Columns that stages read or change; all others ride along in one struct, so no stage's own names meet theirs.
USED = ("doc_id", "text", "source", "n_chars")


def _with_all_columns(stage: Callable) -> Callable:
    """The stage on the columns it uses; every row comes back with all columns of its input, in their order."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        used, others = [c for c in docs.columns if c in USED], [c for c in docs.columns if c not in USED]
        packed = docs.select(*used, F.struct(*[F.col(f"`{c}`") for c in others]).alias("others")) if others else docs
        out = stage(spark, packed, sf_dir)
        return out.select(*[F.col(c) if c in USED else F.col(f"others.`{c}`").alias(c) for c in docs.columns])
    return run


@_with_all_columns
def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model (fitted on the labelled ones) does not reject."""
    lexicon, w = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, lexicon, w, with_text=True).filter("predicted = 0").select(*docs.columns)


@_with_all_columns
def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that at least three documents share; n_chars follows the text."""
    out = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)


@_with_all_columns
def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (similarity 0.8 or more)."""
    return near_dedup.drop_near_duplicates(docs, percent=80)


@_with_all_columns
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weighted mix of sources takes them."""
    return mixing.mixed_rows(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of 4096."""
    return packing.pack(docs.select("doc_id", "text"), _tokenizer("word_bpe_49k.json"), window=4096, end_id=2)


STAGES = [("toxicity", toxicity_stage), ("line_dedup", line_dedup_stage), ("near_dedup", near_dedup_stage),
          ("mixing", mixing_stage), ("packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of ``sf_dir``, each to the table its predecessor wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
