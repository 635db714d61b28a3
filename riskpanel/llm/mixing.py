"""Mixing sources to target weights by pivotal dependent rounding.

A source's target divided by its size is the number of copies each of its
documents should get: a whole number plus a fractional probability. Dependent
rounding settles the fractions so that the source's words stay at the target:
two documents with fractional probabilities are paired, and words are moved
from one to the other, in a direction drawn at random so that neither's
expectation changes, until one probability is 0 or 1. What words one document
loses the other gains.

Blocks of a source are rounded in parallel and each leaves at most one
unsettled document; those residuals are combined by the same step in further
levels of a reduction tree, until a source has one, which is rounded to the
nearer whole number. Draws are hashes of seed and document, so reruns agree.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskpanel.llm.common import WORD, shipped, written

#: Documents rounded in one block, and residuals combined in one step of the tree.
BLOCK = 4096
WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0,
                   weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Targets per source: (source, source_size, target) from (source, source_size) rows.

    Sources in code-point order, null last, weigh ``weights`` repeating and
    share ``share`` times all words; a target stops at ``most`` times its
    source's size, and what is over is shared again by weight.
    """
    ordered = sizes.withColumn("__null", F.col("source").isNull())
    # one row per source: the only unpartitioned order is over source names
    rank = F.row_number().over(Window.orderBy("__null", F.col("source").cast("binary"))) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    t = written(ordered.select("source", "source_size", w.alias("weight"),
                               (F.col("source_size") * most).alias("cap")), "mix-sources")
    total = t.agg(F.sum("source_size")).first()[0] or 0
    budget, level, before = min(share, most) * total, 0.0, -1
    while True:  # at each turn more targets are at their cap; few turns, each one small aggregate
        at_cap = F.col("cap") <= F.lit(level) * F.col("weight")
        n, capped, free = t.agg(F.count(F.when(at_cap, 1)), F.coalesce(F.sum(F.when(at_cap, F.col("cap"))), F.lit(0.0)),
                                F.coalesce(F.sum(F.when(~at_cap, F.col("weight"))), F.lit(0.0))).first()
        if n == before or free == 0:
            break
        before, level = n, (budget - capped) / free
    target = F.when(F.lit(free == 0), F.col("cap")).otherwise(F.least("cap", F.lit(level) * F.col("weight")))
    return t.select("source", "source_size", target.cast("double").alias("target"))


def _settle(pdf: pd.DataFrame) -> pd.DataFrame:
    """Round one block, largest documents first; at most one row stays fractional."""
    pdf = pdf.sort_values(["size", "draw", "doc"], ascending=[False, True, True]).reset_index(drop=True)
    size, p, draw = pdf["size"].tolist(), pdf["p"].tolist(), pdf["draw"].tolist()
    held = None
    for i in range(len(size)):
        if not 0.0 < p[i] < 1.0:
            continue
        if held is None:
            held = i
            continue
        j = held
        up = min(size[i] * (1 - p[i]), size[j] * p[j])  # words that can go from j to i
        down = min(size[i] * p[i], size[j] * (1 - p[j]))  # and from i to j
        move = up if draw[i] * (up + down) < down else -down
        p[i] = _whole(p[i] + move / size[i])
        p[j] = _whole(p[j] - move / size[j])
        held = i if 0.0 < p[i] < 1.0 else j if 0.0 < p[j] < 1.0 else None
    pdf["p"] = p
    return pdf


def _whole(p: float) -> float:
    """Snap to 0 or 1 what differs from it by rounding error alone."""
    return 0.0 if p < 1e-12 else 1.0 if p > 1 - 1e-12 else p


_ROWS = "doc string, source string, words long, size long, draw double, p double, block long"


def round_copies(rows: DataFrame) -> DataFrame:
    """(doc, source, words, p) with p 0 or 1, from rows with p in (0, 1) and a block in their source."""
    out, level = None, rows
    while True:
        done = written(shipped(level).groupBy("source", "block").applyInPandas(_settle, _ROWS), "mix-level")
        rest = done.filter((F.col("p") > 0) & (F.col("p") < 1))
        settled = done.filter((F.col("p") == 0) | (F.col("p") == 1))
        out = settled if out is None else out.unionByName(settled)
        top = rest.agg(F.max("block")).first()[0]
        if not top:  # block 0 alone: at most one document of a source is left
            last = rest.withColumn("p", F.when(F.col("p") >= 0.5, 1.0).otherwise(0.0))
            return out.unionByName(last).select("doc", "source", "words", "p")
        level = rest.withColumn("block", F.floor(F.col("block") / BLOCK).cast("long"))


def mix(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS,
        seed: str = "mix") -> DataFrame:
    """``docs`` with size, source_size, target and copies (how often the mix takes the document).

    size: words of the text. No document gets more than ``most`` copies,
    rounded up; a document without words gets none, and a source without words
    has target 0. Null sources are one source. Rows alike in id, source and
    size are settled together and get the same number of copies. Empty input
    gives no rows. Input columns with the names of new columns are replaced.
    """
    new = ("size", "source_size", "target", "copies")
    base = docs.drop(*new)
    key = ["doc", "source", "words"]
    units = written(base.select(F.col("doc_id").cast("string").alias("doc"), F.col("source").cast("string"),
                                word_count(F.col("text")).alias("words"))
                    .groupBy(*key).agg(F.count(F.lit(1)).alias("n")), "mix-units")
    per_source = written(units.groupBy("source").agg(F.sum(F.col("words") * F.col("n")).alias("source_size"),
                                                     F.count(F.lit(1)).alias("docs")), "mix-source-sizes")
    targets = source_targets(per_source.select("source", "source_size"), share, most, weights)
    t = written(targets.join(per_source.select(F.col("source").alias("s2"), "docs"),
                             F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
                .withColumn("ratio", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                            .otherwise(0.0))
                .withColumn("whole", F.floor(F.col("ratio") + 1e-12))
                .withColumn("frac", F.greatest(F.col("ratio") - F.col("whole"), F.lit(0.0)))
                .withColumn("blocks", F.ceil(F.col("docs") / BLOCK)), "mix-targets")
    u = units.join(t, units["source"].eqNullSafe(t["source"])).drop(t["source"])
    spread = F.xxhash64(F.lit(seed), "doc", "source", "words")
    rows = u.filter((F.col("words") > 0) & (F.col("frac") > 1e-12)).select(
        "doc", "source", "words", (F.col("words") * F.col("n")).alias("size"),
        (F.pmod(spread, F.lit(1 << 53)) / float(1 << 53)).alias("draw"), F.col("frac").alias("p"),
        F.pmod(F.xxhash64(F.lit(seed + " block"), "doc", "words"), F.col("blocks")).alias("block"))
    rounded = round_copies(rows)
    of_unit = u.join(rounded.select(*[F.col(k).alias(f"r_{k}") for k in key], "p"),
                     u["doc"].eqNullSafe(F.col("r_doc")) & u["source"].eqNullSafe(F.col("r_source"))
                     & (u["words"] == F.col("r_words")), "left")
    copies = F.when(F.col("words") == 0, F.lit(0)).otherwise(F.col("whole") + F.coalesce("p", F.lit(0.0)))
    plan = written(of_unit.select(F.col("doc").alias("u_doc"), F.col("source").alias("u_source"), F.col("words").alias("u_words"),
                                  "source_size", "target", copies.cast("long").alias("copies")), "mix-plan")
    sized = base.withColumn("size", word_count(F.col("text")))
    return (sized.join(plan, sized["doc_id"].cast("string").eqNullSafe(plan["u_doc"])
                       & sized["source"].cast("string").eqNullSafe(plan["u_source"])
                       & (sized["size"] == plan["u_words"]))
            .drop("u_doc", "u_source", "u_words"))


def mixed_rows(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: each document's row as often as its copies, with the columns of ``docs``."""
    m = mix(docs, **how)
    return m.filter(F.col("copies") > 0).withColumn("__i", F.explode(F.expr("sequence(1L, copies)"))).select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in ("size", "source_size", "target", "copies")])
