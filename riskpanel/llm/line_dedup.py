"""Line dedup over levelled sorted runs of line hashes.

Documents come in batches. A batch's line keys are reduced to one row per key
(number of documents, largest ``doc_id``). The keys that no stored run has
(anti-join) become a run of their own, sorted by key hash; the others are
counts for keys already stored and go to a side table. When a level holds
``fanout`` runs they are compacted into one sorted run of the next level; runs
share no key, so that is a merge without aggregation. Keys found in at least
``min_docs`` documents then lose their lines in every document but the one
with the largest ``doc_id`` holding them.

Everything is DataFrame code. Line texts are never shuffled for counting, only
their 128-bit hashes; the one shuffle of texts brings each document its list
of dropped keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskpanel.llm.common import written

STRIP = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A key with at least this share of all (document, key) rows is hot; at most
#: 1 / HOT_SHARE such keys exist, so they can be broadcast at any size.
HOT_SHARE = 1e-4
_NULL_ID = -(2 ** 63)


def line_key(line: Column) -> Column:
    """The line without ASCII white space at both ends, A-Z lower-cased."""
    return F.translate(F.trim(line, F.lit(STRIP)), UPPER, LOWER)


def _hash(key: Column) -> Column:
    """128 bits of the key: two 64-bit hashes with unlike functions."""
    b = key.cast("binary")
    return F.struct(F.xxhash64(b).alias("h1"), F.xxhash64(F.md5(b), F.length(b)).alias("h2"))


def _doc(c: str = "doc_id") -> Column:
    return F.coalesce(F.col(c).cast("long"), F.lit(_NULL_ID))


def document_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row (doc, k) for each document and each of its long enough line keys."""
    keys = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), line_key)
    long_keys = F.filter(keys, lambda k: F.length(k) >= min_chars)
    return (docs.select(_doc().alias("doc"), F.array_distinct(long_keys).alias("ks"))
            .select("doc", F.explode("ks").alias("key"))
            .select("doc", _hash(F.col("key")).alias("k")))


class LineRuns:
    """Levelled sorted runs (k, n_docs, max_doc) in the shared checkpoint folder."""

    def __init__(self, fanout: int = 4):
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = []
        self.repeats: list[DataFrame] = []

    def stored(self) -> DataFrame | None:
        runs = [r for level in self.levels for r in level]
        out = None
        for r in runs:
            out = r if out is None else out.unionByName(r)
        return out

    def add(self, batch: DataFrame) -> None:
        """Add one batch of (doc, k) rows; all rows of a document come in one batch."""
        own = (batch.groupBy("k", "doc").agg(F.lit(1).alias("one"))
               .groupBy("k").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc").alias("max_doc")))
        seen = self.stored()
        if seen is None:
            self._push(own, 0)
            return
        own = written(own, "lines-batch")
        self.repeats.append(written(own.join(seen.select("k"), "k", "left_semi"), "lines-again"))
        self._push(own.join(seen.select("k"), "k", "left_anti"), 0)

    def _push(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        run = written(run.sortWithinPartitions("k"), f"lines-run-{level}")
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = self.levels[level][0]
            for r in self.levels[level][1:]:
                merged = merged.unionByName(r)
            self.levels[level] = []
            self._push(merged.repartitionByRange("k"), level + 1)

    def repeated(self, min_docs: int) -> DataFrame:
        """Keys of at least ``min_docs`` documents: (k, n_docs, max_doc)."""
        all_rows = self.stored()
        for r in self.repeats:
            all_rows = all_rows.unionByName(r)
        return (all_rows.groupBy("k").agg(F.sum("n_docs").alias("n_docs"), F.max("max_doc").alias("max_doc"))
                .filter(F.col("n_docs") >= min_docs))


def dedup_lines(docs: DataFrame, min_docs: int = 3, min_chars: int = 20, batches: int = 4,
                fanout: int = 3) -> DataFrame:
    """Return ``docs`` with ``text`` deduplicated by line, plus n_lines and n_dropped.

    A null or empty text is one empty line and comes back as ''. Rows with the
    same ``doc_id`` are one document: a line repeated only inside it counts
    once, and all of them keep it if the id is the largest. A null ``doc_id``
    is a document below all others. Lines that stay keep their order and their
    own spelling. Empty input gives an empty result. All other columns pass
    through; input columns named n_lines or n_dropped are replaced.
    """
    keys = written(document_keys(docs, min_chars)
                   .withColumn("batch", F.pmod(F.xxhash64("doc"), F.lit(batches))), "lines-keys")
    runs = LineRuns(fanout)
    for b in range(batches):
        runs.add(keys.filter(F.col("batch") == b).drop("batch"))
    repeated = written(runs.repeated(min_docs), "lines-repeated")
    # Keys that very many documents share are few whatever the size: broadcast them; join the rest by key.
    n_keys = keys.count()
    least = max(1000, int(n_keys * HOT_SHARE))
    hot = F.broadcast(repeated.filter(F.col("n_docs") >= least))
    cold = repeated.filter(F.col("n_docs") < least)
    rows = keys.drop("batch").join(hot.select("k", F.col("max_doc").alias("hot_doc")), "k", "left")
    of_hot = rows.filter(F.col("doc") < F.col("hot_doc")).select("doc", "k")
    of_cold = (rows.filter(F.col("hot_doc").isNull()).select("doc", "k").join(cold, "k")
               .filter(F.col("doc") < F.col("max_doc")).select("doc", "k"))
    drops = of_hot.unionByName(of_cold).groupBy("doc").agg(F.collect_set("k").alias("__drop"))
    base = docs.drop("n_lines", "n_dropped").withColumn("__doc", _doc())
    joined = base.join(drops.withColumnRenamed("doc", "__doc"), "__doc", "left")
    lines = F.split(F.coalesce("text", F.lit("")), "\n")

    def stays(x):
        key = line_key(x)
        return (F.length(key) < min_chars) | ~F.array_contains(F.col("__drop"), _hash(key))

    kept = F.when(F.col("__drop").isNull(), F.col("__lines")).otherwise(F.filter("__lines", stays))
    out = (joined.withColumn("__lines", lines).withColumn("__kept", kept)
           .withColumn("text", F.concat_ws("\n", "__kept"))
           .withColumn("n_lines", F.size("__lines").cast("long"))
           .withColumn("n_dropped", (F.size("__lines") - F.size("__kept")).cast("long")))
    return out.select(*[c for c in base.columns if c != "__doc"], "n_lines", "n_dropped")
