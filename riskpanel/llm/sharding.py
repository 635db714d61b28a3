"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Rows with equal text form a group that no shard boundary may split. Groups
sorted by size enter the bin with the least remaining capacity that still
holds them, found in a balanced search tree of remaining capacities. For a
given number of shards the capacity is the smallest at which that many bins
suffice.

At scale only bounded summaries are packed on the driver. A group of at least
1/GRAIN of a shard's fair share is placed by itself: there are at most
``GRAIN * shards`` of those. All smaller groups are first packed, with the
same method inside each task, into bundles of 1/GRAIN of a share; bundles are
indivisible from then on, and their number is bounded the same way (plus one
open bundle a task). Rows, texts and small groups stay on the executors.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel.llm.common import numbered, parallelism, shipped, stable_rows, written

GRAIN = 2048


class OpenBins:
    """Bins by remaining capacity in a balanced tree of sorted leaves."""

    LEAF = 512

    def __init__(self):
        self.leaves: list[list[tuple[int, int]]] = [[]]
        self.tops: list[tuple[int, int]] = []

    def _leaf(self, item: tuple[int, int]) -> int:
        return min(bisect_left(self.tops, item), len(self.leaves) - 1)

    def _refresh(self) -> None:
        self.leaves = [x for x in self.leaves if x] or [[]]
        self.tops = [x[-1] for x in self.leaves if x]

    def add(self, room: int, bin_id: int) -> None:
        i = self._leaf((room, bin_id))
        insort(self.leaves[i], (room, bin_id))
        if len(self.leaves[i]) > 2 * self.LEAF:
            self.leaves[i:i + 1] = [self.leaves[i][:self.LEAF], self.leaves[i][self.LEAF:]]
            self._refresh()
        elif len(self.tops) <= i:
            self._refresh()
        else:
            self.tops[i] = self.leaves[i][-1]

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the (room, bin) with the least room >= size, the first bin on ties."""
        i = bisect_left(self.tops, (size, -1))
        if i >= len(self.tops):
            return None
        leaf = self.leaves[i]
        found = leaf.pop(bisect_left(leaf, (size, -1)))
        if leaf:
            self.tops[i] = leaf[-1]
        else:
            self._refresh()
        return found


def best_fit_decreasing(sizes: list[int], capacity: int, most_bins: int | None = None) -> list[int] | None:
    """Bin of each item (``sizes`` descending), or None if more than ``most_bins`` were needed.

    An item above the capacity gets a bin of its own.
    """
    bins, opened, out = OpenBins(), 0, []
    for size in sizes:
        found = bins.take_tightest(size)
        if found is None:
            if most_bins is not None and opened == most_bins:
                return None
            found = (max(capacity, size), opened)
            opened += 1
        out.append(found[1])
        if found[0] > size:
            bins.add(found[0] - size, found[1])
    return out


def fixed_shards(sizes: list[int], shards: int) -> list[int]:
    """Pack ``sizes`` (descending) into at most ``shards`` bins at the smallest capacity (to 1e-4) that allows it.

    An item as large as an equal share of what is left gets a bin of its own;
    the others are packed into the remaining bins.
    """
    alone, rest = 0, sum(sizes)
    while alone < min(len(sizes), shards - 1) and sizes[alone] * (shards - alone) >= rest:
        rest -= sizes[alone]
        alone += 1
    own, sizes, shards = list(range(alone)), sizes[alone:], shards - alone
    if not sizes:
        return own
    fair = -(-rest // shards)
    low = high = max(fair, sizes[0])
    while (best := best_fit_decreasing(sizes, high, shards)) is None:
        low, high = high, high + max(1, high // 64)
    while high - low > max(1, fair // 10_000):
        mid = (low + high) // 2
        got = best_fit_decreasing(sizes, mid, shards)
        if got is None:
            low = mid
        else:
            high, best = mid, got
    return own + [alone + x for x in best]


def _bundles(small: DataFrame, capacity: int) -> DataFrame:
    """Best fit decreasing inside each task: small groups to bundles of ``capacity``."""
    # one task's groups: hashed by digest, so about as many in each; a bundle is named by its first group
    def run(batches):
        keys, sizes, rows = [], [], 0
        bins, names, out_k, out_b, out_s = OpenBins(), [], [], [], []
        for b in batches:  # rows come sorted by size, descending
            for g, size in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = bins.take_tightest(size)
                if found is None:
                    found = (capacity, len(names))
                    names.append(g)
                if found[0] > size:
                    bins.add(found[0] - size, found[1])
                out_k.append(g)
                out_b.append(names[found[1]])
                out_s.append(size)
            yield pa.RecordBatch.from_arrays([pa.array(out_k, pa.binary()), pa.array(out_b, pa.binary()),
                                              pa.array(out_s, pa.int64())], ["g", "bundle", "bytes"])
            out_k, out_b, out_s = [], [], []

    dealt = small.select("g", "bytes").repartition(parallelism(small), "g") \
        .sortWithinPartitions(F.desc("bytes"), "g")
    return shipped(dealt).mapInArrow(run, "g binary, bundle binary, bytes long")


def assign_shards(docs: DataFrame, shards: int = 8) -> DataFrame:
    """The input's other columns, then size, text_crc32, shard and slot (``text`` is left to the files).

    size: UTF-8 bytes of the text (null: none) plus 1; text_crc32: its checksum
    (null text: null). Rows of equal text (all null texts are equal, '' is
    another text) share a shard; shard sizes are near equal as far as the
    groups allow. slot: position in the shard, gapless from 0. Repeated rows
    each get a slot. Fewer groups than shards leave shards empty; empty input
    gives no rows. Input columns with the names of new columns are replaced.
    """
    new = ("size", "text_crc32", "shard", "slot", "g")
    rest = [c for c in docs.columns if c not in new and c != "text"]
    b = F.col("text").cast("binary")
    rows = written(docs.select(
        *[F.col(f"`{c}`") for c in rest], (F.coalesce(F.length(b), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(b).alias("text_crc32"),
        F.unhex(F.coalesce(F.sha2(b, 256), F.lit(""))).alias("g")), "shard-rows")
    groups = written(rows.groupBy("g").agg(F.sum("size").alias("bytes")), "shard-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    grain = max(1, total // (shards * GRAIN))
    bundles = written(_bundles(groups.filter(F.col("bytes") < grain), grain), "shard-bundles")
    units = (groups.filter(F.col("bytes") >= grain).select(F.col("g").alias("bundle"), "bytes")
             .unionByName(bundles.groupBy("bundle").agg(F.sum("bytes").alias("bytes"))))
    got = [(bytes(r["bundle"]), r["bytes"]) for r in units.collect()]  # about 2 * GRAIN * shards rows at most
    got.sort(key=lambda x: (-x[1], x[0]))
    where = fixed_shards([x[1] for x in got], shards)
    spark = docs.sparkSession
    placed = spark.createDataFrame([(bytearray(k), s) for (k, _), s in zip(got, where)], "bundle binary, shard int")
    of_group = written(
        groups.select("g").join(bundles.select("g", "bundle"), "g", "left")
        .select("g", F.coalesce("bundle", "g").alias("bundle"))
        .join(F.broadcast(placed), "bundle").select("g", "shard"), "shard-of-group")
    located = rows.join(of_group, "g").drop("g")
    order = ["doc_id", "size", "text_crc32"] if "doc_id" in rest else ["size", "text_crc32"]
    return numbered(written(located, "shard-located"), "shard", order, "slot")


def write_shards(docs: DataFrame, path: str, shards: int = 8) -> DataFrame:
    """Write every row of ``docs`` as one folder per shard (``shard=N``, with its slot) and return the assignment.

    Rows are told apart by their place, not by an id, so repeated and null ids
    are written like others. Input columns named shard or slot are replaced.
    """
    rows = stable_rows(docs.drop("shard", "slot"))
    key = ["__file", "__row"]
    a = written(assign_shards(rows.select(*key, *[c for c in ("doc_id",) if c in rows.columns], "text"), shards), "shard-assignment")
    rows.join(a.select(*key, "shard", "slot"), key).drop(*key).write.partitionBy("shard").parquet(path)
    return a.drop(*key)
