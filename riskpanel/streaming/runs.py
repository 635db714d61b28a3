"""Tables that a stream adds to, kept as levelled runs.

Every micro-batch writes one run, ``run=<first>-<last>`` of the epochs it holds.
When ``fanout`` runs of one level are there, they are merged into one of the
next, so a table of n batches is read from at most (fanout - 1) * log(n) + 1
runs. A run counts once its ``_SUCCESS`` mark is there and no larger finished run
holds its epochs: readers never see a half-written run, a batch that Spark
replays overwrites its own run, and a merge that was cut off is done again.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

_NAME = re.compile(r"run=(\d+)-(\d+)$")


class Runs:
    """Levelled runs under ``path``; ``merge`` combines the rows of several runs (default: keeps them all)."""

    def __init__(self, spark: SparkSession, path: str, schema, merge: Callable[[DataFrame], DataFrame] = lambda df: df,
                 partition_by: str | None = None, fanout: int = 4):
        self.spark, self.path, self.schema, self.merge = spark, path, schema, merge
        self.partition_by, self.fanout = partition_by, fanout

    def live(self) -> list[tuple[int, int]]:
        """(first, last) epochs of the finished runs that no other finished run contains, in order."""
        jvm = self.spark.sparkContext._jvm
        top = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = top.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(top):
            return []
        done = []
        for s in fs.listStatus(top):
            m = _NAME.match(s.getPath().getName())
            if m and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")):
                done.append((int(m[1]), int(m[2])))
        return sorted(r for r in done if not any(o != r and o[0] <= r[0] and r[1] <= o[1] for o in done))

    def _read(self, runs: list[tuple[int, int]]) -> DataFrame:
        parts = [self.spark.read.schema(self.schema).parquet(f"{self.path}/run={a}-{b}") for a, b in runs]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], self.schema)

    def read(self, before: int | None = None) -> DataFrame:
        """All rows, or those of the epochs before ``before`` (a replayed batch does not see itself)."""
        return self._read([r for r in self.live() if before is None or r[1] < before])

    def _write(self, df: DataFrame, first: int, last: int) -> None:
        w = df.select(*self.schema.fieldNames()).write.mode("overwrite")
        (w.partitionBy(self.partition_by) if self.partition_by else w).parquet(f"{self.path}/run={first}-{last}")

    def add(self, df: DataFrame, epoch: int) -> None:
        """Write the run of one epoch, then merge each level that it fills; merged runs' parts are removed."""
        if any(a < b and a <= epoch <= b for a, b in self.live()):
            return  # a replay of a batch that was merged before it was committed
        self._write(df, epoch, epoch)
        size = self.fanout
        while (epoch + 1) % size == 0:
            first = epoch + 1 - size
            parts = [r for r in self.live() if first <= r[0] and r[1] <= epoch]
            self._write(self.merge(self._read(parts)), first, epoch)
            self._remove(parts)
            size *= self.fanout

    def _remove(self, runs: list[tuple[int, int]]) -> None:
        jvm = self.spark.sparkContext._jvm
        for a, b in runs:
            p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/run={a}-{b}")
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
