"""CSV records of text files, those that span lines included, read in parallel.

A line ends a record unless a quote is open there, so what a line is depends on
all quotes before it. Files are still read in blocks (Spark's file splits):
only the lines with an odd number of quotes change the state. One pass sums up
each block - its lines and where its odd lines lie, under both states it may
start in - and a pass over these summaries, one row per block, tells in which
state each block starts. Then every block is cut into records on its own; only
the pieces of records that cross a block's border are put together in a shuffle.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpanel.session import ship_package

#: Lines of a record at most: a quote that is not closed within as many stands for itself, and so does its line.
MAX_LINES = 10_000


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, block, at, odd): lines in the order of their block; ``odd`` if they have an odd number of quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return spark.read.text(path).select(
        "value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), (quotes % 2 == 1).alias("odd"))


def _summaries(lines: DataFrame, most: int) -> DataFrame:
    """One row per block: lines, and its odd lines (count, first, last, whether two neighbours among them lie more
    than ``most`` lines apart, and how many follow the last such gap), places counted from the block's first line."""
    schema = "file long, block long, n long, odds long, first long, last long, gap boolean, after long"

    def run(batches):
        key, n, odds, first, last, gap, after = None, 0, 0, -1, -1, False, 0

        def row():
            return pa.RecordBatch.from_pandas(pd.DataFrame([(*key, n, odds, first, last, gap, after)], columns=[
                "file", "block", "n", "odds", "first", "last", "gap", "after"]), preserve_index=False)

        for b in batches:
            for own, start, stop in _blocks(b):
                if own != key:
                    if key is not None:
                        yield row()
                    key, n, odds, first, last, gap, after = own, 0, 0, -1, -1, False, 0
                odd = np.flatnonzero(b.column(2).slice(start, stop - start).to_numpy(zero_copy_only=False)) + n
                if len(odd):
                    far = np.flatnonzero(np.diff(odd, prepend=last if odds else odd[0]) > most)
                    after = len(odd) - far[-1] if len(far) else after + len(odd)
                    gap, odds, last = gap or bool(len(far)), odds + len(odd), int(odd[-1])
                    first = int(odd[0]) if first < 0 else first
                n += stop - start
        if key is not None:
            yield row()

    ship_package(lines.sparkSession)
    return lines.select("file", "block", "odd").mapInArrow(run, schema)


def _blocks(b: pa.RecordBatch):
    """((file, block), start, stop) of the runs of rows of one block."""
    file, block = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    cut = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1
    for start, stop in zip([0, *cut.tolist()], [*cut.tolist(), len(file)]):
        if stop > start:
            yield (int(file[start]), int(block[start])), start, stop


def block_states(summaries: pd.DataFrame, most: int) -> pd.DataFrame:
    """(file, block, head, tail, record) of one file's blocks with a record across a border, from their summaries.

    ``head``: the block starts inside a record that closes at its first odd line
    (or, if ``tail`` too and it has no odd line, runs on); ``tail``: it ends
    inside one. ``record`` is the block where the head's record began.
    """
    s = list(summaries.sort_values("block").itertuples())
    head, tail, record = set(), set(), {}
    open_line = open_at = None  # line number and block of an opening line that is not closed so far
    base = 0
    for i, x in enumerate(s):
        if x.odds:
            closes = open_line is not None and base + x.first - open_line <= most
            if closes:
                for j in range(open_at, i):
                    tail.add(j)
                    head.add(j + 1)
                    record[j + 1] = s[open_at].block
            in_run = x.after if x.gap else x.odds + closes
            open_line, open_at = (base + x.last, i) if in_run % 2 else (None, None)
        base += x.n
    rows = [(s[i].file, s[i].block, i in head, i in tail, record.get(i, s[i].block)) for i in sorted(head | tail)]
    return pd.DataFrame(rows, columns=["file", "block", "head", "tail", "record"])


def _cut(lines: DataFrame, states: dict, most: int) -> DataFrame:
    """(value, file, record, block): whole records (record null), and pieces of records that cross blocks."""
    def joined(parts):
        return pa.array(["\n".join(x for p in parts for x in p.to_pylist())], pa.string())

    def run(batches):
        key, held, since, head, tail, begun = None, [], 0, False, False, 0

        def out(values, record=None):
            n = len(values)
            return pa.RecordBatch.from_arrays(
                [values, pa.array([key[0]] * n, pa.int64()), pa.array([record] * n, pa.int64()),
                 pa.array([key[1]] * n, pa.int64())], ["value", "file", "record", "block"])

        def end():
            """What is held at a block's end: a piece of a record that goes on, or an opening line that nothing closes."""
            if held and (head or tail):
                yield out(joined(held), begun if head else key[1])
            else:
                yield from map(out, held)

        for b in batches:
            for own, start, stop in _blocks(b):
                if own != key:
                    if key is not None:
                        yield from end()
                    key, held, since = own, [], 0
                    head, tail, begun = states.get(own, (False, False, 0))
                text, done = b.column(3).slice(start, stop - start), 0
                odd = np.flatnonzero(b.column(2).slice(start, stop - start).to_numpy(zero_copy_only=False))
                for i in odd.tolist():
                    if head or held and since + i - done <= most:  # closes the record
                        yield out(joined([*held, text.slice(done, i + 1 - done)]), begun if head else None)
                        held, head = [], False
                    else:  # what was held stood for itself; this line opens
                        yield from map(out, held)
                        yield out(text.slice(done, i - done))
                        held, since = [text.slice(i, 1)], 1
                    done = i + 1
                rest = text.slice(done)
                if head or held:
                    held.append(rest)
                    since += len(rest)
                    if not head and since > most + 1:
                        yield from map(out, held)
                        held = []
                else:
                    yield out(rest)
        if key is not None:
            yield from end()

    ship_package(lines.sparkSession)
    return lines.select("file", "block", "odd", "value").mapInArrow(run, "value string, file long, record long, block long")


def read_records(spark: SparkSession, path: str, max_lines: int = MAX_LINES) -> DataFrame:
    """(value): the records of CSV text files, a record's lines joined by a line feed.

    A quote opens or closes, a doubled one does both, so a record ends where its
    lines' quotes are even. A line that opens a quote which none of the next
    ``max_lines`` lines closes (nor any line up to the file's end) is a record
    by itself, and so are the lines after it: one stray quote spoils one record.
    Where no line has an odd number of quotes, lines are records and no more
    than that count is needed. Empty lines outside records are returned too.
    """
    lines = _lines(spark, path)
    if lines.filter("odd").isEmpty():
        return lines.select("value")
    states = _summaries(lines, max_lines).groupBy("file").applyInPandas(
        lambda s: block_states(s, max_lines), "file long, block long, head boolean, tail boolean, record long")
    # one row for each file block whose border a record crosses
    known = {(r["file"], r["block"]): (r["head"], r["tail"], r["record"]) for r in states.collect()}
    cut = _cut(lines, known, max_lines)
    whole = cut.filter("record is null").select("value")
    if not known:
        return whole
    pieces = cut.filter("record is not null").groupBy("file", "record").agg(
        F.sort_array(F.collect_list(F.struct("block", "value"))).alias("p"))
    return whole.unionByName(pieces.select(F.concat_ws("\n", F.col("p.value")).alias("value")))
