"""Packing documents into sequences of one length, best fit decreasing.

Texts become token ids; a document longer than a window is first cut into full
windows. The remaining pieces are shorter than a window, so best fit
decreasing needs only how many pieces there are of each length: at most
``window`` numbers whatever the corpus. The plan runs over these counts,
longest first; a segment tree indexed by remaining capacity finds the tightest
open sequences with room. It yields stretches "pieces a..b of length L go to
sequences s..s+b-a at offset o", and each piece finds its stretch by its rank
among the pieces of its length. Ranking is spread over hash buckets, so a
length that a third of all pieces share is no single task.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskpanel.llm.common import give_back, numbered, shipped, stable_rows, written
from riskpanel.llm.word_encoder import byte_sizes, groups, word_encoder

def cut_documents(docs: DataFrame, path: str, window: int = 4096, end_id: int = 2, with_ids: bool = True,
                  with_crc: bool = False, places: str | None = None) -> DataFrame:
    """Pieces of at most ``window`` ids: the input's other columns, then start, length, doc_tokens, ids.

    ``ids`` is binary (little-endian unsigned 32-bit). Each document ends with
    ``end_id``; a null or empty text has this id alone. All pieces but a
    document's last are full windows. ``text`` is replaced by the ids, which are
    left out without ``with_ids``; ``with_crc`` adds their ids_crc32, computed
    where they are made. Input columns with the names of new columns are
    dropped. ``places`` names a column with the (start, sequence_id, offset) of
    the document's pieces in order: it is replaced by each piece's own
    sequence_id and offset.
    """
    placed = ("sequence_id", "offset") if places else ()
    longs = ("start", "length", "doc_tokens", *placed, *(("ids_crc32",) if with_crc else ()))
    keep = [f for f in docs.schema.fields if f.name not in ("text", places, "ids", *longs)]
    names = [f.name for f in keep]
    schema = T.StructType([*keep, *[T.StructField(n, T.LongType()) for n in longs],
                           *([T.StructField("ids", T.BinaryType())] if with_ids else [])])
    at_once = max(1, (2 << 20) // window)  # pieces of a batch: at most 8 MB of ids

    def pieces_of(batch, first, n):
        """All pieces of n rows, as columns, a bounded number at a time."""
        ids, bounds = word_encoder(path).encode_column(batch.column(len(names)).slice(first, n), end_id)
        tokens = np.diff(bounds)
        times = -(-tokens // window)
        row = np.repeat(np.arange(n), times)
        start = (np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)) * window
        length = np.minimum(window, tokens[row] - start)
        begin = bounds[row] + start
        if places:
            own = batch.column(len(names) + 1).slice(first, n).flatten()
        view = memoryview(ids).cast("B")
        for a in range(0, len(row), at_once):
            s = slice(a, a + at_once)
            out = [batch.column(i).take(pa.array(first + row[s])) for i in range(len(names))]
            out += [pa.array(x[s], pa.int64()) for x in (start, length, tokens[row])]
            if places:
                out += [own.field(x).slice(a, at_once).cast(pa.int64()) for x in placed]
            ends = (begin + length)[s]
            if with_crc:
                out.append(pa.array([zlib.crc32(view[4 * x:4 * y]) for x, y in zip(begin[s].tolist(), ends.tolist())], pa.int64()))
            if with_ids:
                offsets = np.append(begin[s], ends[-1:]) - begin[a]
                out.append(pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer((4 * offsets).astype(np.int32)),
                                                                          pa.py_buffer(ids[begin[a]:ends[-1]])]))
            yield pa.RecordBatch.from_arrays(out, [f.name for f in schema.fields])

    def run(batches):
        give_back()  # what other tasks of this worker left
        for b in batches:
            for first, n in groups(byte_sizes(b.column(len(names)))):
                yield from pieces_of(b, first, n)
            del b
            give_back()

    return shipped(docs).select(*[F.col(f"`{n}`") for n in names], F.col("text").cast("string").alias("text"),
                                *([F.col(places)] if places else [])).mapInArrow(run, schema)


class CapacityTree:
    """Segment tree over remaining capacities 0..size: how many open sequences have each."""

    def __init__(self, size: int):
        self.leaves = 1
        while self.leaves <= size:
            self.leaves *= 2
        self.sums = [0] * (2 * self.leaves)

    def add(self, capacity: int, n: int) -> None:
        i = self.leaves + capacity
        while i:
            self.sums[i] += n
            i //= 2

    def tightest(self, need: int) -> int | None:
        """The smallest capacity >= need that an open sequence has."""
        i = self.leaves + need
        if self.sums[i]:
            return need
        while i > 1:
            if i % 2 == 0 and self.sums[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.sums[2 * i] else 2 * i + 1
                return i - self.leaves
            i //= 2
        return None


def plan_best_fit(counts: dict[int, int], window: int) -> list[tuple[int, int, int, int, int]]:
    """Best fit decreasing over piece counts by length.

    Returns stretches (length, first rank, last rank + 1, first sequence,
    offset); sequences are numbered from 0 in the order they are opened. A
    sequence that takes a piece is then the tightest with room, so it takes
    pieces of that length until none fits; sequences with equal room are
    treated together.
    """
    tree, open_at = CapacityTree(window), {}
    plan, opened = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room = window
                each = room // length
                first, last = opened, opened + -(-left // each)
                opened = last
            else:
                each = room // length
                first, last = open_at[room].pop()
                tree.add(room, first - last)
            full = min(last - first, left // each)
            if full:
                n, times = full, each
            else:
                n, times = 1, left
            for j in range(times):
                plan.append((length, rank, rank + n, first, window - room + j * length))
                rank += n
            left -= n * times
            for a, b, capacity in ((first, first + n, room - times * length), (first + n, last, room)):
                if b > a and capacity and capacity < window:
                    open_at.setdefault(capacity, []).append((a, b))
                    tree.add(capacity, b - a)
                elif b > a and capacity == window:
                    opened = a
    return plan


def place(pieces: DataFrame, window: int = 4096) -> DataFrame:
    """Add sequence_id and offset to pieces with a ``length`` of 1 to ``window``.

    Every piece lies in exactly one sequence and sequences fill without gaps
    from offset 0. Repeated pieces are placed each on their own. No pieces: no
    rows.
    """
    clash = [c for c in ("sequence_id", "offset", "__rank", "__first") if c in pieces.columns]
    order = [c for c in ("doc_id", "start") if c in pieces.columns] or ["length"]
    ranked = numbered(pieces.drop(*clash), "length", order, "__rank")
    counts = {r["length"]: r["n"] for r in
              pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``window`` rows
    plan = np.array(sorted((length, a, first, offset) for length, a, _, first, offset in plan_best_fit(counts, window)),
                    np.int64).reshape(-1, 4)
    most = int(max(counts.values(), default=0)) + 1

    def find(batches):
        keys = plan[:, 0] * most + plan[:, 1]  # stretches by length and first rank
        for b in batches:
            length, rank = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            _, a, first, offset = plan[np.searchsorted(keys, length * most + rank, "right") - 1].T
            cols = [b.column(i) for i in range(2, b.num_columns)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(first + rank - a, pa.int64()), pa.array(offset, pa.int64())],
                                             [*b.schema.names[2:], "sequence_id", "offset"])

    rest = [c for c in ranked.columns if c != "__rank"]
    schema = T.StructType([*ranked.select(*[F.col(f"`{c}`") for c in rest]).schema.fields,
                           T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return shipped(ranked).select(F.col("length").alias("__l"), F.col("__rank"), *[F.col(f"`{c}`") for c in rest]) \
        .mapInArrow(find, schema)


def pack(docs: DataFrame, path: str, window: int = 4096, end_id: int = 2) -> DataFrame:
    """Cut and place whole documents: the pieces with their ids, sequence_id and offset.

    Ids are large and texts are not, so placing works on the pieces' lengths
    alone; each document then gets its pieces' places and is encoded once more
    where its pieces are returned.
    """
    rows = stable_rows(docs.drop("__places"))
    key = ["__file", "__row"]
    order = [c for c in ("doc_id",) if c in rows.columns]
    lengths = written(cut_documents(rows.select(*key, *order, "text"), path, window, end_id, with_ids=False), "pieces")
    places = place(lengths, window).groupBy(*key).agg(
        F.sort_array(F.collect_list(F.struct("start", "sequence_id", "offset"))).alias("__places"))
    placed = rows.join(places.hint("merge"), key).drop(*key)
    return cut_documents(placed, path, window, end_id, places="__places")
