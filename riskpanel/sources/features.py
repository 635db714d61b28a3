"""Features of large GeoJSON files, read in parallel.

A FeatureCollection is one JSON document, often without a line break. The file
is read in blocks (Spark's splits, with a closing brace as the separator), and
where a feature begins depends on all brackets and quotes before it. One pass
sums up each block: how deep it goes and whether it ends inside a string, for
both states it may start in. A pass over these summaries, one row per block,
gives each block's start. A second such round tells which blocks start within
the document's ``features`` array; the third pass cuts the features, and pieces
of features that cross a block's border are put together in a shuffle.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpanel.session import ship_package

_KEY = re.compile(rb'"features"\s*:\s*\Z')
_STEP = np.zeros(256, np.int8)
_STEP[[ord("{"), ord("[")]] = 1
_STEP[[ord("}"), ord("]")]] = -1


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value): the file cut after every closing brace, in the order of each block."""
    return spark.read.option("lineSep", "}").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _runs(batches):
    """((file, block), bytes) of the runs of chunks of one block, a batch at a time."""
    for b in batches:
        file, block = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        cut = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1
        for start, stop in zip([0, *cut.tolist()], [*cut.tolist(), len(file)]):
            if stop > start:
                text = b.column(2).slice(start, stop - start).cast(pa.binary()).to_pylist()
                yield (int(file[start]), int(block[start])), b"}".join(text) + b"}"


def _outside(text: np.ndarray, in_string: bool) -> tuple[np.ndarray, bool]:
    """(mask of bytes outside strings, whether the text ends inside one). Quotes after an odd run of backslashes are text."""
    quote = text == 34
    slash = np.flatnonzero(text == 92)
    if len(slash):
        first = np.flatnonzero(np.diff(slash, prepend=-2) != 1)
        last = np.append(first[1:] - 1, len(slash) - 1)
        after = slash[last[(last - first) % 2 == 0]] + 1
        quote[after[after < len(text)]] = False
    odd = np.cumsum(quote) + in_string & 1
    return (odd == 0) & ~quote, bool(odd[-1])


def _depths(text: np.ndarray, in_string: bool, depth: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """(places of brackets, depth after each, ends inside a string)."""
    free, inside = _outside(text, in_string)
    at = np.flatnonzero((_STEP[text] != 0) & free)
    return at, depth + np.cumsum(_STEP[text[at]], dtype=np.int64), inside


def _per_block(chunks: DataFrame, columns: dict, start, step, row) -> DataFrame:
    """One row per block: ``row(state)`` after ``step(state, bytes)`` over its text from ``start(key)`` on."""
    def run(batches):
        key, state = None, None
        out = lambda: pa.RecordBatch.from_pydict(
            {n: pa.array([v], t) for (n, t), v in zip([("file", pa.int64()), ("block", pa.int64()), *columns.items()],
                                                      [*key, *row(state)])})
        for own, text in _runs(batches):
            if own != key:
                if key is not None:
                    yield out()
                key, state = own, start(own)
            state = step(state, text)
        if key is not None:
            yield out()

    kinds = {pa.int64(): "long", pa.bool_(): "boolean"}
    ship_package(chunks.sparkSession)
    return chunks.mapInArrow(run, ", ".join(["file long", "block long", *[f"{n} {kinds[t]}" for n, t in columns.items()]]))


def _nesting(chunks: DataFrame) -> dict:
    """{(file, block): (starts inside a string, depth at its start)}."""
    def step(state, text):
        text = np.frombuffer(text, np.uint8)
        out = []
        for inside, depth in state:
            _, depths, now = _depths(text, inside, depth)
            out.append((now, int(depths[-1]) if len(depths) else depth))
        return out

    sums = _per_block(chunks, {"end0": pa.bool_(), "deep0": pa.int64(), "end1": pa.bool_(), "deep1": pa.int64()},
                      lambda key: [(False, 0), (True, 0)], step, lambda s: [*s[0], *s[1]])

    def carry(s: pd.DataFrame) -> pd.DataFrame:
        inside, depth, rows = False, 0, []
        for x in s.sort_values("block").itertuples():
            rows.append((x.file, x.block, inside, depth))
            inside, depth = (x.end1, depth + x.deep1) if inside else (x.end0, depth + x.deep0)
        return pd.DataFrame(rows, columns=["file", "block", "inside", "depth"])

    got = sums.groupBy("file").applyInPandas(carry, "file long, block long, inside boolean, depth long")
    return {(r["file"], r["block"]): (r["inside"], r["depth"]) for r in got.collect()}  # one row per file block


def _array_events(text: bytes, inside: bool, depth: int):
    """(places, depths, ends inside, events): events are (place, whether it opens the root's features array) at depth 1 to 2."""
    data = np.frombuffer(text, np.uint8)
    at, depths, now = _depths(data, inside, depth)
    up = (_STEP[data[at]] > 0)
    events = [(int(i), data[i] == ord("[") and bool(_KEY.search(text, max(0, i - 200), i)))
              for i in at[up & (depths == 2)].tolist()]
    events += [(int(i), False) for i in at[~up & (depths == 1)].tolist()]
    return at, depths, now, sorted(events)


def _starts(chunks: DataFrame) -> dict:
    """{(file, block): (starts inside a string, depth, within the features array, block where the feature it starts in began)}."""
    nesting = _nesting(chunks)

    def step(state, text):
        inside, depth, last, low = state
        _, depths, now, events = _array_events(text, inside, depth)
        low = low or bool(len(depths) and depths.min() <= 2)
        return now, int(depths[-1]) if len(depths) else depth, events[-1][1] if events else last, low

    sums = _per_block(chunks, {"last": pa.bool_(), "low": pa.bool_()}, lambda key: (*nesting[key], None, nesting[key][1] <= 2),
                      step, lambda s: s[2:])
    out, file, within, began = {}, None, False, None
    for r in sums.orderBy("file", "block").collect():  # one row per file block
        if r["file"] != file:
            file, within, began = r["file"], False, None
        out[file, r["block"]] = (*nesting[file, r["block"]], within, began)
        within = within if r["last"] is None else r["last"]
        began = r["block"] if r["low"] else began
    return out


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """(value): the JSON text of every object in the ``features`` array of the GeoJSON files of ``path``.

    A file holds one document. Elements that are no objects are left out.
    """
    chunks = _chunks(spark, path)
    starts = _starts(chunks)

    def run(batches):
        key, held, inside, depth, within, began, crossed = None, [], False, 0, False, None, False
        schema = ["value", "file", "record", "block"]

        def out(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.binary()).cast(pa.string()), pa.array([key[0]] * len(rows), pa.int64()),
                 pa.array([r[1] for r in rows], pa.int64()), pa.array([key[1]] * len(rows), pa.int64())], schema)

        def end():
            """The piece of a feature that goes on in the next block, under the block where it began."""
            return out([(b"".join(held), began if crossed else key[1])])

        for own, text in _runs(batches):
            if own != key:
                if key is not None and held:
                    yield end()
                key, held = own, []
                inside, depth, within, began = starts[own]
                crossed = within and depth > 2
                if crossed:
                    held = [b""]
            at, depths, now, events = _array_events(text, inside, depth)
            up = _STEP[np.frombuffer(text, np.uint8)[at]] > 0
            opens = at[up & (depths == 3)].tolist()
            closes = (at[~up & (depths == 2)] + 1).tolist()
            moves = sorted([(i, 0, v) for i, v in events] + [(i, 1, None) for i in opens] + [(i - 1, 2, i) for i in closes])
            rows, begun = [], 0 if held else None
            for i, what, x in moves:
                if what == 0:
                    within = x
                elif what == 1 and within and text[i:i + 1] == b"{":
                    begun = i
                elif what == 2 and begun is not None:
                    rows.append((b"".join([*held, text[begun:x]]), began if crossed else None))
                    held, begun, crossed = [], None, False
            if rows:
                yield out(rows)
            if begun is not None:
                held.append(text[begun:])
            inside, depth = now, int(depths[-1]) if len(depths) else depth
        if key is not None and held:
            yield end()

    ship_package(chunks.sparkSession)
    cut = chunks.mapInArrow(run, "value string, file long, record long, block long")
    whole = cut.filter("record is null").select("value")
    if len(starts) < 2:
        return whole
    pieces = cut.filter("record is not null").groupBy("file", "record").agg(
        F.sort_array(F.collect_list(F.struct("block", "value"))).alias("p"))
    return whole.unionByName(pieces.select(F.concat_ws("", "p.value").alias("value")))
