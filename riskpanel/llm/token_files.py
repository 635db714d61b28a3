"""Token ids in Arrow files: sequences of one length, read without a copy.

Documents are encoded in ascending order of their ids, one range of ids per
task, and each task streams its token ids into one file of the Arrow IPC file
format: batches of ``BATCH`` rows with two fixed-size-list columns, ``ids`` and
``mask`` (true for a token, false for the padding at the end of the file's last
sequence). The values of a batch lie in one buffer, so sequence i is a slice of
batch i // BATCH, and a memory-mapped file gives any of them without reading
the others. A second file beside it says where each document lies.

A task names its files by a random name and returns it in the manifest, which
Spark commits with the task: files of a lost or repeated attempt are in no
manifest and are not read. Places over all files come from running sums over
the manifest, which has one row per file.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskpanel.llm.common import parallelism, shipped, written
from riskpanel.llm.word_encoder import byte_sizes, groups, word_encoder

#: Sequences of a batch, and documents of a batch of the second file.
BATCH, DOC_BATCH = 256, 65_536
#: Rows of a batch that a query of documents returns.
_OUT = 16_384

MANIFEST = "part int, tokens string, documents string, n_docs long, n_sequences long, n_tokens long"
_PLACES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The Arrow file system of a folder's URI or absolute path, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def sequence_schema(length: int, end_id: int, kind: pa.DataType) -> pa.Schema:
    """Schema of a token file with ids of type ``kind``; its metadata hold the sequence length and the end id."""
    return pa.schema([pa.field("ids", pa.list_(pa.field("item", kind, False), length), False),
                      pa.field("mask", pa.list_(pa.field("item", pa.bool_(), False), length), False)],
                     {"length": str(length), "end_id": str(end_id)})


class TokenWriter:
    """One token file and its document file, written in batches of bounded size."""

    def __init__(self, folder: str, name: str, length: int, end_id: int, kind: pa.DataType):
        self.fs, base = file_system(folder)
        self.names = f"{base}/tokens-{name}.arrow", f"{base}/documents-{name}.arrow"
        self.length, self.schema = length, sequence_schema(length, end_id, kind)
        self.streams = [self.fs.open_output_stream(n) for n in self.names]
        self.tokens = pa.ipc.new_file(self.streams[0], self.schema)
        self.places = pa.ipc.new_file(self.streams[1], _PLACES)
        self.held = np.empty(BATCH * length, kind.to_pandas_dtype())
        self.fill = self.written = self.docs = self.sequences = 0

    def add(self, doc_ids: pa.Array, ids: np.ndarray, bounds: np.ndarray) -> None:
        """Documents with the ids ids[bounds[i]:bounds[i + 1]]."""
        at = self.written + self.fill
        self.places.write_batch(pa.RecordBatch.from_arrays(
            [doc_ids, pa.array(at + bounds[:-1], pa.int64()), pa.array(np.diff(bounds), pa.int64())], schema=_PLACES))
        self.docs += len(doc_ids)
        done = 0
        while done < len(ids):
            n = min(len(ids) - done, len(self.held) - self.fill)
            self.held[self.fill:self.fill + n] = ids[done:done + n]
            self.fill, done = self.fill + n, done + n
            if self.fill == len(self.held):
                self._batch()

    def _batch(self) -> None:
        rows = -(-self.fill // self.length)
        size = rows * self.length
        self.held[self.fill:size] = 0
        mask = pa.Array.from_buffers(pa.bool_(), size, [None, pa.py_buffer(np.packbits(np.arange(size) < self.fill, bitorder="little"))])
        self.tokens.write_batch(pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(v, type=f.type)
             for v, f in zip((pa.array(self.held[:size]), mask), self.schema)], schema=self.schema))
        self.written, self.fill, self.sequences = self.written + self.fill, 0, self.sequences + rows

    def close(self) -> tuple[str, str, int, int, int]:
        """Finish both files: (token file, document file, documents, sequences, tokens)."""
        if self.fill:
            self._batch()
        for x in (self.tokens, self.places, *self.streams):
            x.close()
        return *(n.rsplit("/", 1)[1] for n in self.names), self.docs, self.sequences, self.written


class TokenFile:
    """Random access to the sequences of one token file; local files are memory-mapped."""

    def __init__(self, folder: str, name: str):
        fs, base = file_system(folder)
        path = f"{base}/{name}"
        self.source = pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)
        self.reader = pa.ipc.open_file(self.source)
        self.length = int(self.reader.schema.metadata[b"length"])
        self._at, self._values = -1, ()

    def _batch(self, k: int) -> tuple[np.ndarray, pa.Array]:
        if k != self._at:
            b = self.reader.get_batch(k)
            self._at, self._values = k, (b.column(0).flatten().to_numpy(), b.column(1).flatten())
        return self._values

    def sequence(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of sequence i: views of the file's buffers (a mask is a bit for each id)."""
        ids, mask = self._batch(i // BATCH)
        at = i % BATCH * self.length
        return ids[at:at + self.length], mask.slice(at, self.length)

    def ids(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The n ids from ``start`` on: views, one for each batch they lie in."""
        size = BATCH * self.length
        while n > 0:
            here = min(n, size - start % size)
            yield self._batch(start // size)[0][start % size:start % size + here]
            start, n = start + here, n - here

    def close(self) -> None:
        self._values = ()
        self.source.close()


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, length: int = 2048,
                      parts: int | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id, text; other columns are not used) into ``folder`` and return the manifest.

    Documents lie in ascending order of doc_id (null first; equal ids by a hash
    of the text, so a repeated id is spread over files). A null or empty text
    is the end id alone. Manifest: part (files in order), names of its token and
    document file, n_docs, n_sequences, n_tokens (padding not counted). A range
    without documents, and so an empty table, has no file. ``folder`` must be
    shared by all executors (a path or URI that pyarrow opens); it is made if missing.
    Ids are stored in 16 bits where the tokenizer's vocabulary and ``end_id`` allow it, else in 32.
    """
    top = max(end_id, *Tokenizer.from_file(tokenizer).get_vocab().values())
    kind = pa.uint16() if top < 1 << 16 else pa.uint32()
    fs, base = file_system(folder)
    fs.create_dir(base, recursive=True)

    def run(batches):
        writer = None
        for b in batches:
            text = b.column(1)
            for first, n in groups(byte_sizes(text)):
                ids, bounds = word_encoder(tokenizer).encode_column(text.slice(first, n), end_id)
                if writer is None:
                    part = TaskContext.get().partitionId()
                    writer = TokenWriter(folder, f"{part:06d}-{uuid.uuid4().hex}", length, end_id, kind)
                writer.add(b.column(0).slice(first, n), ids, bounds)
        if writer is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(
                (part, *writer.close()), (pa.int32(), pa.string(), pa.string(), *[pa.int64()] * 3))],
                ["part", "tokens", "documents", "n_docs", "n_sequences", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.xxhash64("text").alias("tie"))
    ranged = rows.repartitionByRange(parts or parallelism(docs), "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    return written(shipped(ranged).select("doc_id", "text").mapInArrow(run, MANIFEST), "token-manifest")


def read_documents(manifest: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document, read back from the files.

    ``start`` counts the ids of all documents before it over all files in order;
    ``ids_crc32`` is the unsigned checksum of its ids as little-endian unsigned
    32-bit integers (``ids``). One task reads whole files, a batch at a time.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = manifest.select("part", "tokens", "documents",
                            F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")

    def documents(tokens: str, documents: str, base: int):
        tokens = TokenFile(folder, tokens)
        fs, path = file_system(folder)
        with fs.open_input_file(f"{path}/{documents}") as source:
            reader = pa.ipc.open_file(source)
            for k in range(reader.num_record_batches):
                whole = reader.get_batch(k)
                for a in range(0, whole.num_rows, _OUT):
                    part = whole.slice(a, _OUT)
                    crc, ids, held, done = [], [], 0, 0
                    for i, (start, n) in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist())):
                        c, views = 0, list(tokens.ids(start, n))
                        for v in views:
                            c = zlib.crc32(v.astype("<u4"), c)
                        crc.append(c)
                        held += 4 * n if with_ids else 0
                        if with_ids:
                            ids.append(b"".join(v.astype("<u4").tobytes() for v in views))
                        if held > 8 << 20 or i + 1 == part.num_rows:
                            m = i + 1 - done
                            out = [part.column(0).slice(done, m),
                                   pa.array(part.column(1).slice(done, m).to_numpy() + base), part.column(2).slice(done, m),
                                   pa.array(crc, pa.int64()), *([pa.array(ids, pa.binary())] if with_ids else [])]
                            yield pa.RecordBatch.from_arrays(
                                out, ["doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])])
                            crc, ids, held, done = [], [], 0, i + 1
        tokens.close()

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                yield from documents(row["tokens"], row["documents"], row["base"])

    return shipped(files).select("tokens", "documents", "base").repartition(max(1, manifest.count())).mapInArrow(run, schema)


def read_sequences(manifest: DataFrame, folder: str) -> DataFrame:
    """(part, sequence, ids array<long>, mask array<boolean>): all sequences, numbered within their file."""
    def run(batches):
        for b in batches:
            for part, name in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                f = TokenFile(folder, name)
                for k in range(f.reader.num_record_batches):
                    got = f.reader.get_batch(k)
                    n = got.num_rows
                    at = pa.array(np.arange(0, (n + 1) * f.length, f.length, dtype=np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part] * n, pa.int32()), pa.array(np.arange(n) + k * BATCH, pa.int64()),
                         pa.ListArray.from_arrays(at, got.column(0).flatten().cast(pa.int64())),
                         pa.ListArray.from_arrays(at, got.column(1).flatten())],
                        ["part", "sequence", "ids", "mask"])
                f.close()

    return shipped(manifest).select("part", "tokens").repartition(max(1, manifest.count())) \
        .mapInArrow(run, "part int, sequence long, ids array<long>, mask array<boolean>")
