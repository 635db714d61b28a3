"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskpanel.session import checkpoint_dir

#: Text separators of words: space and the ASCII controls tab to carriage return.
SPACES = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(name: str, columns: list[str]) -> str:
    """``name``, lengthened until no column has it."""
    while name in columns:
        name += "_"
    return name


def shipped(df: DataFrame) -> DataFrame:
    """``df``, after making sure that Python workers can import this package.

    Once per Spark context the package's sources go to the executors as a zip
    file, as ``--py-files`` would send them.
    """
    sc = df.sparkSession.sparkContext
    if not any(os.path.basename(x) == "riskpanel-src.zip" for x in sc._python_includes):
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="riskpanel-src-"), "riskpanel-src.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(root):
                for n in names:
                    if n.endswith(".py"):
                        full = os.path.join(folder, n)
                        z.write(full, os.path.join("riskpanel", os.path.relpath(full, root)))
        sc.addPyFile(path)
    return df


def give_back() -> None:
    """Return this process's freed memory to the system.

    For tasks with large arrays: Spark reuses Python workers and keeps idle
    ones, which else hold the most that any earlier task took.
    """
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """Make a folder (named by a UUID) under the shared checkpoint folder; it goes when the driver's file system closes."""
    path = f"{checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    fs.deleteOnExit(target)  # a folder must be there to be marked
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Cuts the lineage at files that outlive a lost executor. The folder has a
    name of its own (UUID) and goes when the driver's file system closes.
    """
    path = scratch_folder(df.sparkSession, name) + "/table"
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def stable_rows(docs: DataFrame) -> DataFrame:
    """``docs`` with a row key (__file, __row) that every scan gives alike.

    A Parquet table's rows are named by file and position; anything else is
    written to such a table first.
    """
    def keyed(df):
        return df.select("*", F.xxhash64("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))

    base = docs.drop("__file", "__row")
    try:
        return keyed(base)
    except AnalysisException:  # not a scan: no file, no position
        return keyed(written(base, "stable-rows"))


def fold(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5 (null id: null)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % 5


def is_held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for the held-out fold (remainder 0); a null id is not held out."""
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


def parallelism(df: DataFrame) -> int:
    """Shuffle partitions of the session: the least number of groups worth making."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, key: str, order: list[str], out: str, rows_per_bucket: int = 50_000) -> DataFrame:
    """Add ``out``: the row's position within its ``key``, gapless from 0.

    A key may hold any share of the rows: rows are ranked inside hash buckets
    of a key, and a small table of bucket sizes gives each bucket its start.
    Equal rows get positions in some order among themselves.
    """
    buckets = max(2 * parallelism(df), -(-df.count() // rows_per_bucket))
    b = df.withColumn("__b", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    before = Window.partitionBy(key).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = (b.groupBy(key, "__b").agg(F.count(F.lit(1)).alias("__n"))
              .select(F.col(key).alias("__k"), F.col("__b").alias("__b2"),
                      F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")))
    local = F.row_number().over(Window.partitionBy(key, "__b").orderBy(*order)) - 1
    ranked = b.withColumn("__r", local.cast("long"))
    return (ranked.join(starts, (F.col(key).eqNullSafe(F.col("__k"))) & (F.col("__b") == F.col("__b2")), "left")
            .withColumn(out, F.col("__r") + F.col("__start"))
            .drop("__b", "__r", "__k", "__b2", "__start"))
