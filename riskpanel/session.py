"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(largest_shuffle_bytes: int | None = None) -> dict:
    """Settings for a large cluster (pass as ``extra`` to ``get_session``).

    Shuffle partitions are sized to about 128 MB of the largest expected
    shuffle (AQE coalesces small ones at run time); file splits are 128 MB; the
    streaming de-duplication state lives in RocksDB instead of the JVM heap."""
    conf = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.files.maxPartitionBytes": "128m",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    if largest_shuffle_bytes:
        conf["spark.sql.shuffle.partitions"] = str(max(200, -(-int(largest_shuffle_bytes) // (128 << 20))))
    return conf


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "riskpanel", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster the operator of the cluster sets it to shared storage and it
    is only read here. Where it is unset (local tests) a folder is made once
    and registered, so later calls reuse it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder on shared storage "
                               "(a machine-local folder does not survive a lost executor)")
        conf_dir = tempfile.mkdtemp(prefix="riskpanel-ckpt-")  # local mode only: one machine
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the shared checkpoint folder for a written table
    (named by a UUID: drivers that share the folder never meet)."""
    base = checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    folder = os.path.join(base, "tables", uuid.uuid4().hex)
    # the folder goes when the driver's file system closes (it must be there to be marked)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    fs.deleteOnExit(target)
    return os.path.join(folder, name)


def ship_package(spark: SparkSession) -> None:
    """Once per Spark context, send the package's sources to the executors, as
    ``--py-files`` would: functions that run in tasks are imported from them."""
    sc = spark.sparkContext
    if any(os.path.basename(x) == "riskpanel-src.zip" for x in sc._python_includes):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="riskpanel-src-"), "riskpanel-src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("riskpanel", os.path.relpath(full, root)))
    sc.addPyFile(path)
