"""Spark session and checkpoint-directory helpers."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Defaults that matter for every plan in this package.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, *, shuffle_partitions: int | None = None,
              app_name: str = "msgsift", extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the plan defaults above.

    Master, memory and shuffle partitions are left to the cluster's own configuration unless they
    are passed here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must be provided (a shared filesystem path). Only in
    local mode, when it is unset, a fresh scratch folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative jobs")
    path = tempfile.mkdtemp(prefix="msgsift-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder, for tables that outlive one job."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on the executors, once per application.

    The sources go as one zip through the shared checkpoint folder to ``addPyFile``, so Python
    tasks work wherever the driver was started and whatever ``PYTHONPATH`` the executors have.
    """
    sc = spark.sparkContext
    root = os.path.dirname(os.path.abspath(__file__))
    if sc.applicationId in _shipped or not os.path.isdir(root):
        return
    blob = io.BytesIO()
    with zipfile.ZipFile(blob, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join(os.path.basename(root), os.path.relpath(full, root)))
    path = f"{checkpoint_dir(spark).rstrip('/')}/{os.path.basename(root)}-{sc.applicationId}.zip"
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(blob.getvalue()))
    out.close()
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


#: Spark removes the shuffle files of a finished query at once, not when the driver collects its garbage; and
#: Python workers get small batches (64 MB by default, held by the executor and the worker, for each core).
_FREED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Tables built and read to their end in here leave no shuffle files behind. Not for iterators, which go on reading."""
    before = {k: spark.conf.get(k) for k in _FREED}
    for k, v in _FREED.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def cut_lineage(df):
    """Reliable checkpoint into the shared checkpoint folder (never localCheckpoint)."""
    checkpoint_dir(df.sparkSession)
    with shuffles_freed(df.sparkSession):
        return df.select("*").checkpoint(eager=True)


def on_files(df, name: str, folder: str | None = None):
    """The table written once to the shared checkpoint folder (or to ``folder`` in it), as compressed columns.
    Smaller than ``cut_lineage`` for texts and arrays; column names must differ."""
    path = f"{folder}/{name}" if folder else scratch_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of ``scratch_path`` whose tables nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
