"""Session defaults, the shared working folder, and lineage cutting."""

from __future__ import annotations

import atexit
import gc
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app_name: str = "sparrowmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this library is tuned for.

    Nothing here caps cluster resources: executor sizing and
    ``spark.sql.shuffle.partitions`` stay with the submit command, and AQE
    coalesces small partitions at run time.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master is not None:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    A machine-local folder is created only for a local master, where driver and
    executors are one process; on a cluster the setting is required.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        folder = configured
    else:
        folder = spark.sparkContext.getCheckpointDir()
        if folder is None:
            if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
                raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
            folder = tempfile.mkdtemp(prefix="sparrowmill-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    # The folder inside it that holds this application's checkpoints, and no other's.
    files, place = _file_system(spark, spark.sparkContext.getCheckpointDir())
    files.deleteOnExit(place)
    return folder


def _file_system(spark: SparkSession, path: str) -> tuple:
    """The store of ``path`` and the path in it, whatever store that is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for a table handed to a later stage.

    What lies there when the application ends is deleted then.
    """
    path = f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    files, place = _file_system(spark, path)
    files.deleteOnExit(place.getParent())
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder in whatever store it lies; one that is not there is left alone."""
    files, place = _file_system(spark, path)
    files.delete(place, True)


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A path for a table that is written and read inside the block, and deleted with it, on failure too.

    What is returned from the block must not read the path any more: pass it
    through ``cut_lineage``, whose files Spark deletes once nobody refers to them.
    """
    path = scratch_path(spark, name)
    try:
        yield path
    finally:
        drop_path(spark, path)


@contextmanager
def _held(spark: SparkSession, name: str, value: int) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shuffled_into(spark: SparkSession, partitions: int):
    """Shuffles planned inside the block have that many partitions."""
    return _held(spark, "spark.sql.shuffle.partitions", partitions)


def listed_by(spark: SparkSession, tasks: int):
    """Folders opened inside the block are listed by that many tasks, not by one for each."""
    return _held(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", tasks)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder; later stages start from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Has shuffles and checkpoints deleted that nothing refers to any more.

    Spark deletes them once the driver's memory has been collected, which by itself
    comes far too late for the disks of a job of many steps.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def settled(df: DataFrame) -> DataFrame:
    """``cut_lineage``, after which the shuffles that led to it go, unless something else refers to them."""
    out = cut_lineage(df)
    del df
    release(out.sparkSession)
    return out
