"""Session settings and shared scratch space."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings every job here expects. None of them fixes a partition
# count: adaptive execution sizes partitions from the data.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # What cannot be read or stored is an error, never a silent NULL.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.storeAssignmentPolicy": "ANSI",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # HotSpot never compiles methods beyond 8000 bytes. A projection of many
    # columns that grows past that must give up whole-stage code, which is one
    # such method, for code in small pieces; it ran three times faster so.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


@contextmanager
def shuffles_into(spark: SparkSession, parts: int) -> Iterator[None]:
    """Let shuffles have at least so many parts, which adaptive execution joins again.

    It never cuts a part without skew, so a job over much data says how many it needs.
    """
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(name, None)
    usual = int(before or spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set(name, str(max(parts, usual)))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Free the shuffle files of a job when it ends, not when the driver collects its garbage.

    For jobs that write a result in rounds, each of which would leave its own.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="landfall-")


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach.

    Named by ``spark.checkpoint.dir`` or by the context's checkpoint directory.
    Only a session within one machine may do without; any other stops here, as
    its executors would write to disks of their own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError(
            "no shared folder: set spark.checkpoint.dir to one that all executors reach"
        )
    return _local_root()


@functools.cache
def _run_folder(spark: SparkSession) -> str:
    path = f"{shared_root(spark)}/landfall-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    filesystem = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    filesystem.mkdirs(jvm_path)
    filesystem.deleteOnExit(jvm_path)
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder, deleted when the session's JVM ends."""
    return f"{_run_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there, on whatever storage it lies."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, on whatever storage."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files below a folder, on whatever storage."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(jvm_path).getLength()


@contextmanager
def scratch_folder(spark: SparkSession, label: str) -> Iterator[str]:
    """A folder for the stages of one job, deleted when the job ends."""
    path = scratch_path(spark, label)
    try:
        yield path
    finally:
        delete_path(spark, path)


def materialize(spark: SparkSession, df, label: str, folder: str | None = None, options: dict | None = None):
    """Write a frame to the shared folder and read it back.

    Cuts lineage so that consumers of a shared result do not recompute it, and
    keeps the result when executors are lost, unlike cached blocks. ``folder``
    is one of ``scratch_folder``, which says when it goes; ``options`` are the
    writer's.
    """
    path = f"{folder}/{label}" if folder else scratch_path(spark, label)
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
