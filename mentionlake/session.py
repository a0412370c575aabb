"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

Save = Callable[[DataFrame, str], DataFrame]

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Partition values such as 05-01-2024 or 2024 stay strings.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def cluster_settings(cores: int) -> dict[str, str]:
    """Settings for many executors: shuffles start wide, adaptive execution merges.

    With 128 MB as the aim of a shuffle partition the number is only an upper bound.
    """
    return {
        "spark.sql.shuffle.partitions": str(max(200, 4 * cores)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.files.maxPartitionBytes": "256MB",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    }


def get_spark(app_name: str = "mentionlake", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def bundle() -> str:
    """A zip of this package, in a folder of its own."""
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="mentionlake-ship-"), "mentionlake.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as bundle:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    bundle.write(file, os.path.relpath(file, os.path.dirname(root)))
    return path


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of the session, once per application.

    Functions that run in workers are pickled by reference, so an executor must be
    able to import the package, wherever the driver was started.
    """
    context = spark.sparkContext
    if getattr(context, "_mentionlake_shipped", False):
        return
    path = bundle()
    context.addPyFile(path)
    context._mentionlake_shipped = True


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A folder of this machine is used only in local mode, where driver and
    executors share one file system.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_root()
    raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="mentionlake-")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/mentionlake/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a result must not be computed twice (a paid scorer) or must not
    depend on files that the same job is about to replace. Unlike a cache it
    survives the loss of executors.
    """
    spark = df.sparkSession
    path = f"{folder}/{label}" if folder else scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession, label: str) -> Iterator[Save]:
    """``materialise`` into one folder, which is removed when the job is over."""
    folder = scratch_path(spark, label)
    try:
        yield lambda df, name: materialise(df, name, folder)
    finally:
        delete_folder(spark, folder)


BATCH_BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def batches_of(spark: SparkSession, size: int) -> Iterator[None]:
    """Python tasks of jobs that run meanwhile are sent about ``size`` bytes at once, or one larger row.

    By default it is 10 000 rows, of up to 64 MB together. The JVM holds a batch several times over outside its heap, as it
    grows the buffers by doubling, and keeps much of that room later on.
    """
    before = spark.conf.get(BATCH_BYTES_SETTING, None)
    spark.conf.set(BATCH_BYTES_SETTING, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_BYTES_SETTING)
        else:
            spark.conf.set(BATCH_BYTES_SETTING, before)


def path_exists(spark: SparkSession, name: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def delete_folder(spark: SparkSession, folder: str, keep_if_contains: str | None = None) -> None:
    """Remove a folder of this package, or only the files right in it if it holds another that must stay."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return
    inside = keep_if_contains is not None and _plain(keep_if_contains).startswith(_plain(folder) + "/")
    if not inside:
        files.delete(path, True)
        return
    for found in files.listStatus(path):
        if not _plain(keep_if_contains).startswith(_plain(found.getPath().toString())):
            files.delete(found.getPath(), True)


def _plain(path: str) -> str:
    return path.removeprefix("file:").replace("///", "/").replace("//", "/").rstrip("/")
