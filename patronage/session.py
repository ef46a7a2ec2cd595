"""Session settings, the shared folder, and run folders that a job removes when it is done."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", app_name: str = "patronage") -> SparkSession:
    """Single-machine session for tests and benchmarks.

    The low broadcast threshold makes Spark plan joins of small test tables the way it plans
    the large ones they stand for.
    """
    partitions = "8" if cores == "*" else str(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.autoBroadcastJoinThreshold", "256k")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    There is no default: executors could not read each other's files in a folder of one machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return folder.rstrip("/")


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system that holds ``path``, and the path in its terms."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


@contextmanager
def run_folder(spark: SparkSession, base: str | None = None) -> Iterator[str]:
    """A fresh folder below ``base``, or the shared folder, for one job's intermediate tables.

    It is removed at the end, so whatever reads it must have been written by then.
    """
    folder = f"{(base or shared_dir(spark)).rstrip('/')}/patronage-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        system, path = file_system(spark, folder)
        system.delete(path, True)
