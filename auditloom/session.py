"""Intermediate tables, written to storage that outlives an executor."""

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# folders this process made for local sessions that name none
_own_folders: dict[str, str] = {}


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def work_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables of this application.

    It lies in the folder the cluster names in spark.checkpoint.dir and is deleted
    when the driver ends. Only a single-JVM session without that setting gets a folder
    of its own; on a cluster a machine-local folder could not be read by the others.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        if context.applicationId not in _own_folders:
            folder = tempfile.mkdtemp(prefix="auditloom-work-")
            _own_folders[context.applicationId] = folder
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        base = "file://" + _own_folders[context.applicationId]
    folder = f"{base.rstrip('/')}/auditloom-{context.applicationId}"
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


# shuffle files of a query go when it ends, not when the driver's garbage is collected
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _without_left_shuffles(spark: SparkSession):
    before = spark.conf.get(_SHUFFLES_GO, None)
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLES_GO)
        else:
            spark.conf.set(_SHUFFLES_GO, before)


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet and read it from there, columns and filters pruned.

    Nothing of its shuffles stays on the executors' disks.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark)}/{uuid.uuid4().hex}"
    with _without_left_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete what ``materialise`` has written for ``tables``, which nothing may read any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        own = path(work_folder(spark)).toUri().getPath()
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
            if path(folder).getParent().toUri().getPath() == own:
                files = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
                files.delete(path(folder), True)
