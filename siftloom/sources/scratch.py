"""Folders for intermediate tables, which driver and executors share, and their removal."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_MADE: list[str] = []
_LOCAL: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary one, as driver and executors are one process there; it goes
    when the process ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if not _LOCAL:
            folder = tempfile.mkdtemp(prefix="siftloom-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
            _LOCAL.append("file://" + folder)
        folder = _LOCAL[0]
    return folder.rstrip("/")


def new_folder(spark: SparkSession, prefix: str = "siftloom") -> str:
    """A folder name below the shared folder that nothing has yet; ``remove_scratch`` knows it."""
    _MADE.append(f"{shared_folder(spark)}/{prefix}-{uuid.uuid4().hex}")
    return _MADE[-1]


def remove_scratch(spark: SparkSession) -> int:
    """Remove the folders that this process got from ``new_folder``; tables that are read from them are gone then.

    The number of folders removed. To be called when a run's results are written.
    """
    removed = 0
    while _MADE:
        path = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        removed += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return removed
