"""Tables kept in the folder that driver and executors share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Cells (rows of a few numbers, or list entries) of a stored table that may be broadcast: some 60 MB at most.
BROADCAST_ROWS = 1_000_000


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder, as driver and executors are one process there;
    on a cluster a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.gettempdir()
    return f"{base.rstrip('/')}/siftloom-llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The same rows from Parquet in the shared folder: cuts the lineage and outlives lost executors."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS, cells: Column | None = None) -> DataFrame:
    """Mark a stored table for broadcast if it is counted to be small; larger ones are joined by shuffling.

    ``cells`` is what a row counts for, where rows hold lists.
    """
    size = df.agg(F.coalesce(F.sum(F.lit(1) if cells is None else cells), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= rows else df


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` with this package sent along, so that executors need not have it installed."""
    context = df.sparkSession.sparkContext
    if getattr(context, "_siftloom_sent", None) is None:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="siftloom-"), "siftloom.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
            for folder, _, names in os.walk(package):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        archive.write(full, os.path.relpath(full, os.path.dirname(package)))
        context.addPyFile(path)
        context._siftloom_sent = path
    return df.mapInArrow(function, schema)
