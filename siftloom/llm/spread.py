"""Joins whose hot keys are dealt over many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys that are salted, the heaviest; any other key holds less than a thousandth of the rows. One salt per so many rows.
HOT_KEYS, ROWS_PER_SALT = 1_000, 20_000


def spread_join(rows: DataFrame, side: DataFrame, key: str, by: Column, counts: DataFrame) -> DataFrame:
    """``rows`` left join ``side``, which has one row per ``key``; ``counts`` has ``key`` and ``n``, the rows of each key.

    The rows of a heavy key are dealt over salts by a hash of ``by``, and its side row is repeated per salt, so that a
    key with a third of all rows costs each task no more than ``ROWS_PER_SALT`` or so. Both lists are read more than
    once and should be stored.
    """
    hot = counts.where(F.col("n") > ROWS_PER_SALT).orderBy(F.desc("n"), key).limit(HOT_KEYS).select(
        key, F.ceil(F.col("n") / ROWS_PER_SALT).cast("int").alias("__salts"))
    salt = F.coalesce(F.pmod(F.xxhash64(by), F.col("__salts")).cast("int"), F.lit(0))
    dealt = rows.join(F.broadcast(hot), key, "left").withColumn("__salt", salt).drop("__salts")
    copies = side.join(F.broadcast(hot), key, "left").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1))).drop("__salts")
    return dealt.join(copies, [key, "__salt"], "left").drop("__salt")
