"""Row identity: a dense ``1..n`` number in input order, without a global sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import named
from .scratch import new_folder


def pin(df: DataFrame, by: str | None = None) -> DataFrame:
    """Write a table once to the shared folder and go on from that copy.

    For tables that are costly to compute and read several times, or whose rows
    may come out in another order when computed again. The copy is Parquet, so
    later passes still read only the columns they need, and it outlives executors;
    ``by`` names a column of few values to lay it out by.
    """
    target = new_folder(df.sparkSession)
    (df.write.partitionBy(by) if by else df.write).parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)


def number_placed(df: DataFrame, name: str = "row_number", file: str = "file", start: str = "start", at: str = "at") -> DataFrame:
    """Replace the place of each row (file, piece of the file, order in the piece) by a dense row number in that order.

    Rows are ranked within their piece, which is bounded, and pieces are counted; nothing is sorted as a whole or copied.
    """
    columns = [c for c in df.columns if c not in (file, start, at)]
    pieces = df.groupBy(file, start).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy(file, start).rowsBetween(Window.unboundedPreceding, -1))
    offsets = pieces.select(named(file).alias("__f"), named(start).alias("__s"), F.coalesce(before, F.lit(0)).alias("__before"))
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(file, start).orderBy(at)))
    met = ranked.join(F.broadcast(offsets), (named(file) == F.col("__f")) & (named(start) == F.col("__s")))
    return met.select((F.col("__before") + F.col("__rank")).alias(name), *[named(c) for c in columns])


def number_rows(df: DataFrame, name: str = "row_number", from_files: bool = True) -> DataFrame:
    """Add a dense row number in input order (file path, position in the file).

    Two narrow passes: rows are counted per file piece, the counts add up to one
    offset per piece, and the offsets go back to the rows. A table that does not
    come straight from files is pinned first.
    """
    df = df if from_files else pin(df)
    columns = df.columns
    placed = df.select(
        "*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__start"),
        F.monotonically_increasing_id().alias("__at"))
    pieces = placed.groupBy("__file", "__start").agg(F.count("*").alias("n"), F.min("__at").alias("__first"))
    before = F.sum("n").over(Window.orderBy("__file", "__start").rowsBetween(Window.unboundedPreceding, -1))
    # A piece is known by a hash: 24 bytes for each 128 MB of the table, so this is always small enough to broadcast.
    piece = F.xxhash64("__file", "__start")
    offsets = pieces.select(piece.alias("__piece"), (F.coalesce(before, F.lit(0)) - F.col("__first") + 1).alias("__shift"))
    twice = F.count("*").over(Window.partitionBy("__piece")) > 1
    offsets = offsets.select("__piece", F.when(twice, F.raise_error("two file pieces share a hash").cast("bigint"))
                             .otherwise(F.col("__shift")).alias("__shift"))
    numbered = placed.withColumn("__piece", piece).join(F.broadcast(offsets), "__piece")
    return numbered.select((F.col("__shift") + F.col("__at")).alias(name), *[named(c) for c in columns])
