"""CSV files with line ends inside quotes, read by many tasks.

Whether a line end is real depends on whether a quoted field is open there, which depends on all lines before. Every
line is therefore taken as a function of that state: where it leaves a reader that comes to it outside of quotes, and
where one that comes to it inside. Such functions compose, so tasks take pieces of a file in any order: one pass gives
the function of each piece, their composition along the file gives the state at the start of each piece, and with that
the lines of every piece are put together to records on their own. Only a record that crosses a piece's border is left
for a last step, which sees at most two fragments per piece.

A quote opens a field only where a field begins; elsewhere it is a character like any other, as for Spark's own reader.
Everything is expressions over Spark's text source: no Python sees a row, and any store that Spark can read will do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .identity import pin

# A field after its pairs of quotes are gone: quoted and then anything up to the comma, or not beginning with a quote.
_FIELD = r'(?:[ \t]*+"[^"]*+"[^,]*+|(?![ \t]*+")[^,]*+)'
_FIELDS_THEN_OPEN = rf'(?:{_FIELD},)*+[ \t]*+"[^"]*+$'
# Outside, the line leaves a field open; inside, it closes none, or closes one and leaves another open. Quantifiers are
# possessive: no backtracking, and no recursion on long lines.
_OPENS = rf"(?s)^{_FIELDS_THEN_OPEN}"
_STAYS = rf'(?s)^[^"]*+(?:$|"[^,]*+,{_FIELDS_THEN_OPEN})'

PLAIN, QUOTED, RETURNS = "plain", "quoted", "returns"


def physical_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``value, file, start, at``: the lines of text files, cut at line feeds only; ``at`` orders the lines of a piece."""
    lines = spark.read.option("lineSep", "\n").text(paths)
    start = F.col("_metadata.file_block_start")
    value = F.when((start == 0) & F.startswith("value", F.lit("\ufeff")), F.substr("value", F.lit(2))).otherwise(F.col("value"))
    return lines.select(value.alias("value"), F.col("_metadata.file_path").alias("file"), start.alias("start"), F.monotonically_increasing_id().alias("at"))


def _after(line: Column) -> tuple[Column, Column]:
    """Whether a quoted field is open after a line: if none was before, and if one was. A pair of quotes changes nothing."""
    bare = F.when(line.contains('"'), F.replace(line, F.lit('""'), F.lit(""))).otherwise(F.lit(""))
    return bare.rlike(_OPENS), bare.rlike(_STAYS)


def _filled(name: str) -> Column:
    return F.trim(name, F.lit(" \t\r")) != ""


def survey(lines: DataFrame) -> DataFrame:
    """``file, kind, header, header_open``: one row per file from one pass.

    ``kind`` is PLAIN where line ends are always real, QUOTED where a field may hold one, RETURNS where carriage returns
    alone end the lines. ``header`` is the first line with anything in it.
    """
    opens, _ = _after(F.col("value"))
    filled = F.when(_filled("value"), F.struct("start", "at"))
    return lines.withColumn("opens", opens).withColumn("filled", filled).groupBy("file").agg(
        F.count("*").alias("n"), F.bool_or("opens").alias("opens"), F.bool_or(F.rtrim("value", F.lit("\r")).contains("\r")).alias("inner"),
        F.min_by("value", "filled").alias("header"), F.min_by("opens", "filled").alias("header_open")).select(
        "file", F.when((F.col("n") == 1) & F.col("inner"), RETURNS).when(F.col("opens") | F.col("inner"), QUOTED).otherwise(PLAIN).alias("kind"),
        "header", F.coalesce("header_open", F.lit(False)).alias("header_open"))


def _running(lines: DataFrame, window: Window) -> DataFrame:
    """Add ``turns``, the lines so far that swap the states, and ``mark``, the last line that leads to one state whatever came."""
    opens, stays = F.col("opens"), F.col("stays")
    turned = lines.withColumn("turns", F.count_if(opens & ~stays).over(window))
    fixed = F.when(opens == stays, F.struct("at", opens.alias("state"), "turns"))
    return turned.withColumn("mark", F.max(fixed).over(window))


def _state(mark: Column, turns: Column, before: Column) -> Column:
    """The state after the lines that ``mark`` and ``turns`` describe, if it was ``before`` ahead of them."""
    odd = (F.coalesce(turns, F.lit(0)) - F.coalesce(mark["turns"], F.lit(0))) % 2 == 1
    return F.coalesce(mark["state"], before) != odd


def open_pieces(lines: DataFrame) -> DataFrame:
    """``file, start, inside``: whether a quoted field is open where each piece of each file begins."""
    opens, stays = _after(F.col("value"))
    marked = lines.select("file", "start", "at", opens.alias("opens"), stays.alias("stays"))
    moving = marked.where(F.col("opens") | ~F.col("stays"))
    inner = Window.partitionBy("file", "start").orderBy("at")
    last = _running(moving, inner).groupBy("file", "start").agg(F.max_by(F.struct("turns", "mark"), "at").alias("piece"))
    pieces = lines.select("file", "start").groupBy("file", "start").agg(F.count("*").alias("n")).drop("n").join(last, ["file", "start"], "left")
    # A piece is a swap, a fixed state, or neither; pieces are few enough for one window per file.
    whole = F.col("piece")
    swaps = F.when(whole["mark"].isNull(), F.coalesce(whole["turns"] % 2 == 1, F.lit(False))).otherwise(False)
    ends = F.when(whole["mark"].isNotNull(), _state(whole["mark"], whole["turns"], F.lit(False)))
    along = Window.partitionBy("file").orderBy("start")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    turned = pieces.withColumn("turns", F.count_if(swaps).over(along)).withColumn("fixed", F.when(ends.isNotNull(), F.struct(
        F.col("start").alias("at"), ends.alias("state"), "turns")))
    return turned.select("file", "start", _state(F.max("fixed").over(before), F.max("turns").over(before), F.lit(False)).alias("inside"))


def records(spark: SparkSession, paths: str | list[str], pieces: DataFrame | None = None) -> DataFrame:
    """``record, header, file, start, at``: the records of CSV files with line ends inside quotes, whether they are their
    file's first, and their place.

    Records keep their text; a carriage return before a record's end goes. Lines without any text outside of quotes are
    no records. A field that no quote closes runs to the end of its file.
    """
    lines = physical_lines(spark, paths)
    pieces = pin(open_pieces(lines)) if pieces is None else pieces
    opens, stays = _after(F.col("value"))
    # A piece is known by a hash: 17 bytes for each 128 MB of input may be broadcast.
    known = F.broadcast(pieces.select(F.xxhash64("file", "start").alias("piece"), "inside"))
    placed = lines.withColumn("piece", F.xxhash64("file", "start")).join(known, "piece").drop("piece")
    window = Window.partitionBy("file", "start").orderBy("at")
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    run = _running(placed.withColumn("opens", opens).withColumn("stays", stays), window)
    inside = _state(F.max("mark").over(before), F.max("turns").over(before), F.col("inside"))
    joined = run.withColumn("within", inside).withColumn("open", _state(F.col("mark"), F.col("turns"), F.col("inside")))
    head = F.min(F.when(~F.col("within") & _filled("value"), F.col("at"))).over(Window.partitionBy("file", "start"))
    first = joined.withColumn("first", F.max(F.when(~F.col("within"), F.col("at"))).over(window)).withColumn("head", head)

    def text(part: str, order: list[str]) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col(part).alias("part")))), lambda x: x["part"]), "\n")

    grouped = first.groupBy("file", "start", "first").agg(text("value", ["at"]).alias("record"), F.max_by("open", "at").alias("open"), F.max("head").alias("head"))
    grouped = grouped.withColumn("header", F.coalesce((F.col("start") == 0) & (F.col("first") == F.col("head")), F.lit(False)))
    ready = grouped.where(F.col("first").isNotNull() & ~F.col("open"))
    # What crosses borders: the open end of a piece, pieces without a record's begin, and the head of the piece that closes it.
    rest = grouped.where(F.col("first").isNull() | F.col("open"))
    number = F.count("first").over(Window.partitionBy("file").orderBy("start", F.asc_nulls_first("first")))
    crossing = rest.withColumn("number", number).groupBy("file", "number").agg(
        F.min(F.when(F.col("first").isNotNull(), F.struct("start", "first"))).alias("place"), text("record", ["start"]).alias("record"),
        F.bool_or("header").alias("header"))
    both = ready.select("record", "header", "file", "start", F.col("first").alias("at")).unionByName(
        crossing.select("record", "header", "file", "place.start", F.col("place.first").alias("at")))
    return both.withColumn("record", F.regexp_replace("record", "\r$", "")).where(_filled("record"))
