"""Reading raw tables and writing cleaned tables, samples and result bundles."""

from __future__ import annotations

import csv
import io
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.text import is_present, named, sanitise
from ..operators.roles import text_columns
from ..operators.scale import first_rows
from ..settings import DEFAULT, Settings
from .identity import number_placed, number_rows
from .quoted_csv import PLAIN, QUOTED, RETURNS, physical_lines, records, survey


class InputError(ValueError):
    """The input is missing or has no rows or columns."""


#: Where the text of records with more fields than their header has is kept.
OVERFLOW = "_overflow"


# Where a row of a CSV file comes from.
_PLACE = ("__csv_file", "__csv_start", "__csv_at")
_OPTIONS = {"quote": '"', "escape": '"', "nullValue": "NA", "mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true",
            "maxCharsPerColumn": "-1"}


def header_names(text: str, overflow: str = OVERFLOW) -> list[str]:
    """Column names of a header record: trimmed, nameless ones by their place (``V2``), repeated ones numbered (``x_2``)."""
    found: list[str] = []
    taken = {overflow.lower()}
    for i, name in enumerate(next(csv.reader(io.StringIO(text.lstrip("\ufeff"), newline=""))), 1):
        name = base = name.strip() or f"V{i}"
        k = 1
        while name.lower() in taken:
            k += 1
            name = f"{base}_{k}"
        taken.add(name.lower())
        found.append(name)
    return found


def _groups(spark: SparkSession, path: str, columns: list[str] | None, multi_line: bool, overflow: str) -> list[tuple[list[str], str, bool, list[str]]]:
    """Files by column names, kind, and whether their lines end with a carriage return too; one pass over the text finds all."""
    files = survey(physical_lines(spark, path)).where("header IS NOT NULL")
    if not multi_line:
        files = files.withColumn("kind", F.lit(PLAIN))
    groups = files.groupBy("kind", "header", "header_open").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("files").collect()
    found: dict[tuple, list[str]] = {}
    for g in groups:
        if columns:
            texts = {f: None for f in g.files}
        elif g.header_open and g.kind == QUOTED:
            texts = {r.file: r.record for r in records(spark, list(g.files)).where("header").select("file", "record").collect()}
        else:
            # The lines of an old file that ends them with carriage returns alone are one for the survey.
            texts = {f: g.header.split("\r")[0] if g.kind == RETURNS else g.header.rstrip("\r") for f in g.files}
        for file, text in texts.items():
            names = columns or header_names(text, overflow)
            found.setdefault((tuple(names), g.kind, g.header.endswith("\r")), []).append(file)
    return [(list(names), kind, crlf, sorted(files)) for (names, kind, crlf), files in sorted(found.items(), key=lambda kv: min(kv[1]))]


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None, multi_line: bool = True,
             overflow: str = OVERFLOW, one_task: bool = False) -> DataFrame:
    """Every field as text by the name in its own file's header: UTF-8, double quotes, short rows padded with NULL.

    Files may list their columns in any order, and a column that a file lacks is NULL there. Records with more fields
    than their header keep these fields as named, and the whole record's text in ``overflow``; nothing is cut.
    ``columns`` gives the names instead of the headers, which are then skipped. The word NA is NULL. Blank lines are
    skipped, also ahead of the header; nameless and repeated names of a header are numbered.

    One pass over the text finds headers and files with line ends inside quotes. Such files are split and put together
    again by ``quoted_csv``; all others go through Spark's reader, split as well. ``multi_line=False`` says that no field
    holds a line end. ``one_task`` reads each file as a whole in one task instead, for comparison.
    """
    parts = _csv_parts(spark, path, columns, multi_line, overflow, one_task)
    return _together(spark, [p for p, _ in parts], overflow)


def _csv_parts(spark: SparkSession, path: str, columns: list[str] | None = None, multi_line: bool = True, overflow: str = OVERFLOW,
               one_task: bool = False) -> list[tuple[DataFrame, bool]]:
    """A table per group of files, and whether Spark's reader reads it; others have the place of their rows."""
    try:
        groups = _groups(spark, path, columns, multi_line, overflow)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise InputError(f"raw data file not found: {path}") from error
        raise
    return [(_read_quoted(spark, names, files, crlf, overflow), False) if kind == QUOTED and not one_task
            else (_read_files(spark, names, files, one_task or kind == RETURNS, overflow), True) for names, kind, crlf, files in groups]


def _together(spark: SparkSession, parts: list[DataFrame], overflow: str, keep: tuple[str, ...] = ()) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], f"`{overflow}` string")
    table = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return table.select(*[named(c) for c in table.columns if c not in (overflow, *_PLACE)], named(overflow), *keep)


def _read_files(spark: SparkSession, names: list[str], files: list[str], multi_line: bool, overflow: str) -> DataFrame:
    fields = [T.StructField(c, T.StringType()) for c in names]
    raw = (spark.read.options(**_OPTIONS).option("header", True).option("multiLine", multi_line).option("encoding", "UTF-8")
           .option("enforceSchema", True).option("columnNameOfCorruptRecord", overflow)
           .schema(T.StructType([*fields, T.StructField(overflow, T.StringType())])).csv(files))
    # A record of another length than the header comes with its text; it is short unless it has one field more.
    wider = ", ".join(f"c{i} string" for i in range(len(names) + 1))
    surplus = F.from_csv(F.rtrim(named(overflow), F.lit(" \t\r\n")), wider, {**_OPTIONS, "multiLine": "true"})[f"c{len(names)}"].isNotNull()
    return raw.withColumn(overflow, F.when(surplus, named(overflow)))


def _read_quoted(spark: SparkSession, names: list[str], files: list[str], crlf: bool, overflow: str) -> DataFrame:
    # As Spark's reader does: the file's line end becomes a line feed inside fields, and blanks behind the last field go.
    text = F.rtrim(F.replace("record", F.lit("\r\n"), F.lit("\n")) if crlf else F.col("record"), F.lit(" \t"))
    wider = ", ".join(f"c{i} string" for i in range(len(names) + 1))
    parsed = records(spark, files).where("NOT header").withColumn("fields", F.from_csv(text, wider, {**_OPTIONS, "multiLine": "true"}))
    surplus = F.col("fields")[f"c{len(names)}"].isNotNull()
    return parsed.select(*[F.col("fields")[f"c{i}"].alias(c) for i, c in enumerate(names)], F.when(surplus, F.col("record")).alias(overflow),
                         *[F.col(c).alias(p) for c, p in zip(("file", "start", "at"), _PLACE)])


def _numbered_parts(spark: SparkSession, parts: list[tuple[DataFrame, bool]], name: str, overflow: str) -> DataFrame:
    """All rows, numbered in the order of files and places in them."""
    if len(parts) == 1 and parts[0][1]:
        return number_rows(_together(spark, [parts[0][0]], overflow), name)
    placed = [p.select("*", F.col("_metadata.file_path").alias(_PLACE[0]), F.col("_metadata.file_block_start").alias(_PLACE[1]),
                       F.monotonically_increasing_id().alias(_PLACE[2])) if native else p for p, native in parts]
    return number_placed(_together(spark, placed, overflow, _PLACE), name, *_PLACE)


def overflow_count(df: DataFrame, overflow: str = OVERFLOW) -> DataFrame:
    """One row, ``records``: how many records of a landed table had more fields than their header."""
    return df.agg(F.count(named(overflow)).alias("records"))


# Types a text column may turn out to have, in this order: name, and when a text is of that type.
_KINDS = (
    ("bigint", lambda c: c.rlike(r"^[+-]?(0|[1-9][0-9]*)$") & c.try_cast("bigint").isNotNull()),
    ("double", lambda c: c.rlike(r"^[+-]?((0|[1-9][0-9]*)(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$") & c.try_cast("double").isNotNull()),
    ("boolean", lambda c: c.rlike("^(true|false|TRUE|FALSE|True|False|T|F)$")),
    ("date", lambda c: c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & c.try_cast("date").isNotNull()),
    ("timestamp_ntz", lambda c: c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}") & c.try_cast("timestamp_ntz").isNotNull()),
)


def infer_types(df: DataFrame) -> DataFrame:
    """Text columns as numbers, booleans, dates or times where all their present values are.

    One aggregate over all rows decides, no sample. Numbers with leading zeros stay texts; columns without values too.
    """
    texts = text_columns(df)
    if not texts:
        return df
    counts = df.agg(*[x for i, c in enumerate(texts) for x in (
        F.count_if(is_present(named(c))).alias(f"n{i}"),
        *[F.count_if(is_present(named(c)) & kind(named(c))).alias(f"k{i}_{j}") for j, (_, kind) in enumerate(_KINDS)])]).first()
    to = {c: next((name for j, (name, _) in enumerate(_KINDS) if counts[f"n{i}"] and counts[f"k{i}_{j}"] == counts[f"n{i}"]), "string")
          for i, c in enumerate(texts)}
    return df.select(*[named(c).try_cast(to[c]).alias(c) if to.get(c, "string") != "string" else named(c) for c in df.columns])


def validated(df: DataFrame) -> DataFrame:
    """The table itself, or an error when it has no columns or no rows."""
    if not df.columns:
        raise InputError("the data has no columns")
    if df.isEmpty():
        raise InputError("the data has no rows")
    return df


def land_csv(spark: SparkSession, source: str, target: str, cfg: Settings = DEFAULT, **options) -> DataFrame:
    """CSV to Parquet once, with row numbers; everything later reads the Parquet copy.

    Rows are numbered in file order, whatever headers the files have. The column of records with surplus fields is there if there are any.
    """
    overflow = options.get("overflow", OVERFLOW)
    parts = _csv_parts(spark, source, **options)
    validated(_together(spark, [p for p, _ in parts], overflow))
    _numbered_parts(spark, parts, cfg.row_id, overflow).write.mode("overwrite").parquet(target)
    landed = spark.read.parquet(target)
    return landed if overflow_count(landed, overflow).first().records else landed.drop(overflow)


def write_clean_csv(df: DataFrame, path: str) -> None:
    """CSV with header and NULL as an empty field, in as many files as the table has partitions."""
    (df.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "")
     .option("quote", '"').option("escape", '"').csv(path))


def write_clean(df: DataFrame, folder: str) -> None:
    """The cleaned table once as Parquet and, from that copy, as CSV."""
    df.write.mode("overwrite").parquet(f"{folder}/parquet")
    write_clean_csv(df.sparkSession.read.parquet(f"{folder}/parquet"), f"{folder}/csv")


def sanitised(df: DataFrame) -> DataFrame:
    """All text columns without control and other unprintable characters."""
    texts = set(text_columns(df))
    return df.select(*[sanitise(F.col(c)).alias(c) if c in texts else F.col(c) for c in df.columns])


def sample_extract(df: DataFrame, n: int | None = None, cfg: Settings = DEFAULT) -> DataFrame:
    """Rows with safe texts: the first ``n`` by row id, or all."""
    return sanitised(df if n is None else first_rows(df, n, cfg.row_id))


def write_bundle(tables: dict[str, DataFrame], folder: str) -> None:
    """One Parquet folder per named table, texts made safe."""
    for name, table in tables.items():
        sanitised(table).write.mode("overwrite").parquet(f"{folder}/{name}")


def read_bundle(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}
