"""Secret scans over an incremental blob ledger.

Every version of every path is addressed by the SHA-256 of its content. A ledger, a Parquet table that grows by one
append per run, holds a row per scanned blob: which rules, in which versions, were run over it and what they found. A
run reads the texts of such blobs only that lack a wanted pair of blob and rule version, each from one of its paths,
and joins the ledger's findings back to all paths.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftloom.llm.spread import spread_join
from siftloom.llm.store import map_arrow, shared_folder, stored
from siftloom.llm.words import blocks


@dataclass(frozen=True)
class Rule:
    """Leftmost, non-overlapping matches of ``pattern`` (ASCII classes) whose ``group`` has ``least`` characters or more.

    A changed rule needs a new ``version``; blobs that were scanned with the old one are then scanned again.
    """

    kind: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 0

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: The kinds that every scan reports, in their order.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, least=6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Keys whose makers give them a form of their own.
MORE = (
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
)
RULES = BASE + MORE

_FOUND = "array<struct<rule:string,version:int,first:int,last:int>>"
LEDGER = f"blob binary, scanned array<string>, found {_FOUND}"


def blob_id(text: Column) -> Column:
    """Content address: SHA-256 of the UTF-8 bytes; a null text is an empty one."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def spans(text: str, rules: list[tuple[Rule, re.Pattern]]) -> list[tuple[str, int, int, int]]:
    """Findings of the rules as rule, version, start and end in code points, end exclusive."""
    return [(r.kind, r.version, m.start(), m.end()) for r, pattern in rules for m in pattern.finditer(text)
            if m.end(r.group) - m.start(r.group) >= r.least]


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All rows of a ledger, none where it does not exist yet; a blob has one row per run that scanned it."""
    try:
        return spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], LEDGER)


def _scan_texts(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``blob, text, todo`` to ledger rows; a blob that a task meets again is passed over."""
    pairs = [(r, r.pattern) for r in rules]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = {r.name: (r, re.compile(pattern, re.ASCII)) for r, pattern in pairs}
        kind, done = pa.list_(pa.struct([("rule", pa.string()), ("version", pa.int32()), ("first", pa.int32()), ("last", pa.int32())])), set()
        for part, _, _ in blocks(batches, "text"):
            out = []
            for blob, text, todo in zip(*(part.column(c).to_pylist() for c in ("blob", "text", "todo"))):
                if blob not in done:
                    done.add(blob)
                    found = spans(text, [compiled[name] for name in todo])
                    out.append((blob, todo, [dict(zip(("rule", "version", "first", "last"), f)) for f in found]))
            if out:
                blob, todo, found = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(blob, pa.binary()), pa.array(todo, pa.list_(pa.string())), pa.array(found, kind)],
                                                 ["blob", "scanned", "found"])

    return map_arrow(texts.select("blob", "text", "todo"), run, LEDGER)


def scan(versions: DataFrame, path: list[str], ledger: str | None = None, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """One row per version: ``path`` (a struct of the columns named, which say path and version), ``blob`` and ``found``.

    ``found`` lists the findings of ``rules`` (``first``, ``order`` of the rule, ``last``, ``rule``), by start, then in
    the rules' order. ``ledger`` is the folder of the ledger, to which this run appends one commit; without one the run
    has a ledger of its own. Null texts are empty ones. Rows of one content share its findings, whatever their paths;
    repeated rows are repeated. Other columns take no part. An empty table scans nothing and gives no rows.
    """
    spark = versions.sparkSession
    ledger = ledger or shared_folder(spark)
    keys = [F.col(f"`{c}`") for c in path]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    pick = F.xxhash64(*[k.cast("string") for k in keys])
    listed = stored(versions.select(F.struct(*keys).alias("path"), blob_id(body).alias("blob"), pick.alias("pick")))
    blobs = stored(listed.groupBy("blob").agg(F.count("*").alias("n"), F.min("pick").alias("pick")))

    wanted = F.array(*[F.lit(r.name) for r in rules])
    known = read_ledger(spark, ledger).groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("scanned"))).alias("scanned"))
    unseen = blobs.join(known, "blob", "left").select(
        "blob", "pick", F.array_except(wanted, F.coalesce("scanned", F.array().cast("array<string>"))).alias("todo")).where(F.size("todo") > 0)
    # A text moves once at most, and only to be scanned: rows of other paths meet no partner on (blob, pick).
    texts = versions.select(body.alias("text"), blob_id(body).alias("blob"), pick.alias("pick")).join(stored(unseen), ["blob", "pick"])
    _scan_texts(texts, rules).write.mode("append").parquet(ledger)

    current = read_ledger(spark, ledger).select("blob", F.filter("found", lambda f: F.concat_ws("@", f["rule"], f["version"]).isin(
        [r.name for r in rules])).alias("found")).where(F.size("found") > 0)
    order = F.array(*[F.lit(r.kind) for r in rules])
    ranked = F.transform("found", lambda f: F.struct(f["first"].alias("first"), (F.array_position(order, f["rule"]) - 1).cast("int").alias("order"),
                                                     f["last"].alias("last"), f["rule"].alias("rule")))
    by_blob = stored(current.select("blob", ranked.alias("found")).groupBy("blob").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("found")))).alias("found")))
    counts = blobs.join(by_blob, "blob", "left_semi").select("blob", "n")
    joined = spread_join(listed, by_blob, "blob", F.col("pick"), counts)
    nothing = F.array().cast(by_blob.schema["found"].dataType)
    return joined.select("path", "blob", F.coalesce("found", nothing).alias("found"))
