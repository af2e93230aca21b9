"""Bounded samples of rows that models are fitted to.

Rows are taken by a hash threshold that follows from the number of rows, so nothing is sorted and no text is shuffled
to be dropped: what comes to the driver is about the sample, whatever the size of the table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftloom.llm.store import stored

#: UTF-8 bytes of the texts of a labelled sample, half of them for each label.
SAMPLE_BYTES = 64_000_000
#: Groups that a sample of texts is taken of, and texts of all of them together.
GROUPS, TEXTS = 256, 12_000


@dataclass
class Sample:
    """Texts with labels and languages, sorted, and how many rows each label has in all."""

    texts: list[str]
    labels: list
    langs: list[str | None]
    totals: dict


def below(hash_: Column, share: float) -> Column:
    """True for about ``share`` of the 64-bit hashes."""
    return F.lit(True) if share >= 1 else hash_ < F.lit(int(-(1 << 63) + share * (1 << 64)))


def by_group(rows: DataFrame, group: str, hash_: Column, sample: int) -> tuple[DataFrame, dict]:
    """About ``sample`` rows of each value of ``group`` (few values, not null) by hash; the number of rows of each."""
    totals = {r[0]: r[1] for r in rows.groupBy(group).count().collect()}
    keep = F.lit(False)
    for value, n in sorted(totals.items()):
        keep = keep | ((F.col(group) == F.lit(value)) & below(hash_, sample / n))
    return rows.where(keep), totals


def labelled_rows(documents: DataFrame, labels: DataFrame, column: str, sample: int, chars: int, seed: int = 7, max_bytes: int = SAMPLE_BYTES
                  ) -> tuple[DataFrame, dict]:
    """About ``sample`` documents of each label in ``labels[column]`` (0 or 1) whose texts have at most ``chars`` characters,
    as stored rows ``label, text, lang``, and how many rows each label has in all.

    An id's label counts once (the larger, if they differ), and so does its text (the smallest). The chosen ids are a
    bounded list and are sent to the documents. Null ids, labels and texts are left out. Where the chosen texts of a label
    exceed half of ``max_bytes``, the last ones by hash are left out.
    """
    label = labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1)).groupBy("doc_id").agg(F.max(column).alias("label"))
    hash_ = F.xxhash64("doc_id", F.lit(seed))
    ids, totals = by_group(label, "label", hash_, sample)
    lang = F.col("lang").cast("string") if "lang" in documents.columns else F.lit(None).cast("string")
    texts = documents.where("text is not null").where(F.length("text") <= chars).select("doc_id", "text", lang.alias("lang"))
    rows = stored(texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label").agg(F.min(F.struct("text", "lang")).alias("row"))
                  .select("label", hash_.alias("hash"), "row.text", "row.lang"))
    sizes: dict = {}
    for r in sorted(rows.select("label", "hash", F.octet_length("text").alias("n")).collect()):
        sizes.setdefault(r["label"], []).append((r["hash"], r["n"]))
    keep = F.lit(True)
    for value, found in sizes.items():
        left = max_bytes // 2
        for at, n in found:
            left -= n
            if left < 0:
                keep = keep & ((F.col("label") != value) | (F.col("hash") < at))
                break
    return rows.where(keep).select("label", "text", "lang"), totals


def as_sample(rows: list, totals: dict) -> Sample:
    """Rows of label, text and language in an order of their own."""
    rows = sorted(rows, key=lambda r: (r[0], r[1], r[2] or ""))
    return Sample([r[1] for r in rows], [r[0] for r in rows], [r[2] for r in rows], totals)


def labelled_sample(documents: DataFrame, labels: DataFrame, column: str, sample: int, chars: int, seed: int = 7) -> Sample:
    """The rows of ``labelled_rows`` on the driver."""
    rows, totals = labelled_rows(documents, labels, column, sample, chars, seed)
    return as_sample(rows.collect(), totals)


def text_sample(texts: DataFrame, sample: int, chars: int, group: str | None = None, seed: int = 3, groups: int = GROUPS,
                pieces: bool = True) -> Sample:
    """About ``sample`` distinct texts (column ``text``) of each value of ``group``, if given.

    Of a text with more than ``chars`` characters a piece of that length is taken, from a place that its hash says; without
    ``pieces`` such texts are left out, for models that look at whole texts. A
    group's share follows from its number of distinct texts, so copies take no text's place, and a group of few texts gives
    them all. Of more than ``groups`` values of ``group`` those with the most texts are sampled, and of many groups fewer
    texts each, ``TEXTS`` in all.
    """
    name = F.col(group).cast("string") if group else F.lit("")
    rows = texts.select(name.alias("group"), "text").where("text is not null and group is not null").withColumn("hash", F.xxhash64("text", F.lit(seed)))
    rows = rows if pieces else rows.where(F.length("text") <= chars)
    sizes = rows.groupBy("group").agg(F.count("*").alias("n"), F.approx_count_distinct("hash", 0.02).alias("kinds")) \
        .orderBy(F.desc("n"), "group").limit(groups).collect()
    # One row per group: the number of groups is bounded.
    sample = min(sample, TEXTS // max(1, len(sizes)))
    limits = [(r["group"], 1.0 if r["kinds"] <= sample else sample / r["kinds"]) for r in sizes]
    keep = F.lit(False)
    for value, share in sorted(limits):
        keep = keep | ((F.col("group") == F.lit(value)) & below(F.col("hash"), share))
    start = F.pmod("hash", F.length("text") - chars + 1).cast("int") + 1
    piece = F.when(F.length("text") <= chars, F.col("text")).otherwise(F.substr("text", start, F.lit(chars)))
    found = rows.where(keep).groupBy("group", "hash").agg(F.min(piece).alias("text")).select("group", "text").collect()
    found = sorted(found, key=lambda r: (r["group"], r["text"]))
    return Sample([r["text"] for r in found], [r["group"] for r in found], [None] * len(found), {r["group"]: r["n"] for r in sizes})
