"""A training corpus from ``documents``: each stage's result is written as Parquet and read again for the next one.

Null texts, empty texts and repeated rows are treated as each operator states; all columns of ``documents``, also ones
unknown here, pass through, and the last stage adds ``epoch`` and ``tokens``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siftloom.llm.decontaminate import decontaminate
from siftloom.llm.line_chunks import drop_repeated_chunks
from siftloom.llm.mixture import mix
from siftloom.llm.queries import MIXTURE_WEIGHTS, mixture_domain
from siftloom.llm.simhash_trie import drop_near_duplicates
from siftloom.llm.store import stored
from siftloom.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_repeated_chunks(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    chosen = mix(docs, mixture_domain(), share=0.8, epochs=2, weights=MIXTURE_WEIGHTS, seed=13)
    added = [c for c in ("epoch", "tokens") if c not in docs.columns]
    return chosen.select("doc.*", *added)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: The classifier of the first stage is learned, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
