"""From raw documents to encoded ones: quality, line and document dedup, decontamination, ids.

Each stage takes ``(spark, docs, sf_dir)`` and works on what the one before it kept. Its result
is written as Parquet to the folder all executors share and read again, so that a lost executor
costs no more than the stage it was in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import (
    decontaminate,
    line_dedup,
    near_copies as copies,
    quality_rules,
    sentencepiece_fst,
)
from ledgerlake.llm.shared import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them; all documents stay."""
    return line_dedup.with_kept_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of exact and near copies one document stays.

    Near copies share four fifths of their five-word shingles. SimHash finds those whose
    fingerprints are close, each checked on the texts, and a complete join all others.
    """
    return copies.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's ids, their number, and whether decoding them gives the text back."""
    machine = sentencepiece_fst.load(spark)
    encoded = sentencepiece_fst.encode_checked(docs, machine, carry=["doc_id"])
    return encoded.select("row.doc_id", "ids", "n_ids", "given_back")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_copies),
    ("decontamination", benchmark),
    ("sentencepiece", encoding),
]

#: Near copies and encoding are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; the rows of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
