"""From raw documents to packed training sequences, one staged step after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.common import Workspace
from millrace.llm.decontaminate import drop_contaminated
from millrace.llm.line_dedup import without_repeated_lines
from millrace.llm.minhash import keep_one_of_each
from millrace.llm.packing import pack
from millrace.llm.quality import keep_quality


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document, or an earlier place, has."""
    return without_repeated_lines(docs)


def minhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that copy no benchmark item."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences."""
    return pack(docs)


STAGES = [
    ("quality", quality), ("line_dedup", line_dedup), ("minhash", minhash), ("decontaminate", decontaminate), ("packing", packing),
]

# Trained scores, alignments and tokenizers cannot be written in SQL; tests/llm compares stages and run() with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read back."""
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = work.stage(stage(spark, docs, sf_dir))
    return docs
