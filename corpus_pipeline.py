"""From raw documents to packed training sequences, in five stages.

Every stage takes all documents that the one before it kept and returns the
columns of `documents`; the last returns the pieces of the sequences. A stage's
result is written and read again before the next one starts. Odd rows are handled as the
operator of each stage says.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyrock.llm import decontaminate, line_dedup, ngram_join, packing, quality
from tallyrock.llm.common import read, written


# Rows that go to a Python worker at a time. Workers and executors keep the memory of their largest batch from
# stage to stage, and the default is ten times as many.
BATCH_ROWS = 1024


def in_small_batches(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage, in a session that sends few rows at a time to its Python workers."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        return stage(spark, docs, sf_dir)

    return run


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model does not reject."""
    labels = read(spark, sf_dir, "labels", "doc_id", "quality")
    return quality.keep_good(docs, quality.train(docs, labels, ~quality.held_out()))


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat; those with no line left go. n_chars is counted anew."""
    kept = line_dedup.without_repeated_lines(docs, drop_emptied=True)
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return ngram_join.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks."""
    return decontaminate.without_leaks(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the sequences, with their token ids."""
    return packing.pack(docs)


STAGES = [
    (name, in_small_batches(stage))
    for name, stage in (
        ("quality", good_documents),
        ("line_dedup", fresh_lines),
        ("near_duplicates", one_of_each_group),
        ("decontamination", without_benchmark),
        ("packing", packed),
    )
]

#: SQL cannot express the learned model, the index or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
