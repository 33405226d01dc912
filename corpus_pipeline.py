"""The corpus pipeline: five stages, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import decontaminate, jaccard_join, line_dedup, packing, quality_rules
from ledgerline.llm.common import delete_path, made, purge_scratch, read_table, shared_root
from ledgerline.llm.queries import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised quality rules keep."""
    return quality_rules.keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that a larger doc_id repeats."""
    return line_dedup.dedup_lines(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return jaccard_join.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.packing_report(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("jaccard_join", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Label model, MinHash search, path sampling and tokenizer are beyond SQL; tests/llm holds the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; each result but the last is a table in the shared folder.

    When a stage's result is written, its scratch tables go, and so does the table that it read.
    """
    docs, old = read_table(spark, sf_dir, "documents"), None
    root = f"{shared_root(spark)}/ledgerline/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        since = len(made)
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        purge_scratch(spark, since)
        if old:
            delete_path(spark, old)
        old = f"{root}/{name}"
        docs = spark.read.parquet(old)
    return STAGES[-1][1](spark, docs, sf_dir)
