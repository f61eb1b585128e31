"""Cleaning and tokenising of a document corpus in stages.

Each stage takes what its predecessor kept, written as Parquet, and all but the last return
the columns of documents. ``run`` writes the results between stages to the shared folder.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quarry.llm import bpe, decontam, line_dedup, near_dedup, quality
from quarry.llm.common import materialise
from quarry.sources.tables import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base test or a learned rule rejects go."""
    return quality.drop_low_quality(docs, read_table(spark, sf_dir, "labels", ["doc_id", "quality"]))


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines that five documents or more share stay in the last of them only."""
    return line_dedup.dedup_lines(docs).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return near_dedup.drop_near_duplicates(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontam.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark", ["item_id", "text"]))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): each text as ids and back."""
    return bpe.digests(bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", shared_lines),
    ("near dedup", near_duplicates),
    ("decontamination", benchmark_passages),
    ("byte-level BPE", token_ids),
]

#: the learned rules, the tiles and the merges are not SQL; see tests/llm/test_pipeline.py
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the last one's rows."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
