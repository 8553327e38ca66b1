"""Corpus pipeline: filter, de-duplicate, decontaminate and tokenise documents.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of ``documents``. Stages whose Python
workers hold texts take at most a thousand in an Arrow batch (a session setting).

Nulls, empty and very long texts, repeated rows and further columns are treated
as each operator states; further columns pass through all stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from reelrank.llm import bpe, decontam, line_dedup, simhash, toxicity
from reelrank.llm.common import materialise, table, text_batches

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar predicts toxic go (score at the threshold or above)."""
    text_batches(spark)
    grammar = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.apply(docs, grammar)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are cut; a document of nothing else goes."""
    text_batches(spark)
    return line_dedup.apply(docs)


def dedup_simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one with the smallest doc_id."""
    text_batches(spark)
    return simhash.keep_one(docs, shingle=4, bits=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of the decoded text."""
    text_batches(spark)
    states, entries = bpe.SMALL  # the executor's heap has grown in four stages before
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                          with_ids=True, states=states, entries=entries)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_simhash),
    ("benchmark_decontamination", decontaminate),
    ("byte_bpe", tokenise),
]

#: SQL cannot express the learned grammar, SimHash bits or BPE; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
