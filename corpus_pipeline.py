"""A pipeline over the documents: from raw texts to tokens.

Every stage takes what the one before has kept and returns rows with the columns of `documents`;
the last one returns counts and digests of the tokens of each document.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tesela.llm import bpe, decontaminate, exact_dedup, shingles, simhash, toxicity
from tesela.llm.common import materialise, read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents judged toxic go."""
    return toxicity.drop_toxic(docs, toxicity.learn(docs, read_table(spark, sf_dir, "labels"), part=0, of=5))


def drop_exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of equal texts the document with the largest id stays."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of texts whose fingerprints link the document with the smallest id stays; four of 64 bits reach only
    almost identical texts, so of those left that share four fifths of their five-word shingles one stays as well."""
    return shingles.keep_one(materialise(simhash.keep_one(docs), "unlinked"), width=5, least=0.8)


def drop_benchmark_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that hold ten consecutive words of a benchmark item go."""
    return decontaminate.drop_documents(docs, read_table(spark, sf_dir, "benchmark"), n=10)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: token counts, and digests of the ids and of the bytes they decode to."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_duplicates),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_benchmark_texts),
    ("tokens", tokens),
]

#: A learned score and a merge loop are beyond SQL: tests/llm holds the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage returns is written and read by the next one."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
