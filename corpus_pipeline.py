"""A corpus pipeline of five stages, each one of the operators of plumbline.llm over all that its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of docs. A stage
learns and counts from its own input: the language network from the documents it is given, shared lines, similar
documents and so on from what is left at that point.

Defined cases are those of the operators; an empty table passes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import decontaminate, jaccard, langid, linededup, pieces
from plumbline.llm.common import stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be determined go."""
    return langid.with_language(docs)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents or more hold stay in the last of them only; every document stays."""
    return linededup.without_shared_lines(docs)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked by 5-word shingles at a similarity of 0.75 or more, the one with the smallest id stays."""
    return jaccard.one_of_each_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    return decontaminate.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sampled segmentations of every document that is left, with their piece ids."""
    return pieces.encode_samples(docs)


STAGES = [
    ("language ID", identify_language),
    ("line dedup", drop_shared_lines),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding", encode),
]

# SQL can express neither the network of the first stage nor the sampling of the last one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; the result of each is written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
