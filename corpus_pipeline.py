"""From raw documents to token ids: each stage works on what the one before it kept.

Every stage is written as Parquet to the shared folder and read back, so a lost executor costs a
reread, and no stage's plan grows into the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortmill.llm import bpe, decontam, linededup, ngrams, quality
from cohortmill.llm.common import scratch_table, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality policy keeps."""
    return quality.filter_documents(docs)


def dedupe_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that many of them share."""
    return linededup.dedupe_documents(docs)


def dedupe_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngrams.keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of what is left."""
    return bpe.encode(docs, carry=["doc_id"]).select("row.doc_id", "n_tokens", "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", keep_good),
    ("line dedup", dedupe_lines),
    ("n-gram join", dedupe_documents),
    ("decontamination", decontaminate),
    ("byte-pair encoding", tokenize),
]

# Neither the similarity join, nor latent retrieval, nor the tokenizer can be put in SQL; the tests
# check the operator of every stage against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
