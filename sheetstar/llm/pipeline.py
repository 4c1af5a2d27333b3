"""From raw documents to token files: language, near duplicates, benchmark passages, mixture, ids.

Each stage works on all that the one before kept, which is written and read again in between; so
a lost executor never costs more than its tasks, and no stage is planned on top of another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sheetstar.llm import contamination, language, mixing, set_join, token_files
from sheetstar.llm.common import Scratch, table


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that get a language, with it where they had none: those without letters go."""
    return language.accepted(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id."""
    return set_join.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark text."""
    return contamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return mixing.repeat(docs)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents in id order, and where each document lies in them."""
    folder = Scratch(spark, "token-files").path("ids")
    token_files.write(docs, folder, token_files.public_tokenizer())
    return token_files.digests(spark, folder)


STAGES = [
    ("language identification", identified),
    ("n-gram Jaccard join", distinct),
    ("benchmark decontamination", decontaminated),
    ("mixing to target weights", mixed),
    ("token ids", tokenized),
]

#: No SQL: language identification and byte-pair ids are beyond it. The tests hold every stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document copy in the token files."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
