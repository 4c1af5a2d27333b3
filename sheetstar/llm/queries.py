"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sheetstar.llm import contamination, language, mixing, near_vectors, piece_tokens, prefix_trie, secrets, set_join, sharding, token_files, toxicity, url_filter, word_runs
from sheetstar.llm.common import Scratch, table
from sheetstar.llm.pipeline import run as pipeline
from sheetstar.llm.sql import ORACLES  # noqa: F401


def op1_projection_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_word_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op3_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op4_shard_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id")
    return sharding.place(documents, "doc_id", sharding.query_shards())


def op5_convolution_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.fit(documents, table(spark, sf_dir, "labels")))


def op6_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = secrets.Ledger(spark, Scratch(spark, "ledger").path("blobs"))
    return secrets.digest(secrets.scan_versions(table(spark, sf_dir, "documents"), ledger))


def op7_window_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = contamination.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return contamination.digest(scanned)


def op8_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = Scratch(spark, "token-files").path("ids")
    token_files.write(table(spark, sf_dir, "documents"), folder, token_files.public_tokenizer())
    return token_files.digests(spark, folder)


def op9_shingle_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join.groups(table(spark, sf_dir, "documents"))


def op10_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, url_filter.listed_pages(pages))


def op11_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_runs.digest(word_runs.find(word_runs.planted(table(spark, sf_dir, "documents"))))


def op12_prefix_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_tokens.digests(table(spark, sf_dir, "documents"), piece_tokens.public_model())


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.build(table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_projection_neighbours, op2_word_backoff, op3_entropy_mix, op4_shard_lookup, op5_convolution_toxicity,
        op6_secret_ledger, op7_window_automaton, op8_token_blocks, op9_shingle_groups, op10_url_verdicts,
        op11_word_runs, op12_prefix_pieces, op13_prefix_trie,
    )
} | {"pipeline": pipeline}
