"""The queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    block_codebooks,
    byte_bpe,
    chosen_path,
    conversation_trie,
    histogram_sort,
    language_centroids,
    long_matches,
    multiset_hash,
    projection_search,
    rans_store,
    soft_mixing,
    toxic_automaton,
    url_trees,
)
from ledgerloom.llm.oracles import ORACLES  # noqa: F401
from ledgerloom.llm.support import fold, ship, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
END_OF_TEXT = 2


def query(function: Query) -> Query:
    """Register under the function's name; the executors get the package first."""

    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


#: The rules of the URL filter: host, path, verdict.
URL_RULES = [
    url_trees.Rule("org", "/", url_trees.ALLOW),
    url_trees.Rule("example.org", "/es/", url_trees.BLOCK),
    url_trees.Rule("example.org", "/en/1", url_trees.BLOCK),
    url_trees.Rule("com", "/fr/", url_trees.ALLOW),
    url_trees.Rule("com", "/de/", url_trees.BLOCK),
]


@query
def op1_url_boosted_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_trees.judge(pages, URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict", "block_score"
    )


@query
def op2_rans_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return rans_store.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"), END_OF_TEXT)


@query
def op3_chosen_path_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


@query
def op4_language_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = language_centroids.fit(docs.where(~held_out).select("text", "lang"))
    answers = language_centroids.with_language(docs.select("doc_id", "text"), model, "answer")
    return answers.select(
        "doc_id", held_out.alias("held_out"), F.col("answer.lang").alias("lang_pred"),
        F.col("answer.score").alias("score"), F.col("answer.rejected").alias("rejected"),
    )


@query
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.digests(docs, path, public_tokenizers.PATTERN)


@query
def op6_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset_hash.compare(table(spark, sf_dir, "documents"))


@query
def op7_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = soft_mixing.mix(docs, "source")
    copies = soft_mixing.copies(F.col("rate"), F.col("doc_id"), F.col("text"))
    return mixed.select("doc_id", "source", "tokens", "member", "rate", copies.alias("copies"))


@query
def op8_toxicity_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 5) == 0
    labels = table(spark, sf_dir, "labels").where(~held_out)
    model = toxic_automaton.fit(docs, labels)
    return toxic_automaton.with_toxicity(docs, model, "score").select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op9_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return histogram_sort.assignment(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op10_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return projection_search.nearest(vectors, F.col("id") % 50 == 0, projection_search.K)


@query
def op11_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of `documents` without its 100-byte passages that also start earlier."""
    return long_matches.digests(table(spark, sf_dir, "documents"))


@query
def op12_block_codebooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes, errors and the codebooks' digest of every usable row of `embeddings`."""
    return block_codebooks.compress(table(spark, sf_dir, "embeddings")).drop("label")


@query
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt `conversations`."""
    return conversation_trie.trie(table(spark, sf_dir, "conversations"))
