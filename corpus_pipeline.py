"""The corpus pipeline: language, toxicity, near-duplicates, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written as
Parquet and read again for the next one. All but the last return the columns of `documents`.

- language: documents whose text is near no learned language (or has no letter) go.
- toxicity: documents with a score of 0.5 or more go.
- near_duplicates: the document with the least doc_id of each group of near copies stays, once; if
  one doc_id has several texts, each of them stays.
- mixing: each document is repeated or left out as its fitted rate says.
- token_ids: doc_id, number of ids, the ids (little-endian unsigned 32-bit integers) and the digest
  of the bytes decoded from them.

A null doc_id is a document of its own and stays through the near-duplicate stage. Extra columns
pass through; an empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import byte_bpe, chosen_path, language_centroids, soft_mixing, toxic_automaton
from ledgerloom.llm.support import fold, ship, table, unused
from ledgerloom.session import new_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    training = docs.where(fold(F.col("doc_id"), 3) != 1).select("text", "lang")
    model = language_centroids.fit(training)
    name = unused(docs.columns, "language")
    answers = language_centroids.with_language(docs, model)
    return answers.where(~F.col(f"{name}.rejected")).select(*docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 5) != 0)
    model = toxic_automaton.fit(docs, labels)
    name = unused(docs.columns, "toxicity")
    scored = toxic_automaton.with_toxicity(docs, model)
    return scored.where(F.col(name) < 0.5).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    kept = chosen_path.near_duplicates(docs).where("kept and doc_id is not null")
    digest = unused(docs.columns, "digest")
    known = docs.where("doc_id is not null").join(
        kept.select("doc_id").distinct(), "doc_id", "left_semi"
    ).withColumn(digest, F.xxhash64("text")).dropDuplicates(["doc_id", digest])
    return known.select(*docs.columns).union(docs.where("doc_id is null"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return soft_mixing.resample(docs, "source")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    tokens = byte_bpe.with_tokens(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN)
    return tokens.select(
        "doc_id", (F.octet_length("tokens.ids") / 4).cast("long").alias("n_tokens"),
        F.col("tokens.ids").alias("ids"), F.sha2("tokens.decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language", language),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("token_ids", token_ids),
]
#: Classifiers, fitted rates and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
