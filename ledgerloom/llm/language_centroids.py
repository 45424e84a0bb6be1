"""Language identification by nearest centroid.

A text becomes a normalised TF-IDF vector of its letter n-grams (1 to 3 letters, hashed). Each
language has several centroids, found by spherical k-means over a bounded sample of labelled
texts; the nearest centroid by cosine names the language, and a text that lies farther from it
than nearly every training text did is rejected. Document frequencies are counted over all
training rows; only the centroids are fitted on the sample.

Defined cases: a null text or one without a letter is `und` with score 0 and is rejected; empty
training data make every text `und`; equal cosines go to the language first in the alphabet;
repeated rows get equal answers; other columns pass through untouched. A label is used as given.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerloom.llm.support import col, letter_table, unused
from ledgerloom.session import stage

UNKNOWN = "und"
DIMENSIONS = 1 << 13
SAMPLE_PER_LANGUAGE = 400
CENTROIDS_PER_LANGUAGE = 4
#: A text is rejected below this share of the cosine that all but `TAIL` of the sample reach.
REJECT_SHARE = 0.25
TAIL = 0.01
_ROUNDS = 12


@dataclass(frozen=True)
class LanguageModel:
    """Centroids (rows of unit length), their languages and least cosines, and the weights."""

    languages: list[str]
    centroids: np.ndarray
    least: np.ndarray
    idf: np.ndarray


#: All of them: letters stand beyond the first 65,536 too.
CODE_POINTS = 0x110000


def ngram_counts(text: str, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of the lower-cased letters and their counts. White space, digits and signs
    are one separator; n-grams of separators alone do not count."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4")
    codes = np.where(letters[codes], codes, 32).astype(np.uint32)
    word = codes != 32
    if not word.any():
        return np.empty(0, np.int64), np.empty(0)
    codes = np.concatenate(([32], codes, [32])).astype(np.uint32)
    keep = np.concatenate(([True], (codes[1:] != 32) | (codes[:-1] != 32)))
    codes = codes[keep]
    one, two = codes * np.uint32(0x9E3779B1), codes[:-1] * np.uint32(0x85EBCA6B)
    two = two + codes[1:] * np.uint32(0xC2B2AE35)
    three = two[:-1] * np.uint32(0x27D4EB2F) + codes[2:] * np.uint32(0x165667B1)
    hashed = np.concatenate((one[codes != 32], two, three))
    slots = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(19)
    counts = np.bincount(slots, minlength=DIMENSIONS)
    found = np.flatnonzero(counts)
    return found, counts[found]


def _vector(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = np.log1p(counts) * idf[found]
    return values / max(np.sqrt(values @ values), 1e-12)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each hashed n-gram stands. One row per slot reaches the driver."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters, total, rows = letter_table(CODE_POINTS), np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                found, _ = ngram_counts(text, letters)
                total[found] += 1
                rows += 1
        slots = np.flatnonzero(total)
        yield pd.DataFrame({
            "slot": np.append(slots, -1), "n": np.append(total[slots], rows),
        })

    partial = texts.select("text").mapInPandas(count, "slot long, n long")
    rows = partial.groupBy("slot").agg(F.sum("n").alias("n")).collect()
    frequencies, size = np.zeros(DIMENSIONS), 0
    for slot, n in rows:
        if slot < 0:
            size = n
        else:
            frequencies[slot] = n
    return frequencies, size


def sample(training: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """At most `per_language` different texts of each language, by the order of their hashes.

    A hash threshold from the number of the language's different texts comes first, so that little
    more than the sample is shuffled; copies share one hash, so they are no part of that number. One
    count per language reaches the driver, as the centroids do."""
    marked = training.select("lang", "text", F.xxhash64("text").alias("_hash"))
    different = marked.select("lang", "_hash").distinct().groupBy("lang").count()
    sizes = {r["lang"]: r["count"] for r in different.collect()}
    if not sizes:
        return training.select("lang", "text")
    texts = F.element_at(F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair]), F.col("lang"))
    share = F.col("_hash").bitwiseAND(F.lit((1 << 30) - 1)) / F.lit(float(1 << 30))
    few = marked.where(share * texts < 2.0 * per_language + 50).dropDuplicates(["lang", "_hash"])
    order = W.partitionBy("lang").orderBy(share)
    return few.withColumn("_rank", F.row_number().over(order)).where(
        F.col("_rank") <= per_language
    ).select("lang", "text")


def fit(training: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE,
        clusters: int = CENTROIDS_PER_LANGUAGE) -> LanguageModel:
    """Learn from rows with `text` and `lang`; rows without either teach nothing."""
    known = training.select("lang", "text").where("text is not null and lang is not null")
    frequencies, size = document_frequencies(known)
    idf = np.log((1 + size) / (1 + frequencies)) + 0.1

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        letters, vectors = letter_table(CODE_POINTS), []
        for text in sorted(group["text"]):
            found, counts = ngram_counts(text, letters)
            if len(found):
                row = np.zeros(DIMENSIONS)
                row[found] = _vector(found, counts, idf)
                vectors.append(row)
        if not vectors:
            return pd.DataFrame({"lang": [], "least": [], "centroid": []})
        centroids, nearest = spherical_kmeans(np.array(vectors), clusters)
        least = [
            float(np.quantile(nearest[1][nearest[0] == k], TAIL)) for k in range(len(centroids))
        ]
        return pd.DataFrame({
            "lang": group["lang"].iloc[0], "least": least,
            "centroid": [c.astype("<f4").tobytes() for c in centroids],
        })

    chosen = stage(sample(known, per_language), "language-sample")
    rows = chosen.groupBy("lang").applyInPandas(
        cluster, "lang string, least double, centroid binary"
    ).collect()
    rows.sort(key=lambda r: (r["lang"], bytes(r["centroid"])))
    centroids = [np.frombuffer(r["centroid"], dtype="<f4") for r in rows]
    return LanguageModel(
        [r["lang"] for r in rows],
        np.array(centroids, dtype=np.float32).reshape(-1, DIMENSIONS),
        np.array([r["least"] for r in rows]), idf.astype(np.float32),
    )


def spherical_kmeans(rows: np.ndarray, clusters: int):
    """Centroids of unit length, and each row's centroid and cosine. The first centres are rows
    at even ranks of their cosine to the mean; centres that end with few rows are given up, so
    that one odd text does not become a language's centroid."""
    ranked = np.argsort(-(rows @ rows.mean(axis=0)), kind="stable")
    places = (np.arange(clusters) + 0.5) / clusters * len(rows)
    centres = rows[ranked[np.unique(places.astype(int))]]
    least = min(max(2, len(rows) // 50), len(rows))
    for _ in range(_ROUNDS):
        owner = (rows @ centres.T).argmax(axis=1)
        large = [k for k in np.unique(owner) if (owner == k).sum() >= least] or [owner[0]]
        sums = np.array([rows[owner == k].sum(axis=0) for k in large])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    cosines = rows @ centres.T
    owner = cosines.argmax(axis=1)
    used = np.unique(owner)
    return centres[used], (np.searchsorted(used, owner), cosines[np.arange(len(rows)), owner])


def classify(text: str | None, model: LanguageModel, letters: np.ndarray):
    """(language, cosine, rejected) of one text."""
    if not text or not model.languages:
        return UNKNOWN, 0.0, True
    found, counts = ngram_counts(text, letters)
    if not len(found):
        return UNKNOWN, 0.0, True
    cosines = model.centroids[:, found] @ _vector(found, counts, model.idf).astype(np.float32)
    best = int(cosines.argmax())
    cosine = float(min(max(cosines[best], 0.0), 1.0))
    return model.languages[best], cosine, bool(cosine < REJECT_SHARE * model.least[best])


def language(text: Column, model: LanguageModel) -> Column:
    """A struct of `lang`, `score` (the cosine) and `rejected`."""
    shared = model

    @F.pandas_udf("lang string, score double, rejected boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        letters = letter_table(CODE_POINTS)
        for texts in batches:
            yield pd.DataFrame(
                [classify(t, shared, letters) for t in texts],
                columns=["lang", "score", "rejected"],
            )

    return run(text)


def with_language(docs: DataFrame, model: LanguageModel, name: str = "language") -> DataFrame:
    """All columns of `docs` and the answer as one struct column."""
    return docs.withColumn(unused(docs.columns, name), language(col("text"), model))
