"""Byte-level BPE with the tiktoken library: local rank file, safe pre-splitting, raw-byte decoding.

A long text is cut before the library sees it. A cut is made only between a letter or digit and
the blank or line break after it: no match of the pattern spans such a place (blanks only ever
begin a match, and the pattern looks ahead but never back), so the pieces give the same ids as the
whole text. Runs without such a place, for instance thousands of blanks, are handed over match by
match, because the library's pattern engine would run out of stack on them.

Defined cases: a null text is the empty text with no ids; repeated rows are encoded each by
itself; other columns pass through untouched, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.support import col, load_ranks, release_memory, ship_file, shipped, unused

#: Texts up to this many characters go to the library whole.
PIECE_CHARS = 50_000
#: Runs of white space beyond this many characters are encoded match by match.
RUN_CHARS = 2_000

_SAFE = re.compile(r"(?<=[A-Za-z0-9])(?=[ \n])")
_LONG_RUN = re.compile(r"\s{%d,}" % RUN_CHARS)


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str):
    """The library's encoder over a local rank file, without special tokens."""
    import tiktoken

    return tiktoken.Encoding(
        "local", pat_str=pattern, mergeable_ranks=load_ranks(shipped(path)), special_tokens={}
    )


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """Cut a text at safe places into pieces of about `size` characters."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def encode(text: str | None, path: str, pattern: str) -> np.ndarray:
    """The ids of one text."""
    if not text:
        return np.empty(0, dtype="<u4")
    encoder = encoding(path, pattern)
    ids: list[int] = []
    for piece in pieces(text):
        if len(piece) > RUN_CHARS and _LONG_RUN.search(piece):
            ids += _by_match(piece, encoder, pattern)
        else:
            ids += encoder.encode_ordinary(piece)
    return np.asarray(ids, dtype="<u4")


def _by_match(piece: str, encoder, pattern: str) -> list[int]:
    import regex

    ids: list[int] = []
    for match in regex.finditer(pattern, piece):
        ids += encoder._encode_single_piece(match.group().encode())
    return ids


def decode(ids: np.ndarray, path: str, pattern: str) -> bytes:
    """The raw bytes behind the ids; they need not be valid text at the ends of a slice."""
    return encoding(path, pattern).decode_bytes(ids.tolist())


def tokens(text: Column, path: str, pattern: str) -> Column:
    """A struct of `ids` (little-endian unsigned 32-bit integers) and the bytes `decoded` from them."""

    @F.pandas_udf("ids binary, decoded binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        release_memory()  # the library needs much for itself
        for texts in batches:
            ids = [encode(t, path, pattern) for t in texts]
            yield pd.DataFrame({
                "ids": [i.tobytes() for i in ids],
                "decoded": [decode(i, path, pattern) for i in ids],
            })

    return run(text)


def with_tokens(docs: DataFrame, path: str, pattern: str, name: str = "tokens") -> DataFrame:
    """All columns of `docs` and one more, `name` (underscores are added if it is taken)."""
    file = ship_file(docs.sparkSession, path)
    return docs.withColumn(unused(docs.columns, name), tokens(col("text"), file, pattern))


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: number of ids, digest of the ids, digest of the decoded bytes."""
    name = unused(docs.columns, "tokens")
    return with_tokens(docs, path, pattern).select(
        col("doc_id"),
        (F.octet_length(f"`{name}`.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col(f"`{name}`.ids"), 256).alias("ids_sha256"),
        F.sha2(F.col(f"`{name}`.decoded"), 256).alias("decoded_sha256"),
    )
