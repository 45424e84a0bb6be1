"""Document fingerprints: a homomorphic hash of a text's multiset of paragraphs.

Each paragraph is cut into parts after words that its own content chooses, about every fourth one, so
that a long paragraph is no single unit. Each part is hashed to a wide vector of unsigned 32-bit
lanes, and a text's fingerprint is the sum of its parts' vectors, lane by lane modulo 2 to the power
32. Equality therefore does not depend on the order of paragraphs, and a paragraph is inserted or
deleted by adding or subtracting its vector. A part's vector is 1 in the first lane, which counts
parts, and otherwise zero outside the section of lanes that its hash names. So the share of sections
in which two fingerprints agree tells how many parts they do not share: likeness is the share of the
larger text's parts that both have, as estimated from that. Where all sections differ it is 0; that
happens to texts that differ in over a thousand parts, about 5,000 words.

Defined cases: paragraphs are what stands between line breaks, empty ones included, so the empty
text has one empty paragraph; a null text is the empty text; a document that repeats gets the same
fingerprint each time; documents with equal keys follow one another in the order of their texts;
a null key is last in descending order; one document alone is its own next document; an empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.support import col, range_bounds, range_of

SECTIONS = 256
LANES = 2
#: A paragraph is cut after one word in so many, on average.
CUT = 4
_BYTES = 4 * LANES


def parts(paragraph: str) -> list[str]:
    """A paragraph cut after the words whose checksum says so."""
    words, out, start = paragraph.split(" "), [], 0
    for i, word in enumerate(words, 1):
        if zlib.crc32(word.encode("utf-8", "surrogatepass")) % CUT == 0:
            out.append(" ".join(words[start:i]))
            start = i
    return out if start == len(words) else [*out, " ".join(words[start:])]


def vector(paragraphs: list[str]) -> np.ndarray:
    """The sum of the paragraphs' vectors: the number of parts, then SECTIONS times LANES sums."""
    hashed = b"".join(
        hashlib.blake2b(p.encode("utf-8", "surrogatepass"), digest_size=_BYTES + 4).digest()
        for paragraph in paragraphs for p in parts(paragraph)
    )
    rows = np.frombuffer(hashed, "<u4").reshape(-1, LANES + 1)
    total = np.zeros((SECTIONS, LANES), np.uint32)
    np.add.at(total, rows[:, LANES] % SECTIONS, rows[:, :LANES])
    return np.concatenate([[np.uint32(len(rows))], total.ravel()])


def fingerprint(text: str | None) -> np.ndarray:
    return vector((text or "").split("\n"))


def insert(print_: np.ndarray, paragraph: str) -> np.ndarray:
    """The fingerprint after one more paragraph."""
    return print_ + vector([paragraph])


def delete(print_: np.ndarray, paragraph: str) -> np.ndarray:
    """The fingerprint after one paragraph less."""
    return print_ - vector([paragraph])


def text_form(print_: np.ndarray) -> str:
    return base64.b64encode(print_.astype("<u4").tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The estimated share of the larger text's parts that both texts have.

    A section stays equal if none of the parts that only one text has falls into it, which for d
    such parts has the probability (1 - 1 / SECTIONS) ** d."""
    agree = int((a[1:] == b[1:]).reshape(SECTIONS, LANES).all(axis=1).sum())
    if agree == SECTIONS and a[0] == b[0]:
        return 1.0
    if not agree:
        return 0.0
    apart = math.log(agree / SECTIONS) / math.log(1 - 1 / SECTIONS)
    total = int(a[0]) + int(b[0])
    return min(max(0.0, (total - apart) / 2 / max(int(a[0]), int(b[0]))), 1.0)


def edited(text: str, following: str) -> str:
    """The last third (rounded down) replaced by as many first characters of the next text."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of a key range together, in descending order of the key, with a copy of the first row
    of the next range (after the last range: of the first) behind them, marked `ahead`.

    The ranges come from the key column alone; each text crosses the network once, and one row
    per range a second time."""
    bounds = range_bounds(docs, key, descending=True)
    parts = max(len(bounds), 1)
    placed = docs.select(
        col(key).alias("doc_id"), F.coalesce(col(text), F.lit("")).alias("text"),
        range_of(col(key), bounds, descending=True).alias("part"),
    )
    own = F.struct(F.col("part").alias("part"), F.lit(False).alias("ahead"))
    back = F.struct(
        ((F.col("part") + parts - 1) % parts).cast("int").alias("part"), F.lit(True).alias("ahead")
    )
    first = F.col("doc_id").isin(bounds) if bounds else F.lit(True)
    both = F.when(first, F.array(own, back)).otherwise(F.array(own))
    return (
        placed.select("doc_id", "text", F.explode(both).alias("_at"))
        .select("doc_id", "text", "_at.part", "_at.ahead")
        .repartition(parts, "part")
        .sortWithinPartitions(
            "part", "ahead", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text"
        )
    )


def compare(docs: DataFrame) -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and how like they and the next
    document's are."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                mine = fingerprint(row.text)
                if held is not None and held[0].part == row.part and not held[0].ahead:
                    before, its = held
                    changed = edited(before.text, row.text)
                    after = fingerprint(changed)
                    digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass"))
                    out.append((
                        before.doc_id, len(before.text), digest.hexdigest(), text_form(its),
                        text_form(after), likeness(its, after), likeness(its, mine),
                    ))
                held = (row, mine)
            yield pd.DataFrame(out, columns=_COLUMNS).astype({"doc_id": "Int64"})

    return with_next(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", "part", "ahead"
    ).mapInPandas(run, _SCHEMA)


_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)
_COLUMNS = [field.split()[0] for field in _SCHEMA.split(", ")]
