"""Vector codes: exact integer product codebooks, trained over Hilbert-sorted flat blocks.

Components become integers, vectors are cut into 16 equal parts, and each part position has a
codebook that starts as that part of the smallest ids and is refined by rounds of nearest entry and
integer mean. The table is turned into chunks once: inside a chunk each part position has its own
order along a Hilbert curve, cut into flat blocks of a fixed number of parts with the box (least and
greatest of each component) and the sum of their parts. Chunks need no exchange: every task makes
them of the rows it reads, and they are staged.

A round compares boxes first. An entry stays on a block's shortlist if its least distance to the box
is no more than the smallest of all greatest distances, and if the entry with that distance is not
nearer in the whole box; so every nearest entry of a part of the block is on it, ties included. A block with one entry left is counted by its stored sum alone; the parts of
the others are compared with the shortlist by an integer kernel. Only sums per (part, entry) leave a
task: at most 64 entries of 16 parts, whatever the size of the table.

Defined cases: vectors that are null or hold null or non-finite components are dropped; a null id
sorts last and is kept; rows of one id are ordered by their components; shorter vectors are padded
with zeros to the longest, and that to a multiple of 16 components; with fewer rows than entries a
codebook has one entry a row; an empty table gives an empty result; null labels are equal; other
columns are not read. Integers are exact: components so large that a squared distance of a part
does not fit 64 bits are refused with a message before anything is written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.support import col
from ledgerloom.operators.heavy import heavy_join
from ledgerloom.session import stage

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Rows of a chunk and parts of a block.
CHUNK_ROWS = 32_768
BLOCK = 32
#: Blocks compared at a time, which bounds the kernel's memory.
KERNEL_BLOCKS = 64


def complete(vector: Column) -> Column:
    """Neither null nor with null or non-finite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def integers(vectors: pd.Series, width: int) -> np.ndarray:
    """floor(SCALE * x) per component, padded with zeros to `width`."""
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = np.floor(np.asarray(v, dtype=float) * SCALE)
    return out


# --- blocks -----------------------------------------------------------------------------------

def hilbert(points: np.ndarray) -> np.ndarray:
    """Positions along a Hilbert curve through the components with the widest range (Skilling's
    transposed form, over all points at once)."""
    low = points.min(axis=0)
    spread = points.max(axis=0) - low
    dims = min(points.shape[1], 8)
    widest = np.sort(np.argsort(-spread, kind="stable")[:dims])
    bits = min(62 // dims, 16)
    shift = max(int(spread.max()).bit_length() - bits, 0)
    x = [((points[:, d] - low[d]) >> shift).astype(np.uint64) for d in widest]
    step = np.uint64(1) << np.uint64(bits - 1)
    q = step
    while q > 1:
        rest = q - np.uint64(1)
        for i in range(dims):
            mask = (x[i] & q) != 0
            swap = np.where(mask, 0, (x[0] ^ x[i]) & rest).astype(np.uint64)
            x[0] = np.where(mask, x[0] ^ rest, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
        q >>= np.uint64(1)
    for i in range(1, dims):
        x[i] = x[i] ^ x[i - 1]
    turn, q = np.zeros(len(points), np.uint64), step
    while q > 1:
        turn = np.where((x[-1] & q) != 0, turn ^ (q - np.uint64(1)), turn)
        q >>= np.uint64(1)
    key = np.zeros(len(points), np.uint64)
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << np.uint64(1)) | (((x[d] ^ turn) >> np.uint64(b)) & np.uint64(1))
    return key


def make_chunk(ids: list, labels: list, rows: np.ndarray) -> dict:
    """Sorted parts, boxes and sums of one chunk. The last block is filled up by its last part,
    which counts in no sum."""
    n, width = rows.shape
    size = width // PARTS
    blocks = -(-n // BLOCK)
    order = np.empty((PARTS, n), "<i4")
    points = np.empty((PARTS, blocks * BLOCK, size), "<i8")
    sums = np.zeros((PARTS, blocks, size), "<i8")
    for p in range(PARTS):
        part = rows[:, p * size:(p + 1) * size]
        order[p] = np.argsort(hilbert(part), kind="stable") if size else np.arange(n)
        points[p, :n] = part[order[p]]
        points[p, n:] = points[p, n - 1]
        sums[p] = np.add.reduceat(points[p, :n], np.arange(0, n, BLOCK), axis=0)
    cut = points.reshape(PARTS, blocks, BLOCK, size)
    return {
        "ids": ids, "labels": labels, "sorted": order.tobytes(), "points": points.tobytes(),
        "low": cut.min(axis=2).tobytes(), "high": cut.max(axis=2).tobytes(), "sums": sums.tobytes(),
    }


class Chunk:
    """A staged chunk read back."""

    def __init__(self, row, width: int):
        self.ids, self.labels = row.ids, row.labels
        self.rows, self.size = len(row.ids), width // PARTS
        self.blocks = -(-self.rows // BLOCK)
        self.order = np.frombuffer(row.sorted, "<i4").reshape(PARTS, self.rows)
        shape = (PARTS, self.blocks, self.size)
        self.points = np.frombuffer(row.points, "<i8").reshape(PARTS, self.blocks, BLOCK, self.size)
        self.low = np.frombuffer(row.low, "<i8").reshape(shape)
        self.high = np.frombuffer(row.high, "<i8").reshape(shape)
        self.sums = np.frombuffer(row.sums, "<i8").reshape(shape)
        self.counts = np.full(self.blocks, BLOCK)
        self.counts[-1] = self.rows - BLOCK * (self.blocks - 1)


def shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """For each block and entry, whether the entry can be the nearest one of a part in the block.

    The entry with the smallest greatest distance is the block's rival. An entry goes if its least
    distance to the box is beyond the rival's greatest one, or if the rival is nearer everywhere in
    the box: the difference of their squared distances is linear, so a corner decides."""
    least = np.zeros((len(low), len(entries)), np.int64)
    most = np.zeros_like(least)
    for d in range(entries.shape[1]):
        below = low[:, d, None] - entries[None, :, d]
        above = entries[None, :, d] - high[:, d, None]
        least += np.maximum(np.maximum(below, above), 0) ** 2
        most += np.maximum(np.abs(below), np.abs(above)) ** 2
    rival = entries[most.argmin(axis=1)]
    behind = np.zeros_like(least)
    for d in range(entries.shape[1]):
        slope = 2 * (rival[:, d, None] - entries[None, :, d])
        behind += entries[None, :, d] ** 2 - rival[:, d, None] ** 2
        behind += np.minimum(slope * low[:, d, None], slope * high[:, d, None])
    return (least <= most.min(axis=1, keepdims=True)) & (behind <= 0)


def kernel(points: np.ndarray, kept: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest shortlisted entry and squared distance of each part of some blocks; ties go to the
    lower index, as distance and index are compared as one integer."""
    block, entry = np.nonzero(kept)
    total = np.zeros((len(block), points.shape[1]), np.int64)
    for d in range(entries.shape[1]):
        gap = points[block, :, d] - entries[entry, None, d]
        total += gap * gap
    key = total * ENTRIES + entry[:, None]
    best = np.minimum.reduceat(key, np.searchsorted(block, np.arange(len(points))), axis=0)
    return best % ENTRIES, best // ENTRIES


def add_sums(chunk: Chunk, books: np.ndarray, n: np.ndarray, total: np.ndarray) -> None:
    """Add a chunk's counts and component sums per part position and entry."""
    for p in range(PARTS):
        kept = shortlists(chunk.low[p], chunk.high[p], books[p])
        alone = kept.sum(axis=1) == 1
        owner = np.argmax(kept[alone], axis=1)
        np.add.at(n[p], owner, chunk.counts[alone])
        np.add.at(total[p], owner, chunk.sums[p][alone])
        open_ = np.flatnonzero(~alone)
        for low in range(0, len(open_), KERNEL_BLOCKS):
            at = open_[low:low + KERNEL_BLOCKS]
            code, _ = kernel(chunk.points[p][at], kept[at], books[p])
            real = np.arange(BLOCK)[None, :] < chunk.counts[at, None]
            np.add.at(n[p], code[real], 1)
            np.add.at(total[p], code[real], chunk.points[p][at][real])


def encode(chunk: Chunk, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and squared distances of a chunk's rows, in the order of its ids."""
    codes = np.zeros((chunk.rows, PARTS), np.uint8)
    errors = np.zeros(chunk.rows, np.int64)
    for p in range(PARTS):
        kept = shortlists(chunk.low[p], chunk.high[p], books[p])
        code = np.empty((chunk.blocks, BLOCK), np.int64)
        far = np.empty_like(code)
        for low in range(0, chunk.blocks, KERNEL_BLOCKS):
            at = slice(low, low + KERNEL_BLOCKS)
            code[at], far[at] = kernel(chunk.points[p][at], kept[at], books[p])
        codes[chunk.order[p], p] = code.reshape(-1)[:chunk.rows]
        errors[chunk.order[p]] += far.reshape(-1)[:chunk.rows]
    return codes, errors


# --- on Spark ---------------------------------------------------------------------------------

def make_chunks(rows: DataFrame, width: int) -> DataFrame:
    """Rows of (id, label, vector) as staged chunks, made where the rows are read."""
    label = rows.schema["label"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, labels, held = [], [], []
        for frame in frames:
            held.append(integers(frame["vector"], width))
            ids += [None if pd.isna(i) else int(i) for i in frame["id"]]
            labels += [None if pd.isna(v) else v for v in frame["label"]]
            if len(ids) >= CHUNK_ROWS:
                yield pd.DataFrame([make_chunk(ids, labels, np.concatenate(held))])
                ids, labels, held = [], [], []
        if ids:
            yield pd.DataFrame([make_chunk(ids, labels, np.concatenate(held))])

    fields = "sorted binary, points binary, low binary, high binary, sums binary"
    return stage(rows.mapInPandas(run, f"ids array<bigint>, labels array<{label}>, {fields}"), "chunks")


def _one_round(chunks: DataFrame, books: np.ndarray, width: int) -> np.ndarray:
    """The codebooks after one round; entries without parts stay."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros(books.shape[:2], np.int64)
        total = np.zeros(books.shape, np.int64)
        for frame in frames:
            for row in frame.itertuples():
                add_sums(Chunk(row, width), books, n, total)
        part, entry = np.nonzero(n)
        yield pd.DataFrame({
            "part": part.astype("int32"), "entry": entry.astype("int32"), "n": n[part, entry],
            "total": list(total[part, entry]),
        })

    sums = chunks.mapInPandas(run, "part int, entry int, n bigint, total array<bigint>")
    size = width // PARTS
    whole = [F.sum(F.get("total", F.lit(d))).alias(f"t{d}") for d in range(size)]
    after = books.copy()
    for row in sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *whole).collect():
        after[row["part"], row["entry"]] = [row[f"t{d}"] // row["n"] for d in range(size)]
    return after


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
             label: str = "label") -> DataFrame:
    """Per kept row: vec_id, label, code, error, label_error, codebooks_sha256."""
    rows = vectors.select(
        col(key).cast("long").alias("id"), col(label).alias("label"),
        F.transform(col(vector), lambda x: x.cast("double")).alias("vector"),
    ).where(complete(F.col("vector")))
    greatest = F.array_max(F.transform("vector", lambda x: F.abs(x)))
    longest, largest = rows.agg(F.max(F.size("vector")), F.max(greatest)).first()
    width = -(-(longest or 0) // PARTS) * PARTS
    if width // PARTS * (2 * (SCALE * (largest or 0) + 1)) ** 2 * ENTRIES >= 2 ** 63:
        raise ValueError(f"a component of {largest} is too large for exact 64-bit distances")
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(ENTRIES).select("vector").toPandas()
    start = integers(first["vector"], width)
    books = np.ascontiguousarray(start.reshape(len(start), PARTS, width // PARTS).transpose(1, 0, 2))
    chunks = make_chunks(rows, width)
    if width and len(start):
        for _ in range(ROUNDS):
            books = _one_round(chunks, books, width)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                chunk = Chunk(row, width)
                codes, errors = encode(chunk, books)
                yield pd.DataFrame({
                    "vec_id": pd.array(chunk.ids, dtype="Int64"), "label": list(chunk.labels),
                    "code": [c.tobytes().hex() for c in codes], "error": errors,
                })

    kind = rows.schema["label"].dataType.simpleString()
    coded = stage(chunks.mapInPandas(run, f"vec_id bigint, label {kind}, code string, error bigint"), "codes")
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    unlabelled = coded.where("label is null").agg(F.sum("error")).scalar()
    totals = stage(by_label.where("label is not null"), "labels")
    return heavy_join(coded, totals, "label").select(
        "vec_id", "label", "code", "error",
        F.when(F.col("label").isNull(), unlabelled).otherwise(F.col("label_error")).alias("label_error"),
        F.lit(digest).alias("codebooks_sha256"),
    )
