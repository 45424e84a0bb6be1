"""Removal of long repeated passages, byte by byte, with run-length indexes of what may repeat.

A window is any `length` bytes of a document. The content of a window names its anchor: the place of
its least hashed 24 bytes. Consecutive windows with one anchor form a stretch, and equal windows have
equal anchors, so stretches meet in buckets by the hash of their anchor. No window is left out, and a
window is in one stretch only.

Tasks cut the documents they read into stretches and send each different stretch once, compressed;
repeats within a task are matched on the spot. In a bucket, stretches equal to an earlier one are
matched whole. The others, where at least two share an anchor, go into a run-length index
(`run_index`), which streams the matching statistics over them and marks the windows that begin
earlier too. Only the matched byte ranges come back to the documents.

Anchors with more different stretches than one index may hold are settled window by window, as a
plain aggregate over 128-bit hashes, which partial aggregation spreads over all tasks.

Defined cases: a null text is empty; documents shorter than the window keep all; a null doc_id sorts
after all others; rows that repeat doc_id and text are one document and get one result; different
texts of one doc_id are ordered by a hash of the text; an empty table gives an empty result; other
columns pass through untouched. Documents and stretches are told apart by hashes (64 bits of the
text beside doc_id; 128 bits).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.run_index import RunIndex
from ledgerloom.llm.support import col, unused
from ledgerloom.session import stage

LENGTH = 100
#: Bytes of the text that an anchor is chosen by.
ANCHOR = 24
#: A null doc_id is ordered as this one.
LAST_ID = 2 ** 63 - 1
_PLACE = np.uint64((1 << 24) - 1)
_PIECE = 1 << 20  # bytes that are anchored at a time; some arrays of them need eight times that


@dataclass(frozen=True)
class Sizes:
    """Bytes of text that a task cuts at a time, of stretches in a bucket, of one anchor in an index
    (half of that for several), and the most a bucket may hold in memory; ranges that wait, and crowded stretches in one row."""

    cut: int = 8 << 20
    bucket: int = 16 << 20
    index: int = 2_000_000
    hold: int = 64 << 20
    ranges: int = 500_000
    slice: int = 500


# --- stretches --------------------------------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def stretches(texts: list[bytes], length: int = LENGTH) -> Iterator[tuple[np.ndarray, ...]]:
    """The stretches of some texts, in parts: number of the text, start, anchor hash, and the bytes.

    Texts are anchored side by side in one buffer; windows that would cross an edge are left out."""
    held, weight = [], 0
    for number, data in enumerate(texts):
        for low in range(0, max(len(data) - length + 1, 0), _PIECE):
            held.append((number, low, data[low:low + _PIECE + length - 1]))
            weight += len(held[-1][2])
            if weight >= _PIECE:
                yield _stretches(held, length)
                held, weight = [], 0
    if held:
        yield _stretches(held, length)


def _stretches(held: list, length: int) -> tuple[np.ndarray, ...]:
    data = b"".join(piece for *_, piece in held)
    width = length - ANCHOR + 1  # anchors of one window
    words = np.ndarray(len(data) - 7, "<u8", data, 0, (1,)).astype(np.uint64)
    grams = len(data) - ANCHOR + 1
    hashed = _mix(words[:grams])
    for at in range(8, ANCHOR, 8):
        hashed ^= words[at:at + grams]
        hashed = _mix(hashed)
    # the place in the low bits makes the leftmost of equal ones the least
    keys = (hashed & ~_PLACE) | np.arange(grams, dtype=np.uint64)
    padded = np.full(-(-grams // width) * width, ~np.uint64(0))
    padded[:grams] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = len(data) - length + 1
    place = (np.minimum(back[:windows], ahead[width - 1:width - 1 + windows]) & _PLACE).astype(np.int64)
    sizes = np.fromiter((len(piece) for *_, piece in held), np.int64, len(held))
    ends = np.cumsum(sizes)
    inside = np.ones(windows, bool)
    for end in ends[:-1].tolist():
        inside[end - length + 1:end] = False
    joined = inside[1:] & inside[:-1] & (place[1:] == place[:-1])
    starts = np.flatnonzero(inside & np.concatenate([[True], ~joined]))
    lasts = np.flatnonzero(inside & np.concatenate([~joined, [True]]))
    piece = np.searchsorted(ends, starts, side="right")
    number, low = (np.array([p[i] for p in held], np.int64) for i in (0, 1))
    texts = [data[s:e] for s, e in zip(starts.tolist(), (lasts + length).tolist(), strict=True)]
    return number[piece], starts - (ends - sizes)[piece] + low[piece], hashed[place[starts]], texts


@dataclass
class Stretches:
    """Columns of stretches and their bytes."""

    doc: np.ndarray
    tag: np.ndarray
    start: np.ndarray
    anchor: np.ndarray
    digest: np.ndarray
    text: list

    def take(self, rows) -> Stretches:
        return Stretches(self.doc[rows], self.tag[rows], self.start[rows], self.anchor[rows],
                         self.digest[rows], [self.text[i] for i in np.arange(len(self.text))[rows]])

    @staticmethod
    def joined(parts: list[Stretches]) -> Stretches:
        whole = [np.concatenate([getattr(p, f) for p in parts])
                 for f in ("doc", "tag", "start", "anchor", "digest")]
        return Stretches(*whole, [t for p in parts for t in p.text])

    @property
    def sizes(self) -> np.ndarray:
        return np.fromiter(map(len, self.text), np.int64, len(self.text))

    def packed(self) -> bytes:
        columns = [self.doc, self.tag, self.start, self.anchor.view(np.int64), self.digest.view(np.int64), self.sizes]
        whole = np.array([len(self.text)], "<i8").tobytes() + np.stack(columns).astype("<i8").tobytes()
        return zstandard.ZstdCompressor(level=3).compress(whole + b"".join(self.text))

    @staticmethod
    def unpacked(packed: bytes) -> Stretches:
        whole = zstandard.ZstdDecompressor().decompress(packed)
        n = int(np.frombuffer(whole, "<i8", 1)[0])
        doc, tag, start, anchor, digest, sizes = np.frombuffer(whole, "<i8", 6 * n, 8).reshape(6, n)
        ends = np.cumsum(sizes) + 8 + 48 * n
        text = [whole[e - s:e] for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
        return Stretches(doc, tag, start, anchor.view(np.uint64), digest.view(np.uint64), text)


def settle(all_: Stretches) -> tuple[Stretches, np.ndarray]:
    """The first of equal stretches, ordered by anchor, and the rows of those that come later."""
    rows = np.lexsort((all_.start, all_.tag, all_.doc, all_.digest, all_.anchor))
    anchor, digest = all_.anchor[rows], all_.digest[rows]
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (digest[1:] != digest[:-1])][:len(rows)]
    first = rows[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(rows) else rows
    same = (all_.doc[rows] == all_.doc[first]) & (all_.tag[rows] == all_.tag[first])
    same &= all_.start[rows] == all_.start[first]
    return all_.take(rows[new]), rows[~same]


class Ranges:
    """Matched byte ranges of documents, handed on in groups of documents."""

    def __init__(self, groups: int):
        self.parts: list = []
        self.groups = groups

    def add(self, part: Stretches, rows, start, end) -> None:
        self.parts.append(np.stack([part.doc[rows], part.tag[rows], start, end]))

    def frames(self) -> Iterator[pd.DataFrame]:
        """One row per group: the merged ranges of its documents."""
        if not self.parts:
            return
        merged = merge_all(np.concatenate(self.parts, axis=1))
        self.parts = []
        group = (merged[0] ^ merged[1]) % self.groups
        for one in np.unique(group).tolist():
            yield _row(one, ranges=merged[:, group == one].astype("<i8").tobytes())


def merge_all(ranges: np.ndarray) -> np.ndarray:
    """Rows doc, tag, start, end: sorted, and disjoint within a document."""
    ranges = ranges[:, np.lexsort((ranges[2], ranges[1], ranges[0]))]
    if not ranges.shape[1]:
        return ranges
    document = np.concatenate([[0], np.cumsum((np.diff(ranges[0]) != 0) | (np.diff(ranges[1]) != 0))])
    far = int(ranges[3].max()) + 1
    reach = np.maximum.accumulate(document * far + ranges[3])
    new = np.concatenate([[True], (document * far + ranges[2])[1:] > reach[:-1]])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(new)]]) - 1
    return np.stack([ranges[0, first], ranges[1, first], ranges[2, first], reach[last] - document[first] * far])


# --- tasks ------------------------------------------------------------------------------------

FIELDS = "bucket long, packed binary, ranges binary"


def _row(bucket: int, packed: bytes | None = None, ranges: bytes | None = None) -> pd.DataFrame:
    """A row of stretches for their bucket, or of ranges for their group of documents."""
    return pd.DataFrame({"bucket": [bucket], "packed": [packed], "ranges": [ranges]})


def _settled(held: list[Stretches], ranges: Ranges) -> Stretches:
    """The first ones of equal stretches; the others are matched whole."""
    every = Stretches.joined(held)
    first, later = settle(every)
    size = np.fromiter((len(every.text[i]) for i in later.tolist()), np.int64, len(later))
    ranges.add(every, later, every.start[later], every.start[later] + size)
    return first


def cut(frames: Iterator[pd.DataFrame], length: int, buckets: int, sizes: Sizes) -> Iterator[pd.DataFrame]:
    """Stretches of the documents of a task by bucket, each different one once, and the ranges of
    those that repeat an earlier one of the same task."""
    held, weight = [], 0

    def flush() -> Iterator[pd.DataFrame]:
        ranges = Ranges(buckets)
        first = _settled(held, ranges)
        yield from ranges.frames()
        bucket = (first.anchor % np.uint64(buckets)).astype(np.int64)
        # in the order of the texts, neighbours share a document and most of their bytes
        rows = np.lexsort((first.start, first.tag, first.doc, bucket))
        for part in np.split(rows, np.flatnonzero(np.diff(bucket[rows])) + 1):
            yield _row(int(bucket[part[0]]), first.take(part).packed())

    for frame in frames:
        doc, tag = frame["doc"].to_numpy(), frame["tag"].to_numpy()
        for number, start, anchor, texts in stretches([t.encode() for t in frame["text"]], length):
            digest = np.fromiter(map(xxhash.xxh3_64_intdigest, texts), np.uint64, len(texts))
            held.append(Stretches(doc[number], tag[number], start, anchor, digest, texts))
        weight += int(frame["text"].str.len().sum())
        if weight >= sizes.cut and held:
            yield from flush()
            held, weight = [], 0
    if held:
        yield from flush()


def match(frames: Iterator[pd.DataFrame], length: int, groups: int, sizes: Sizes) -> Iterator[pd.DataFrame]:
    """Matched ranges of sorted buckets, by group of documents. Stretches of crowded anchors come out
    as they are."""
    bucket, held, weight, crowded = None, [], 0, set()
    ranges, waiting = Ranges(groups), 0

    def packed(part: Stretches) -> Iterator[pd.DataFrame]:
        for low in range(0, len(part.text), sizes.slice):
            yield _row(-1, part.take(slice(low, low + sizes.slice)).packed())

    def split(every: Stretches, names: set) -> tuple[Stretches, Stretches]:
        away = np.isin(every.anchor, np.fromiter(names, np.uint64, len(names)))
        return every.take(~away), every.take(away)

    def shrink() -> Iterator[pd.DataFrame]:
        """Repeats go; if that does not halve what is held, so do the largest anchors."""
        nonlocal held, weight
        first = _settled(held, ranges)
        size = first.sizes
        if size.sum() > sizes.hold // 2:
            names, inverse = np.unique(first.anchor, return_inverse=True)
            total = np.bincount(inverse, size).astype(np.int64)
            largest = np.argsort(-total, kind="stable")
            left = size.sum() - np.cumsum(total[largest])
            crowded.update(names[largest[:int((left > sizes.hold // 2).sum()) + 1]].tolist())
            first, away = split(first, crowded)
            yield from packed(away)
        held, weight = [first], int(first.sizes.sum())

    def finish() -> Iterator[pd.DataFrame]:
        first = _settled(held, ranges)
        _, edges = np.unique(first.anchor, return_index=True)
        counts = np.diff(np.concatenate([edges, [len(first.anchor)]]))
        heavy = np.add.reduceat(first.sizes + 1, edges) if len(edges) else counts
        several = counts > 1
        batch, total = [], 0
        for low, count, size in zip(*(x[several].tolist() for x in (edges, counts, heavy)), strict=True):
            if size > sizes.index:
                yield from packed(first.take(slice(low, low + count)))
                continue
            if batch and total + size > sizes.index // 2:
                compare(first, batch)
                batch, total = [], 0
            batch.append(np.arange(low, low + count))
            total += size
        if batch:
            compare(first, batch)

    def compare(first: Stretches, batch: list) -> None:
        """One index over whole anchors, its texts in the order of documents and places."""
        rows = np.concatenate(batch)
        rows = rows[np.lexsort((first.start[rows], first.tag[rows], first.doc[rows]))]
        index = RunIndex([first.text[i] for i in rows.tolist()])
        places = index.repeated(length)
        if not len(places):
            return
        low = np.concatenate([[0], np.flatnonzero(np.diff(places) != 1) + 1])
        high = np.concatenate([low[1:], [len(places)]]) - 1
        of = np.searchsorted(index.starts, places[low], side="right") - 1
        start = first.start[rows[of]] - index.starts[of]
        ranges.add(first, rows[of], start + places[low], start + places[high] + length)

    for frame in frames:
        for row in frame.itertuples():
            if row.packed is None:
                ranges.parts.append(np.frombuffer(row.ranges, "<i8").reshape(4, -1))
                continue
            if row.bucket != bucket:
                if held:
                    yield from finish()
                bucket, held, weight, crowded = row.bucket, [], 0, set()
            part = Stretches.unpacked(row.packed)
            if crowded:
                part, away = split(part, crowded)
                yield from packed(away)
            held.append(part)
            weight += int(part.sizes.sum())
            if weight > sizes.hold:
                yield from shrink()
            if sum(p.shape[1] for p in ranges.parts) > sizes.ranges:
                yield from ranges.frames()
    if held:
        yield from finish()
    yield from ranges.frames()


def by_document(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per document of sorted groups: its disjoint ranges."""
    group, held = None, []

    def finish() -> Iterator[pd.DataFrame]:
        merged = merge_all(np.concatenate(held, axis=1))
        edges = np.flatnonzero((np.diff(merged[0]) != 0) | (np.diff(merged[1]) != 0)) + 1
        pairs = np.ascontiguousarray(merged[2:].T)
        yield pd.DataFrame({
            "doc": merged[0, np.concatenate([[0], edges])], "tag": merged[1, np.concatenate([[0], edges])],
            "ranges": [p.astype("<i8").tobytes() for p in np.split(pairs, edges)],
        })

    for frame in frames:
        for row in frame.itertuples():
            if row.bucket != group:
                if held:
                    yield from finish()
                group, held = row.bucket, []
            held.append(np.frombuffer(row.ranges, "<i8").reshape(4, -1))
    if held:
        yield from finish()


def windows(frames: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    """Every window of some stretches with its hash."""
    for frame in frames:
        for packed in frame["packed"]:
            part = Stretches.unpacked(packed)
            many = part.sizes - length + 1
            row = np.repeat(np.arange(len(many)), many)
            at = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            yield pd.DataFrame({
                "hash": [xxhash.xxh3_128_digest(part.text[r][a:a + length])
                         for r, a in zip(row.tolist(), at.tolist(), strict=True)],
                "doc": part.doc[row], "tag": part.tag[row], "start": part.start[row] + at,
            })


def found_ranges(frames: Iterator[pd.DataFrame], length: int, groups: int) -> Iterator[pd.DataFrame]:
    """Windows (doc, tag, start) as merged ranges by group of documents."""
    for frame in frames:
        ranges = Ranges(groups)
        start = frame["start"].to_numpy()
        ranges.parts.append(np.stack([frame["doc"].to_numpy(), frame["tag"].to_numpy(), start, start + length]))
        yield from ranges.frames()


# --- on Spark ---------------------------------------------------------------------------------

def _keys(docs: DataFrame, key: str, text: str) -> tuple[Column, Column, Column]:
    whole = F.coalesce(col(text).cast("string"), F.lit(""))
    return F.coalesce(col(key).cast("long"), F.lit(LAST_ID)), F.xxhash64(whole), whole


def matched_ranges(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                   sizes: Sizes = Sizes()) -> DataFrame:
    """Staged (doc, tag, ranges): per document the disjoint byte ranges that are unions of windows
    which also begin earlier; documents without any are left out."""
    if length < ANCHOR + 8:
        raise ValueError(f"windows need at least {ANCHOR + 8} bytes")
    doc, tag, whole = _keys(docs, key, text)
    rows = docs.select(doc.alias("doc"), tag.alias("tag"), whole.alias("text")).where(
        F.octet_length("text") >= length)
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    # a stretch has about half as many windows as a window has anchors
    overlap = 1 + 2 * length / (length - ANCHOR + 2)
    buckets = max(1, round(total * overlap / sizes.bucket))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts, groups = min(buckets, 4 * tasks), min(buckets, tasks)
    sent = rows.mapInPandas(lambda frames: cut(frames, length, buckets, sizes), FIELDS)
    sorted_ = sent.repartition(parts, "bucket").sortWithinPartitions("bucket")
    found = stage(sorted_.mapInPandas(lambda frames: match(frames, length, groups, sizes), FIELDS), "matches")
    listed = found.where("ranges is not null").select("bucket", "ranges")
    crowded = found.where("packed is not null").select("packed")
    if not crowded.isEmpty():
        every = stage(crowded.repartition(parts).mapInPandas(
            lambda frames: windows(frames, length), "hash binary, doc long, tag long, start long"), "windows")
        first = every.groupBy("hash").agg(F.min(F.struct("doc", "tag", "start")).alias("f")).select("f.*")
        again = every.join(first, ["doc", "tag", "start"], "left_anti").select("doc", "tag", "start")
        listed = listed.unionByName(again.mapInPandas(
            lambda frames: found_ranges(frames, length, groups), FIELDS).drop("packed"))
    grouped = listed.repartition("bucket").sortWithinPartitions("bucket")
    return stage(grouped.mapInPandas(by_document, "doc long, tag long, ranges binary"), "ranges")


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                sizes: Sizes = Sizes(), name: str = "kept") -> DataFrame:
    """All columns of `docs` and a struct `name`: the removed spans (start, end) and the bytes left."""
    found = matched_ranges(docs, key, text, length, sizes)
    side = [unused(docs.columns, n) for n in ("_doc", "_tag", "_ranges", "_own_doc", "_own_tag")]
    by_doc = found.toDF(*side[:3])
    doc, tag, whole = _keys(docs, key, text)
    name = unused(docs.columns, name)

    @F.pandas_udf("spans array<struct<start: long, end: long>>, bytes binary")
    def remove(texts: pd.Series, ranges: pd.Series) -> pd.DataFrame:
        spans, left = [], []
        for text, packed in zip(texts, ranges, strict=True):
            data = text.encode()
            if packed is None:
                spans.append([])
                left.append(data)
                continue
            cut_ = np.frombuffer(packed, "<i8").reshape(-1, 2)
            spans.append([{"start": int(s), "end": int(e)} for s, e in cut_])
            edges = [0, *cut_.ravel().tolist(), len(data)]
            left.append(b"".join(data[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2)))
        return pd.DataFrame({"spans": spans, "bytes": left})

    joined = docs.withColumns({side[3]: doc, side[4]: tag}).join(
        by_doc, (F.col(side[3]) == F.col(side[0])) & (F.col(side[4]) == F.col(side[1])), "left")
    return joined.select(*[col(c) for c in docs.columns], remove(whole, F.col(side[2])).alias(name))


def digests(docs: DataFrame) -> DataFrame:
    """Per document: sizes, number of removed spans and the digest of the bytes left."""
    kept = deduplicate(docs.select("doc_id", "text"))
    total = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    return kept.select(
        "doc_id", total.alias("n_bytes"),
        (total - F.octet_length("kept.bytes")).cast("long").alias("n_removed"),
        F.size("kept.spans").cast("long").alias("n_spans"),
        F.sha2("kept.bytes", 256).alias("kept_sha256"),
    )

