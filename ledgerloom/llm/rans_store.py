"""Token files: a static range asymmetric numeral system over shared frequency tables.

Documents in ascending order of their ids are cut into blocks of whole documents. One table of
frequencies, counted over all ids of the corpus, codes every block; a block is coded by up to 4,096
interleaved coders and stands alone, so blocks are read in parallel and in any order. Inside a
block, checkpoints hold the states of all coders every so many steps: reading can start at any of
them. Each block ends in a checksum.

The files are two Parquet folders below one path: `table` (symbol, frequency) and `blocks`, a row
per block: its place in the order (`part`, `seq`), its number of tokens, and its bytes:

    magic "RNB1", bits of the table, coders, steps between checkpoints      4s B H H
    documents, tokens, checkpoints, words                                   I I I I
    per document: key (signed 64 bits, 0 if null), tokens (32), null (8)
    per checkpoint: words read before it (32), crc32 of its ids (32), states of the coders (64 each)
    words (32 each)
    crc32 of all above (32)

All numbers are little-endian. Spark's writer commits a block file as a whole, so a lost executor
leaves no half of a block.

Defined cases: a null text is the empty text; every document ends with the end id, so it has one
id at least; rows that repeat are written as often as they stand there; a null key is last in the
order; an empty table gives files without blocks. A document longer than a block is a block.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.support import col, range_bounds, range_positions, ship_file, shipped
from ledgerloom.session import new_path

BLOCK_TOKENS = 1 << 19
MOST_CODERS = 4096
CHECKPOINT_STEPS = 64
#: The shared table's frequencies add up to 2 to this power; it must exceed the vocabulary.
TABLE_BITS = 20
#: Words whose ids a Python worker keeps.
CACHE_WORDS = 1_500_000
_LOW = np.uint64(1 << 31)
_HEAD = struct.Struct("<4sBHHIIII")
_DOCUMENT = np.dtype([("key", "<i8"), ("tokens", "<u4"), ("null", "u1")])


# --- the coder --------------------------------------------------------------------------------

class Table:
    """Frequencies that add up to 2**bits; every symbol that occurs has one at least."""

    def __init__(self, symbols: np.ndarray, frequencies: np.ndarray, bits: int = TABLE_BITS):
        self.symbols, self.bits = np.asarray(symbols, "<u4"), bits
        self.frequencies = np.asarray(frequencies, np.uint64)
        self.starts = np.concatenate(([0], np.cumsum(self.frequencies)))[:-1].astype(np.uint64)
        self.index = np.zeros(int(self.symbols.max(initial=0)) + 1, np.int64)
        self.index[self.symbols] = np.arange(len(self.symbols))
        self.owner = np.repeat(np.arange(len(self.symbols), dtype=np.uint32),
                               self.frequencies.astype(np.int64))

    @staticmethod
    def scaled(symbols: np.ndarray, counts: np.ndarray, bits: int = TABLE_BITS) -> Table:
        """From counts. What rounding leaves over goes to the most frequent symbols."""
        order = np.argsort(symbols)
        symbols, counts = np.asarray(symbols)[order], np.asarray(counts, float)[order]
        total = 1 << bits
        if not len(symbols):
            return Table(symbols, counts, bits)
        if len(symbols) > total:
            raise ValueError(f"{len(symbols)} symbols do not fit a table of {bits} bits")
        spare = total - len(symbols)
        scaled = 1 + np.floor(counts / counts.sum() * spare).astype(np.int64)
        scaled[np.argmax(counts)] += total - scaled.sum()
        return Table(symbols, scaled, bits)


def encode_block(keys: list[int | None], documents: list[np.ndarray], table: Table) -> bytes:
    """One block of whole documents."""
    ids = np.concatenate(documents)
    coders = 1
    while coders < MOST_CODERS and coders * 64 < len(ids):
        coders *= 2
    at = table.index[ids]
    frequency, start = table.frequencies[at], table.starts[at]
    bits, shift = np.uint64(table.bits), np.uint64(63 - table.bits)
    state = np.full(coders, _LOW, np.uint64)
    words: list[np.ndarray] = []
    marks: list[tuple[int, np.ndarray]] = []
    steps = -(-len(ids) // coders)
    for step in range(steps - 1, -1, -1):
        low, high = step * coders, min((step + 1) * coders, len(ids))
        x, f = state[:high - low], frequency[low:high]
        full = np.flatnonzero(x >= (f << shift))
        if len(full):
            large = x[full]
            words.append(large.astype("<u4"))
            x[full] = large >> np.uint64(32)
        quotient = x // f
        x[:] = (quotient << bits) + (x - quotient * f) + start[low:high]
        if step % CHECKPOINT_STEPS == 0:
            marks.append((sum(map(len, words)), state.copy()))
    stream = np.concatenate(words[::-1]) if words else np.empty(0, "<u4")
    described = np.zeros(len(keys), _DOCUMENT)
    described["key"] = [k or 0 for k in keys]
    described["tokens"] = [len(d) for d in documents]
    described["null"] = [k is None for k in keys]
    body = [_HEAD.pack(b"RNB1", table.bits, coders, CHECKPOINT_STEPS, len(keys), len(ids),
                       len(marks), len(stream)), described.tobytes()]
    span = coders * CHECKPOINT_STEPS
    for number, (written, states) in enumerate(marks[::-1]):
        part = ids[number * span:(number + 1) * span]
        read = len(stream) - written
        body.append(struct.pack("<II", read, zlib.crc32(part.astype("<u4").tobytes())))
        body.append(states.astype("<u8").tobytes())
    body.append(stream.tobytes())
    data = b"".join(body)
    return data + struct.pack("<I", zlib.crc32(data))


class Block:
    """A block read back. `segment(i)` decodes from checkpoint `i` to the next one alone."""

    def __init__(self, data: bytes, table: Table):
        if zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
            raise ValueError("a block's checksum does not match")
        magic, bits, self.coders, self.interval, n_docs, self.tokens, n_marks, n_words = (
            _HEAD.unpack_from(data)
        )
        if magic != b"RNB1" or bits != table.bits:
            raise ValueError("not a block for this table")
        self.table = table
        place = _HEAD.size
        self.documents = np.frombuffer(data, _DOCUMENT, n_docs, place)
        place += self.documents.nbytes
        self.marks = []
        for _ in range(n_marks):
            read, check = struct.unpack_from("<II", data, place)
            states = np.frombuffer(data, "<u8", self.coders, place + 8)
            self.marks.append((read, check, states))
            place += 8 + states.nbytes
        self.words = np.frombuffer(data, "<u4", n_words, place)

    def segment(self, number: int) -> np.ndarray:
        read, check, states = self.marks[number]
        table, state = self.table, states.astype(np.uint64)
        bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
        first = number * self.interval * self.coders
        last = min(first + self.interval * self.coders, self.tokens)
        ids = np.empty(last - first, "<u4")
        for low in range(first, last, self.coders):
            high = min(low + self.coders, last)
            x = state[:high - low]
            slot = x & mask
            symbol = table.owner[slot.astype(np.int64)]
            ids[low - first:high - first] = table.symbols[symbol]
            x[:] = table.frequencies[symbol] * (x >> bits) + slot - table.starts[symbol]
            empty = np.flatnonzero(x < _LOW)
            if len(empty):
                x[empty] = (x[empty] << np.uint64(32)) | self.words[read:read + len(empty)]
                read += len(empty)
        if zlib.crc32(ids.tobytes()) != check:
            raise ValueError("a segment's checksum does not match")
        return ids

    def ids(self) -> np.ndarray:
        parts = [self.segment(i) for i in range(len(self.marks))]
        return np.concatenate(parts) if parts else np.empty(0, "<u4")


# --- token ids --------------------------------------------------------------------------------

# Texts in which blanks, tabs and line breaks are the only white space, and in which lower-casing
# letter by letter is what the tokenizer does first. Both hold for whole texts or not at all.
_PLAIN = re.compile("[\\t\\n !-~¡-¬®-įı-ɏ]*\\Z")
_BLANK = re.compile("[ \\n\\t]+")
_STOPS = ".,!"


def _printable_bytes() -> dict[int, str]:
    """The usual byte-level alphabet: printable bytes stand for themselves, the others follow
    from code point 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(others)) for b in range(256)}


class Words(dict):
    """Ids of each chunk of a text, asked from the tokenizers library once for each chunk.

    Chunks are what stands between blanks; the tokenizer always splits there, so keeping its
    answers changes no id and saves most of its time. A word of Latin letters needs no
    normalising and no splitting, so it goes to the library's model at once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.alphabet = _printable_bytes()

    def __missing__(self, chunk: str) -> bytes:
        word = chunk.rstrip(_STOPS)
        if word and len(word) < len(chunk) and self._simple(word):
            ids = self[word] + self[chunk[len(word):]]
        elif self._simple(chunk):
            spelled = chunk if chunk.isascii() else "".join(map(self.alphabet.__getitem__, chunk.encode()))
            ids = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(spelled)])
        else:
            found = self.tokenizer.encode(chunk, add_special_tokens=False).ids
            ids = np.array(found, "<u4").tobytes()
        self[chunk] = ids
        return ids

    @staticmethod
    def _simple(chunk: str) -> bool:
        return chunk.isalpha() and chunk.islower() and max(chunk) <= "ÿ"

    def encode(self, texts: list[str | None], end: int) -> list[np.ndarray]:
        if len(self) > CACHE_WORDS:
            self.clear()
        last = np.array([end], "<u4").tobytes()
        found = []
        for text in texts:
            # the names of special tokens are special only as they are written
            if text and "<|" not in text and _PLAIN.match(text):
                chunks = text.lower().split()
            else:
                chunks = [c for c in _BLANK.split(text) if c] if text else []
            ids = b"".join(map(self.__getitem__, chunks))
            found.append(np.frombuffer(ids + last, "<u4"))
        return found


@lru_cache(maxsize=2)
def words(path: str) -> Words:
    return Words(shipped(path))


def _batches(frames: Iterator[pd.DataFrame], rows: int = 64):
    for frame in frames:
        for low in range(0, len(frame), rows):
            yield frame.iloc[low:low + rows]


# --- files ------------------------------------------------------------------------------------

def tokenized(docs: DataFrame, tokenizer: str, end: int, key: str = "doc_id",
              text: str = "text") -> DataFrame:
    """Blocks of ids in key order: part, seq, n_tokens, keys, absent, lengths, ids. Texts are encoded where
    they are read; only their ids cross the network, once, to the range of their key, and a range's
    rows then stream through one task."""
    bounds = range_bounds(docs, key)
    parts = max(len(bounds), 1)
    number = col(key).cast("long")
    rows = docs.select(
        F.coalesce(number, F.lit(0)).alias("key"), number.isNull().alias("absent"),
        F.xxhash64(col(text)).alias("tie"), col(text).alias("text"),
    )

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        library = words(tokenizer)
        for frame in _batches(frames):
            ids = library.encode([None if pd.isna(t) else t for t in frame["text"]], end)
            part = range_positions(frame["key"], bounds).to_numpy()
            yield pd.DataFrame({
                "part": np.where(frame["absent"], parts - 1, part).astype("int32"), "absent": frame["absent"].to_numpy(), "key": frame["key"].to_numpy(),
                "tie": frame["tie"].to_numpy(), "ids": [narrow(row) for row in ids],
            })

    encoded = rows.mapInPandas(encode, "part int, absent boolean, key long, tie long, ids binary")
    ordered = encoded.repartition(parts, "part").sortWithinPartitions("part", "absent", "key", "tie", "ids")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seq, keys, rows, size = None, 0, [], [], 0

        def block():
            return pd.DataFrame({
                "part": [part], "seq": [seq], "n_tokens": [size],
                "keys": [np.array([k or 0 for k in keys], "<i8").tobytes()],
                "absent": [np.array([k is None for k in keys]).tobytes()],
                "lengths": [[len(r) for r in rows]], "ids": [narrow(np.concatenate(rows))],
            })

        for frame in frames:
            for p, absent, k, data in zip(*(frame[c] for c in ("part", "absent", "key", "ids")), strict=True):
                row = widened(data)
                if rows and (p != part or size + len(row) > BLOCK_TOKENS):
                    yield block()
                    seq = seq + 1 if p == part else 0
                    keys, rows, size = [], [], 0
                if p != part:
                    part, seq = p, 0
                keys.append(None if absent else int(k))
                rows.append(row)
                size += len(row)
        if rows:
            yield block()

    return ordered.mapInPandas(
        cut, "part int, seq int, n_tokens long, keys binary, absent binary, lengths array<int>, ids binary"
    )


def narrow(ids: np.ndarray) -> bytes:
    """Ids on their way between tasks: two bytes each if all of them fit, else four; the first byte
    tells which."""
    two = not len(ids) or int(ids.max()) < 1 << 16
    return (b"\2" if two else b"\4") + ids.astype("<u2" if two else "<u4").tobytes()


def widened(data: bytes) -> np.ndarray:
    """The ids that `narrow` wrote."""
    return np.frombuffer(data, "<u2" if data[0] == 2 else "<u4", offset=1).astype("<u4")


def frequencies(blocks: DataFrame) -> DataFrame:
    """How often each id occurs: counted per task, then summed."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(0, np.int64)
        for frame in frames:
            for data in frame["ids"]:
                found = np.bincount(widened(data), minlength=len(total))
                found[:len(total)] += total
                total = found
        symbols = np.flatnonzero(total)
        yield pd.DataFrame({"symbol": symbols, "n": total[symbols]})

    return (
        blocks.select("ids").mapInPandas(count, "symbol long, n long")
        .groupBy("symbol").agg(F.sum("n").alias("n"))
    )


def write(docs: DataFrame, path: str, tokenizer: str, end: int, key: str = "doc_id") -> None:
    """Tokenize and write the files below `path`. Two passes: ids and their counts, then coding.
    The table has one row per id of the vocabulary; that is its bound on the driver."""
    spark = docs.sparkSession
    fresh = tokenized(docs, ship_file(spark, tokenizer), end, key)
    staged = new_path(spark, "token-blocks")
    # ids repeat in frequency rather than in runs, which this codec's entropy coding uses
    fresh.write.option("compression", "zstd").parquet(staged)
    blocks = spark.read.schema(fresh.schema).parquet(staged)
    counted = frequencies(blocks).collect()
    table = Table.scaled(
        np.array([r["symbol"] for r in counted], np.int64), np.array([r["n"] for r in counted])
    )
    spark.createDataFrame(
        pd.DataFrame({"symbol": table.symbols.astype("int64"),
                      "frequency": table.frequencies.astype("int64")}),
        "symbol long, frequency long",
    ).coalesce(1).write.parquet(f"{path}/table")
    symbols, scaled = table.symbols, table.frequencies

    def code(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shared = Table(symbols, scaled)
        for frame in frames:
            for row in frame.itertuples():
                ids = widened(row.ids)
                documents = np.split(ids, np.cumsum(row.lengths)[:-1])
                absent = np.frombuffer(row.absent, bool)
                keys = [None if a else k for k, a in zip(np.frombuffer(row.keys, "<i8").tolist(), absent)]
                yield pd.DataFrame({
                    "part": [row.part], "seq": [row.seq], "n_tokens": [row.n_tokens],
                    "block": [encode_block(keys, documents, shared)],
                })

    blocks.mapInPandas(
        code, "part int, seq int, n_tokens long, block binary"
    ).write.option("compression", "none").parquet(f"{path}/blocks")


def read_table(spark: SparkSession, path: str) -> Table:
    rows = spark.read.parquet(f"{path}/table").toPandas().sort_values("symbol")
    return Table(rows["symbol"].to_numpy(), rows["frequency"].to_numpy())


def _starts(blocks: DataFrame) -> DataFrame:
    """part, seq and the ids of all blocks before. Ranges are summed first, so the window over
    all of them has one row per range."""
    index = blocks.select("part", "seq", "n_tokens")
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = index.groupBy("part").agg(F.sum("n_tokens").alias("_n")).select(
        "part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    inside = W.partitionBy("part").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    return index.join(parts, "part").select(
        "part", "seq",
        (F.col("_before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("start"),
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian unsigned 32-bit integers) of every document in
    the files, and seq, its place among the documents of a block."""
    blocks = spark.read.parquet(f"{path}/blocks")
    table = read_table(spark, path)
    symbols, scaled = table.symbols, table.frequencies

    def decode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shared = Table(symbols, scaled)
        for frame in frames:
            for start, data in zip(frame["start"], frame["block"], strict=True):
                block = Block(bytes(data), shared)
                lengths = block.documents["tokens"].astype(np.int64)
                ends = np.cumsum(lengths)
                ids = np.split(block.ids(), ends[:-1])
                keys = pd.array(block.documents["key"], dtype="Int64")
                keys[block.documents["null"] == 1] = pd.NA
                yield pd.DataFrame({
                    "doc_id": keys, "start": int(start) + ends - lengths, "n_tokens": lengths,
                    "ids": [i.tobytes() for i in ids],
                })

    # the starts (two integers a block) go to the blocks, whose bytes do not move for it
    placed = blocks.join(_starts(blocks), ["part", "seq"])
    return placed.select("start", "block").mapInPandas(
        decode, "doc_id long, start long, n_tokens long, ids binary"
    )


def round_trip(docs: DataFrame, tokenizer: str, end: int) -> DataFrame:
    """Write `docs` to files below the shared folder and report each document from them."""
    spark = docs.sparkSession
    path = new_path(spark, "token-files")
    write(docs, path, tokenizer, end)
    return read(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
