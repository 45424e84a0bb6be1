"""Sharding by histogram sort: splitters are found by counting, then rows move once.

Rows are ordered by (hash of the text, hash of the key). Every pass counts the exact bytes below a
grid of candidate boundaries in all partitions at once; the cell that holds a wanted boundary is
probed more finely in the next pass, until some boundary is within the tolerance. A pass adds eight
bits, so the number of passes is bounded, and about as many cells as splitters times 256 reach the
driver. Equal texts are neighbours and stay in one shard, unless a group of them is so large that
no boundary beside it is within the tolerance: such a group is cut by the hashes of its keys.

Then whole documents move once, to the tasks of their shards, and each task writes its sorted rows.
A shard is dealt to as many tasks as it has pieces of `PIECE_BYTES`, cut by the same counts; copies
that agree in key and text, which no boundary can part, are dealt in turn. Sizes, checksums and
slots are read from the written shards.

Sizes: bytes of the text plus one. Only DataFrame functions are used.

Defined cases: a null text has no bytes, size 1 and checksum 0, and counts as the empty text; rows
that agree in key and text are one document and stay in one shard; null keys are spread by the text
alone; with fewer rows than shards some shards are empty; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerloom.llm.support import col, unused
from ledgerloom.operators.sequence import task_of
from ledgerloom.session import new_path, stage

SHARDS = 16
#: A boundary may miss its target by this share of a shard's bytes.
TOLERANCE = 0.005
#: Text that one task of the exchange is to receive, about.
PIECE_BYTES = 32 << 20
_BITS, _STEP = 56, 8
_MASK = (1 << _BITS) - 1


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit(""))).bitwiseAND(F.lit(_MASK))


def row_key(key: Column) -> Column:
    return F.xxhash64(F.lit(9), key).bitwiseAND(F.lit(_MASK))


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The narrow table that all passes read: doc_id, size, text_crc32 and the two sort keys."""
    whole = F.coalesce(col(text), F.lit(""))
    return docs.select(
        col(key).alias("doc_id"), (F.octet_length(whole) + 1).cast("long").alias("size"),
        F.crc32(whole).alias("text_crc32"), text_key(col(text)).alias("_text"),
        row_key(col(key)).alias("_row"),
    )


@dataclass
class _Probe:
    """A wanted boundary: the cell that holds it and the bytes before that cell."""

    target: float
    before: int
    cell: tuple[int, int, int]  # level of 0 (text) or 1 (row), fixed text hash, prefix
    found: tuple[int, int] | None = None


def splitters(rows: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """The first (text, row) keys of shards 1, 2, …, by exact counts over `rows` (as `measured`)."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    allowed = tolerance * total / shards
    probes = [_Probe(total * i / shards, 0, (0, 0, 0)) for i in range(1, shards)]
    bits = 0
    for word in ("_text", "_row"):
        bits = 0
        while bits < _BITS:
            open_ = [p for p in probes if p.found is None and p.cell[0] == (word == "_row")]
            if not open_:
                break
            _refine(rows, word, bits, open_, allowed)
            bits += _STEP
        for p in probes:
            if p.found is None and p.cell[0] == (word == "_row"):
                p.found = (p.cell[1], p.cell[2]) if p.cell[0] else (p.cell[2], 0)
    return [p.found for p in probes]


def _refine(rows: DataFrame, word: str, bits: int, probes: list[_Probe], allowed: float) -> None:
    """One pass: split the cells of the open probes into 256 and choose among their edges."""
    level = int(word == "_row")
    shift = _BITS - bits - _STEP
    cell = F.shiftright(F.col(word), shift)
    wanted = rows
    if level:
        wanted = wanted.where(F.col("_text").isin(sorted({p.cell[1] for p in probes})))
    if bits:
        wanted = wanted.where(F.shiftright(cell, _STEP).isin(sorted({p.cell[2] for p in probes})))
    group = F.col("_text") if level else F.lit(0).cast("long")
    counted = (
        wanted.groupBy(group.alias("_group"), cell.alias("_cell"))
        .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"),
             F.min(word).alias("low"), F.max(word).alias("high"))
        .orderBy("_group", "_cell").collect()
    )
    for p in probes:
        own = [r for r in counted if not level or r["_group"] == p.cell[1]]
        if bits:
            own = [r for r in own if r["_cell"] >> _STEP == p.cell[2]]
        _choose(p, own, level, allowed)


def _choose(p: _Probe, cells: list, level: int, allowed: float) -> None:
    before = p.before
    for r in cells:
        after = before + r["bytes"]
        if after <= p.target and r is not cells[-1]:
            before = after
            continue
        misses = {"low": p.target - before, "high": after - p.target}
        side = min(misses, key=misses.get)
        one_key = r["low"] == r["high"]
        if misses[side] <= allowed or (one_key and (level or r["rows"] == 1)):
            edge = r["low"] if side == "low" else r["high"] + 1
            p.found = (p.cell[1], edge) if level else (edge, 0)
        elif one_key:
            p.cell, p.before = (1, r["low"], 0), before  # a large group of equal texts
        else:
            p.cell, p.before = (level, p.cell[1], r["_cell"]), before
        return
    p.found = (_MASK + 1, 0) if not level else (p.cell[1], 0)


def shard_of(bounds: list[tuple[int, int]], text: Column, row: Column) -> Column:
    """How many boundaries are at or before a row."""
    shard = F.lit(0)
    for text_edge, row_edge in bounds:
        beyond = (text > text_edge) | ((text == text_edge) & (row >= row_edge))
        shard = shard + beyond.cast("int")
    return shard


@dataclass
class Piece:
    """A range of keys within a shard: its first key, the first task it is dealt to, and how many."""

    first: tuple[int, int]
    task: int = 0
    tasks: int = 1


def pieces(rows: DataFrame, bounds: list[tuple[int, int]], piece_bytes: int = PIECE_BYTES) -> list[list[Piece]]:
    """The pieces of every shard, in order, from exact counts over `rows` (as `measured`). One row
    per piece reaches the driver."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    inner = splitters(rows, max(1, math.ceil(total / piece_bytes)), 0.5)
    starts = [(0, 0), *bounds]
    ends = [*bounds, (_MASK + 1, 0)]
    made = [
        [Piece(k) for k in sorted({low, *(k for k in inner if low < k < high)})]
        for low, high in zip(starts, ends, strict=True)
    ]
    shard = shard_of(bounds, F.col("_text"), F.col("_row"))
    key = F.struct("_text", "_row")
    piece = _piece_of(made, shard, F.col("_text"), F.col("_row"))
    counted = rows.groupBy(shard.alias("shard"), piece.alias("piece")).agg(
        F.sum("size").alias("bytes"), F.min(key).alias("low"), F.max(key).alias("high")
    ).collect()
    for r in counted:
        if r["low"] == r["high"]:  # copies of one document
            made[r["shard"]][r["piece"]].tasks = max(1, math.ceil(r["bytes"] / piece_bytes))
    task = 0
    for p in (p for own in made for p in own):
        p.task, task = task, task + p.tasks
    return made


def _piece_of(made: list[list[Piece]], shard: Column, text: Column, row: Column) -> Column:
    """The position of a row's piece in its shard. The keys go into the array beside the edges, so
    that they are not hashed again for each edge."""
    edge = lambda t, r: F.struct(t.alias("text"), r.alias("row"))
    own = F.element_at(F.array(*[
        F.array(*[edge(F.lit(p.first[0]).cast("long"), F.lit(p.first[1]).cast("long")) for p in shard_])
        for shard_ in made
    ]), shard + 1)
    beyond = F.zip_with(
        own, F.array_repeat(edge(text, row), F.size(own)), lambda e, k: (e <= k).cast("int")
    )
    return F.aggregate(beyond, F.lit(0), lambda n, x: n + x) - 1


def exchange(docs: DataFrame, bounds: list[tuple[int, int]], name: str = "shard",
             key: str = "doc_id", text: str = "text", made: list[list[Piece]] | None = None) -> DataFrame:
    """Whole documents, moved once to the tasks of their shard's pieces, in the order of the pieces
    (one piece a shard if none are given), and sorted there by shard, text key and row key."""
    name = unused(docs.columns, name)
    made = made or [[Piece(k, i)] for i, k in enumerate([(0, 0), *bounds])]
    taken = [*docs.columns, name]
    texts, rows, piece, task = (unused(taken, c) for c in ("_text", "_row", "_piece", "_task"))
    keyed = docs.withColumn(texts, text_key(col(text))).withColumn(rows, row_key(col(key)))
    placed = keyed.withColumn(name, shard_of(bounds, col(texts), col(rows)).cast("int"))
    placed = placed.withColumn(piece, _piece_of(made, col(name), col(texts), col(rows)))
    of_piece = lambda field: F.element_at(F.element_at(F.array(*[
        F.array(*[F.lit(getattr(p, field)) for p in own]) for own in made
    ]), col(name) + 1), col(piece) + 1)
    turn = F.lit(0)
    if any(p.tasks > 1 for own in made for p in own):
        turn = F.monotonically_increasing_id() % of_piece("tasks")
    dealt = placed.withColumn(task, (of_piece("task") + turn).cast("int"))
    moved = dealt.repartitionById(made[-1][-1].task + made[-1][-1].tasks, col(task))
    return moved.sortWithinPartitions(col(name), col(texts), col(rows)).select(*map(col, taken))


def sharded(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE,
            piece_bytes: int = PIECE_BYTES) -> tuple[DataFrame, str, str]:
    """Whole documents as written, one folder a shard, with the names of two columns: the shard and
    the position, which grows in the sort order."""
    spark = docs.sparkSession
    rows = stage(measured(docs).select("size", "_text", "_row"), "shard-rows")
    bounds = splitters(rows, shards, tolerance)
    name = unused(docs.columns, "shard")
    position = unused([*docs.columns, name], "_position")
    moved = exchange(docs, bounds, name, made=pieces(rows, bounds, piece_bytes)).withColumn(
        position, F.monotonically_increasing_id()
    )
    path = new_path(spark, "shards")
    moved.write.option("compression", "zstd").partitionBy(name).parquet(path)
    return spark.read.schema(moved.schema).parquet(path), name, position


def assignment(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE,
               piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every document, from the written shards. Slots
    count from 0 in each shard, in the sort order; the tasks of a shard number their own rows."""
    written, shard, position = sharded(docs, shards, tolerance, piece_bytes)
    at = written.select(col(shard).alias("shard"), col(position).alias("_position"))
    parts = at.groupBy("shard", task_of("_position").alias("_task")).agg(
        F.count("*").alias("_rows"), F.min("_position").alias("_low")
    )
    before = W.partitionBy("shard").orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    offsets = parts.select(
        "shard", "_task", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_low")).alias("_shift")
    )
    whole = F.coalesce(col("text"), F.lit(""))
    narrow = written.select(
        "doc_id", (F.octet_length(whole) + 1).cast("long").alias("size"),
        F.crc32(whole).alias("text_crc32"), col(shard).alias("shard"),
        col(position).alias("_position"), task_of(position).alias("_task"),
    )
    return narrow.join(F.broadcast(offsets), ["shard", "_task"]).select(
        "doc_id", "size", "text_crc32", "shard",
        (F.col("_position") + F.col("_shift")).cast("long").alias("slot"),
    )
