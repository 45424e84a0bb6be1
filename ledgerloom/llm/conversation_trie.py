"""Prefix trie of conversations: adaptive radix trees over fixed-width turn ids, built range by range.

A turn's id is 24 bytes: 16 of the SHA-256 of its role and text, then the big-endian length of its
text. A conversation is the string of its turn ids. Equal conversations are counted before they are
shuffled, the different ones are range-partitioned by their bytes, and each task grows radix trees
over its sorted runs; only byte depths that end a turn are nodes of the result. A hot first turn is
thus split by the turns after it, and a hot conversation is one key with a count.

Nodes on the edge of a run (the prefixes of its first and last key) may have members in other runs:
their parts are summed by node, and what their subtrees hold is rolled up by pointer jumping, in
rounds as the logarithm of the depth. All other nodes are final in the task that found them.

Long conversations are cut into segments of a fixed number of turns. A segment hangs below the node
where the one before it ends, so no key grows with a conversation; positions within a conversation
come from a range partitioning too, so that one conversation can be spread over tasks.

Defined cases: rows without conv_id belong to no conversation; a null turn sorts first, turns of one
number are ordered by their ids, and repeated rows are turns of their own; null role or text is
empty; conversations without turns are members of the root; an empty table has no nodes, not even a
root; other columns are not read. Turns are told apart by 128 bits of a cryptographic digest.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.radix_tree import RadixTree
from ledgerloom.llm.support import col
from ledgerloom.operators.heavy import heavy_join
from ledgerloom.session import stage

#: Bytes of a turn id.
WIDTH = 24
#: Turns that a conversation takes at most from the head of its group.
GROUP, HEAD = 5, 8
EMPTY = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class Sizes:
    """Turns of a segment, keys and key bytes of a tree, characters of a list of ids in one row."""

    segment: int = 1024
    tree_keys: int = 20_000
    tree_bytes: int = 32 << 20
    piece_chars: int = 1 << 20


def node_id(entry: bytes, path: bytes) -> bytes:
    """Identity of the node that `path` leads to from the node `entry`."""
    return hashlib.sha256(entry + path).digest()[:16] if path else entry


def _node_id(entry: Column, path: Column) -> Column:
    """The same on columns."""
    digest = F.unhex(F.substring(F.sha2(F.concat(entry, path), 256), 1, 32))
    return F.when(F.octet_length(path) > 0, digest).otherwise(entry)


# --- rebuilt conversations --------------------------------------------------------------------

def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv, turn and the turn's id."""
    role, text = F.coalesce(col("role"), F.lit("")), F.coalesce(col("text"), F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    size = F.lpad(F.hex(F.octet_length(text)), 16, "0")
    return conversations.where(col("conv_id").isNotNull()).select(
        col("conv_id").cast("long").alias("conv"), col("turn").alias("turn"),
        F.unhex(F.concat(F.substring(digest, 1, 32), size)).alias("unit"),
    )


def numbered(turns: DataFrame) -> DataFrame:
    """Staged turns with `pos`, their place within the conversation from 1.

    Tasks number what they hold; a conversation that goes on in the next task starts there at the
    count it left off, known from one row per task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, last, seen = TaskContext.get().partitionId(), None, 0
        for frame in frames:
            conv = frame["conv"].to_numpy()
            if not len(conv):
                continue
            starts = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
            local = np.arange(len(conv)) - np.repeat(starts, np.diff(np.r_[starts, len(conv)])) + 1
            if conv[0] == last:
                local[:starts[1] if len(starts) > 1 else len(conv)] += seen
            last, seen = conv[-1], int(local[-1])
            yield pd.DataFrame({"conv": conv, "unit": frame["unit"], "task": task, "local": local})

    order = ["conv", F.col("turn").asc_nulls_first(), "unit"]
    ranged = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stage(ranged.mapInPandas(run, "conv long, unit binary, task int, local long"), "turns")
    edges = rows.groupBy("task").agg(
        F.min("conv").alias("first"), F.max(F.struct("conv", "local")).alias("last")
    ).orderBy("task").collect()  # a row per task
    carried, open_conv, open_rows = [(-1, 0, 0)], None, 0
    for edge in edges:
        before = open_rows if edge["first"] == open_conv else 0
        if before:
            carried.append((edge["task"], edge["first"], before))
        open_conv = edge["last"]["conv"]
        open_rows = edge["last"]["local"] + (before if open_conv == edge["first"] else 0)
    offsets = turns.sparkSession.createDataFrame(carried, "task int, conv long, before long")
    return rows.join(F.broadcast(offsets), ["task", "conv"], "left").select(
        "conv", "unit", (F.col("local") + F.coalesce("before", F.lit(0))).alias("pos")
    )


def head_turns(conv: Column) -> Column:
    """How many turns of its group's first conversation a conversation starts with."""
    return F.crc32(conv.cast("string")) % (HEAD + 1)


def segments(conversations: DataFrame, size: int) -> DataFrame:
    """Staged segments of the rebuilt conversations: conv, segment, entry, path, total (turns)."""
    rows = numbered(turn_rows(conversations))
    heads = rows.where((F.col("pos") <= HEAD) & (F.col("conv") % GROUP == 0)).groupBy(
        F.col("conv").alias("source")
    ).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "unit"))), lambda x: x.unit).alias("heads"))
    convs = rows.groupBy("conv").agg(F.max("pos").alias("length"))
    convs = convs.withColumn("source", F.col("conv") - F.col("conv") % GROUP).join(heads, "source", "left")
    wanted = head_turns(F.col("conv"))
    head = F.slice(F.coalesce("heads", F.array().cast("array<binary>")), F.lit(1), wanted.cast("int"))
    convs = convs.select("conv", wanted.alias("wanted"), head.alias("head"), "length").select(
        "conv", "head", (F.col("wanted") - F.size("head")).alias("shift"),
        (F.size("head") + F.greatest(F.col("length") - F.col("wanted"), F.lit(0))).alias("total"),
    )
    convs = stage(convs, "conversations")
    own = heavy_join(
        rows.where(F.col("pos") > head_turns(F.col("conv"))),
        convs.select(F.col("conv").alias("key"), "shift", "total"), "conv", "key",
    ).select("conv", (F.col("pos") - F.col("shift")).alias("pos"), "unit", "total")
    taken = convs.select("conv", "total", F.posexplode("head").alias("pos", "unit")).select(
        "conv", (F.col("pos") + 1).cast("long").alias("pos"), "unit", "total"
    )
    parts = own.unionByName(taken).groupBy(
        "conv", F.floor((F.col("pos") - 1) / size).alias("segment")
    ).agg(F.array_sort(F.collect_list(F.struct("pos", "unit"))).alias("turns"), F.max("total").alias("total"))
    path = F.unhex(F.array_join(F.transform("turns", lambda x: F.hex(x.unit)), ""))
    nothing = convs.where("total = 0").select(
        "conv", F.lit(0).cast("long").alias("segment"), F.lit(b"").alias("path"), "total"
    )
    cut = stage(parts.select("conv", "segment", path.alias("path"), "total").unionByName(nothing), "segments")
    short = cut.where(F.col("total") <= size).withColumn("entry", F.lit(b""))
    long = cut.where(F.col("total") > size).repartition("conv").sortWithinPartitions("conv", "segment")
    fields = "conv long, segment long, path binary, total long, entry binary"
    return short.unionByName(long.mapInPandas(_entries, fields))


def _entries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The node at which each segment of a conversation starts, along its sorted segments."""
    conv, at = None, b""
    for frame in frames:
        entry = []
        for row in frame.itertuples():
            if row.conv != conv:
                conv, at = row.conv, b""
            entry.append(at)
            at = node_id(at, row.path)
        yield frame.assign(entry=entry)


# --- trees ------------------------------------------------------------------------------------

NODE_FIELDS = (
    "node binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, "
    "size long, n_children long, n_leaves long, saved long, edge boolean"
)


def tree_nodes(entry: bytes, depth: int, keys: list, cut: tuple[bool, bool]) -> dict[str, list]:
    """The nodes of one entry's sorted keys (path, n, least conv, goes on); the entry has `depth`.

    `cut` tells whether other runs may hold keys before the first or after the last one. Edge nodes
    (the entry itself, prefixes of such keys and of keys that go on) give what they hold without
    other edge nodes; all others are final."""
    tree = RadixTree()
    for path, *value in keys:
        tree.insert(path, value)
    edges = {b""}
    outer = [keys[0][0]] * cut[0] + [keys[-1][0]] * cut[1] + [path for path, _, _, on in keys if on]
    for path in outer:
        edges.update(path[:i] for i in range(WIDTH, len(path) + 1, WIDTH))

    paths, above, turns_of = [b""], [-1], []
    n, least = [0], [None]
    for node, parent, way, _ in tree.walk():
        path, at = (turns_of[parent][0] + way, turns_of[parent][1]) if parent >= 0 else (b"", 0)
        start = len(path) - len(way)
        for end in range(start - start % WIDTH + WIDTH, len(path) + 1, WIDTH):
            paths.append(path[:end])
            above.append(at)
            n.append(0)
            least.append(None)
            at = len(paths) - 1
        turns_of.append((path, at))
        if node.value is not None:
            n[at] += node.value[0]
            least[at] = node.value[1]
    ends = {path for path, *_ in keys}
    count = len(paths)
    children, leaves, saved = [0] * count, [0] * count, [0] * count
    size = [int.from_bytes(p[-8:], "big") if p else 0 for p in paths]
    edge = [p in edges for p in paths]
    for i in range(count - 1, -1, -1):
        if not edge[i]:
            leaves[i] += not children[i]
            saved[i] += (n[i] - 1) * size[i]
        up = above[i]
        if up < 0:
            continue
        n[up] += n[i]
        if least[i] is not None and (least[up] is None or least[i] < least[up]):
            least[up] = least[i]
        if not edge[i]:
            children[up] += 1
            leaves[up] += leaves[i]
            saved[up] += saved[i]
    ids = [node_id(entry, p) if e or p in ends else None for p, e in zip(paths, edge, strict=True)]
    inner = depth > 0  # the entry of a later segment is counted where the one before it ends
    hide = [inner and not p for p in paths]
    return {
        "node": ids,
        "parent": [ids[u] if u >= 0 and edge[u] else None for u in above],
        "depth": [depth + len(p) // WIDTH for p in paths],
        "conv_id": [None if h else x for x, h in zip(least, hide, strict=True)],
        "parent_conv_id": [least[u] if u >= 0 and not edge[u] else None for u in above],
        "n_convs": [0 if h else x for x, h in zip(n, hide, strict=True)],
        "size": [None if h else x for x, h in zip(size, hide, strict=True)],
        "n_children": children, "n_leaves": leaves, "saved": saved, "edge": edge,
    }


def _grow(frames: Iterator[pd.DataFrame], sizes: Sizes) -> Iterator[pd.DataFrame]:
    """Trees over the sorted keys of a task, run by run."""
    held: list = []
    size = 0

    def trees() -> Iterator[pd.DataFrame]:
        first, last = held[0][0], held[-1][0]
        low = 0
        while low < len(held):
            entry, segment = held[low][:2]
            high = low
            while high < len(held) and held[high][0] == entry:
                high += 1
            cut = (entry == first, entry == last)
            nodes = tree_nodes(entry, segment * sizes.segment, [k[2:] for k in held[low:high]], cut)
            whole = ["depth", "conv_id", "parent_conv_id", "n_convs", "size", "n_children", "n_leaves", "saved"]
            yield pd.DataFrame(nodes).astype(dict.fromkeys(whole, "Int64"))
            low = high

    for frame in frames:
        for row in frame.itertuples():
            held.append((row.entry, int(row.segment), row.path, int(row.n), int(row.least), bool(row.goes_on)))
            size += len(row.path)
            if len(held) >= sizes.tree_keys or size >= sizes.tree_bytes:
                yield from trees()
                held, size = [], 0
    if held:
        yield from trees()


def trie(conversations: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256."""
    parts = segments(conversations, sizes.segment)
    keys = parts.groupBy("entry", "path").agg(
        F.min("segment").alias("segment"), F.count("*").alias("n"), F.min("conv").alias("least"),
        F.max(F.col("total") > (F.col("segment") + 1) * sizes.segment).alias("goes_on"),
    )
    sorted_keys = keys.repartitionByRange("entry", "path").sortWithinPartitions("entry", "path")
    found = stage(sorted_keys.mapInPandas(lambda frames: _grow(frames, sizes), NODE_FIELDS), "nodes")
    edge = edge_nodes(found.where("edge"))
    final = ["node", "parent", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved"]
    nodes = stage(found.where("not edge").select(*final).unionByName(edge.select(*final)), "all-nodes")
    above = edge.select(F.col("node").alias("key"), F.col("conv_id").alias("above"))
    nodes = stage(heavy_join(nodes, above, "parent", "key"), "linked-nodes")
    last = parts.where(F.col("segment") == F.floor(F.greatest(F.col("total") - 1, F.lit(0)) / sizes.segment))
    ends = ends_digests(last.select(_node_id(F.col("entry"), F.col("path")).alias("node"), "conv"), sizes)
    return heavy_join(nodes, ends.withColumnRenamed("node", "key"), "node", "key").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "above").alias("parent_conv_id"), "n_convs",
        "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("digest", F.lit(EMPTY)).alias("ends_sha256"),
    )


def edge_nodes(parts: DataFrame) -> DataFrame:
    """Edge nodes summed over the runs that hold parts of them, with what their subtrees hold."""
    sums = ["n_convs", "n_children", "n_leaves", "saved"]
    merged = stage(parts.groupBy("node").agg(
        F.max("parent").alias("parent"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.max("size").alias("size"), *[F.sum(c).alias(c) for c in sums],
    ), "edge-parts")
    below = merged.where("parent is not null").groupBy(F.col("parent").alias("_up")).agg(
        F.count("*").alias("_edges"))
    merged = merged.join(below, F.col("node") == F.col("_up"), "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("_edges", F.lit(0))
    ).drop("_up", "_edges")
    own = merged.withColumns({
        "n_leaves": F.col("n_leaves") + (F.col("n_children") == 0).cast("long"),
        "saved": F.col("saved") + (F.col("n_convs") - 1) * F.col("size"),
        "parent_conv_id": F.lit(None).cast("long"),
    })
    own = stage(own, "edge-nodes")
    state = own.select("node", F.col("parent").alias("up"), "n_leaves", "saved")
    rounds = math.ceil(math.log2((own.agg(F.max("depth")).first()[0] or 0) + 1))
    for _ in range(rounds):
        # each node adds what it holds to the node `up`, then looks twice as far
        gained = state.where("up is not null").groupBy(F.col("up").alias("_to")).agg(
            F.sum("n_leaves").alias("_leaves"), F.sum("saved").alias("_saved"))
        farther = state.where("up is not null").select(
            F.col("node").alias("_via"), F.col("up").alias("_next"))
        jumped = heavy_join(state, farther, "up", "_via")
        state = stage(jumped.join(gained, F.col("node") == F.col("_to"), "left").select(
            "node", F.col("_next").alias("up"),
            (F.col("n_leaves") + F.coalesce("_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved") + F.coalesce("_saved", F.lit(0))).alias("saved"),
        ), "edge-sums")
    return own.drop("n_leaves", "saved").join(state.drop("up"), "node")


# --- members that end at a node ---------------------------------------------------------------

def ends_digests(ends: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """Staged (node, digest) of the ascending, comma-joined conversation ids per node.

    The pairs are sorted over all tasks. A node that lies inside a task is digested there; the text
    of any other node is cut into pieces, and its pieces are digested one after the other."""
    ranged = ends.repartitionByRange("node", "conv").sortWithinPartitions("node", "conv")
    rows = stage(ranged.mapInPandas(
        lambda frames: _end_texts(frames, sizes.piece_chars), "node binary, at long, text string, digest string"
    ), "ends")
    pieces = rows.where("text is not null").select("node", "at", "text")
    streamed = pieces.repartition("node").sortWithinPartitions("node", "at").mapInPandas(
        _end_digests, "node binary, digest string")
    return stage(rows.where("digest is not null").select("node", "digest").unionByName(streamed), "digests")


def _end_texts(frames: Iterator[pd.DataFrame], piece_chars: int) -> Iterator[pd.DataFrame]:
    """Digests of nodes that begin and end in this task, pieces of the others."""
    node, at, text, whole = None, None, [], False
    length, started = 0, False
    out: list = []

    def piece():
        return (node, at, ",".join(text), None)

    for frame in frames:
        for key, conv in zip(frame["node"], frame["conv"], strict=True):
            if key != node or not started:
                if started:
                    joined = ",".join(text)
                    digest = hashlib.sha256(joined.encode()).hexdigest()
                    out.append((node, None, None, digest) if whole else piece())
                # the first node of a task may have begun in the one before
                node, at, text, whole, length, started = key, conv, [], started, 0, True
            elif length > piece_chars:
                out.append(piece())
                at, text, whole, length = conv, [], False, 0
            text.append(str(conv))
            length += len(text[-1]) + 1
        if out:
            yield pd.DataFrame(out, columns=["node", "at", "text", "digest"]).astype({"at": "Int64"})
            out = []
    if started:
        yield pd.DataFrame([piece()], columns=["node", "at", "text", "digest"])


def _end_digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One digest per node over its pieces in order; only the state of the hash is kept."""
    node, state = None, None
    for frame in frames:
        done = []
        for key, text in zip(frame["node"], frame["text"], strict=True):
            if state is not None and key == node:
                state.update(b",")
            else:
                if state is not None:
                    done.append((node, state.hexdigest()))
                node, state = key, hashlib.sha256()
            state.update(text.encode())
        yield pd.DataFrame(done, columns=["node", "digest"])
    if state is not None:
        yield pd.DataFrame([(node, state.hexdigest())], columns=["node", "digest"])
