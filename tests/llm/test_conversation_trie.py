"""The conversation trie against plain prefix counting, and the radix tree's layouts."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import conversation_trie as ct
from ledgerloom.llm.radix_tree import RadixTree

SCHEMA = "conv_id long, turn long, role string, text string, node string"


def plain(rows):
    """Nodes by grouping the prefixes of the rebuilt conversations."""
    own = {}
    for conv, turn, role, text, _ in rows:
        if conv is not None:
            unit = (role or "", text or "")
            digest = hashlib.sha256(f"{len(unit[0].encode())}:{unit[0]}{unit[1]}".encode()).digest()[:16]
            own.setdefault(conv, []).append((turn is not None, turn or 0, digest, unit))
    turns = {c: [u for *_, u in sorted(t)] for c, t in own.items()}
    nodes = {}
    for conv, mine in turns.items():
        h = zlib.crc32(str(conv).encode()) % 9
        source = conv - (conv % 5 if conv >= 0 else -(-conv % 5))
        whole = tuple(turns.get(source, [])[:h] + mine[h:])
        for d in range(len(whole) + 1):
            node = nodes.setdefault(whole[:d], {"in": [], "ends": []})
            node["in"].append(conv)
            if d == len(whole):
                node["ends"].append(conv)
    kids = {}
    for path in nodes:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for path, node in nodes.items():
        cost = (len(node["in"]) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in kids
            saved[path[:d]] += cost
    return sorted((
        (min(n["in"]), len(p), min(nodes[p[:-1]]["in"]) if p else None, len(n["in"]), len(kids.get(p, [])),
         leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(n["ends"]))).encode()).hexdigest())
        for p, n in nodes.items()), key=repr)


def trie(spark, rows, **sizes):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted((tuple(r) for r in ct.trie(df, ct.Sizes(**sizes)).collect()), key=repr)


def conversations():
    random.seed(13)
    rows = []
    for conv in range(0, 160):
        if conv % 11 == 10:
            continue
        copy = conv % 3 == 0  # a third of all conversations are the same
        for turn in range(7 if copy else random.randint(1, 14)):
            text = f"same {turn}" if copy or turn < 2 else random.choice(["é", "", "yes", "no " * 9, str(conv)])
            rows.append((conv, turn, random.choice(["user", "user", None]) if not copy else "user", text, "x"))
    rows += [(7, None, "user", "first", "x"), (7, None, None, None, "x"), (7, 3, "user", "tied", "x")]
    rows += [rows[5], rows[5], (None, 1, "user", "nobody", "x"), (-3, 0, "user", "below", "x")]
    rows += [(1003, 0, None, None, "x"), (1000, None, None, None, "x")]
    return rows


def test_nodes_equal_plain_counting(spark):
    rows = conversations()
    assert trie(spark, rows) == plain(rows)


def test_runs_segments_and_pieces_of_any_size_give_the_same_nodes(spark):
    rows = conversations()
    rows += [(c, t, "user", f"long {t}", "x") for c in (2000, 2001, 2005, 2006) for t in range(40 + c % 5)]
    assert trie(spark, rows, segment=4, tree_keys=7, piece_chars=20) == plain(rows)


def test_cases(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 1, "user", "x", "x")]) == []
    # conversation 1 takes h turns of the absent conversation 0 and drops its own first h
    one = [(11, 0, "user", "only", "x")]
    assert trie(spark, one) == plain(one) and len(plain(one)) == 1


def test_positions_of_a_conversation_that_spans_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = spark.range(3000).select(
            F.when(F.col("id") < 2500, 5).otherwise(F.col("id")).alias("conv"), F.col("id").alias("turn"),
            F.unhex(F.lpad(F.hex("id"), 48, "0")).alias("unit"),
        ).repartition(5)
        got = ct.numbered(turns).select("conv", "pos", F.conv(F.hex("unit"), 16, 10).cast("long").alias("id"))
        places = got.collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(places) == 3000
    assert all(r["pos"] == (r["id"] + 1 if r["conv"] == 5 else 1) for r in places)


@pytest.mark.parametrize("fan", [3, 4, 5, 16, 17, 48, 49, 256])
def test_layouts_grow_and_keep_order(fan):
    random.seed(fan)
    tree, wanted = RadixTree(), {}
    for byte in random.sample(range(256), fan):
        for tail in (b"", b"aaaa", b"aaab", b"aa"):
            key = b"pre" + bytes([byte]) + tail
            tree.insert(key, len(wanted))
            wanted[key] = len(wanted)
    for key in random.sample(sorted(wanted), 3):
        tree.insert(key, -1)
        wanted[key] = -1
    paths, seen = [], []
    for node, parent, way, number in tree.walk():
        paths.append((paths[parent] if parent >= 0 else b"") + way)
        assert number == len(paths) - 1
        if node.value is not None:
            seen.append((paths[-1], node.value))
    assert seen == sorted(wanted.items())
    room = max(node.room for node, *_ in tree.walk())
    assert room == next(r for r in (4, 16, 48, 256) if fan <= r)
