"""Near-duplicates by a chosen-path set similarity join.

A document's set holds its distinct word shingles. Documents with equal sets are one class. The
classes are the root of several independent trees. A node of a tree branches by a few minwise
tokens that its path chooses: classes whose minwise token agrees go on together. Two sets of
similarity s agree on a token with probability s, so a pair at the threshold of 0.8 that branches
twice a level has 1.6 common children on average and survives in some branch of some tree almost
surely, while pairs that are not alike part at once.

A node is compared exhaustively as soon as the pairs still open in it are few for its size: pairs
of classes that are not yet known to be connected. Larger nodes are linked to one leader first, so
that a group of thousands of near copies is connected by a linear number of comparisons; then they
branch. A node whose classes are all connected has nothing left to tell and ends. At the last level
all pairs that are still open are compared, so no candidate is ever dropped.

Rows carry a short form of their tokens, and a comparison is a condition of the join that meets a
node's rows: only pairs that are alike by it are ever written, not all that meet. Every link is
confirmed on the full sets, and no pair is confirmed twice.

Copies of one text that were edited in places of their own are alike in pairs, by the thousand, and
yet few pairs reach the threshold. For the classes that are still open in large nodes after the second
level and after later ones, the shingles that only one or two of them have are found in one pass over
their sets. What two sets have in common is bounded by the other, common shingles of each, and by the
rare ones that they share. So pairs that share rare shingles are looked at by themselves; and where the
common ones alone are too few, a class leaves its node and a pair is never met. This bound is exact: it
loses no link. The leader of a node is then the class with the least share of rare shingles.

Connected components come from rounds of minimum labels over the confirmed links, each written to
the shared folder.

Defined cases: a document with fewer words than a shingle has one shingle of all its words; without
words, or with a null text, it has none and is linked with nothing; equal keys are one document
with several texts, and share one component; a null key is linked with nothing, has a null
component and is kept; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from ledgerloom.llm.support import col, release_memory
from ledgerloom.session import at_most, stage

SHINGLE_WORDS = 5
THRESHOLD_PERCENT = 80
#: Independent trees, their levels, and the minwise tokens that a level chooses from.
TREES, LEVELS, POOL = 4, 4, 3
#: Tokens by which a node branches.
BRANCHES = 2
#: A node is compared exhaustively up to so many open pairs per class.
OPEN_PAIRS = 12
#: All nodes are compared exhaustively once the open pairs of the larger ones are so few per class.
REST_PAIRS = 5
#: A candidate pair agrees on this share of all tokens at least. For sets at the threshold that is
#: more than five standard deviations below what they agree on.
SKETCH_SHARE = 0.5
#: Most classes (under 100 bytes each) that are sent to every task.
BROADCAST_CLASSES = 400_000
#: The first level after which rare shingles of the open classes are found.
BOUND_LEVEL = 1
_TOKENS = TREES * LEVELS * POOL
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: The short form: the low bits of each token, so many tokens to a 64-bit integer.
SHORT_BITS, SHORT_TOKENS = 5, 12
SHORT = [f"short{i}" for i in range(-(-_TOKENS // SHORT_TOKENS))]
_TOP = sum(1 << (SHORT_BITS * i + SHORT_BITS - 1) for i in range(SHORT_TOKENS))
_LOW = sum((1 << (SHORT_BITS - 1)) - 1 << SHORT_BITS * i for i in range(SHORT_TOKENS))


# --- sets and sketches ------------------------------------------------------------------------

def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of one text."""
    # of bytes, lower() means A to Z and split() means blanks and the control codes 9 to 13
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(xxh3_64_intdigest, found), np.uint64, len(found))
    width = min(words, len(codes))
    total = np.zeros(len(codes) - width + 1, np.uint64)
    for place in range(width):
        total = _scramble(total * np.uint64(0x100000001B3) + codes[place:len(codes) - width + 1 + place])
    return np.unique(total)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SEEDS = (_MIX * np.arange(1, 2 * _TOKENS, 2, dtype=np.uint64))[:, None]


def minwise(shingles: np.ndarray) -> np.ndarray:
    """For each hash function, 32 bits of the least hash of the set."""
    least = np.full(_TOKENS, np.iinfo(np.uint64).max, np.uint64)
    for low in range(0, len(shingles), 4096):
        mixed = shingles[None, low:low + 4096] ^ _SEEDS
        mixed *= _SEEDS | np.uint64(1)
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        np.minimum(least, mixed.min(axis=1), out=least)
    return (_scramble(least) & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)


def short(tokens: np.ndarray) -> np.ndarray:
    """The short form of one set's tokens."""
    low = np.zeros(len(SHORT) * SHORT_TOKENS, np.int64)
    low[:len(tokens)] = tokens & ((1 << SHORT_BITS) - 1)
    return (low.reshape(-1, SHORT_TOKENS) << (SHORT_BITS * np.arange(SHORT_TOKENS))).sum(axis=1)


def digest(shingles: np.ndarray) -> str | None:
    if not len(shingles):
        return None
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).hexdigest()


def _texts(frames: Iterator[pd.DataFrame], words: int):
    release_memory()  # workers of earlier stages are used again
    for frame in frames:
        for low in range(0, len(frame), 500):
            part = frame.iloc[low:low + 500]
            yield part, [shingle_hashes(None if pd.isna(t) else t, words) for t in part["text"]]


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """Per row: doc_id, number of shingles, a digest of the set, its minwise tokens and their short
    form."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, found in _texts(frames, words):
            tokens = [minwise(s) if len(s) else None for s in found]
            brief = [short(t) if t is not None else [None] * len(SHORT) for t in tokens]
            yield pd.DataFrame({
                "doc_id": part["doc_id"].astype("Int64").to_numpy(dtype=object, na_value=None),
                "n_shingles": [len(s) for s in found],
                "digest": [digest(s) for s in found],
                "tokens": tokens,
                **{name: pd.array([b[i] for b in brief], "Int64") for i, name in enumerate(SHORT)},
            })

    return docs.mapInPandas(
        run, "doc_id long, n_shingles long, digest string, tokens array<int>, "
        + ", ".join(f"{name} long" for name in SHORT)
    )


def full_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(rep, shingles) of the staged `wanted` classes (rep, key, digest), from the texts again: sets
    are large and few are needed, so they are not kept for all rows. Up to BROADCAST_CLASSES of them
    go to the texts, which then do not move; beyond that both are shuffled."""

    return _of_texts(docs, wanted, words, "binary", lambda s: s.astype("<u8").tobytes())


def rare_shingles(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(a, b, rare): how many shingles only the classes a < b of the staged `wanted` ones have, or only
    a = b. Shingles are compared by 32 bits of their hash. Where two agree by chance they count as
    one of more owners, so no class seems to have more rare ones than it has."""
    narrow = _of_texts(
        docs, wanted, words, "array<int>", lambda s: (s & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
    ).select("rep", F.explode("shingles").alias("shingle"))
    owners = narrow.groupBy("shingle").agg(
        F.min("rep").alias("a"), F.max("rep").alias("b"), F.count("*").alias("_rows"))
    return owners.where("a = b or _rows = 2").groupBy("a", "b").agg(F.count("*").alias("rare"))


def _of_texts(docs: DataFrame, wanted: DataFrame, words: int, kind: str, form: Callable) -> DataFrame:
    """(rep, shingles) of the staged `wanted` classes (rep, key, digest), the sets as `form` writes them."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, found in _texts(frames, words):
            yield pd.DataFrame({"digest": [digest(s) for s in found], "shingles": [form(s) for s in found]})

    names = wanted.select("rep", "digest")
    keys = wanted.select(F.col("key").alias("doc_id")).distinct()
    if at_most(wanted, BROADCAST_CLASSES):
        names, keys = F.broadcast(names), F.broadcast(keys)
    picked = docs.join(keys, "doc_id", "left_semi").mapInPandas(run, f"digest string, shingles {kind}")
    return picked.join(names, "digest").select("rep", "shingles")


# --- components -------------------------------------------------------------------------------

def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in `links` (a, b): the least id that can be reached.

    Each round hands every id the least label among its neighbours and then lets labels jump to
    their own label, so that long chains close in few rounds."""
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).where("a != b")
    edges = stage(both.distinct(), "links")
    labels = edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("_least")).select(
        "id", F.least("id", "_least").alias("component")
    )
    while True:
        after = stage(_spread(edges, _spread(edges, labels)), "labels")
        # labels only ever fall, and stay the same in a round if and only if they are final
        same = _spread(edges, after).join(after.withColumnRenamed("component", "_old"), "id")
        if same.where("component != _old").isEmpty():
            return after
        labels = after


def _spread(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """One round: the least label among the neighbours, then that label's own label."""
    near = edges.join(labels.withColumnRenamed("id", "b"), "b").select(F.col("a").alias("id"), "component")
    least = near.union(labels).groupBy("id").agg(F.min("component").alias("component"))
    jump = labels.select(F.col("id").alias("component"), F.col("component").alias("_next"))
    return least.join(jump, "component", "left").select(
        "id", F.coalesce("_next", "component").alias("component")
    )


# --- the trees --------------------------------------------------------------------------------

#: What a row of a tree carries; `component` is what its class is known to belong to so far, `common`
#: how many of its shingles more than one other open class may have.
_ROW = ["rep", "tree", "node", "component", "n_shingles", "common", *SHORT]


def _branch(rows: DataFrame, level: int) -> DataFrame:
    """Each row once per token that its node chooses, without the tokens. The choice hangs on the
    path alone; every level has tokens of its own, so no path meets a token twice."""
    left_out = F.pmod(F.xxhash64("node", F.lit(level)), F.lit(POOL))
    places = F.transform(
        F.sequence(F.lit(1), F.lit(BRANCHES)), lambda i: F.pmod(left_out + i, F.lit(POOL))
    )
    first = F.col("tree") * (LEVELS * POOL) + level * POOL + 1
    token = F.element_at("tokens", (first + F.col("_place")).cast("int"))
    return (
        rows.select(*_ROW, "tokens", F.explode(places).alias("_place"))
        .withColumn("node", F.xxhash64("node", "_place", token)).select(*_ROW)
    )


def _labelled(rows: DataFrame, label: DataFrame) -> DataFrame:
    """With the component that each class is known to belong to by now."""
    known = label.select(F.col("id").alias("rep"), F.col("component").alias("_known"))
    return rows.join(known, "rep", "left").withColumn(
        "component", F.coalesce("_known", "component")
    ).drop("_known")


def _alike(percent: int) -> Column:
    """What the sizes and the short forms of two rows (x_, y_) allow. Equal tokens have equal short
    forms, so every pair that `_promising` lets through is let through here."""
    def unequal(name: str) -> Column:
        # the top bit of each field is set if and only if the fields differ; no sum leaves its field
        both = F.col(f"x_{name}").bitwiseXOR(F.col(f"y_{name}"))
        filled = (both.bitwiseAND(F.lit(_LOW)) + F.lit(_LOW)).bitwiseOR(both)
        return F.bit_count(filled.bitwiseAND(F.lit(_TOP)))

    differ = unequal(SHORT[0])
    for name in SHORT[1:]:
        differ = differ + unequal(name)
    sizes = F.col("x_n_shingles"), F.col("y_n_shingles")
    common = F.least("x_common", "y_common")
    return (
        (100 * F.least(*sizes) >= percent * F.greatest(*sizes)) & _enough(common, *sizes, percent)
        & (differ <= F.lit(int(_TOKENS - SKETCH_SHARE * _TOKENS)))
    )


def _enough(common: Column, one: Column, other: Column, percent: int) -> Column:
    """Whether two sets of these sizes can be similar enough with at most `common` equal shingles."""
    return (100 + percent) * common >= percent * (one + other)


def _bounded(rows: DataFrame, rare: DataFrame) -> DataFrame:
    """With `common` from what each class has rare."""
    of_each = rare.select(F.col("a").alias("rep"), "rare").union(
        rare.where("a != b").select("b", "rare")).groupBy("rep").agg(F.sum("rare").alias("_rare"))
    common = F.col("n_shingles") - F.coalesce("_rare", F.lit(0))
    return rows.join(of_each, "rep", "left").withColumn("common", common).drop("_rare")


def _by_rare(rows: DataFrame, rare: DataFrame, percent: int) -> DataFrame:
    """The open pairs that share rare shingles, if these and their common ones are enough."""
    of = rows.select("rep", "component", "n_shingles", "common").distinct()
    left, right = (of.select(*[F.col(c).alias(f"{s}_{c}") for c in of.columns]) for s in "xy")
    # a partner has at least `percent` of their own size
    enough = 100 * (F.col("x_common") + F.col("rare")) >= percent * F.col("x_n_shingles")
    one = rare.where("a != b").join(left, (F.col("a") == F.col("x_rep")) & enough)
    common = F.least("x_common", "y_common") + F.col("rare")
    return one.join(right, (F.col("b") == F.col("y_rep")) & (F.col("x_component") != F.col("y_component"))
                    & _enough(common, F.col("x_n_shingles"), F.col("y_n_shingles"), percent)).select("a", "b")


def _linkable(rows: DataFrame, percent: int) -> DataFrame:
    """The rows whose common shingles are enough for some partner in their node. A partner has at least
    `percent` of their own size, and no less than the node's least set."""
    least = rows.groupBy("node").agg(F.min("n_shingles").alias("_least"))
    partner = F.greatest(F.col("_least").cast("double"), percent * F.col("n_shingles") / 100)
    return rows.join(least, "node").where(
        _enough(F.col("common"), F.col("n_shingles"), partner, percent)
    ).drop("_least")


def _side(rows: DataFrame, side: str, *more: str) -> DataFrame:
    """The rows as one side of a comparison within their nodes. Without a bound on what a row has in
    common with others, all its shingles may be."""
    if "common" not in rows.columns:
        rows = rows.withColumn("common", F.col("n_shingles"))
    compared = ["rep", "component", "n_shingles", "common", *SHORT, *more]
    return rows.select("node", *[F.col(c).alias(f"{side}_{c}") for c in compared])


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _open_nodes(marked: DataFrame, level: int, fresh: bool) -> DataFrame:
    """Nodes that hold more than one component: size, a leader, the largest component, and the
    number of open pairs (of classes that are not known to be connected)."""
    order = F.struct((1 - F.col("common") / F.col("n_shingles")).alias("rare"), F.xxhash64("rep", F.lit(level)).alias("o"))
    if fresh:  # each class is a component of its own
        nodes = marked.groupBy("node").agg(
            F.count("*").alias("size"), F.min_by("rep", order).alias("leader"),
            F.count("*").alias("_parts"), F.count("*").alias("_together"),
        ).withColumn("major", F.col("leader"))
    else:
        parts = marked.groupBy("node", "component").agg(
            F.count("*").alias("_n"), F.min(F.struct(order.alias("o"), F.col("rep"))).alias("_first")
        )
        nodes = parts.groupBy("node").agg(
            F.sum("_n").alias("size"), F.min("_first").getField("rep").alias("leader"),
            F.count("*").alias("_parts"), F.sum(F.col("_n") * F.col("_n")).alias("_together"),
            F.max_by("component", F.struct("_n", "component")).alias("major"),
        )
    open_pairs = ((F.col("size") * F.col("size") - F.col("_together")) / 2).alias("open")
    return nodes.where("_parts > 1").select("node", "size", "leader", "major", open_pairs)


def _exhaustive(rows: DataFrame, percent: int) -> DataFrame:
    """The open pairs of each node that are alike. Rows outside the node's largest component are few,
    and each meets all rows of its node; pairs within the largest component need no look."""
    minor, every = _side(rows.where("component != major"), "x"), _side(rows, "y", "major")
    once = (F.col("y_component") == F.col("y_major")) | (F.col("x_rep") < F.col("y_rep"))
    return minor.join(every, "node").where(
        (F.col("x_component") != F.col("y_component")) & once & _alike(percent)
    ).select(*_pair("x_rep", "y_rep"))


def _to_leader(rows: DataFrame, percent: int) -> DataFrame:
    """Each class of a large node against the node's leader, if they are alike."""
    leaders, others = _side(rows.where("rep = leader"), "x"), _side(rows.where("rep != leader"), "y")
    return others.join(leaders, "node").where(_alike(percent)).select(*_pair("x_rep", "y_rep"))


def _promising(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs that their sizes and all their tokens allow."""
    left = classes.select(
        F.col("rep").alias("a"), F.col("n_shingles").alias("_na"), F.col("tokens").alias("_ta")
    )
    right = classes.select(
        F.col("rep").alias("b"), F.col("n_shingles").alias("_nb"), F.col("tokens").alias("_tb")
    )
    equal = F.aggregate(
        F.zip_with("_ta", "_tb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x
    )
    return (
        pairs.join(left, "a").join(right, "b")
        .where(100 * F.least("_na", "_nb") >= percent * F.greatest("_na", "_nb"))
        .where(equal >= SKETCH_SHARE * _TOKENS).select("a", "b")
    )


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    @F.pandas_udf("boolean")
    def similar(one: pd.Series, other: pd.Series) -> pd.Series:
        result = []
        for x, y in zip(one, other, strict=True):
            a, b = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
            common = len(np.intersect1d(a, b, assume_unique=True))
            result.append(100 * common >= percent * (len(a) + len(b) - common))
        return pd.Series(result, dtype=bool)

    first = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("_sa"))
    second = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("_sb"))
    return pairs.join(first, "a").join(second, "b").where(similar("_sa", "_sb")).select("a", "b")


def links(docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """Confirmed links between classes (rep, key, digest, n_shingles, tokens and their short form),
    enough of them to connect all that any candidate pair connects."""
    spark = docs.sparkSession
    trees = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    rows = classes.select("rep", "tokens", "n_shingles", *SHORT, trees).withColumns(
        {"node": F.xxhash64("tree"), "component": F.col("rep"), "common": F.col("n_shingles")})
    found = tested = spark.createDataFrame([], "a long, b long")
    sets = label = beside = None
    few = REST_PAIRS * classes.count()
    for level in range(LEVELS):
        marked = _branch(rows, level)
        nodes = _open_nodes(marked, level, label is None)
        rows = stage(marked.join(nodes, "node"), "nodes")
        small = F.col("open") <= OPEN_PAIRS * F.col("size")
        # each row of a node carries its share of the node's open pairs
        rest = rows.where(~small).agg(F.sum(F.col("open") / F.col("size"))).first()[0] or 0.0
        last = level == LEVELS - 1 or rest <= few
        pairs = _exhaustive(rows if last else rows.where(small), percent)
        if not last:
            pairs = pairs.union(_to_leader(rows.where(~small), percent))
        if beside is not None:
            pairs = pairs.union(beside)
        # pairs that an earlier level has confirmed or refused need no second look
        pairs = pairs.distinct().join(tested, ["a", "b"], "left_anti")
        pairs = stage(_promising(pairs, classes, percent), "pairs")
        tested = tested.union(pairs)
        paired = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct()
        reps = paired if sets is None else paired.join(sets.select("rep"), "rep", "left_anti")
        wanted = stage(classes.select("rep", "key", "digest").join(reps, "rep"), "wanted")
        if not wanted.isEmpty():
            fetched = stage(full_sets(docs, wanted, words).dropDuplicates(["rep"]), "sets")
            sets = fetched if sets is None else sets.union(fetched)
        if sets is not None:
            # sets that this level has no pair for stay out of its shuffle
            needed = sets.join(paired, "rep", "left_semi")
            new = stage(_confirmed(pairs, needed, percent), "links")
            found = found.union(new)
        if last:
            break
        # without a pair so far, the large nodes are still open and branch
        if sets is not None and not new.isEmpty():
            label = components(found)
        large = rows.where(~small).select(*_ROW)
        if label is not None:
            large = _labelled(large, label)
        large = stage(large, "large")
        if label is not None:
            still = _open_nodes(large, level, False).select("node")
            large = stage(large.join(still, "node", "left_semi"), "open")
        if level >= BOUND_LEVEL:
            reps = large.select("rep").distinct()
            wanted = stage(classes.select("rep", "key", "digest").join(reps, "rep"), "wanted")
            rare = stage(rare_shingles(docs, wanted, words), "rare")
            large = stage(_bounded(large, rare), "large")
            beside = _by_rare(large, rare, percent)
            large = _linkable(large, percent)
        rows = large.join(classes.select("rep", "tokens"), "rep")
    return found


# --- the operator -----------------------------------------------------------------------------

def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS,
                    percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the least key reachable), kept.

    The trees and the sketch share are made for `THRESHOLD_PERCENT`; below it they would miss
    links, so lower values are refused."""
    if not THRESHOLD_PERCENT <= percent <= 100:
        raise ValueError(f"percent must be from {THRESHOLD_PERCENT} to 100, not {percent}")
    texts = docs.select(col("doc_id").cast("long").alias("doc_id"), col("text").alias("text"))
    rows = stage(sketches(texts, words), "sketches")
    known = rows.where("doc_id is not null and digest is not null")
    # one row stands for each class: the narrow minimum finds it, so hot classes combine early
    position = F.struct("doc_id", F.monotonically_increasing_id().alias("place"))
    placed = stage(known.select("digest", "n_shingles", "tokens", *SHORT, position.alias("at")), "placed")
    first = placed.groupBy("digest").agg(F.min("at").alias("at"))
    classes = stage(
        placed.join(first, ["digest", "at"]).select(
            F.col("at.place").alias("rep"), F.col("at.doc_id").alias("key"),
            "digest", "n_shingles", "tokens", *SHORT,
        ), "classes"
    )
    found = links(texts, classes, words, percent)
    names = classes.select("rep", "key")
    between = (
        found.join(names.select(F.col("rep").alias("a"), F.col("key").alias("_a")), "a")
        .join(names.select(F.col("rep").alias("b"), F.col("key").alias("_b")), "b")
        .select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    )
    members = known.select("doc_id", "n_shingles", "digest").join(
        classes.select("digest", "key"), "digest"
    )
    several = members.groupBy("doc_id").agg(
        F.min("key").alias("a"), F.max("key").alias("_max"), F.collect_set("key").alias("_keys")
    ).where("a != _max").select("a", F.explode("_keys").alias("b"))
    label = components(between.union(several)).withColumnRenamed("id", "key")
    linked = members.join(label, "key", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "key").alias("component_id")
    )
    alone = rows.where("doc_id is null or digest is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return linked.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
