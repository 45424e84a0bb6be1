"""Approximate nearest neighbours by a few stable projections and a kd-tree.

Vectors are normalised, so that cosine and distance order alike, and projected to a few dimensions
with Gaussian (2-stable) weights: the squared projected distance of two vectors, divided by their
squared distance, follows a chi-square law with as many degrees of freedom as there are
projections. A kd-tree over the projections, fitted on a bounded sample, cuts the table into cells;
every vector is in one cell. A query visits cells in the order of their projected distance, some at
a time, and verifies every vector in them by its exact cosine. It stops when the chi-square test
says that a vector as near as its present k-th neighbour would already have been seen with the
wanted confidence. Queries that have not stopped go on; at the last cell the search is exact.

The queries are dealt to the cells they visit, so a round is one join of queries and cells, worked
off cell by cell. Cells that hold far more rows than others are cut into slices.

Equal vectors are one candidate that carries its smallest ids, as many as a result can name, so a
vector that a third of the rows share costs no more than any other.

Defined cases: vectors that are null, zero or hold null or non-finite components take no part, as
queries or candidates; ties go to the smaller id; a query gets all candidates if there are fewer
than k; rows with equal ids are candidates of one another only if their ids differ; an empty table
gives an empty result; vectors of different lengths are compared with those of their own length
only. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.support import col
from ledgerloom.session import stage

K = 5
#: Projected dimensions.
DIMENSIONS = 8
#: The stopping test's confidence for each single neighbour.
CONFIDENCE = 0.99
#: Bound of the sample that the tree is fitted on, and rows wanted in a cell.
SAMPLE = 20_000
CELL_ROWS = 500
#: The deepest tree: 2 to this power cells.
MOST_LEVELS = 14
#: Cells that a query visits in its first round; each next round doubles them.
FIRST_CELLS = 8
#: Rows of one slice of a cell.
SLICE_ROWS = 5_000


def chi_square(x: np.ndarray, degrees: int) -> np.ndarray:
    """The distribution function for an even number of degrees of freedom."""
    half = np.asarray(x, float) / 2
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, degrees // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def projection(size: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    return np.random.default_rng(20_240).standard_normal((size, dimensions))


# --- the tree ---------------------------------------------------------------------------------

@dataclass(frozen=True)
class Tree:
    """Cuts in heap order: node i goes left below `value[i]` in dimension `axis[i]`. Cells are
    numbered from left to right; `low` and `high` are their boxes."""

    levels: int
    axis: np.ndarray
    value: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def cell(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        for _ in range(self.levels):
            right = points[np.arange(len(points)), self.axis[node]] >= self.value[node]
            node = 2 * node + 1 + right
        return node - (len(self.axis))

    def distances(self, points: np.ndarray) -> np.ndarray:
        """Squared distance of each point to each cell's box."""
        total = np.zeros((len(points), len(self.low)))
        for d in range(points.shape[1]):
            x = points[:, d:d + 1]
            gap = np.maximum(np.maximum(self.low[:, d] - x, x - self.high[:, d]), 0)
            total += gap * gap
        return total


def fit_tree(sample: np.ndarray, rows: int) -> Tree:
    """Median cuts of the widest dimension, until a cell holds about CELL_ROWS of `rows`."""
    dims = sample.shape[1]
    levels = max(0, min(MOST_LEVELS, math.ceil(math.log2(max(rows / CELL_ROWS, 1)))))
    inner = (1 << levels) - 1
    axis, value = np.zeros(inner, np.int64), np.zeros(inner)
    parts, lows, highs = [sample], [np.full(dims, -np.inf)], [np.full(dims, np.inf)]
    node = 0
    for _ in range(levels):
        next_parts, next_lows, next_highs = [], [], []
        for part, low, high in zip(parts, lows, highs, strict=True):
            d = int(np.argmax(np.ptp(part, axis=0))) if len(part) else 0
            cut = float(np.median(part[:, d])) if len(part) else 0.0
            axis[node], value[node] = d, cut
            node += 1
            left_high, right_low = high.copy(), low.copy()
            left_high[d], right_low[d] = min(high[d], cut), max(low[d], cut)
            below = part[:, d] < cut
            next_parts += [part[below], part[~below]]
            next_lows += [low, right_low]
            next_highs += [left_high, high]
        parts, lows, highs = next_parts, next_lows, next_highs
    return Tree(levels, axis, value, np.array(lows), np.array(highs))


# --- preparing --------------------------------------------------------------------------------

def usable(vector: Column) -> Column:
    """Neither null nor zero, and all components present and finite."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(doubles, lambda x: x != 0)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array([np.asarray(v, float) for v in column], dtype=float).reshape(len(column), -1)


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def distinct_vectors(vectors: DataFrame, key: str, vector: str, keep: int) -> DataFrame:
    """Per different vector: its `keep` smallest ids. Rows of one vector are combined by task
    first: ids beyond the smallest of a task cannot be among the smallest of all."""
    whole = F.transform(col(vector), lambda x: x.cast("double") + F.lit(0.0))
    rows = vectors.select(col(key).cast("long").alias("id"), whole.alias("vector")).where(
        usable(F.col("vector")) & F.col("id").isNotNull()
    )
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(64)))
    few = salted.groupBy("vector", "_salt").agg(F.collect_set("id").alias("ids"))
    few = few.select("vector", F.slice(F.array_sort("ids"), 1, keep).alias("ids"))
    merged = few.groupBy("vector").agg(F.flatten(F.collect_list("ids")).alias("ids"))
    return merged.select("vector", F.slice(F.array_sort("ids"), 1, keep).alias("ids"))


# --- searching --------------------------------------------------------------------------------

def nearest(vectors: DataFrame, is_query: Column, k: int = K, key: str = "vec_id",
            vector: str = "embedding", confidence: float = CONFIDENCE) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest other rows of each query row.

    `is_query` is a condition on the column `id`."""
    spark = vectors.sparkSession
    rows = stage(
        distinct_vectors(vectors, key, vector, k + 1).withColumn("size", F.size("vector")), "vectors"
    )
    lengths = sorted(r["size"] for r in rows.select("size").distinct().collect())
    queries = vectors.select(col(key).cast("long").alias("id"), col(vector).alias("vector")).where(
        is_query & usable(F.col("vector"))
    ).select("id", F.transform("vector", lambda x: x.cast("double") + F.lit(0.0)).alias("vector"))
    queries = stage(queries.dropDuplicates(["id", "vector"]), "queries")
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for size in lengths:
        empty = empty.union(_search(
            rows.where(F.col("size") == size), queries.where(F.size("vector") == size),
            size, k, confidence,
        ))
    return empty


def _search(rows: DataFrame, queries: DataFrame, size: int, k: int, confidence: float) -> DataFrame:
    count = rows.count()
    share = min(1.0, 1.2 * SAMPLE / max(count, 1))
    sample = rows.where(F.rand(7) < share).limit(SAMPLE) if share < 1 else rows.limit(SAMPLE)
    weights = projection(size)
    tree = fit_tree(_unit(_matrix(sample.select("vector").toPandas()["vector"])) @ weights, count)

    @F.pandas_udf("int")
    def cell_of(batch: pd.Series) -> pd.Series:
        return pd.Series(tree.cell(_unit(_matrix(batch)) @ weights).astype("int32"))

    placed = rows.withColumn("cell", cell_of("vector"))
    sizes = placed.groupBy("cell").count().collect()  # a row per cell, whose number is bounded
    slices = {r["cell"]: -(-r["count"] // SLICE_ROWS) for r in sizes}
    most = max(slices.values(), default=1)
    slice_of = F.pmod(F.xxhash64("vector"), F.lit(most))
    if any(n > 1 for n in slices.values()):
        cut = F.element_at(F.create_map(*[F.lit(x) for c, n in slices.items() for x in (c, n)]), F.col("cell"))
        slice_of = F.pmod(F.xxhash64("vector"), cut)
    cells = stage(placed.withColumn("slice", slice_of.cast("int")), "cells")

    def visit(frames: Iterator[pd.DataFrame], first: int, last: int) -> Iterator[pd.DataFrame]:
        """The cells of ranks first to last of each query, once per slice."""
        for frame in frames:
            if not len(frame):
                continue
            far = tree.distances(_unit(_matrix(frame["vector"])) @ weights)
            order = np.argsort(far, axis=1, kind="stable")[:, first:last]
            for i, near in enumerate(order):
                at = [(c, s) for c in near.tolist() for s in range(slices.get(c, 0))]
                yield pd.DataFrame({
                    "id": frame["id"].iloc[i], "vector": [frame["vector"].iloc[i]] * len(at),
                    "cell": pd.Series([c for c, _ in at], dtype="int32"),
                    "slice": pd.Series([s for _, s in at], dtype="int32"),
                })

    def compare(asked: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        """The k best of one slice for each query that visits it, by exact cosine."""
        if not len(asked) or not len(there):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        base = _unit(_matrix(there["vector"]))
        ids = [np.asarray(i) for i in there["ids"]]
        out = []
        for low in range(0, len(asked), 256):
            part = asked.iloc[low:low + 256]
            scores = _unit(_matrix(part["vector"])) @ base.T
            wide = min(2 * k + 2, scores.shape[1])
            best = np.argpartition(-scores, wide - 1, axis=1)[:, :wide]
            for i, query in enumerate(part["id"]):
                least = scores[i, best[i]].min()
                tied = np.flatnonzero(scores[i] >= least - 1e-12)
                found = [(-scores[i, j], int(x)) for j in tied for x in ids[j] if x != query]
                found.sort()
                out += [(query, x, -s) for s, x in found[:k]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    def stopped(frame: pd.DataFrame, seen: int) -> pd.Series:
        """Whether the chi-square test holds for the k-th cosine after `seen` cells."""
        far = np.sort(tree.distances(_unit(_matrix(frame["vector"])) @ weights), axis=1)
        nextly = far[:, seen] if seen < far.shape[1] else np.full(len(frame), np.inf)
        distance = np.maximum(2 - 2 * frame["kth"].fillna(-1.0).to_numpy(), 1e-12)
        return pd.Series(chi_square(nextly / distance, DIMENSIONS) >= confidence)

    total = 1 << tree.levels
    open_, best, first, width = queries, None, 0, FIRST_CELLS
    done = []
    while True:
        last = min(first + width, total)
        visits = open_.select("id", "vector").mapInPandas(
            lambda frames, a=first, b=last: visit(frames, a, b),
            "id long, vector array<double>, cell int, slice int",
        )
        found = visits.groupBy("cell", "slice").cogroup(cells.groupBy("cell", "slice")).applyInPandas(
            compare, "query_id long, vec_id long, score double"
        )
        found = found if best is None else found.union(best)
        best = stage(_top(found, k), "neighbours")
        if last == total:
            return _ranked([*done, best], k)
        kth = best.groupBy("query_id").agg(
            F.when(F.count("*") >= k, F.min("score")).alias("kth")
        ).withColumnRenamed("query_id", "id")
        test = F.pandas_udf(
            lambda v, s, n=last: stopped(pd.DataFrame({"vector": v, "kth": s}), n), "boolean"
        )
        judged = stage(
            open_.select("id", "vector").join(kth, "id", "left")
            .withColumn("stop", test("vector", "kth")), "judged"
        )
        open_ = judged.where("not stop")
        over = best.join(judged.where("stop").select(F.col("id").alias("query_id")), "query_id", "left_semi")
        done.append(over)
        if open_.isEmpty():
            return _ranked(done, k)
        best = best.join(open_.select(F.col("id").alias("query_id")), "query_id", "left_semi")
        first, width = last, 2 * width


def _top(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query; at most k rows a slice come in."""
    pairs = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = F.struct((-F.col("score")).alias("s"), "vec_id")
    lists = pairs.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(order)), 1, k).alias("l"))
    return lists.select("query_id", F.explode("l").alias("e")).select(
        "query_id", "e.vec_id", (-F.col("e.s")).alias("score")
    )


def _ranked(parts: list[DataFrame], k: int) -> DataFrame:
    every = parts[0]
    for part in parts[1:]:
        every = every.union(part)
    order = F.struct((-F.col("score")).alias("s"), "vec_id")
    lists = every.groupBy("query_id").agg(F.array_sort(F.collect_list(order)).alias("l"))
    return lists.select("query_id", F.posexplode("l").alias("p", "e")).select(
        "query_id", (F.col("p") + 1).alias("rank"), "e.vec_id", (-F.col("e.s")).alias("score")
    )
