"""Vector codes against a plain all-against-all version."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import block_codebooks as bc

SCHEMA = "vec_id long, embedding array<float>, label int, `label_error` int, id string"


def plain(rows):
    """code, error, label_error per row and the digest, by comparing every part with every entry."""
    fine = [(i, [math.floor(256 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in fine), default=0) // 16) * 16
    fine = [(i, v + [0] * (width - len(v)), lab) for i, v, lab in fine]
    size = width // 16
    cut = [[v[p * size:(p + 1) * size] for p in range(16)] for _, v, _ in fine]
    first = sorted(range(len(fine)), key=lambda r: (fine[r][0] is None, fine[r][0] or 0, fine[r][1]))[:64]
    books = [[cut[r][p] for r in first] for p in range(16)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), j) for j, e in enumerate(book))

    for _ in range(2):
        for p in range(16):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(c[p], books[p])[1], []).append(c[p])
            books[p] = [
                [sum(x) // len(groups[j]) for x in zip(*groups[j])] if j in groups else e
                for j, e in enumerate(books[p])
            ]
    out = []
    for (i, v, lab), c in zip(fine, cut):
        near = [nearest(c[p], books[p]) for p in range(16)]
        out.append((i, lab, "".join(f"{j:02x}" for _, j in near), sum(d for d, _ in near)))
    totals = {}
    for _, lab, _, error in out:
        totals[lab] = totals.get(lab, 0) + error
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, code, error, totals[lab], digest) for i, lab, code, error in out), key=repr)


def coded(spark, rows, parts=3):
    df = spark.createDataFrame([(i, v, lab, 1, "x") for i, v, lab in rows], SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in bc.compress(df).drop("label").collect()), key=repr)


@pytest.mark.parametrize("width", [32, 40])
def test_codes_equal_all_against_all(spark, monkeypatch, width):
    monkeypatch.setattr(bc, "CHUNK_ROWS", 150)
    random.seed(width)
    rows = [(i, [random.choice([-1.5, -0.25, 0.0, 0.3, random.gauss(0, 1)]) for _ in range(width)],
             random.choice([None, 1, 1, 1, 2, 3])) for i in range(300)]
    rows += [(500 + i, list(rows[7][1]), 1) for i in range(200)]  # copies of one vector
    rows += [(7, list(rows[8][1]), 2), (7, list(rows[7][1]), 2), (None, list(rows[9][1]), 4)]
    rows += [(900, None, 1), (901, [None] + [0.0] * (width - 1), 1), (902, [math.nan] * width, 1),
             (903, [math.inf] * width, 1), (904, [0.5] * 3, None), (905, [], 9)]
    assert coded(spark, rows) == plain(rows)


def test_few_rows_empty_tables_and_large_components(spark):
    few = [(3, [0.1] * 16, None), (1, [-0.1] * 16, None), (2, [0.1] * 16, 5)]
    assert coded(spark, few) == plain(few)
    assert coded(spark, []) == []
    assert coded(spark, [(1, None, 1)]) == []
    assert coded(spark, [(1, [], 1), (2, [], 1)]) == plain([(1, [], 1), (2, [], 1)])
    with pytest.raises(ValueError, match="too large"):
        coded(spark, [(1, [1e30] * 16, 1)])


def test_shortlists_never_lose_a_nearest_entry():
    rng = np.random.default_rng(5)
    points = rng.integers(-300, 300, (4000, 4))
    points = points[np.argsort(bc.hilbert(points), kind="stable")].reshape(-1, bc.BLOCK, 4)
    entries = rng.integers(-300, 300, (64, 4))
    kept = bc.shortlists(points.min(axis=1), points.max(axis=1), entries)
    far = ((points[:, :, None, :] - entries) ** 2).sum(axis=-1)
    code, distance = bc.kernel(points, kept, entries)
    assert (code == far.argmin(axis=2)).all() and (distance == far.min(axis=2)).all()
    assert kept.mean() < 0.5  # the boxes leave less than half of the entries


def test_hilbert_neighbours_touch():
    grid = np.stack(np.meshgrid(np.arange(8), np.arange(8)), axis=-1).reshape(-1, 2)
    walk = grid[np.argsort(bc.hilbert(grid))]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_no_exchange_moves_vectors(spark):
    df = spark.range(100).select(
        F.col("id").alias("id"), F.lit(1).alias("label"), F.array(*[F.rand(i) for i in range(16)]).alias("vector"))
    plan = bc.make_chunks(df, 16)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
