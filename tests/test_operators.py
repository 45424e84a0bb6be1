import datetime as dt
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerloom.operators import (
    carry,
    grouping,
    heavy,
    joins,
    keyed,
    matching,
    profile,
    quantile,
    ranges,
    sequence,
)

DAY = dt.date(2024, 1, 1)


def test_keep_first_prefers_known_times_and_treats_null_keys_as_equal(spark):
    df = spark.createDataFrame(
        [("a", None, 1), ("a", 5, 2), ("a", 3, 3), (None, 1, 4), (None, 2, 5)],
        "k string, t int, id int",
    )
    kept = keyed.keep_first(df, ["k"], [F.col("t").asc_nulls_last(), F.col("id")])
    assert rows(kept, "id") == [(3,), (4,)]


def test_keep_first_limits_rows_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id")
    plan = keyed.keep_first(df, ["k"], [F.col("id")])._jdf.queryExecution().executedPlan()
    below = plan.toString().split("Exchange")[1]
    assert "WindowGroupLimit" in below


def test_duplicate_rows_counts_composite_keys_with_nulls(spark):
    df = spark.createDataFrame(
        [(1, None), (1, None), (1, 2), (2, None), (None, None), (None, None)], "a int, b int"
    )
    assert tuple(keyed.duplicate_rows(df, ["a", "b"]).first()) == (6, 4, 2)


def test_dangling_counts_rows_and_ignores_null(spark):
    df = spark.createDataFrame([(1,), (9,), (9,), (None,)], "m int")
    people = spark.createDataFrame([(1,), (None,)], "id int")
    assert rows(keyed.dangling(df, "m", people, "id")) == [(9, 2)]


def test_label_counts(spark):
    df = spark.createDataFrame([("a;b",), ("a",), ("",), (None,)], "f string")
    assert rows(keyed.label_counts(df, "f")) == [("a", 2), ("b", 1)]


def test_dense_key_is_dense_and_ordered_over_many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).selectExpr("id * 7919 % 5000 AS k", "id AS payload").repartition(7)
        got = sequence.dense_key(df, "key", ["k"]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(r["key"] for r in got) == list(range(1, 5001))
    assert all(r["key"] == r["k"] + 1 for r in got)


def test_dense_key_of_an_empty_table(spark):
    assert sequence.dense_key(spark.range(0), "key", ["id"]).count() == 0


def test_lookup_join_never_adds_rows(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "z")], "id int, k string")
    names = spark.createDataFrame([("a", "x", 2), ("a", "y", 1), ("b", "z", 3)],
                                  "code string, name string, seq int")
    joined = joins.lookup_join(facts, names, {"k": "code"}, {"name": "label"},
                               order_by=[F.col("seq")])
    assert rows(joined) == [(1, "a", "y"), (2, "b", "z"), (3, None, None), (4, "z", None)]
    assert tuple(joins.grain_check(facts, joined, "label").first()) == (4, 4, 2, True)


def _versions(spark):
    data = []
    for key in range(6):
        cuts = [DAY + dt.timedelta(days=40 * i + key) for i in range(key + 1)]
        ends = [*cuts[1:], dt.date(9999, 12, 31)]
        data += [(key, a, b, b.year == 9999, key * 100 + i)
                 for i, (a, b) in enumerate(zip(cuts, ends, strict=True))]
    return data, spark.createDataFrame(
        data, "k int, valid_from date, valid_to date, is_current boolean, v int"
    )


def test_as_of_join_equals_brute_force_on_both_paths(spark):
    """A third of the facts share one key; some have no key, no day or no version yet."""
    data, versions = _versions(spark)
    rng = random.Random(7)
    facts = []
    for i in range(900):
        key = 5 if i % 3 == 0 else rng.choice([0, 1, 2, 3, 4, 5, 77, None])
        day = None if i % 50 == 0 else DAY + dt.timedelta(days=rng.randrange(-60, 400))
        facts.append((i, key, day))

    def expected(key, day):
        own = [r for r in data if r[0] == key]
        hit = [r[4] for r in own if day is not None and r[1] <= day < r[2]]
        return hit[0] if hit else next((r[4] for r in own if r[3]), None)

    want = sorted(((i, k, d, expected(k, d)) for i, k, d in facts), key=repr)
    df = spark.createDataFrame(facts, "id int, k int, d date")
    for limit in (1000, 0):
        got = joins.as_of_join(df, versions, key="k", day="d", version_key="k", value="v",
                               name="then", broadcast_rows=limit)
        assert rows(got) == want


def _match(raises, closes):
    """Every closing of the same project at or after the raise and before the next raise."""
    result = []
    for r in raises:
        later = [x for x in raises if x[1] == r[1] and x[1] is not None and x[2] is not None
                 and r[2] is not None and (x[2], x[0]) > (r[2], r[0])]
        end = min((x[2] for x in later), default=None)
        fitting = [c for c in closes if c[1] == r[1] and r[1] is not None
                   and c[2] is not None and r[2] is not None and c[2] >= r[2]
                   and (end is None or c[2] < end)]
        best = min(fitting, key=lambda c: (c[2], c[0]), default=None)
        result.append((r[0], best[2] if best else None, best[3] if best else None))
    return sorted(result, key=repr)


def test_match_following_equals_brute_force(spark):
    """One project holds most events; times repeat, and keys and times may be missing."""
    rng = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    events = []
    for i in range(600):
        project = rng.choice(["hot", "hot", "hot", "a", "b", None])
        at = None if rng.random() < 0.03 else base + dt.timedelta(hours=rng.randrange(24 * 12))
        kind = rng.choice(["raise", "close", "other"])
        events.append((i, project, at, f"u{i}", kind))
    df = spark.createDataFrame(events, "id int, p string, t timestamp, who string, kind string")
    got = matching.match_following(
        df, opens=F.col("kind") == "raise", closes=F.col("kind") == "close",
        key="p", time="t", row_id="id", open_fields=["kind"], close_fields=["who"],
    )
    want = _match([e for e in events if e[4] == "raise"], [e for e in events if e[4] == "close"])
    assert rows(got, "id", "closed_at", "who") == want


@pytest.mark.parametrize("limit", [10**6, 0])
def test_quantiles_equal_numpy_on_both_paths(spark, limit):
    rng = random.Random(1)
    data = [(k, round(rng.gauss(50, 20), 2)) for k in ("hot",) * 2000 + ("a",) * 5 + ("b",)]
    data += [("hot", None), (None, 3.0), (None, 5.0)]
    df = spark.createDataFrame(data, "k string, v double").repartition(5)
    got = {r["k"]: r["q"] for r in quantile.quantiles_by(
        df, "k", "v", [0.0, 0.25, 0.5, 0.99, 1.0], "q", limit).collect()}
    for key in ("hot", "a", "b", None):
        values = [v for k, v in data if k == key and v is not None]
        assert got[key] == pytest.approx(np.quantile(values, [0.0, 0.25, 0.5, 0.99, 1.0]))


def test_top_n_with_other(spark):
    df = spark.createDataFrame([("a", 5), ("b", 4), ("c", 4), ("d", 1), (None, 2)], "k string, m int")
    assert rows(grouping.top_n_with_other(df, "k", "m", 2, "label")) == [
        ("Other", 7), ("a", 5), ("b", 4)
    ]


def test_cross_table_fills_missing_pairs(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y")], "r string, c string")
    assert rows(grouping.cross_table(df, "r", "c", ["x", "y"])) == [("a", 2, 0), ("b", 0, 1)]


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, m int")
    assert rows(grouping.share_of_total(df, "m", "pct")) == [("a", 1, 25.0), ("b", 3, 75.0)]


def test_profile_and_summary(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (4, "y")], "n int, s string")
    assert rows(profile.table_profile(df)) == [("n", 3, 0), ("s", 3, 1)]
    row = profile.numeric_summary(df, ["n"]).first().asDict()
    assert row == {"column_name": "n", "count": 3, "mean": 2.33, "std": 1.53, "min": 1.0,
                   "p25": 1.5, "p50": 2.0, "p75": 3.0, "max": 4.0}


def test_heavy_join_equals_a_plain_join_and_keeps_hot_rows_in_place(spark):
    people = [(i, None if i % 7 == 0 else 1 if i % 2 else i % 300) for i in range(4000)]
    df = spark.createDataFrame(people, "id int, boss int").repartition(4)
    names = spark.createDataFrame([(i, f"n{i}") for i in range(250)], "key int, name string")
    got = heavy.heavy_join(df, names, "boss", "key")
    wanted = df.join(names, df["boss"] == names["key"], "left").select("id", "boss", "name")
    assert rows(got, "id", "boss", "name") == rows(wanted)
    assert heavy.heavy_keys(df, "boss") == [1]
    assert heavy.heavy_join(df.limit(0), names, "boss", "key").count() == 0


def test_dense_key_refuses_an_order_that_is_not_total(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k int, v string")
    with pytest.raises(ValueError, match="repeat their key"):
        sequence.dense_key(df, "n", ["k"])
    numbered = sequence.dense_key(df.union(df.limit(1)), "n", ["k", "v"])  # equal rows share no order
    assert rows(numbered) == [(1, 1, "a"), (2, 1, "a"), (3, 2, "b"), (4, 2, "c")]


def test_dense_key_moves_and_writes_rows_once(spark):
    df = spark.range(2000).selectExpr("id * 37 % 2000 AS k", "repeat('x', 50) AS wide")
    ranged = ranges.with_range(df, ["k"], "_range")
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(_range") == 1 and "rangepartitioning" not in plan
    got = sequence.dense_key(df, "n", ["k"], drawn_from=df.select("k"))
    assert all(r["n"] == r["k"] + 1 for r in got.collect()) and got.count() == 2000


@pytest.mark.parametrize("keys", [
    [(None, "b"), (1, None), (1, "a"), (1, "é"), (2, "a"), (2, "a")] * 9,
    [(5, "same")] * 40, [(i % 17, f"{i}") for i in range(300)],
])
def test_ranges_are_whole_and_ascend(spark, keys):
    df = spark.createDataFrame(keys, "k int, s string")
    points = ranges.split_points(df, 12)
    assert len(points) <= 11
    placed = df.select("k", "s", ranges.range_number(df, points).alias("r")).orderBy("k", "s").collect()
    assert [r["r"] for r in placed] == sorted(r["r"] for r in placed)
    assert len({(r["k"], r["s"]) for r in placed}) == len({(r["k"], r["s"], r["r"]) for r in placed})


def test_carry_splits_one_key_in_one_hour_over_tasks(spark):
    random.seed(8)
    events = [
        (i, "hot" if i % 3 else random.choice(["a", "b", None]), None if i % 50 == 7 else random.randrange(3600),
         i if random.random() < 0.02 else None)
        for i in range(6000)
    ]
    df = spark.createDataFrame(events, "id int, k string, t int, v int").repartition(5)
    lookup = spark.createDataFrame([("hot", 1), ("b", 2)], "k string, extra int")
    got = carry.carry_last(df, key="k", time="t", value="v", tie=[F.col("id")], lookup=lookup)
    wanted, last = [], {}
    for i, k, t, v in sorted(events, key=lambda e: (e[2] is None, e[2], e[0])):
        if k is not None and t is not None:
            last[k] = v if v is not None else last.get(k)
            wanted.append((i, last[k], {"hot": 1, "b": 2}.get(k)))
        else:
            wanted.append((i, None, {"hot": 1, "b": 2}.get(k)))
    assert rows(got, "id", "_carried", "extra") == sorted(wanted, key=repr)
    order = df.where("k is not null and t is not null").withColumn("tie", F.col("id"))
    sizes = [r["count"] for r in ranges.with_range(order, ["k", "t", "tie"], "r").groupBy("r").count().collect()]
    assert len(sizes) > 8 and max(sizes) < 4 * sorted(sizes)[len(sizes) // 2]


def test_facts_of_one_key_and_day_are_split(spark):
    facts = spark.range(4000).select(
        "id", F.lit("hot").alias("k"), F.lit(DAY).alias("day"))
    versions = spark.createDataFrame(
        [("hot", DAY, dt.date(2024, 2, 1), True, 7), ("cold", DAY, dt.date(2024, 2, 1), True, 8)],
        "k string, valid_from date, valid_to date, is_current boolean, value int")
    arguments = dict(key="k", day="day", version_key="k", value="value", name="found")
    merged = joins.as_of_join(facts, versions, **arguments, broadcast_rows=0)
    assert {r["found"] for r in merged.collect()} == {7} and merged.count() == 4000


def test_facts_are_computed_once_and_find_their_range_by_halving(spark):
    """One pass per fact for the draw, the merge and the current version; no lambda per point."""
    seen = spark.sparkContext.accumulator(0)

    def count(x):
        seen.add(1)
        return x

    once = F.udf(count, "long")
    facts = spark.range(500).select(once("id").alias("id"), (F.col("id") % 5).alias("k"), F.lit(DAY).alias("d"))
    versions = spark.range(5).select(
        F.col("id").alias("k"), F.lit(DAY).alias("a"), F.lit(dt.date(2025, 1, 1)).alias("b"),
        F.lit(True).alias("c"), F.col("id").alias("v"))
    got = joins.as_of_join(facts, versions, key="k", day="d", version_key="k", value="v", name="then",
                           valid_from="a", valid_to="b", current="c", broadcast_rows=0)
    assert all(r["then"] == r["k"] for r in got.collect()) and seen.value == 500
    keys = spark.range(10_000).selectExpr("id % 97 AS k", "cast(id AS string) AS s")
    points = ranges.split_points(keys, 50)
    placed = ranges.place(keys, keys, points, "r")
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan
    assert placed.where(F.col("r") != ranges.range_number(keys, points)).count() == 0


def test_heavy_join_needs_no_adaptive_splitting(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        df = spark.range(200_000, numPartitions=16).select(
            "id", F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 3 == 0, None)
            .otherwise(F.col("id") % 5000).alias("boss"))
        names = spark.range(5000).select(F.col("id").alias("key"), F.col("id").alias("name"))
        joined = heavy.heavy_join(df, names, "boss", "key")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert joined.where("name is null").count() == joined.where("boss is null").count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(sizes) == 200_000 and max(sizes) < 4 * sorted(sizes)[len(sizes) // 2]
