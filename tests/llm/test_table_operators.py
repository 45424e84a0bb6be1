"""Near-duplicates, sharding, mixing, URLs and neighbours on small inputs, and the pipeline."""

import math
import random
import re
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import (
    chosen_path,
    histogram_sort,
    projection_search,
    queries,
    soft_mixing,
    url_trees,
)
from ledgerloom.llm.support import range_bounds, range_of, table
from ledgerloom.session import shared_dir

SF = "/root/testdata/sf0.001"


# --- near-duplicates --------------------------------------------------------------------------

def components_of(rows, width, percent=80):
    """By comparing all pairs."""
    sets = []
    for key, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        n = max(1, len(words) - width + 1)
        sets.append((key, {tuple(words[i:i + width]) for i in range(n)} if words else set()))
    parent = {k: k for k, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {k: (len(s), find(k)) for k, s in sets}


def test_duplicates_equal_brute_force(spark):
    random.seed(4)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [random.choice(vocabulary) for _ in range(70)]
    rows, key = [(0, None), (1, ""), (2, " \n"), (3, "short"), (4, "Short"), (5, "two words")], 10
    for group in range(12):
        base = [random.choice(vocabulary) for _ in range(random.randint(20, 120))]
        if group % 3 == 0:
            base += passage
        for _ in range(random.choice([1, 2, 5, 40])):
            copy = list(base)
            for _ in range(random.choice([0, 0, 1, 2, 3])):
                copy[random.randrange(len(copy))] = random.choice(vocabulary)
            rows.append((key, " ".join(copy).upper() if key % 4 == 0 else " ".join(copy)))
            key += 1
    random.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rep", F.lit("clash"))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"])
           for r in chosen_path.near_duplicates(docs, 4, 80).collect()}
    wanted = {k: (n, c, c == k) for k, (n, c) in components_of(rows, 4).items()}
    assert got == wanted


def test_duplicates_cases(spark):
    rows = [(7, "a b c d e f"), (7, "a b c d e f"), (7, "x y z u v w"), (9, "x y z u v w"),
            (None, "a b c d e f"), (3, "q r s t u v")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, chosen_path.near_duplicates(docs, 4).select(
        "doc_id", "component_id", "kept").collect()), key=repr)
    assert got == sorted([(7, 7, True)] * 3 + [(9, 7, False), (None, None, True), (3, 3, True)], key=repr)
    assert chosen_path.near_duplicates(docs.limit(0)).count() == 0


def test_large_nodes_stay_open_without_a_pair(spark, monkeypatch):
    # level 0 has only large nodes and brings no pair: the next levels find the links
    real, levels = chosen_path._promising, []

    def promising(pairs, classes, percent):
        levels.append(1)
        return real(pairs, classes, percent).where(F.lit(len(levels) > 1))

    monkeypatch.setattr(chosen_path, "_promising", promising)
    monkeypatch.setattr(chosen_path, "OPEN_PAIRS", 0)
    monkeypatch.setattr(chosen_path, "REST_PAIRS", 0)
    words = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join([*words, f"end{i}"])) for i in range(4)]
    got = chosen_path.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4)
    assert {r["component_id"] for r in got.collect()} == {0} and len(levels) > 1


def test_rows_of_a_node_that_are_unlike_make_no_pair(spark):
    # one node of 30 unlike texts, a near copy of one of them, and one of other length
    words = [f"w{i} " * 3 for i in range(4000)]
    rows = [(i, " ".join(words[100 * i:100 * i + 100])) for i in range(30)]
    rows += [(30, rows[7][1] + " end"), (31, " ".join([rows[7][1]] + words[3500:3900]))]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    classes = chosen_path.sketches(texts, 4).withColumnRenamed("doc_id", "rep")
    node = classes.withColumns({
        "node": F.lit(1), "component": F.col("rep"), "major": F.lit(7).cast("long"), "leader": F.lit(7)})
    for found in (chosen_path._exhaustive(node, 80), chosen_path._to_leader(node, 80)):
        assert [tuple(r) for r in found.collect()] == [(7, 30)]
    every = node.select(F.col("rep").alias("a")).crossJoin(node.select(F.col("rep").alias("b"))).where("a < b")
    assert [tuple(r) for r in chosen_path._promising(every, classes, 80).collect()] == [(7, 30)]


def test_no_pair_is_confirmed_twice(spark, monkeypatch):
    # two texts too unlike to be linked, in nodes that stay open at every level
    real, seen = chosen_path._confirmed, []

    def confirmed(pairs, sets, percent):
        seen.extend(map(tuple, pairs.collect()))
        return real(pairs, sets, percent)

    monkeypatch.setattr(chosen_path, "_confirmed", confirmed)
    monkeypatch.setattr(chosen_path, "OPEN_PAIRS", 0)
    monkeypatch.setattr(chosen_path, "REST_PAIRS", 0)
    base = [f"w{i}" for i in range(90)]
    rows = [(0, " ".join(base + [f"x{i}" for i in range(14)])),
            (1, " ".join(base + [f"y{i}" for i in range(14)]))]
    got = chosen_path.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4)
    assert {r["component_id"] for r in got.collect()} == {0, 1} and len(seen) == 1


@pytest.mark.parametrize("percent", [30, 79, 101])
def test_duplicates_refuse_thresholds_they_would_miss(spark, percent):
    docs = spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")
    with pytest.raises(ValueError, match="percent"):
        chosen_path.near_duplicates(docs, 4, percent)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(60)] + [(100, 101)], "a long, b long")
    got = {r["id"]: r["component"] for r in chosen_path.components(links).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


# --- sharding ---------------------------------------------------------------------------------

def test_shards_are_even_whole_and_gapless(spark):
    random.seed(6)
    rows = [(i, "x" * random.randint(0, 300) + str(i % 1500)) for i in range(3_000)]
    rows += [(10_000 + i, "same text " * 20) for i in range(1_500)]
    docs = spark.createDataFrame([*rows, (None, None), (-1, None)], "doc_id long, text string")
    got = histogram_sort.assignment(docs, 8).toPandas()
    assert len(got) == len(rows) + 2
    sizes = got.groupby("shard")["size"].sum()
    assert len(sizes) == 8 and sizes.max() < 1.02 * sizes.mean() and sizes.min() > 0.98 * sizes.mean()
    for _, shard in got.groupby("shard"):
        assert sorted(shard["slot"]) == list(range(len(shard)))
    small = got[got["text_crc32"].map(got["text_crc32"].value_counts()) < 5]
    assert (small.groupby("text_crc32")["shard"].nunique() == 1).mean() > 0.99


@pytest.mark.parametrize("rows", [[], [(1, "a")], [(1, "a"), (1, "a"), (2, None)]])
def test_shards_of_few_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = histogram_sort.assignment(docs).collect()
    assert len(got) == len(rows)
    assert all(0 <= r["shard"] < 16 for r in got)


def test_exchange_moves_whole_documents(spark):
    docs = spark.createDataFrame([(i, "t" * i, 5) for i in range(200)], "doc_id long, text string, shard int")
    bounds = histogram_sort.splitters(histogram_sort.measured(docs), 4)
    moved = histogram_sort.exchange(docs, bounds)
    assert moved.columns == ["doc_id", "text", "shard", "shard_"] and moved.count() == 200


def test_shards_are_written_whole_and_in_order(spark):
    random.seed(5)
    rows = [(i, "y" * random.randint(0, 300), i % 7) for i in range(2_000)]
    rows += [(5_000 + i, "one text " * 20, 1) for i in range(700)]
    rows += [(9_000, "one document " * 20, 2)] * 700  # no boundary can part these
    docs = spark.createDataFrame([*rows, (None, None, 3)], "doc_id long, text string, shard int")
    root = Path(shared_dir(spark)) / "staged" / spark.sparkContext.applicationId
    known = set(root.glob("shards-*"))
    got = histogram_sort.assignment(docs, 4, piece_bytes=20_000).toPandas()
    folder, = set(root.glob("shards-*")) - known
    written = spark.read.parquet(str(folder))
    assert sorted(map(tuple, written.select(*docs.columns).collect()), key=repr) == sorted(
        [*rows, (None, None, 3)], key=repr)
    # each shard is written by several tasks, and so is the document that fills the most of one
    files = [sorted(p.glob("*.parquet")) for p in sorted(folder.glob("shard_=*"))]
    assert len(files) == 4 and min(map(len, files)) > 2
    name = F.input_file_name()
    assert written.where("doc_id = 9000").select(name).distinct().count() > 2
    # slots follow the keys, whatever task wrote the row
    keys = histogram_sort.measured(docs).distinct().select("doc_id", "text_crc32", "_text", "_row").toPandas()
    merged = got.merge(keys, on=["doc_id", "text_crc32"])
    assert len(merged) == len(rows) + 1
    for shard, own in merged.sort_values(["shard", "slot"]).groupby("shard"):
        assert list(own["slot"]) == list(range(len(own)))
        order = list(zip(own["_text"], own["_row"], strict=True))
        assert order == sorted(order)
        assert len(own) == written.where(F.col("shard_") == int(shard)).count()


def test_ranges(spark):
    df = spark.createDataFrame([(i % 50,) for i in range(500)] + [(None,)], "k long")
    for descending in (False, True):
        bounds = range_bounds(df, "k", descending, 6)
        placed = df.select("k", range_of(F.col("k"), bounds, descending).alias("p")).distinct().collect()
        order = sorted(placed, key=lambda r: (r[0] is None, (-1 if descending else 1) * (r[0] or 0)))
        assert [r[1] for r in order] == sorted(r[1] for r in placed)
        assert len({r[0] for r in placed}) == len(placed)


# --- mixing -----------------------------------------------------------------------------------

def test_mixing_reaches_its_targets(spark):
    random.seed(8)
    words = {"a": ["apple", "pear", "plum"], "b": ["iron", "zinc", "lead"], "c": ["sea", "lake", "pond"]}
    rows = []
    for i in range(900):
        domain = random.choices("abc", [6, 2, 1])[0]
        text = " ".join(random.choice(words[domain] + ["the", "of"]) for _ in range(random.randint(5, 60)))
        rows.append((i, text, domain, 1.5))
    rows += [(1_000, None, "a", 1.0), (1_001, "", None, 1.0), (1_001, "", None, 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, rate double")
    mixed = soft_mixing.mix(docs, "source", {"a": 0.4, "b": 0.3, "c": 0.3}).toPandas()
    assert (mixed["rate_"] >= 0).all() and (mixed["rate"] > 0).all()
    weight = (mixed["tokens"] * mixed["rate_"]).to_numpy()
    got = (np.stack(mixed["member"]) * weight[:, None]).sum(axis=0) / mixed["tokens"].sum()
    assert np.abs(got - [0.4, 0.3, 0.3]).max() < 0.01
    assert (mixed[mixed["tokens"] == 0]["rate_"] == 1.0).all()
    again = soft_mixing.resample(docs, "source", targets={"a": 0.4, "b": 0.3, "c": 0.3})
    assert again.columns == docs.columns
    counts = again.groupBy("source").agg(F.sum(soft_mixing.token_count(F.col("text"))).alias("n"))
    shares = {r["source"]: r["n"] for r in counts.where("n > 0").collect()}
    assert shares["c"] / sum(shares.values()) > 0.2


def test_mixing_cases(spark):
    docs = spark.createDataFrame([(1, "x y", "a"), (2, "x", "a")], "doc_id long, text string, source string")
    assert soft_mixing.mix(docs, "source").count() == 2
    assert soft_mixing.resample(docs.limit(0), "source").count() == 0


def test_mixing_learns_domains_of_copies(spark):
    # 20,000 rows of 5 texts: a cut by the number of rows draws none of these texts
    words = {"a": "apple pear plum", "b": "iron zinc lead", "c": "sea lake pond"}
    few = [(f"{words['b']} {i}", "b") for i in range(5)]
    many = [(f"{words[d]} {i}", d) for d in "ac" for i in range(1_000)]
    labelled = spark.createDataFrame(few * 4_000 + many, "text string, domain string")
    model = soft_mixing.fit(labelled, list("abc"), 20)
    assert model.domains == list("abc") and model.bayes.numClasses == 3
    assert model.prior == [1 / 22, 20 / 22, 1 / 22]
    docs = spark.createDataFrame([(t,) for t in words.values()], "text string")
    members = [r["p"] for r in soft_mixing.posteriors(docs, model, "p").collect()]
    assert all(abs(sum(m) - 1) < 1e-9 for m in members)
    assert [int(np.argmax(m)) for m in members] == [0, 1, 2]


# --- URLs -------------------------------------------------------------------------------------

URLS = [
    (1, "http://A.Example.ORG/es/x?y#z"), (2, "https://example.org/en/17"), (3, "http://b.org"),
    (4, "no scheme/at/all"), (5, None), (6, "http://q.com/de/5?u=http://z.org/"), (7, "http://com/fr/"),
    (8, "http://notorg/"), (9, ""), (9, ""), (10, "ftp://h.net/" + "a" * 5_000),
]


def test_url_parts_and_rules(spark):
    pages = spark.createDataFrame([(*u, "clash") for u in URLS], "page_id long, url string, host string")
    judged = url_trees.judge(pages, queries.URL_RULES)
    assert judged.columns == ["page_id", "url", "host", "host_", "path", "rule", "verdict", "block_score"]
    got = {r["page_id"]: r for r in judged.collect()}
    assert judged.count() == len(URLS)
    parts = {k: (r["host_"], r["path"], r["rule"]) for k, r in got.items()}
    assert parts[1] == ("a.example.org", "/es/x", "example.org/es/") and got[1]["verdict"] == "block"
    assert parts[2] == ("example.org", "/en/17", "example.org/en/1")
    assert parts[3] == ("b.org", "", None)
    assert parts[4] == parts[5] == parts[9] == ("", "", None)
    assert parts[6] == ("q.com", "/de/5", "com/de/") and got[6]["verdict"] == "block"
    assert parts[7] == ("com", "/fr/", "com/fr/") and parts[8][2] is None
    assert {r["verdict"] for r in got.values()} <= {"allow", "block"}
    assert url_trees.judge(pages.limit(0), queries.URL_RULES).count() == 0


def test_rules_are_those_of_the_contract():
    assert [(r.text, r.verdict) for r in queries.URL_RULES] == [
        ("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
        ("com/fr/", "allow"), ("com/de/", "block"),
    ]


def test_a_longer_block_wins_over_the_rule_of_its_top_level(spark):
    urls = ["http://example.org/en/17", "http://a.example.org/en/1?x", "http://example.org/en/2"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_trees.judge(pages, queries.URL_RULES).collect()}
    assert got == {0: ("example.org/en/1", "block"), 1: ("example.org/en/1", "block"), 2: ("org/", "allow")}


def test_trees_learn_what_rules_show(spark):
    rows = [(i, f"http://h{i}.org/{i}") for i in range(200)]
    rows += [(1_000 + i, f"http://w{i}.com/de/{'9' * 12}{i}?a=1&b=2&c=3") for i in range(200)]
    rows += [(5_000, "http://h.net/7"), (5_001, f"http://w.net/de/{'9' * 13}?a=1&b=2&c=3")]
    judged = url_trees.judge(spark.createDataFrame(rows, "page_id long, url string"), queries.URL_RULES)
    got = {r["page_id"]: r["verdict"] for r in judged.where("page_id >= 5000").collect()}
    assert got == {5_000: "allow", 5_001: "block"}


# --- neighbours -------------------------------------------------------------------------------

def exact(vectors, k=5):
    """By comparing all pairs."""
    fine = {}
    for key, v in vectors:
        if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v):
            fine[key] = np.array(v, float) / np.linalg.norm(v)
    result = defaultdict(list)
    for q in (k_ for k_ in fine if k_ % 50 == 0):
        found = sorted((-round(float(fine[q] @ w), 12), key) for key, w in fine.items() if key != q)
        result[q] = [key for _, key in found[:k]]
    return result


def test_neighbours_recall_and_cases(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((20, 16))
    vectors = [(i, (centres[i % 20] + 0.3 * rng.standard_normal(16)).tolist()) for i in range(3_000)]
    vectors += [(5_000 + i, vectors[50][1]) for i in range(1_500)]
    vectors += [(9_000, None), (9_050, [0.0] * 16), (9_100, [float("nan")] * 16), (9_150, [None] * 16)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in projection_search.nearest(df, F.col("id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    wanted = exact(vectors)
    assert set(got) == set(wanted)
    hits = sum(len(set(got[q]) & set(wanted[q])) for q in wanted)
    assert hits >= 0.97 * sum(map(len, wanted.values()))
    assert got[50] == [5_000, 5_001, 5_002, 5_003, 5_004]


def test_neighbours_of_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [2.0, 2.0])], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in projection_search.nearest(df, F.col("id") % 50 == 0).orderBy("rank").collect()]
    assert [(q, n, v) for q, n, v, _ in got] == [(0, 1, 1), (0, 2, 2)]
    assert abs(got[0][3] - math.sqrt(0.5)) < 1e-12
    assert projection_search.nearest(df.limit(0), F.col("id") == 0).count() == 0


def test_chi_square():
    assert abs(projection_search.chi_square(np.array([15.507]), 8)[0] - 0.95) < 1e-4


# --- the pipeline -----------------------------------------------------------------------------

def test_pipeline_stage_by_stage(spark, tmp_path):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.count()
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "token_ids":
            assert docs.columns == columns
        if name in ("language", "toxicity", "near_duplicates"):
            assert 0.5 * before < docs.count() <= before
        if name == "near_duplicates":
            rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
            assert all(c == k for k, (_, c) in components_of(rows, 5).items())
    assert docs.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]


def test_pipeline_of_an_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_targets_are_met_in_few_passes_of_one_plan_size(spark, monkeypatch):
    random.seed(31)
    rows = []
    for _ in range(400):
        member = [random.random() ** 4 for _ in range(4)]
        rows.append((random.randint(1, 500), [m / sum(member) for m in member]))
    df = spark.createDataFrame(rows, "tokens long, member array<double>")
    sizes, real = [], soft_mixing.rate

    def measured(tokens, member, moved):
        sizes.append(len(str(df.select(real(tokens, member, moved))._jdf.queryExecution().analyzed())) // 50)
        return real(tokens, member, moved)

    monkeypatch.setattr(soft_mixing, "rate", measured)
    moved = soft_mixing.fit_rates(df, [0.55, 0.05, 0.05, 0.35])  # far from their own: some rates are 0
    # the first vector prints shorter, being zeros; from then on the plan does not grow
    assert len(sizes) <= 15 and max(sizes[1:]) <= min(sizes[1:]) + 1
    found = df.withColumn("r", real(F.col("tokens"), F.col("member"), moved))
    sums = found.agg(F.sum("tokens"), F.min("r"), *[
        F.sum(F.col("tokens") * F.col("r") * F.element_at("member", i + 1)) for i in range(4)]).first()
    assert sums[1] == 0 and [round(x / sums[0], 3) for x in sums[2:]] == [0.55, 0.05, 0.05, 0.35]


def test_many_domains_share_one(spark, monkeypatch):
    monkeypatch.setattr(soft_mixing, "MOST_DOMAINS", 3)
    rows = [(i, f"word{i % 7} text{i}", f"s{min(i % 7, 5)}") for i in range(70)]
    mixed = soft_mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), "source")
    assert sorted(mixed.first()["domains"]) == [soft_mixing.OTHER, "s0", "s5"] and mixed.count() == 70
    with pytest.raises(ValueError, match="one fit takes"):
        soft_mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), "source",
                        {f"s{i}": 1.0 for i in range(6)})


def test_pipeline_keeps_every_text_of_a_kept_key(spark):
    words = [" ".join(f"{c}{i}" for i in range(30)) for c in "abc"]
    rows = [(1, words[0]), (1, words[1]), (1, words[1]), (2, words[0] + " tail"), (3, words[2]), (None, "x")]
    docs = spark.createDataFrame([(k, t, "k") for k, t in rows], "doc_id long, text string, digest string")
    got = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr) == sorted(
        [(1, words[0]), (1, words[1]), (3, words[2]), (None, "x")], key=repr)
