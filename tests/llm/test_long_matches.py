"""Removal of repeated passages against a set of all windows, and the run-length index."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import long_matches as lm
from ledgerloom.llm.run_index import RunIndex

SCHEMA = "doc_id long, text string, kept string, _doc int"


def plain(rows, length=lm.LENGTH):
    """Removed spans per (doc_id, text), by looking up every window in a set."""
    seen, out = set(), {}
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    for key, text in order:
        data, spans, mine = (text or "").encode(), [], set()
        for at in range(len(data) - length + 1):
            window = data[at:at + length]
            if window in seen or window in mine:
                if spans and spans[-1][1] >= at:
                    spans[-1] = (spans[-1][0], at + length)
                else:
                    spans.append((at, at + length))
            mine.add(window)
        seen |= mine
        kept = b"".join(data[a:b] for a, b in zip([0, *[b for _, b in spans]], [*[a for a, _ in spans], len(data)]))
        out[key, text] = (spans, kept)
    return out


def removed(spark, rows, **sizes):
    docs = spark.createDataFrame([(k, t, "clash", 1) for k, t in rows], SCHEMA).repartition(4)
    got = lm.deduplicate(docs, sizes=lm.Sizes(**sizes)).select("doc_id", "text", "kept_.spans", "kept_.bytes")
    return [((r["doc_id"], r["text"]), ([tuple(s) for s in r["spans"]], bytes(r["bytes"]))) for r in got.collect()]


def corpus():
    random.seed(11)
    words = ["lorem", "ipsum", "dolor", "é", "日本", "sit", "amet", "x", "consectetur", "-----"]

    def prose(n):
        return " ".join(random.choice(words) + random.choice(["", "s", "ing"]) for _ in range(n))

    passages = [prose(random.randint(18, 60)) for _ in range(6)]
    base = prose(300)
    rows = [(0, None), (1, ""), (2, "short"), (3, "a" * 400), (4, "ab" * 300), (5, "a" * 99), (6, "a" * 100)]
    rows += [(10 + i, prose(40) + random.choice(passages) + prose(20) + random.choice(passages)) for i in range(40)]
    rows += [(60 + i, base) for i in range(10)]  # exact copies
    for i in range(25):  # near copies, and copies of the edits
        cut = random.randrange(len(base))
        rows.append((80 + i, base[:cut] + random.choice(["#", "", "changed"]) + base[cut + 3:]))
    rows += [(200, rows[-1][1]), (201, rows[-1][1][50:]), (202, base * 3), (203, passages[0] * 5)]
    rows += [(None, base), (10, rows[7][1]), (10, rows[7][1])]  # a null id, and one document given again
    random.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [{}, {"cut": 2000, "bucket": 5000}, {"cut": 4000, "index": 800},
                                   {"cut": 3000, "bucket": 20_000, "hold": 6000, "slice": 3, "ranges": 5}])
def test_spans_equal_the_set_of_windows(spark, sizes):
    rows = corpus()
    wanted = plain(rows)
    got = removed(spark, rows, **sizes)
    assert len(got) == len(rows)
    assert [(key, found) for key, found in got if found != wanted[key]] == []


def test_cases(spark):
    assert removed(spark, []) == []
    short = dict(removed(spark, [(1, None), (2, "x"), (None, "y")]))
    assert short == {(1, None): ([], b""), (2, "x"): ([], b"x"), (None, "y"): ([], b"y")}
    # texts of one doc_id: one of them stays whole, the other one goes
    text = "".join(random.Random(1).choices("abcdefgh ", k=300))
    got = dict(removed(spark, [(1, text), (1, text + "!")]))
    assert sorted(len(b) for _, b in got.values()) in ([0, 301], [1, 300])


def windows_of(texts, length=lm.LENGTH):
    """Start and anchor of each window, by text."""
    out = [[] for _ in texts]
    for number, starts, anchors, parts in lm.stretches(texts, length):
        for n, s, a, part in zip(number.tolist(), starts.tolist(), anchors.tolist(), parts):
            assert texts[n][s:s + len(part)] == part
            out[n] += [(w, a) for w in range(s, s + len(part) - length + 1)]
    return out


@pytest.mark.parametrize("piece", [150, 700, 1 << 23])
def test_each_window_is_in_one_stretch(monkeypatch, piece):
    monkeypatch.setattr(lm, "_PIECE", piece)
    rng = random.Random(2)
    texts = [bytes(rng.choices(range(97, 110), k=n)) for n in (2000, 0, 99, 100, 101, 350, 1000)]
    found = windows_of(texts)
    assert [[w for w, _ in f] for f in found] == [list(range(max(len(t) - 99, 0))) for t in texts]


def test_equal_windows_have_equal_anchors():
    rng = random.Random(3)
    common = bytes(rng.choices(b"abc ", k=180))
    texts = [bytes(rng.choices(b"abc ", k=90)) + common, common + bytes(rng.choices(b"abc ", k=77))]
    one, two = ({t[w:w + 100]: a for w, a in f} for t, f in zip(texts, windows_of(texts)))
    shared = one.keys() & two.keys()
    assert len(shared) >= 81 and all(one[w] == two[w] for w in shared)


@pytest.mark.parametrize("seed", range(6))
def test_index_equals_sorting_all_suffixes(seed):
    rng = random.Random(seed)
    base = bytes(rng.choices(b"ab" if seed % 2 else b"abcdefgh", k=60))
    texts = [base[rng.randrange(20):] + bytes(rng.choices(b"ab", k=rng.randrange(30))) for _ in range(30)]
    index = RunIndex(texts)
    places = {}
    for length in (1, 5, 12, 30):
        seen, wanted = set(), []
        for start, text in zip(index.starts.tolist(), texts):
            for at in range(len(text) - length + 1):
                if text[at:at + length] in seen:
                    wanted.append(start + at)
                seen.add(text[at:at + length])
        places[length] = wanted
        assert index.repeated(length).tolist() == wanted
    place, common = index.statistics()
    whole = b"\0".join(texts) + b"\0"
    inside = np.flatnonzero(index.rest > 0)
    for at in rng.sample(inside.tolist(), 40):
        n = int(common[at])
        assert whole[at:at + n] == whole[place[at]:place[at] + n]


def test_repetitive_texts_have_few_runs():
    base = bytes(random.Random(9).choices(range(97, 117), k=500))
    index = RunIndex([base] * 50)
    assert index.runs < len(index.symbols) / 8


def test_only_matched_ranges_come_back(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string")
    assert set(lm.matched_ranges(docs).columns) == {"doc", "tag", "ranges"}
    fresh = spark.range(40).select(
        F.col("id").alias("doc_id"), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(20)),
        lambda x: F.sha2(F.concat_ws(",", x, "id"), 256)), " ").alias("text"))
    assert lm.matched_ranges(fresh).count() == 0
