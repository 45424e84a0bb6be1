"""Toxicity by a lexicon with spelling errors, and by the context of each hit.

The lexicon is learned from labelled texts: words and word stems that stand in toxic texts and
hardly in others. Its trie is intersected with Levenshtein automata: a state is a set of (trie
node, edits so far), and the subset construction makes one table of transitions from them. Every
word of a text runs through that table, so misspelled terms are found at the cost of one look-up
per letter. Each hit is then weighed by its context: less inside quotation marks or near a verb of
saying, more beside other hits. A logistic curve over the sum gives the score.

Defined cases: a null, empty or very long text is scored like any other (no hits: the base score);
without labelled rows nothing is predicted toxic; labels repeated for a document count once, toxic
if any says so; null labels or keys teach nothing; other columns pass through untouched.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerloom.llm.support import col, letter_table, unused
from ledgerloom.session import stage

#: Bound of the labelled sample: so many documents of each label, by the order of a hash.
SAMPLE_PER_LABEL = 4_000
#: At most so many lexicon candidates reach the driver.
CANDIDATES = 5_000
_MIN_STEM, _MAX_STEM = 3, 14
#: A term stands in this many times as large a share of toxic texts as of others, and its
#: log-likelihood ratio against chance is this large.
LIFT, LEAST_EVIDENCE = 4.0, 12.0
_END = "$"
#: Letters from which on a term may be met with one edit, and with two.
ONE_EDIT, TWO_EDITS = 5, 10
_WINDOW_WORDS = 12
_QUOTED, _REPORTED, _BESIDE = 0.3, 0.7, 1.25
# Verbs of saying in the languages at hand.
_SAYING = frozenset(
    "said says say quoted quote quotes called wrote writes sagte sagt zitat schrieb dit disait "
    "citation écrit dijo dice cita escribió".split()
)
_WORD = re.compile(r"[^\W\d_]+")


# --- learning ---------------------------------------------------------------------------------

def labelled_sample(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> DataFrame:
    """At most `per_label` different texts of each label: `text`, `toxic`.

    The chosen keys are few (twice the bound), so they are broadcast to one scan of the texts."""
    known = (
        labels.where("toxic is not null and doc_id is not null")
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    order = W.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = known.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= per_label)
    texts = docs.select("doc_id", "text").where("text is not null and doc_id is not null")
    return (
        texts.join(F.broadcast(chosen.select("doc_id", "toxic")), "doc_id")
        .select("text", "toxic").dropDuplicates(["text"])
    )


def _terms(text: str) -> set[str]:
    found = set()
    for word in set(_WORD.findall(text.lower())):
        found.add(word + _END)
        for length in range(_MIN_STEM, min(len(word), _MAX_STEM) + 1):
            found.add(word[:length])
    return found


def _count_terms(sample: DataFrame) -> DataFrame:
    """Per term of a toxic text: toxic and other texts that hold it, counted once per task first."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        toxic, other = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch["text"], batch["toxic"], strict=True):
                (toxic if label else other).update(_terms(text))
        terms = list(toxic.keys() | other.keys())
        yield pd.DataFrame({
            "term": terms, "toxic": [toxic[t] for t in terms], "other": [other[t] for t in terms],
        })

    return (
        sample.mapInPandas(count, "term string, toxic long, other long")
        .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    )


def _neighbours(sample: DataFrame, terms: list[str]) -> dict[str, int]:
    """Per candidate, how many different words stand before it in toxic texts. A term that only
    copies of one passage hold has few."""

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted, seen = set(terms), set()
        for batch in batches:
            for text in batch["text"]:
                words = _WORD.findall(text.lower())
                for before, word in zip(["", *words], words, strict=False):
                    for length in range(_MIN_STEM, min(len(word), _MAX_STEM) + 1):
                        if word[:length] in wanted:
                            seen.add((word[:length], before))
                    if word + _END in wanted:
                        seen.add((word + _END, before))
        yield pd.DataFrame(list(seen), columns=["term", "before"])

    found = sample.where("toxic = 1").mapInPandas(pairs, "term string, before string")
    counted = found.groupBy("term").agg(F.count_distinct("before").alias("n")).collect()
    return {r["term"]: r["n"] for r in counted}


def lexicon(sample: DataFrame) -> list[str]:
    """Words (ending in `$`) and stems that toxic texts hold far more often than others."""
    sizes = {bool(r["toxic"]): r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_toxic, n_other = sizes.get(True, 0), sizes.get(False, 0)
    if not n_toxic or not n_other:
        return []
    least = max(3, math.ceil(0.02 * n_toxic))
    lifted = F.col("toxic") * n_other >= LIFT * F.col("other") * n_toxic
    rows = (
        _count_terms(sample).where((F.col("toxic") >= least) & lifted)
        .orderBy(F.desc("toxic"), "term").limit(CANDIDATES).collect()
    )
    share = n_toxic / (n_toxic + n_other)
    gain, held = {}, {}
    for term, toxic, other in rows:
        both = toxic + other
        ratio = toxic * math.log(toxic / (both * share))
        ratio += other * math.log(other / (both * (1 - share))) if other else 0.0
        if ratio >= LEAST_EVIDENCE:
            gain[term], held[term] = ratio, toxic
    variety = _neighbours(sample, list(held))
    held = {t: n for t, n in held.items() if variety.get(t, 0) >= max(3, 0.3 * n)}
    return sorted(_choose(held, gain))


def _choose(held: dict[str, int], gain: dict[str, float]) -> set[str]:
    """Of terms that begin one another, the one that tells most: a stem if it tells nearly as much
    as any of its longer forms, else those forms, each by the same rule."""
    below: dict[str, list[str]] = {t: [] for t in held}
    best = dict.fromkeys(held, 0.0)
    roots = []
    for term in sorted(held, key=len, reverse=True):
        best[term] = max([gain[term], *(best[t] for t in below[term])])
        parent = next((term[:k] for k in range(len(term) - 1, _MIN_STEM - 1, -1) if term[:k] in held), None)
        (below[parent] if parent else roots).append(term)
    chosen, queue = set(), roots
    while queue:
        term = queue.pop()
        if gain[term] < 0.85 * best[term]:
            queue += below[term]
            continue
        while longer := [t for t in below[term]
                         if held[t] >= 0.9 * held[term] and gain[t] >= 0.95 * gain[term]]:
            term = max(longer, key=lambda t: (gain[t], t))
        chosen.add(term)
    return chosen


# --- the automaton ----------------------------------------------------------------------------

@dataclass(frozen=True)
class Automaton:
    """`table[state, class]` is the next state; `accept[state]` is 2 * term + (edits > 0), or -1.
    State 0 is dead. `held[state]` tells that a stem has been met: what follows does not matter."""

    letters: dict[str, int]
    table: np.ndarray
    accept: np.ndarray
    held: np.ndarray
    steps: int


def edits_allowed(term: str) -> int:
    length = len(term.rstrip(_END))
    return (length >= ONE_EDIT) + (length >= TWO_EDITS)


def build(terms: list[str]) -> Automaton:
    """Intersect the trie of the terms with the automata of words within the allowed edits."""
    children: list[dict[str, int]] = [{}]
    ends: list[tuple[int, bool] | None] = [None]
    most = [0]
    for index, term in enumerate(terms):
        node, allowed = 0, edits_allowed(term)
        most[0] = max(most[0], allowed)
        for letter in term.rstrip(_END):
            if letter not in children[node]:
                children[node][letter] = len(children)
                children.append({})
                ends.append(None)
                most.append(0)
            node = children[node][letter]
            most[node] = max(most[node], allowed)
        whole = term.endswith(_END)
        if ends[node] is None or ends[node][1]:
            ends[node] = (index, whole)

    def closed(items: set[tuple[int, int]]) -> frozenset:
        """With letters of the term left out; of each node only its least edits."""
        best: dict[int, int] = {}
        queue = list(items)
        while queue:
            node, edits = queue.pop()
            if edits > most[node] or best.get(node, 99) <= edits:
                continue
            best[node] = edits
            queue += [(child, edits + 1) for child in children[node].values()]
        return frozenset(best.items())

    letters = {x: i + 1 for i, x in enumerate(sorted({x for c in children for x in c}))}
    other = 0
    dead, start = frozenset(), closed({(0, 0)})
    states = {dead: 0, start: 1}
    rows, accept, held, order = [], [], [], [dead, start]
    position = 0
    while position < len(order):
        state = order[position]
        found = [(edits, ends[node][0], ends[node][1]) for node, edits in state
                 if ends[node] is not None and edits <= edits_allowed(terms[ends[node][0]])]
        stems = [f for f in found if not f[2]]
        best = min(found, default=None)
        accept.append(-1 if best is None else 2 * best[1] + (best[0] > 0))
        held.append(bool(stems) and min(stems)[0] == 0)
        row = [0] * (len(letters) + 1)
        if held[-1]:
            row = [position] * (len(letters) + 1)
            accept[-1] = 2 * min(stems)[1]
        else:
            for letter, slot in [(None, other), *letters.items()]:
                moved = set()
                for node, edits in state:
                    moved.add((node, edits + 1))
                    for x, child in children[node].items():
                        moved.add((child, edits + (x != letter)))
                    end = ends[node]
                    if end is not None and not end[1] and edits <= edits_allowed(terms[end[0]]):
                        moved.add((node, edits))  # a misspelled stem goes on as well
                follow = closed(moved)
                if follow not in states:
                    states[follow] = len(order)
                    order.append(follow)
                row[slot] = states[follow]
        rows.append(row)
        position += 1
    longest = max((len(t) for t in terms), default=0) + 3
    return Automaton(letters, np.array(rows, dtype=np.int32), np.array(accept, dtype=np.int32),
                     np.array(held), longest)


@dataclass
class Scanner:
    """Finds the hits in many texts at once."""

    automaton: Automaton
    kinds: np.ndarray = field(init=False)

    def __post_init__(self):
        kinds = np.full(1 << 16, -1, dtype=np.int16)
        kinds[letter_table()] = 0
        for sign in "0123456789@$*":
            kinds[ord(sign)] = 0
        for letter, slot in self.automaton.letters.items():
            kinds[min(ord(letter), 0xFFFF)] = slot
        self.kinds = kinds

    def hits(self, text: str) -> tuple[list[tuple[int, int, int]], int]:
        """(start, length, accept value) of each word that the automaton accepts, and the number
        of all words."""
        codes = np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")
        kinds = self.kinds[np.minimum(codes, 0xFFFF)]
        inside = np.concatenate(([False], kinds >= 0, [False]))
        starts = np.flatnonzero(inside[1:] & ~inside[:-1])
        ends = np.flatnonzero(~inside[1:] & inside[:-1])
        table, state = self.automaton.table, np.ones(len(starts), dtype=np.int32)
        rows = np.arange(len(starts))
        for step in range(self.automaton.steps):
            rows = rows[(ends[rows] - starts[rows] > step)]
            if not len(rows):
                break
            state[rows] = table[state[rows], kinds[starts[rows] + step]]
            rows = rows[state[rows] > 0]
        too_long = (ends - starts > self.automaton.steps) & ~self.automaton.held[state]
        state[too_long] = 0
        found = np.flatnonzero(self.automaton.accept[state] >= 0)
        accept = self.automaton.accept[state[found]]
        hits = zip(starts[found].tolist(), (ends - starts)[found].tolist(), accept.tolist(), strict=True)
        return list(hits), len(starts)


# --- context and score ------------------------------------------------------------------------

def _quoted(line: str, at: int) -> bool:
    before, after = line[:at], line[at:]
    if before.count('"') % 2 == 1 and '"' in after:
        return True
    return any(
        before.rfind(opens) > before.rfind(closes) and closes in after
        for opens, closes in (("“", "”"), ("«", "»"), ("„", "“"))
    )


def context(text: str, start: int, length: int, others: list[int]) -> float:
    """The share of a hit that counts, from the window around it."""
    low = max(text.rfind("\n", 0, start) + 1, start - 400)
    high = text.find("\n", start + length)
    line = text[low:min(high if high >= 0 else len(text), start + 400)]
    factor = _QUOTED if _quoted(line, start - low) else 1.0
    near = _WORD.findall(text[max(0, start - 80):start])[-6:]
    if _SAYING.intersection(near):
        factor *= _REPORTED
    words = 8 * _WINDOW_WORDS
    if any(0 < abs(o - start) <= words for o in others):
        factor *= _BESIDE
    return factor


@dataclass(frozen=True)
class ToxicModel:
    """Terms, the weight of each accept value, the weighed hits a word of a text that is not toxic
    has on average, and the logistic curve."""

    terms: list[str]
    weights: np.ndarray
    background: float
    slope: float
    offset: float

    def scanner(self) -> Scanner:
        return Scanner(build(self.terms))


def weighed_hits(text: str | None, scanner: Scanner, weights: np.ndarray) -> tuple[float, int]:
    """The weighed hits of a text and its number of words."""
    if not text or not len(weights):
        return 0.0, 0
    lowered = text.lower()
    found, words = scanner.hits(lowered)
    hits = [h for h in found if weights[h[2]] > 0]
    starts = [h[0] for h in hits]
    total = 0.0
    for i, (start, length, value) in enumerate(hits):
        beside = starts[max(0, i - 1):i] + starts[i + 1:i + 2]
        total += weights[value] * context(lowered, start, length, beside)
    return total, words


def evidence(total, words, background: float):
    """Logarithm of the hits beyond twice those that a text of this length has by chance."""
    return np.log1p(np.maximum(total - 2 * background * words, 0.0))


def fit(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> ToxicModel:
    """Learn lexicon, weights and curve from the labelled sample."""
    sample = stage(labelled_sample(docs, labels, per_label), "toxic-sample")
    terms = lexicon(sample)
    scanner_terms = list(terms)

    def present(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner, seen = Scanner(build(scanner_terms)), Counter()
        for batch in batches:
            for text, label in zip(batch["text"], batch["toxic"], strict=True):
                values = {h[2] for h in scanner.hits(text.lower())[0]}
                seen.update((int(label), v) for v in values | {-1})
        yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["toxic", "value", "n"])

    counted = (
        sample.mapInPandas(present, "toxic int, value int, n long")
        .groupBy("toxic", "value").agg(F.sum("n").alias("n")).collect()
    )
    seen = {(r["toxic"], r["value"]): r["n"] for r in counted}
    sizes = {label: max(seen.get((label, -1), 0), 1) for label in (0, 1)}
    weights = np.zeros(2 * len(terms))
    for value in range(len(weights)):
        toxic = (seen.get((1, value), 0) + 0.5) / sizes[1]
        other = (seen.get((0, value), 0) + 0.5) / sizes[0]
        known = seen.get((1, value), 0) + seen.get((0, value), 0) > 0
        # a misspelling that no labelled text shows counts half of its term
        odds = math.log(toxic / other) if known else 0.5 * weights[value - value % 2] * 4
        weights[value] = min(max((odds - 0.7) / 4, 0.0), 1.0) if known else min(odds / 4, 0.5)
    frozen = weights.copy()

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(build(scanner_terms))
        for batch in batches:
            found = [weighed_hits(t, scanner, frozen) for t in batch["text"]]
            rows = pd.DataFrame(found, columns=["total", "words"])
            yield rows.assign(toxic=batch["toxic"].astype("int32").to_numpy())

    points = sample.mapInPandas(measure, "total double, words long, toxic int").toPandas()
    clean = points[points["toxic"] == 0]
    background = float(clean["total"].sum() / max(clean["words"].sum(), 1))
    x = evidence(points["total"].to_numpy(), points["words"].to_numpy(), background)
    slope, offset = logistic(x, points["toxic"].to_numpy())
    return ToxicModel(terms, weights, background, slope, offset)


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (not below 0) and offset of a logistic curve, with a small penalty on the slope.
    Both labels weigh the same."""
    if not len(x) or not y.any() or y.all() or not x.any():
        return 0.0, -4.0
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -30, 30)))
        r, h = weight * (y - p), weight * p * (1 - p) + 1e-9
        gradient = np.array([(r * x).sum() - 0.05 * slope, r.sum() - 0.05 * offset])
        matrix = np.array([[(h * x * x).sum() + 0.05, (h * x).sum()],
                           [(h * x).sum(), h.sum() + 0.05]])
        move = np.clip(np.linalg.solve(matrix, gradient), -2, 2)
        slope, offset = slope + move[0], offset + move[1]
        if abs(move).max() < 1e-6:
            break
    return (float(slope), float(offset)) if slope > 0 else (0.0, -4.0)


def toxicity(text: Column, model: ToxicModel) -> Column:
    """Score from 0 to 1; 0.5 or more means toxic."""
    shared = model

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = shared.scanner()
        for texts in batches:
            found = np.array([weighed_hits(t, scanner, shared.weights) for t in texts], dtype=float)
            found = found.reshape(-1, 2)
            x = evidence(found[:, 0], found[:, 1], shared.background)
            z = np.clip(shared.slope * x + shared.offset, -30, 30)
            yield pd.Series(1 / (1 + np.exp(-z)))

    return run(text)


def with_toxicity(docs: DataFrame, model: ToxicModel, name: str = "toxicity") -> DataFrame:
    """All columns of `docs` and the score as one more."""
    return docs.withColumn(unused(docs.columns, name), toxicity(col("text"), model))
