"""Mixing to target weights with soft membership.

A document need not belong to one domain. A classifier learned from a labelled table (documents
and their domains) gives each document a posterior over the domains, and the document counts in
every domain by its share. Rates, one per document and never negative, are fitted so that the
expected tokens of each domain reach their targets: the least-squares problem over all documents
is solved by projected gradient steps with lazy projection. The steps are added up unprojected, in
one number per domain, and the rate of a document is its share of that sum, added to 1 and projected
to what is not negative. So one short vector is the whole state, a plan is as large at the last step
as at the first, and nothing is written between them. A step is one distributed sum, which also
gives the second-moment matrix of the documents whose rate is above 0; the residuals are whitened
with it, which makes the steps converge in few passes.

A rate is the expected number of copies of a document. `resample` turns rates into whole copies by
a hash of the row, so the same documents are chosen on every run.

Only DataFrame functions and Spark's own models are used; no row passes through Python.

Defined cases: a null or empty text has no tokens, the prior of the domains as its posterior and
rate 1, since it moves no target; a null domain teaches nothing; domains without a target are not
modelled, and without targets the domains beyond the MOST_DOMAINS - 1 largest are one domain, as the
matrix has a number for each pair; targets that no document can reach are met as well as least squares can; one domain alone
gives every document the same rate; an empty table gives an empty result; repeated rows get equal
rates; other columns pass through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import NaiveBayes, NaiveBayesModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerloom.llm.support import col, unused
from ledgerloom.session import stage

WORD_SLOTS = 1 << 14
#: Bound of the labelled sample: different texts per domain, by the order of a hash.
SAMPLE_PER_DOMAIN = 400
#: Posteriors are flattened by this power of the number of words, so that long texts stay soft.
SOFTNESS = 0.75
STEPS = 25
CLOSE = 1e-4
#: Domains of one fit, and the name of those that are fitted as one.
MOST_DOMAINS = 32
OTHER = "(other)"
#: Targets grow as the domains' own shares to this power: below 1 it lifts the small ones.
TEMPERATURE = 0.7


@dataclass
class DomainModel:
    """The classifier and the domains in the order of its classes."""

    bayes: NaiveBayesModel | None
    domains: list[str]
    prior: list[float]


def word_counts(text: Column) -> Column:
    """The words of a text: lower-cased runs between white space."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: w != "")


def token_count(text: Column) -> Column:
    return F.size(word_counts(text)).cast("long")


def fit(labelled: DataFrame, domains: list[str], per_domain: int = SAMPLE_PER_DOMAIN) -> DomainModel:
    """Learn from rows with `text` and `domain`. At most `per_domain` different texts of each domain
    are the sample, by the order of their hashes; the prior counts all rows.

    The sample is chosen among the hashes, so only its own texts are shuffled. A hash threshold from
    the number of the domain's different texts comes first, so that few hashes are ranked; copies
    share one hash, so they are no part of that number."""
    known = labelled.where(F.col("text").isNotNull() & F.col("domain").isin(domains)).withColumn(
        "_hash", F.xxhash64("text", "domain")
    )
    distinct = stage(
        known.groupBy("domain", "_hash").agg(F.count("*").alias("rows")), "domain-texts"
    )
    counts = distinct.groupBy("domain").agg(
        F.sum("rows").alias("rows"), F.count("*").alias("texts")
    ).collect()
    sizes = {r["domain"]: r["rows"] for r in counts}
    texts = {r["domain"]: r["texts"] for r in counts}
    found = sorted(sizes)
    if len(found) < 2:
        return DomainModel(None, found or sorted(domains)[:1], [1.0])
    share = F.col("_hash").bitwiseAND(F.lit((1 << 30) - 1)) / F.lit(float(1 << 30))
    limit = F.element_at(F.create_map(*[
        F.lit(x) for d in found for x in (d, min(1.0, (2.0 * per_domain + 50) / texts[d]))
    ]), F.col("domain"))
    order = W.partitionBy("domain").orderBy(share, "_hash")
    chosen = distinct.where(share < limit).withColumn("_rank", F.row_number().over(order)).where(
        F.col("_rank") <= per_domain
    ).select("domain", "_hash")
    few = known.join(F.broadcast(chosen), ["domain", "_hash"], "left_semi").dropDuplicates(
        ["domain", "_hash"]
    )
    label = F.array_position(F.array(*[F.lit(d) for d in found]), F.col("domain")) - 1
    rows = stage(
        few.select(word_counts(F.col("text")).alias("words"), label.cast("double").alias("label")),
        "domain-sample",
    )
    # the model has one class per label it saw: a missing one would shift or blank the posteriors
    seen = {int(r["label"]) for r in rows.select("label").distinct().collect()}
    missing = [d for i, d in enumerate(found) if i not in seen]
    if missing:
        raise RuntimeError(f"no training text was drawn for {missing}")
    counted = HashingTF(inputCol="words", outputCol="features", numFeatures=WORD_SLOTS).transform(rows)
    total = sum(sizes.values())
    return DomainModel(
        NaiveBayes(smoothing=0.1).fit(counted), found, [sizes[d] / total for d in found]
    )


def posteriors(docs: DataFrame, model: DomainModel, name: str, text: str = "text",
               tokens: str | None = None) -> DataFrame:
    """All columns and the array of posteriors, in the order of the model's domains; with `tokens`,
    the number of words under that name too.

    What every element needs goes into the array beside it, and not into the lambda: a lambda works
    it out again for each element."""
    kept = [name, *([tokens] if tokens else [])]
    taken = [*docs.columns, *kept]
    prior = F.array(*[F.lit(float(p)) for p in model.prior])
    counter = tokens or unused(taken, "_size")
    words = unused(taken, "_words")
    split = docs.withColumn(words, word_counts(col(text))).withColumn(
        counter, F.size(col(words)).cast("long")
    )
    if model.bayes is None:
        return split.withColumn(name, prior).select(*map(col, [*docs.columns, *kept]))
    features, raw, weights = (unused(taken, c) for c in ("_features", "_scores", "_weights"))
    held = [unused(taken, c) for c in ("_raw", "_probability", "_prediction")]
    bayes = model.bayes.copy()
    bayes.setFeaturesCol(features).setPredictionCol(held[2])
    bayes.setRawPredictionCol(held[0]).setProbabilityCol(held[1])
    counted = HashingTF(inputCol=words, outputCol=features, numFeatures=WORD_SLOTS).transform(split)
    scored = bayes.transform(counted).withColumn(raw, vector_to_array(col(held[0])))
    power = F.pow(F.greatest(col(counter), F.lit(1)), F.lit(SOFTNESS))
    beside = F.struct(F.array_max(col(raw)).alias("top"), power.alias("by"))
    count = len(model.domains)
    weighed = scored.withColumn(weights, F.zip_with(
        col(raw), F.array_repeat(beside, count),
        lambda x, b: F.exp((x - b.getField("top")) / b.getField("by")),
    ))
    total = F.aggregate(col(weights), F.lit(0.0), lambda a, x: a + x)
    shares = F.zip_with(col(weights), F.array_repeat(total, count), lambda x, t: x / t)
    return weighed.withColumn(name, F.when(col(counter) > 0, shares).otherwise(prior)).select(
        *map(col, [*docs.columns, *kept])
    )


def own_targets(shares: dict[str, float], temperature: float = TEMPERATURE) -> dict[str, float]:
    """Target shares that flatten the domains' own."""
    powers = {d: max(s, 0.0) ** temperature for d, s in shares.items()}
    total = sum(powers.values())
    return {d: p / total for d, p in powers.items()} if total else {}


# --- the fit ----------------------------------------------------------------------------------

def rate(tokens: Column, member: Column, moved: np.ndarray | None) -> Column:
    """The rate when the steps add up to `moved`: 1 and the document's share of it, if above 0.

    The vector is an array and not one literal per domain, so that generated code does not change
    with its values."""
    if moved is None:
        return F.lit(1.0)
    share = F.aggregate(
        F.zip_with(member, F.array(*[F.lit(float(x)) for x in moved]), lambda p, m: p * m),
        F.lit(0.0), lambda a, x: a + x,
    )
    return F.greatest(F.lit(1.0) + tokens * share, F.lit(0.0))


def fit_rates(rows: DataFrame, targets: list[float], steps: int = STEPS) -> np.ndarray | None:
    """Projected gradient steps for `rows` (tokens, member): the sums over documents of rate times
    tokens times membership are to equal `targets` (shares of all tokens). Returns the sum of the
    steps, or None if there are no tokens.

    With A the matrix of tokens times membership, t the targets and m the sum of the steps, each
    step lowers sum(r^2)/2 - m't, whose gradient is the residual A'r - t. The residual is whitened
    with the second moments of the rows whose rate is above 0; a step that does not lower it is
    halved."""
    count = len(targets)
    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    share = [F.col("tokens") * F.element_at("member", i + 1) for i in range(count)]
    live = F.when(F.col("now") > 0, 1.0).otherwise(0.0)
    measures = [
        F.sum("tokens").alias("total"), F.sum(F.col("now") * F.col("now")).alias("square"),
        *[F.sum(share[i] * F.col("now")).alias(f"s{i}") for i in range(count)],
        *[F.sum(live * share[i] * share[j]).alias(f"g{i}_{j}") for i, j in pairs],
    ]
    best, best_value, step, slope, length = np.zeros(count), np.inf, np.zeros(count), 0.0, 1.0
    for _ in range(steps):
        moved = best + length * step
        now = rate(F.col("tokens"), F.col("member"), moved)
        sums = rows.select("tokens", "member", now.alias("now")).agg(*measures).first()
        if not sums["total"]:
            return None
        total = float(sums["total"])
        wanted = np.array(targets) * total
        value = float(sums["square"]) / 2 - float(moved @ wanted)
        if value > best_value + 1e-4 * length * slope:
            length /= 2
            continue
        residual = np.array([float(sums[f"s{i}"]) for i in range(count)]) - wanted
        best, best_value, length = moved, value, 1.0
        if np.abs(residual).sum() < CLOSE * total:
            break
        matrix = np.zeros((count, count))
        for i, j in pairs:
            matrix[i, j] = matrix[j, i] = float(sums[f"g{i}_{j}"])
        step = -(np.linalg.pinv(matrix, rcond=1e-10, hermitian=True) @ residual)
        slope = float(step @ residual)
        if slope >= -1e-12 * abs(best_value):
            break  # no direction is left: the targets are met as well as can be
    return best


def mix(docs: DataFrame, domain: str, targets: dict[str, float] | None = None,
        per_domain: int = SAMPLE_PER_DOMAIN) -> DataFrame:
    """All columns of `docs` with `rate`, `tokens` and `member` (posteriors), and `domains` their
    order (underscores are added to names that are taken).

    `targets` are shares by domain; without them the domains' own token shares are flattened."""
    group = col(domain).cast("string")
    if targets is None:
        worded = docs.where(group.isNotNull() & col("text").rlike(r"\S")).groupBy(group.alias("domain"))
        largest = worded.count().orderBy(F.desc("count"), "domain").limit(MOST_DOMAINS + 1).collect()
        domains = [r["domain"] for r in largest]
        if len(domains) > MOST_DOMAINS:
            named = domains[:MOST_DOMAINS - 1]
            group = F.when(group.isin(named), group).when(group.isNotNull(), F.lit(OTHER))
            domains = [*named, OTHER]
    else:
        targets = {d: t for d, t in targets.items() if t > 0}
        domains = list(targets)
        if len(domains) > MOST_DOMAINS:
            raise ValueError(f"{len(domains)} targets: one fit takes {MOST_DOMAINS} domains")
    labelled = docs.select(col("text").alias("text"), group.alias("domain"))
    model = fit(labelled, sorted(domains), per_domain)
    names = {n: unused(docs.columns, n) for n in ("rate", "tokens", "member", "domains")}
    # written once: the fit then reads two columns of it, and no document is split or scored twice
    rows = stage(
        posteriors(docs, model, names["member"], tokens=names["tokens"]), "memberships"
    )
    if targets is None:
        own = rows.groupBy(group.alias("d")).agg(
            F.sum(col(names["tokens"])).alias("n")
        )
        targets = own_targets({r["d"]: float(r["n"]) for r in own.where("d is not null").collect()})
    narrow = rows.select(
        col(names["tokens"]).alias("tokens"), col(names["member"]).alias("member")
    )
    wanted = np.array([targets.get(d, 0.0) for d in model.domains])
    wanted = wanted / wanted.sum() if wanted.sum() else np.ones(len(wanted)) / len(wanted)
    moved = fit_rates(narrow, wanted.tolist())
    return rows.withColumn(
        names["rate"], rate(col(names["tokens"]), col(names["member"]), moved)
    ).withColumn(names["domains"], F.array(*[F.lit(d) for d in model.domains]))


def copies(rate_: Column, *key: Column) -> Column:
    """Whole copies whose expectation is the rate: the rest is decided by a hash of the key."""
    share = F.xxhash64(*key).bitwiseAND(F.lit((1 << 30) - 1)) / F.lit(float(1 << 30))
    whole = F.floor(rate_)
    return (whole + (share < rate_ - whole).cast("long")).cast("int")


def resample(docs: DataFrame, domain: str, key: str = "doc_id",
             targets: dict[str, float] | None = None) -> DataFrame:
    """The documents as often as their rates say; the columns of `docs` only."""
    mixed = mix(docs, domain, targets)
    added = [c for c in mixed.columns if c not in docs.columns]
    name = next(c for c in added if c.rstrip("_") == "rate")
    times = copies(col(name), col(key), col("text"))
    taken = unused(docs.columns, "_copy")
    repeated = mixed.withColumn(taken, F.explode(F.array_repeat(F.lit(1), times)))
    return repeated.select(*[col(c) for c in docs.columns])
