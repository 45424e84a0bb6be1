"""URL filter: lists of rules, and boosted trees on lexical features for what no rule names.

A rule is a host and a path. It fits its host and all subdomains, if the path of the URL starts
with the rule's; the longest fitting rule wins. URLs that a rule allows or blocks are the labelled
rows. Gradient-boosted trees learn from a bounded sample of them: lengths, depth, shares of digits
and capitals, the entropy of the characters, numbers of parameters and separators, and statistics
of the host's suffix, which are counts over all labelled rows. Features are DataFrame expressions
and the trees are Spark's own, so no row passes through Python.

Defined cases: host and path of a null URL, or of one without `://`, are empty, and such a URL is
judged by its features like any other; without labelled rows of both kinds every URL that no rule
names is allowed; rows with equal URLs get equal verdicts; an empty table gives an empty result;
other columns pass through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerloom.llm.support import col, unused
from ledgerloom.session import stage

ALLOW, BLOCK = "allow", "block"
#: Bound of the training sample, per label, by the order of a hash.
SAMPLE_PER_LABEL = 5_000
ROUNDS, DEPTH, STEP = 12, 3, 0.2
_LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789-._/=&?%#:"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end; A to Z in lower case."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.regexp_extract(_after(url), r"(?s)^([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), upper, upper.lower())


def path_of(url: Column) -> Column:
    """From the end of the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(_after(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, or null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(rule.text)).otherwise(found)
    return found


# --- features ---------------------------------------------------------------------------------

def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _entropy(text: Column) -> Column:
    """Bits per character over the letters, digits and signs that URLs are made of."""
    length = F.greatest(F.length(text), F.lit(1))
    letters = F.array(*[F.lit(x) for x in _LETTERS])
    shares = F.transform(
        letters, lambda x: (F.length(text) - F.length(F.replace(text, x, F.lit("")))) / length
    )
    bits = F.transform(F.filter(shares, lambda p: p > 0), lambda p: -p * F.log2(p))
    return F.aggregate(bits, F.lit(0.0), lambda a, x: a + x)


def features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """The lexical features, as doubles."""
    whole = F.coalesce(url, F.lit(""))
    length = F.greatest(F.length(whole), F.lit(1))
    query = F.regexp_extract(whole, r"(?s)\?([^#]*)", 1)
    last = F.element_at(F.split(path, "/"), -1)
    columns = {
        "f_length": F.length(whole), "f_host_length": F.length(host), "f_path_length": F.length(path),
        "f_depth": _count(path, "/"), "f_labels": _count(host, r"\.") + 1,
        "f_digit_ratio": _count(whole, "[0-9]") / length,
        "f_host_digit_ratio": _count(host, "[0-9]") / F.greatest(F.length(host), F.lit(1)),
        "f_capital_ratio": _count(whole, "[A-Z]") / length,
        "f_parameters": F.when(query == "", 0).otherwise(_count(query, "&") + 1),
        "f_hyphens": _count(whole, "-"), "f_percents": _count(whole, "%"),
        "f_last_length": F.length(last), "f_last_digits": _count(last, "[0-9]"),
        "f_has_fragment": whole.contains("#").cast("int"),
        "f_secure": whole.startswith("https").cast("int"),
        "f_entropy": _entropy(F.lower(whole)), "f_host_entropy": _entropy(host),
    }
    return {name: c.cast("double") for name, c in columns.items()}


def suffixes(host: Column, path: Column) -> dict[str, Column]:
    """The keys whose label counts become features: top level, last two labels, first folder."""
    labels = F.split(host, r"\.")
    return {
        "s_top": F.element_at(labels, -1),
        "s_domain": F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), "."),
        "s_folder": F.coalesce(F.get(F.split(path, "/"), F.lit(1)), F.lit("")),
    }


def suffix_statistics(labelled: DataFrame) -> dict[str, DataFrame]:
    """Per suffix: the smoothed logarithm of blocked against allowed rows, over all labelled rows.
    Counted with partial sums, so a suffix that most rows share is no burden."""
    result = {}
    for name in ("s_top", "s_domain", "s_folder"):
        blocked = F.sum("label")
        odds = F.log((blocked + 1.0) / (F.count("*") - blocked + 1.0))
        result[name] = labelled.groupBy(name).agg(odds.alias("f" + name))
    return result


def _with_statistics(rows: DataFrame, statistics: dict[str, DataFrame]) -> DataFrame:
    for name, counted in statistics.items():
        rows = rows.join(counted, name, "left").withColumn(
            "f" + name, F.coalesce(F.col("f" + name), F.lit(0.0))
        )
    return rows


# --- training and judging ---------------------------------------------------------------------

@dataclass
class UrlModel:
    """The trees (none if one label is absent) and the suffix statistics."""

    trees: GBTClassificationModel | None
    statistics: dict[str, DataFrame]
    names: list[str]


def _described(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """Distinct URLs with host, path, rule, features and suffixes."""
    urls = pages.select(col("url").alias("_url")).distinct()
    parts = urls.withColumn("_host", host_of(F.col("_url"))).withColumn("_path", path_of(F.col("_url")))
    host, path = F.col("_host"), F.col("_path")
    verdicts = {r.text: r.verdict for r in rules}
    rule = rule_of(host, path, rules)
    listed = reduce(
        lambda found, t: F.when(F.col("_rule") == t, verdicts[t]).otherwise(found), verdicts,
        F.lit(None).cast("string"),
    )
    return (
        parts.withColumn("_rule", rule).withColumn("_listed", listed)
        .withColumns(features(F.col("_url"), host, path)).withColumns(suffixes(host, path))
    )


def fit(described: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> UrlModel:
    """Learn from the URLs that a rule names."""
    names = [c for c in described.columns if c.startswith("f_")] + ["fs_top", "fs_domain", "fs_folder"]
    labelled = described.where("_listed is not null").withColumn(
        "label", (F.col("_listed") == BLOCK).cast("double")
    )
    statistics = suffix_statistics(labelled)
    order = W.partitionBy("label").orderBy(F.xxhash64("_url"), "_url")
    few = labelled.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= per_label)
    rows = stage(_with_statistics(few, statistics).select("label", *names), "url-sample")
    if rows.select("label").distinct().count() < 2:
        return UrlModel(None, statistics, names)
    assembled = VectorAssembler(inputCols=names, outputCol="features").transform(rows)
    trees = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, stepSize=STEP, seed=7).fit(assembled)
    return UrlModel(trees, statistics, names)


def judge(pages: DataFrame, rules: list[Rule], per_label: int = SAMPLE_PER_LABEL) -> DataFrame:
    """All columns of `pages` with host, path, rule, verdict and block_score (the trees' share for
    blocking; null where a rule decides)."""
    described = stage(_described(pages, rules), "urls")
    model = fit(described, per_label)
    rows = _with_statistics(described, model.statistics)
    if model.trees is None:
        scored = rows.withColumn("_score", F.lit(0.0))
    else:
        assembled = VectorAssembler(inputCols=model.names, outputCol="features").transform(rows)
        scored = model.trees.transform(assembled).withColumn(
            "_score", F.element_at(vector_to_array("probability"), 2)
        )
    verdict = F.coalesce("_listed", F.when(F.col("_score") >= 0.5, BLOCK).otherwise(ALLOW))
    own = unused(pages.columns, "_own_url")
    answers = scored.select(
        F.col("_url").alias(own), F.col("_host"), F.col("_path"), F.col("_rule"),
        verdict.alias("_verdict"), F.when(F.col("_rule").isNull(), F.col("_score")).alias("_score"),
    )
    taken = list(pages.columns)
    names = {}
    for name in ("host", "path", "rule", "verdict", "block_score"):
        names[name] = unused(taken, name)
        taken.append(names[name])
    joined = pages.join(answers, col("url").eqNullSafe(F.col(own)), "left")
    return joined.select(
        *[col(c) for c in pages.columns], F.col("_host").alias(names["host"]),
        F.col("_path").alias(names["path"]), F.col("_rule").alias(names["rule"]),
        F.col("_verdict").alias(names["verdict"]), F.col("_score").alias(names["block_score"]),
    )
