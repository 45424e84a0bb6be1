"""Configurable data-quality checks, compiled into few passes, and a blocking gate.

A run yields a long table with one row per measurement:
dataset, check, column_name, metric, value, failed, note. Everything else (status per check,
critical failures, the report) is derived from that table.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import rules
from ledgerloom.functions import dates, numbers
from ledgerloom.session import stage

MEASUREMENT = [
    "dataset", "check", "column_name", "metric", "value", "failed", "note",
]
RULE_KEYS = {
    "completeness_threshold", "completeness_optional", "pk_columns", "numeric_ranges",
    "date_columns", "consistency_rules", "foreign_keys", "distribution_max_share", "freshness",
    "outlier_zscore",
}


class DataQualityError(ValueError):
    """Raised by the gate; nothing downstream may run."""


# --- configuration ----------------------------------------------------------------------------

def load_rules(path: str | None = None) -> dict:
    """The default rules, or the rules of a JSON or YAML file of the same shape."""
    if path is None:
        return rules.QUALITY_RULES
    with open(path, encoding="utf-8") as handle:
        if path.endswith(".json"):
            config = json.load(handle)
        else:
            try:
                import yaml
            except ImportError as error:  # pragma: no cover
                raise RuntimeError("YAML rules need PyYAML; use a .json file instead") from error
            config = yaml.safe_load(handle)
    for dataset, spec in config.items():
        unknown = set(spec) - RULE_KEYS
        if unknown:
            raise ValueError(f"{dataset}: unknown rule(s) {', '.join(sorted(unknown))}")
        spec["foreign_keys"] = {k: tuple(v) for k, v in spec.get("foreign_keys", {}).items()}
    return config


# --- checks -----------------------------------------------------------------------------------

@dataclass(frozen=True)
class Measure:
    """One number of the shared aggregation pass."""

    check: str
    column_name: str
    metric: str
    value: Column
    failed: Callable[[Column], Column]
    note: Column | None = None


def _positive(value: Column) -> Column:
    return value > 0


def _never(value: Column) -> Column:
    return F.lit(False)


def _blank(df: DataFrame, column: str) -> Column:
    value = F.col(f"`{column}`")
    blank = value.isNull() | (value.cast("string") == "")
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        blank = blank | F.isnan(value)
    return numbers.known(blank)


def _completeness(df: DataFrame, spec: Mapping, as_of: dt.date) -> list[Measure]:
    threshold = spec.get("completeness_threshold", rules.DEFAULT_COMPLETENESS)
    optional = set(spec.get("completeness_optional", ()))
    measures = []
    for c in df.columns:
        ratio = numbers.half_even(F.lit(1.0) - F.avg(_blank(df, c).cast("int")), 4)
        failed = _never if c in optional else (lambda value: value < threshold)
        measures.append(Measure("completeness", c, "ratio", ratio, failed))
    return measures


def _validity_numeric(df: DataFrame, spec: Mapping, as_of: dt.date) -> list[Measure]:
    measures = []
    for c, limits in spec.get("numeric_ranges", {}).items():
        if c in df.columns:
            number = numbers.to_number(F.col(c))
            low = F.count_if(number < limits["min"])
            high = F.count_if(number > limits["max"])
            measures.append(Measure("validity_numeric", c, "below_min", low, _positive))
            measures.append(Measure("validity_numeric", c, "above_max", high, _positive))
    return measures


def _as_day(df: DataFrame, column: str) -> Column:
    if isinstance(df.schema[column].dataType, T.StringType):
        return dates.parse_day(F.col(column))
    return F.col(column)


def _validity_date(df: DataFrame, spec: Mapping, as_of: dt.date) -> list[Measure]:
    measures = []
    for c, options in spec.get("date_columns", {}).items():
        if c in df.columns:
            day = _as_day(df, c)
            unreadable = F.count_if(F.col(c).isNotNull() & day.isNull())
            measures.append(Measure("validity_date", c, "unparseable", unreadable, _positive))
            if not options.get("allow_future", True):
                future = F.count_if(day > F.lit(as_of))
                measures.append(Measure("validity_date", c, "future", future, _positive))
    return measures


def _consistency(df: DataFrame, spec: Mapping, as_of: dt.date) -> list[Measure]:
    measures = []
    for rule in spec.get("consistency_rules", ()):
        kind = rule["type"]
        if kind == "before":
            a, b = rule["columns"]
            wrong, columns, label = _as_day(df, a) >= _as_day(df, b), [a, b], f"{a} < {b}"
        elif kind == "non_negative":
            c = rule["column"]
            wrong, columns, label = numbers.to_number(F.col(c)) < 0, [c], f"{c} >= 0"
        elif kind == "level_salary_band":
            c = rule["salary_column"]
            wrong = numbers.off_band(F.col(c), F.col(rule["level_column"]), rule["bands"])
            columns, label = [c], "salary within level band"
        else:
            unknown = F.max(F.lit(None).cast("long"))
            label = f"unknown rule type {kind}"
            measures.append(Measure("consistency", "", label, unknown, lambda v: F.lit(True)))
            continue
        measures.append(
            Measure("consistency", ";".join(columns), label, F.count_if(wrong), _positive)
        )
    return measures


def _freshness(df: DataFrame, spec: Mapping, as_of: dt.date) -> list[Measure]:
    rule = spec.get("freshness")
    if not rule:
        return []
    c = rule["date_column"]
    newest = F.max(_as_day(df, c))
    age = F.datediff(F.lit(as_of), newest)
    too_old = lambda value: value > rule["max_age_days"]
    return [
        Measure("freshness", c, "age_days", age, too_old, newest.cast("date").cast("string"))
    ]


def _rows(dataset, check, column_name, metric, value, failed, note=None) -> list[Column]:
    return [
        F.lit(dataset).alias("dataset"), F.lit(check).alias("check"),
        F.lit(column_name).alias("column_name"), F.lit(metric).alias("metric"),
        value.cast("double").alias("value"), numbers.known(failed).alias("failed"),
        (F.lit(None) if note is None else note).cast("string").alias("note"),
    ]


@dataclass(frozen=True)
class Shared:
    """What the grouped checks of one table read instead of the table: `counts` has the rows per
    (column_name, value) of all columns that need it, `moments` mean and deviation by column."""

    counts: DataFrame
    moments: Mapping[str, tuple[float, float]]

    def of(self, column: str) -> DataFrame:
        return self.counts.where(F.col("column_name") == column)


def _key_name(keys: Sequence[str]) -> str:
    return ";".join(keys)


def _counted_columns(df: DataFrame, spec: Mapping, names: Sequence[str]) -> dict[str, Column]:
    """The columns, as text, whose values are counted. A key of several columns is one JSON text."""
    wanted: dict[str, Column] = {}
    if "uniqueness" in names and spec.get("pk_columns"):
        keys = spec["pk_columns"]
        wanted[_key_name(keys)] = F.to_json(F.struct(*keys)) if len(keys) > 1 else F.col(keys[0])
    if "referential_integrity" in names:
        wanted |= {c: F.col(c) for c in spec.get("foreign_keys", {}) if c in df.columns}
    rule = spec.get("distribution_max_share")
    if "distribution" in names and rule:
        wanted |= {c: F.col(c) for c in rule["columns"] if c in df.columns}
    return wanted


def _value_counts(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Staged rows per (column_name, value), null values included: one pass for all columns, in
    which each task counts what it reads before anything is shuffled."""
    if not columns:
        return df.sparkSession.createDataFrame([], "column_name string, value string, n long")
    melted = df.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("column_name"), value.cast("string").alias("value"))
        for name, value in columns.items()
    ])))
    return stage(melted.groupBy("column_name", "value").agg(F.count("*").alias("n")), "value-counts")


def _uniqueness(df, dataset, spec, references, shared) -> list[DataFrame]:
    keys = spec.get("pk_columns")
    if not keys:
        return []
    counted = shared.of(_key_name(keys)).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("unique_rows"))
    n = F.col("rows") - F.col("unique_rows")
    note = F.concat_ws("/", F.col("unique_rows").cast("string"), F.col("rows").cast("string"))
    return [counted.select(
        *_rows(dataset, "uniqueness", _key_name(keys), "duplicates", n, n > 0, note)
    )]


def _referential(df, dataset, spec, references, shared) -> list[DataFrame]:
    parts = []
    for c, (table, ref_key) in spec.get("foreign_keys", {}).items():
        if c in df.columns and references.get(table) is not None:
            known = references[table].select(F.col(ref_key).cast("string").alias("value")).distinct()
            missing = shared.of(c).where("value is not null").join(known, "value", "left_anti")
            n = F.coalesce(F.sum("n"), F.lit(0))
            parts.append(missing.agg(n.alias("n")).select(
                *_rows(dataset, "referential_integrity", c, "orphans", F.col("n"), F.col("n") > 0,
                       F.lit(f"{table}.{ref_key}"))
            ))
    return parts


def _distribution(df, dataset, spec, references, shared) -> list[DataFrame]:
    """Largest share per column."""
    rule = spec.get("distribution_max_share")
    columns = [c for c in rule["columns"] if c in df.columns] if rule else []
    if not columns:
        return []
    counted = shared.counts.where(F.col("column_name").isin(columns) & F.col("value").isNotNull())
    top = counted.groupBy("column_name").agg(
        (F.max("n") / F.sum("n")).alias("share"),
        F.max_by("value", F.struct("n", "value")).alias("top"),
    )
    named = _rows(
        dataset, "distribution", "", "top_share", F.col("share"),
        F.col("share") > rule["threshold"], F.col("top"),
    )
    named[2] = F.col("column_name")
    return [top.select(*named)]


def _outlier_columns(df: DataFrame, spec: Mapping) -> list[str]:
    rule = spec.get("outlier_zscore")
    return [c for c in rule["columns"] if c in df.columns] if rule else []


def _outliers(df, dataset, spec, references, shared) -> list[DataFrame]:
    """Outliers of all columns in one pass; mean and deviation come from the pass of the measures."""
    columns = _outlier_columns(df, spec)
    if not columns:
        return []
    counts = []
    for c in columns:
        mean, deviation = shared.moments[c]
        score = F.abs(numbers.to_number(F.col(c)) - F.lit(mean)) / F.lit(deviation or None)
        counts.append(F.count_if(score > spec["outlier_zscore"]["threshold"]).alias(c))
    counted = df.agg(*counts)
    return [counted.select(F.inline(F.array(*[
        F.struct(*_rows(dataset, "outliers", c, "beyond", F.col(c), F.col(c) > 0)) for c in columns
    ])))]


# Checks that are plain aggregates share one pass over the table, those on values a second one;
# outliers need a third, as they are judged by what the first one finds.
# A new check is one more entry.
PASS_CHECKS: dict[str, Callable[..., list[Measure]]] = {
    "completeness": _completeness,
    "validity_numeric": _validity_numeric,
    "validity_date": _validity_date,
    "consistency": _consistency,
    "freshness": _freshness,
}
GROUPED_CHECKS: dict[str, Callable[..., list[DataFrame]]] = {
    "uniqueness": _uniqueness,
    "referential_integrity": _referential,
    "distribution": _distribution,
    "outliers": _outliers,
}
# Report order, and the checks that run only when configured.
CHECK_ORDER = [
    "completeness", "uniqueness", "validity_numeric", "validity_date", "consistency",
    "referential_integrity", "distribution", "freshness", "outliers",
]
OPTIONAL_CHECKS = {
    "distribution": "distribution_max_share", "freshness": "freshness",
    "outliers": "outlier_zscore",
}


def configured_checks(spec: Mapping) -> list[str]:
    extra = [c for c in (*PASS_CHECKS, *GROUPED_CHECKS) if c not in CHECK_ORDER]
    return [
        c for c in [*CHECK_ORDER, *extra]
        if c not in OPTIONAL_CHECKS or spec.get(OPTIONAL_CHECKS[c])
    ]


def _one_pass(df: DataFrame, dataset: str, spec: Mapping, as_of: dt.date, names):
    """The rows of all plain measures, and mean and deviation of the columns checked for outliers."""
    measures = [m for n in names if n in PASS_CHECKS for m in PASS_CHECKS[n](df, spec, as_of)]
    judged = _outlier_columns(df, spec) if "outliers" in names else []
    aggregates = []
    for i, m in enumerate(measures):
        aggregates.append(m.value.alias(f"m{i}"))
        if m.note is not None:
            aggregates.append(m.note.alias(f"n{i}"))
    for i, c in enumerate(judged):
        number = numbers.to_number(F.col(c))
        aggregates += [F.avg(number).alias(f"mean{i}"), F.stddev_pop(number).alias(f"deviation{i}")]
    if not aggregates:
        return [], {}
    one = df.agg(*aggregates)
    moments = {}
    if judged:
        one = stage(one, "measures")
        found = one.first()
        moments = {c: (found[f"mean{i}"], found[f"deviation{i}"]) for i, c in enumerate(judged)}
    structs = [
        F.struct(*_rows(
            dataset, m.check, m.column_name, m.metric, F.col(f"m{i}"), m.failed(F.col(f"m{i}")),
            None if m.note is None else F.col(f"n{i}"),
        ))
        for i, m in enumerate(measures)
    ]
    return [one.select(F.inline(F.array(*structs)))] if structs else [], moments


def run_checks(
    df: DataFrame,
    dataset: str,
    *,
    config: Mapping | None = None,
    references: Mapping[str, DataFrame] | None = None,
    as_of: dt.date,
    only: list[str] | None = None,
) -> DataFrame:
    """All measurements of the checks configured for `dataset`. The table is read once for the plain
    measures, once for the counts per value, and once for outliers."""
    spec = (rules.QUALITY_RULES if config is None else config).get(dataset, {})
    known = {dataset: df, **(references or {})}
    names = [c for c in configured_checks(spec) if only is None or c in only]
    parts, moments = _one_pass(df, dataset, spec, as_of, names)
    shared = Shared(_value_counts(df, _counted_columns(df, spec, names)), moments)
    for name in names:
        if name in GROUPED_CHECKS:
            parts += GROUPED_CHECKS[name](df, dataset, spec, known, shared)
    # One marker row per check, so that a check without findings still counts as run.
    markers = df.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(*_rows(dataset, n, "", "configured", F.lit(1), F.lit(False))) for n in names
    ])))
    for part in parts:
        markers = markers.unionByName(part)
    return markers


def run_all(
    datasets: Mapping[str, DataFrame], *, config: Mapping | None = None, as_of: dt.date,
    references: Mapping[str, DataFrame] | None = None, only: list[str] | None = None,
) -> DataFrame:
    """Measurements of several datasets, which are references of each other."""
    known = {**datasets, **(references or {})}
    result = None
    for name, df in datasets.items():
        part = run_checks(df, name, config=config, references=known, as_of=as_of, only=only)
        result = part if result is None else result.unionByName(part)
    return result


def check_status(measurements: DataFrame) -> DataFrame:
    """PASS or FAIL per dataset and check, with the failed columns (bounded by the config)."""
    columns = F.flatten(F.collect_set(F.when(F.col("failed"), F.split("column_name", ";"))))
    failed = F.array_sort(F.array_distinct(F.filter(columns, lambda c: c != "")))
    return measurements.groupBy("dataset", "check").agg(
        F.when(F.max("failed"), "FAIL").otherwise("PASS").alias("status"),
        F.array_join(failed, ";").alias("failed_columns"),
    )


def critical_failures(
    measurements: DataFrame, config: Mapping | None = None,
    limit: float = rules.CRITICAL_COMPLETENESS,
) -> DataFrame:
    """Required columns that are less than `limit` complete."""
    config = rules.QUALITY_RULES if config is None else config
    rows = measurements.filter(
        (F.col("check") == "completeness") & (F.col("metric") == "ratio")
        & (F.col("value") < limit)
    )
    for dataset, spec in config.items():
        optional = list(spec.get("completeness_optional", ()))
        if optional:
            rows = rows.filter(
                (F.col("dataset") != dataset) | ~F.col("column_name").isin(*optional)
            )
    return rows.select("dataset", "column_name", F.col("value").alias("completeness"))


def enforce_gate(
    datasets: Mapping[str, DataFrame], *, as_of: dt.date, config: Mapping | None = None
) -> dict[str, dict]:
    """Run every check; raise if a required column is critically incomplete.

    Collects one row per measurement, a number the configuration and the schemas fix.
    """
    from ledgerloom.plans.reports import result_documents

    measured = stage(run_all(datasets, config=config, as_of=as_of), "measured")
    found = [
        f"{r['dataset']}.{r['column_name']} is {r['completeness']:.0%} complete"
        for r in critical_failures(measured, config).orderBy("dataset", "column_name").collect()
    ]
    if found:
        least = f"{rules.CRITICAL_COMPLETENESS:.0%}"
        raise DataQualityError(f"the gate needs {least} of required columns: " + "; ".join(found))
    return result_documents(measured, config)
