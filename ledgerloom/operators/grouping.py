"""Grouped reports: shares, top groups with a remainder, cross tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import percent_of
from ledgerloom.session import stage


def share_of_total(grouped: DataFrame, measure: str, name: str) -> DataFrame:
    """Add the unrounded percentage of the total.

    The total is one scalar instead of a window that pulls all groups into one task. The groups
    are staged, because total and rows would otherwise each aggregate the source.
    """
    groups = stage(grouped, "groups")
    total = groups.agg(F.sum(measure)).scalar()
    return groups.withColumn(name, percent_of(F.col(measure), total))


def top_n_with_other(
    df: DataFrame, key: str, measure: str, n: int, name: str, other: str = "Other"
) -> DataFrame:
    """Sum per key for the `n` largest keys, everything else as one row."""
    sums = df.groupBy(key).agg(F.sum(measure).alias(measure))
    top = sums.orderBy(F.col(measure).desc_nulls_last(), F.col(key)).limit(n)
    marked = sums.join(
        F.broadcast(top.select(F.col(key).alias("_top"))),  # n rows
        F.col(key).eqNullSafe(F.col("_top")),
        "left",
    )
    label = F.when(F.col("_top").isNotNull(), F.col(key).cast("string")).otherwise(F.lit(other))
    return marked.groupBy(label.alias(name)).agg(F.sum(measure).alias(measure))


def cross_table(df: DataFrame, rows: str, columns: str, values: Sequence[str]) -> DataFrame:
    """Counts per pair, one column per entry of `values`, zero where a pair does not occur."""
    pivoted = df.groupBy(rows).pivot(columns, list(values)).agg(F.count(F.lit(1)))
    return pivoted.na.fill(0, list(values))
