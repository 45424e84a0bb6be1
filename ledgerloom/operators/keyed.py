"""One row per key, duplicate counts and existence flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row per key in the given order; give a total order to be deterministic.

    Catalyst pushes the `= 1` below the shuffle (WindowGroupLimit), so of a hot key each map
    task ships one row only.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows come after the first of their key (null keys are equal)."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.count("*").alias("unique_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows and share of non-nulls per value."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    total = counted.agg(F.sum("rows")).scalar()
    return counted.withColumn("share", F.col("rows") / total)


def label_counts(df: DataFrame, column: str, separator: str = ";") -> DataFrame:
    """Rows per label of a joined label column."""
    labels = df.select(F.explode(F.split(column, separator)).alias("label"))
    return labels.filter("label <> ''").groupBy("label").agg(F.count("*").alias("rows"))


def dangling(df: DataFrame, key: str, reference: DataFrame, ref_key: str) -> DataFrame:
    """Non-null values of `key` that `reference` does not have, with their row counts.

    The values are counted before the join, so a hot value crosses the network once per task.
    """
    values = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("value")).count()
    known = reference.select(F.col(ref_key).alias("value")).distinct()
    return values.join(known, "value", "left_anti").withColumnRenamed("count", "rows")
