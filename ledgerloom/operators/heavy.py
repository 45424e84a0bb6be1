"""Joins on a key that a large share of the rows may have."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is heavy if more than one row in HEAVY_PARTS has it, so there are fewer heavy keys than this.
HEAVY_PARTS = 200


def heavy_keys(df: DataFrame, key: str, parts: int = HEAVY_PARTS) -> list:
    """The keys that more than one row in `parts` has: fewer than `parts` values, nulls aside.

    Rows are counted per key by each task before the shuffle, so a heavy key costs one row a task.
    """
    counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_rows"))
    rows = df.count()
    return [r[0] for r in counted.where(F.col("_rows") * parts > rows).select(key).collect()]


def heavy_join(df: DataFrame, reference: DataFrame, key: str, ref_key: str | None = None,
               parts: int = HEAVY_PARTS) -> DataFrame:
    """Left join with a reference that has one row a key; no task gets a heavy key's rows.

    Rows with a heavy key stay where they are: their reference rows, fewer than `parts`, go to
    every task. Rows without a key stay too, and get nulls. Only the rest is shuffled, and none
    of its keys has more than one row in `parts`. `df` is read three times (count, heavy rows,
    other rows): hand in a staged table. The columns of the reference other than its key are added.
    """
    ref_key = ref_key or key
    side = reference.withColumnRenamed(ref_key, "_ref_key")
    heavy = heavy_keys(df, key, parts)
    is_heavy = F.col(key).isin(heavy) if heavy else F.lit(False)
    few = side.where(F.col("_ref_key").isin(heavy) if heavy else F.lit(False))
    staying = df.where(F.col(key).isNull() | is_heavy)
    moving = df.where(F.col(key).isNotNull() & ~is_heavy)
    match = F.col(key) == F.col("_ref_key")
    rest = side.where(~F.col("_ref_key").isin(heavy)) if heavy else side
    joined = staying.join(F.broadcast(few), match, "left").unionByName(moving.join(rest, match, "left"))
    return joined.drop("_ref_key")
