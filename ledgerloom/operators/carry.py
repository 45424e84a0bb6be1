"""Carry the latest earlier value forward within a key, over as many tasks as its rows need."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.operators.heavy import heavy_join
from ledgerloom.operators.ranges import with_range
from ledgerloom.session import stage


def carry_last(
    df: DataFrame,
    *,
    key: str,
    time: str,
    value: str,
    tie: Sequence[Column],
    lookup: DataFrame | None = None,
) -> DataFrame:
    """Add `_carried`: the last non-null `value` at or before each row, in (time, tie) order.

    The rows are cut into ranges of (key, time, tie), so that a hot key, and even one instant of
    it, lies in several tasks. Each row moves once, with its own columns and no others: the order is
    worked out again where it arrives. A window works inside a range; what a key has when a range
    begins comes from the ends of the ranges before it, one row per range. `lookup`
    adds columns per key (unique `key`), also to rows without time. Rows without key or time carry
    nothing and are spread over ranges by their hash.
    """
    usable = F.col(key).isNotNull() & F.col(time).isNotNull()
    spread = F.xxhash64(*[F.col(c) for c in df.columns if not has_map(df, c)])
    order = ["_c_key", "_c_time", *[f"_c_tie{i}" for i in range(len(tie))], "_c_spread"]
    order_of = {
        "_c_key": F.when(usable, F.col(key)),
        "_c_time": F.when(usable, F.col(time)),
        **{f"_c_tie{i}": F.when(usable, t) for i, t in enumerate(tie)},
        "_c_spread": F.when(~usable, spread),
    }
    within = W.partitionBy("_range", "_c_key").orderBy(*order[1:])
    so_far = within.rowsBetween(W.unboundedPreceding, W.currentRow)
    moved = with_range(df.withColumns(order_of), order, "_range", keep=df.columns)
    local = moved.withColumns(order_of).withColumns({
        "_inside": F.when(F.col("_c_key").isNotNull(), F.last(F.col(value), ignorenulls=True).over(so_far)),
        "_ends": F.lead(F.lit(True)).over(within).isNull(),
    })
    staged = stage(local.select(*df.columns, "_range", "_inside", "_ends"), "carried", "zstd")
    rows = staged.withColumn("_c_key", order_of["_c_key"])

    # the last row of each key in a range; that of the last key tells what the next range begins with
    ends = rows.where("_c_key is not null and _ends").groupBy("_range").agg(
        F.min("_c_key").alias("_first"), F.max("_c_key").alias("_last"),
        F.max_by("_inside", "_c_key").alias("_tail"),
    )
    upto = W.partitionBy("_last").orderBy("_range").rowsBetween(W.unboundedPreceding, W.currentRow)
    before = W.orderBy("_range")
    entering = ends.withColumn("_tail", F.last("_tail", ignorenulls=True).over(upto)).select(
        "_range", F.col("_first").alias("_entry_key"),
        F.when(F.lag("_last").over(before) == F.col("_first"), F.lag("_tail").over(before)).alias("_entering"),
    )
    entered = F.when(F.col("_c_key") == F.col("_entry_key"), F.col("_entering"))
    carried = rows.join(F.broadcast(entering), "_range", "left").withColumn(
        "_carried", F.coalesce("_inside", entered)
    )
    if lookup is None:
        return carried.select(*df.columns, "_carried")
    found = heavy_join(carried, lookup.withColumnRenamed(key, "_lookup_key"), key, "_lookup_key")
    return found.select(*df.columns, "_carried", *[c for c in lookup.columns if c != key])


def has_map(df: DataFrame, column: str) -> bool:
    """Maps have no order and no hash."""
    return "map<" in df.schema[column].dataType.simpleString()
