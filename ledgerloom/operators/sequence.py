"""Dense numbering of a whole table without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.operators.ranges import with_range
from ledgerloom.session import stage

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a task in the low 33 bits


def task_of(position: str) -> Column:
    """The task that wrote a row, from its monotonically increasing id."""
    return F.shiftright(position, _ROW_BITS)


def dense_key(df: DataFrame, name: str, order_by: Sequence[str], drawn_from: DataFrame | None = None) -> DataFrame:
    """Number the rows 1, 2, 3, … in the order of `order_by`, which must be a total order.

    Split points are drawn from the order's columns alone, or from `drawn_from` if it is cheaper
    (see `with_range`). Each row moves once, into its range, is numbered there and written; its
    number is the rows of the ranges before it plus that. The offsets have one row per range,
    whatever the size of the table. A repeated order key is refused, unless the order has all
    columns, when the rows that share it are the same.
    """
    within = W.partitionBy("_range").orderBy(*order_by)
    again = F.lit(False)
    if not set(df.columns) <= set(order_by):
        key = F.struct(*order_by)
        again = (F.row_number().over(within) > 1) & F.lag(key).over(within).eqNullSafe(key)
    rows = stage(
        with_range(df, order_by, "_range", drawn_from)
        .withColumns({"_row": F.row_number().over(within), "_again": again}), f"dense-{name}", "zstd",
    )
    sizes = rows.groupBy("_range").agg(F.count("*").alias("rows"), F.count_if("_again").alias("again"))
    before, offsets, repeated = 0, [], 0
    for size in sorted(sizes.collect()):  # one row per range
        offsets.append((size["_range"], before))
        before += size["rows"]
        repeated += size["again"]
    if repeated:
        raise ValueError(f"{repeated} rows repeat their key {list(order_by)}: {name} would not be defined")
    starts = df.sparkSession.createDataFrame(offsets, "_range int, _before long")
    return rows.join(F.broadcast(starts), "_range").select(
        (F.col("_before") + F.col("_row")).alias(name), *[F.col(c) for c in df.columns]
    )
