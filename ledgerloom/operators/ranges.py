"""Cut a table into ranges of an order, with split points that are drawn once from the order alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import shuffles_removed

#: Ranges per shuffle partition, and keys drawn per range.
RANGES_PER_TASK = 4
DRAWN = 50


def split_points(keys: DataFrame, ranges: int | None = None) -> list[tuple]:
    """At most `ranges` - 1 ascending keys that cut the rows into about equal ranges.

    `keys` holds the order's columns and nothing else, so only they are read. The driver gets
    DRAWN keys a range, whatever the size of the table. The points steer balance only: the
    ranges are whole for any points.
    """
    spark = keys.sparkSession
    ranges = ranges or RANGES_PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = ranges * DRAWN
    with shuffles_removed(spark):
        rows = keys.count()
        drawn = (keys.sample(wanted / rows, seed=1) if rows > wanted else keys).collect()
    ordered = sorted(map(tuple, drawn), key=lambda key: [(x is not None, x) for x in key])
    points = [ordered[i * len(ordered) // ranges] for i in range(1, ranges)] if ordered else []
    return [p for i, p in enumerate(points) if i == 0 or p != points[i - 1]]


def range_number(keys: DataFrame, points: list[tuple]) -> Column:
    """The number of the range a row belongs to, from 0, by the columns that `keys` has.

    Compared first with every n-th point and then with those in between, which takes as many
    comparisons as twice the root of the number of points.
    """
    fields = keys.schema.fields

    def literal(point: tuple) -> Column:
        return F.struct(*[F.lit(x).cast(f.dataType).alias(f.name) for x, f in zip(point, fields, strict=True)])

    def below(some: Column) -> Column:
        return F.size(F.filter(some, lambda p: p <= F.struct(*[F.col(f.name) for f in fields])))

    if not points:
        return F.lit(0)
    step = max(1, round(len(points) ** 0.5))
    every = F.array(*[literal(p) for p in points])
    passed = below(F.array(*[literal(p) for p in points[step - 1::step]])) * step
    return (passed + below(F.slice(every, passed + 1, F.lit(step)))).cast("int")


def place(df: DataFrame, keys: DataFrame, points: list[tuple], name: str) -> DataFrame:
    """Add `range_number` as `name`, by halving: one projection a step, each of them compiled, so a
    row costs as many comparisons as the number of points has binary digits."""
    if not points:
        return df.withColumn(name, F.lit(0))
    fields = keys.schema.fieldNames()
    table = df.sparkSession.createDataFrame(points, keys.schema)
    ascending = table.agg(F.sort_array(F.collect_list(F.struct(*fields)))).scalar()
    placed = df.withColumns({"_points": ascending, "_probe": F.struct(*fields), name: F.lit(0)})
    step = 1 << (len(points).bit_length() - 1)
    while step:
        reached = F.col(name) + F.lit(step)
        fits = F.get("_points", reached - 1) <= F.col("_probe")  # null beyond the last point
        placed = placed.withColumn(name, F.when(fits, reached).otherwise(F.col(name)))
        step //= 2
    return placed.drop("_points", "_probe")


def with_range(
    df: DataFrame, order_by: Sequence[str], name: str, drawn_from: DataFrame | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add the range number as `name` and bring each range into one task; rows move once.

    `drawn_from` has the leading columns of the order (all of them by default); points are drawn
    from it, so that an expensive `df` is computed only once. `keep` names the columns that move,
    all of them by default.
    """
    keys = df.select(*order_by) if drawn_from is None else drawn_from
    placed = place(df, keys, split_points(keys), name)
    return placed.select(*(df.columns if keep is None else keep), name).repartition(name)
