"""Match opening events with the closing event that follows them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.carry import carry_last


def match_following(
    df: DataFrame,
    *,
    opens: Column,
    closes: Column,
    key: str,
    time: str,
    row_id: str,
    open_fields: list[str],
    close_fields: list[str],
) -> DataFrame:
    """Every opening row with the earliest closing row of its key at or after it and before the
    next opening row; rows that stay open keep nulls.

    A closing row belongs to the last opening row before it, so a range join is not needed:
    carry the id of the last opening row forward, then group by that id. At equal times an
    opening row sorts first and the id breaks ties. Opening rows without key or time stay open.
    """
    rows = df.filter(opens | closes).select(
        key, time, row_id, *{c: None for c in [*open_fields, *close_fields]},
        opens.alias("_opens"),
    )
    rows = rows.withColumn("_opener", F.when(F.col("_opens"), F.col(row_id)))
    carried = carry_last(
        rows,
        key=key,
        time=time,
        value="_opener",
        tie=[(~F.col("_opens")).cast("int"), F.col(row_id)],
    )
    owner = F.when(F.col("_opens"), F.col(row_id)).otherwise(F.col("_carried"))
    closing = F.struct(F.col(time).alias("closed_at"), F.col(row_id), *close_fields)
    opening = F.struct(F.col(key).alias("key"), F.col(time).alias("opened_at"), *open_fields)
    grouped = (
        carried.withColumn("_owner", owner)
        .filter(F.col("_owner").isNotNull())
        .groupBy("_owner")
        .agg(
            F.max(F.when(F.col("_opens"), opening)).alias("_open"),
            F.min(F.when(~F.col("_opens"), closing)).alias("_close"),
        )
    )
    return grouped.select(
        F.col("_owner").alias(row_id),
        F.col("_open.key").alias(key),
        F.col("_open.opened_at").alias("opened_at"),
        *[F.col("_open")[c].alias(c) for c in open_fields],
        F.col("_close.closed_at").alias("closed_at"),
        *[F.col("_close")[c].alias(c) for c in close_fields],
    )
