"""Running totals of a stream, kept per batch, and publishing with a number per key.

A batch writes its results into folders named by its batch id, over whatever an earlier attempt left
there, and its totals are those of the batch before it plus its own. So a replayed batch changes
nothing, totals cover all batches of all runs, and only the folders of the last two batches stay.
"""

from __future__ import annotations

import re
import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.heavy import heavy_join
from ledgerloom.operators.sequence import dense_key
from ledgerloom.session import stage

#: Totals by event type; one more row, without a type, has the totals that belong to no type.
TOTALS = (
    "event_type string, messages long, late long, forwarded long, malformed long, batches long, "
    "seconds double, newest timestamp"
)
SEQUENCES = "key string, published long"


# --- folders by batch -------------------------------------------------------------------------

def _batch_ids(spark: SparkSession, path: str) -> list[int]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    names = (s.getPath().getName() for s in system.listStatus(folder))
    return sorted(int(m[1]) for m in map(re.compile(r"batch_id=(\d+)$").match, names) if m)


def newest(spark: SparkSession, path: str, schema: str, before: int | None = None) -> DataFrame:
    """What the last batch (before a batch id) wrote; no rows if there is none."""
    ids = [i for i in _batch_ids(spark, path) if before is None or i < before]
    return spark.read.schema(schema).parquet(f"{path}/batch_id={ids[-1]}") if ids else (
        spark.createDataFrame([], schema))


def _put(df: DataFrame, path: str, batch_id: int) -> None:
    """Write the folder of a batch and remove those that no replay can ask for."""
    spark = df.sparkSession
    df.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    for old in _batch_ids(spark, path):
        if old < batch_id - 1:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id={old}")
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


# --- totals -----------------------------------------------------------------------------------

def totals_sink(path: str, malformed: Column, forwarded: Column, lateness: str = "1 day"):
    """Add each batch to the totals below `path`.

    A row is malformed, or it counts for its type (`unknown` without one); it is late if it is older
    than the newest event of earlier batches by more than `lateness`. Late rows are counted, not dropped.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        started = time.time()
        spark = batch.sparkSession
        before = stage(newest(spark, path, TOTALS, batch_id), "totals-before")
        seen = before.agg(F.max("newest")).scalar()
        late = F.col("timestamp") < seen - F.expr(f"INTERVAL {lateness}")
        kind = F.when(~malformed, F.coalesce("event_type", F.lit("unknown")))
        own = stage(batch.groupBy(kind.alias("event_type")).agg(
            F.count_if(~malformed).alias("messages"), F.count_if(~malformed & late).alias("late"),
            F.count_if(~malformed & forwarded).alias("forwarded"),
            F.count_if(malformed).alias("malformed"), F.max("timestamp").alias("newest"),
        ), "totals-own")
        spent = spark.range(1).select(
            F.lit(None).cast("string").alias("event_type"), F.lit(1).alias("batches"),
            F.lit(time.time() - started).alias("seconds"),
        )
        parts = before.unionByName(own, allowMissingColumns=True).unionByName(spent, allowMissingColumns=True)
        sums = ["messages", "late", "forwarded", "malformed", "batches", "seconds"]
        summed = parts.groupBy("event_type").agg(
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums], F.max("newest").alias("newest"))
        columns = [f"CAST({c} AS {t}) AS {c}" for c, t in (f.split() for f in TOTALS.split(", "))]
        _put(summed.selectExpr(*columns), path, batch_id)

    return lambda writer: writer.foreachBatch(write).start()


def run_totals(spark: SparkSession, path: str) -> DataFrame:
    """One row: batches, seconds, messages, rate, late, forwarded and malformed rows so far."""
    whole = newest(spark, path, TOTALS).agg(*[
        F.coalesce(F.sum(c), F.lit(0)).alias(c)
        for c in ("batches", "seconds", "messages", "late", "forwarded", "malformed")
    ])
    rate = F.when(F.col("seconds") > 0, F.col("messages") / F.col("seconds")).otherwise(0.0)
    return whole.withColumn("messages_per_second", rate)


# --- publishing in order ----------------------------------------------------------------------

def sequence_sink(path: str, state: str, order_by: Sequence[str]):
    """Write key/value rows with `sequence`, their place among all rows of their key, from 1.

    Inside a batch the place follows `order_by` and then the value; a batch goes on where the one
    before it stopped. Numbers come from ranges of (key, order), so a hot key is numbered by
    several tasks; each of them writes its range in order."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = stage(newest(spark, state, SEQUENCES, batch_id), "sequences-before")
        rows = stage(batch.withColumn("key", F.coalesce("key", F.lit("unknown"))), "published")
        numbered = stage(dense_key(rows, "_number", ["key", *order_by, "value"]), "numbered")
        own = numbered.groupBy("key").agg(F.min("_number").alias("_first"), F.count("*").alias("_rows"))
        starts = stage(own.join(before, "key", "left").select(
            F.col("key").alias("_key"), (F.coalesce("published", F.lit(0)) - F.col("_first") + 1).alias("_shift"),
            (F.coalesce("published", F.lit(0)) + F.col("_rows")).alias("published"),
        ), "sequence-starts")
        placed = heavy_join(numbered, starts.select("_key", "_shift"), "key", "_key")
        out = placed.select("key", "value", (F.col("_number") + F.col("_shift")).alias("sequence"))
        out.repartitionByRange("key", "sequence").sortWithinPartitions("key", "sequence").write.mode(
            "overwrite").parquet(f"{path}/batch_id={batch_id}")
        after = before.join(starts, F.col("key") == F.col("_key"), "full").select(
            F.coalesce("key", "_key").alias("key"),
            F.coalesce(starts["published"], before["published"]).alias("published"))
        _put(after, state, batch_id)

    return lambda writer: writer.foreachBatch(write).start()
