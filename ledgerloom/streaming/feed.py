"""Publish, count and route events.

Sources and sinks are arguments: a Kafka topic on a cluster that has the connector, files
elsewhere. Every query has its own checkpoint, so a restart continues where it stopped.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from ledgerloom import rules, schemas
from ledgerloom.plans.reports import write_document
from ledgerloom.session import new_path
from ledgerloom.streaming import ledger

log = logging.getLogger(__name__)

MESSAGE = T.StructType([*schemas.EVENTS.fields, T.StructField("produced_at", T.StringType())])

# Topics, and the messages between two progress lines.
EVENTS_TOPIC = "project.events"
ESCALATIONS_TOPIC = "escalations.critical"
PROGRESS_EVERY = 100
CRITICAL = "Critical"
#: The column with the text of what is no JSON.
MALFORMED = "_malformed"


# --- sources ----------------------------------------------------------------------------------

def kafka_messages(spark: SparkSession, servers: str, topic: str = EVENTS_TOPIC) -> DataFrame:
    """Decoded messages of a topic from its earliest offset."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
    )
    return decode(raw)


def decode(raw: DataFrame, malformed: str | None = None) -> DataFrame:
    """Parse the JSON value of key/value rows; `malformed` adds the text of those that are no JSON."""
    broken = malformed or MALFORMED
    options = {"columnNameOfCorruptRecord": broken}
    schema = T.StructType([*MESSAGE.fields, T.StructField(broken, T.StringType())])
    parsed = raw.select(F.from_json(F.col("value").cast("string"), schema, options).alias("m")).select("m.*")
    return parsed if malformed else parsed.drop(broken)


def file_events(
    spark: SparkSession, path: str, schema: T.StructType = schemas.EVENTS, format: str = "json",
    files_per_trigger: int = 100, malformed: str | None = None,
) -> DataFrame:
    """Files of a folder as an event feed; `path` may be a glob. Blank JSON lines are skipped;
    `malformed` adds the text of lines that are no JSON."""
    if malformed:
        schema = T.StructType([*schema.fields, T.StructField(malformed, T.StringType())])
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if malformed:
        reader = reader.option("columnNameOfCorruptRecord", malformed)
    if format == "json":
        reader = reader.option("mode", "PERMISSIVE").option(
            "timestampFormat", "yyyy-MM-dd'T'HH:mm:ssX"
        )
    return reader.format(format).load(path)


def first_events(events: DataFrame, limit: int | None) -> DataFrame:
    """The first `limit` events of a batch feed, or all of them."""
    return events if limit is None else events.limit(limit)


# --- messages ---------------------------------------------------------------------------------

def to_messages(events: DataFrame, *beside: str) -> DataFrame:
    """key = event type, value = the event as JSON with the time it was published; with `beside`,
    columns of the event too."""
    # Fixed value: ISO-8601 with microseconds and offset.
    stamped = events.withColumn(
        "produced_at",
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"),
    )
    return as_messages(stamped, *beside)


def as_messages(events: DataFrame, *beside: str) -> DataFrame:
    """Key and value of events that already carry their publishing time, and columns beside them."""
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ssX"}
    value = F.to_json(F.struct(*[F.col(c) for c in events.columns]), options)
    return events.select(F.col("event_type").alias("key"), value.alias("value"), *beside)


def is_malformed(events: DataFrame) -> Column:
    """Rows that are no JSON, if the feed tells (`{}` is an event of unknown type), else rows in
    which nothing could be parsed."""
    if MALFORMED in events.columns:
        return F.col(MALFORMED).isNotNull()
    return ~F.exists(F.array(*[F.col(c).isNotNull() for c in events.columns]), lambda known: known)


def not_malformed(events: DataFrame) -> DataFrame:
    """Drop rows in which nothing could be parsed."""
    return events.where(~is_malformed(events)).drop(MALFORMED)


def count_by_type(events: DataFrame) -> DataFrame:
    """Running count per event type over the whole stream; every message counts."""
    kind = F.coalesce(F.col("event_type"), F.lit("unknown"))
    return events.groupBy(kind.alias("event_type")).agg(F.count("*").alias("messages"))


def is_critical() -> Column:
    raised = (F.col("event_type") == rules.RAISED) & (F.col("payload")["severity"] == CRITICAL)
    return F.coalesce(raised, F.lit(False))


def critical_escalations(events: DataFrame) -> DataFrame:
    """Raised escalations of critical severity, unchanged."""
    return events.filter(is_critical())


# --- sinks ------------------------------------------------------------------------------------

Sink = Callable[[DataStreamWriter], StreamingQuery]


def kafka_sink(servers: str, topic: str) -> Sink:
    """Messages to a topic; the same key always goes to the same partition."""
    def start(writer: DataStreamWriter) -> StreamingQuery:
        return (
            writer.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("kafka.acks", "all")
            .option("kafka.retries", "3")
            .option("topic", topic)
            .start()
        )
    return start


def file_sink(path: str, format: str = "parquet") -> Sink:
    return lambda writer: writer.format(format).option("path", path).start()


def snapshot_sink(path: str) -> Sink:
    """Keep the latest full result: each batch replaces its own folder, so a repeat is harmless."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return lambda writer: writer.foreachBatch(write).start()


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The result of the newest batch of `snapshot_sink`; no rows if no batch has run yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    table = spark.read.schema(
        T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    ).parquet(path)
    newest = table.agg(F.max("batch_id")).scalar()
    return table.filter(F.col("batch_id") == newest).drop("batch_id")


# --- queries ----------------------------------------------------------------------------------

def run(
    stream: DataFrame, sink: Sink, *, mode: str = "append", checkpoint: str | None = None,
    name: str = "stream", until_idle: bool = True,
) -> StreamingQuery:
    """Start a query; with `until_idle` it ends when the source has nothing new."""
    spark = stream.sparkSession
    writer = (
        stream.writeStream.outputMode(mode)
        .queryName(f"{name}-{time.time_ns()}")
        .option("checkpointLocation", checkpoint or new_path(spark, f"offsets-{name}"))
    )
    if until_idle:
        writer = writer.trigger(availableNow=True)
    query = sink(writer)
    if until_idle:
        query.awaitTermination()
    return query


def publish(events: DataFrame, sink: Sink, **options) -> StreamingQuery:
    return run(to_messages(events), sink, name="publish", **options)


def count_to_snapshot(events: DataFrame, path: str, **options) -> StreamingQuery:
    counts = count_by_type(not_malformed(events))
    return run(counts, snapshot_sink(path), mode="complete", name="counts", **options)


def route_critical(events: DataFrame, sink: Sink, **options) -> StreamingQuery:
    return run(as_messages(critical_escalations(events)), sink, name="route", **options)


def totals(events: DataFrame, path: str, **options) -> StreamingQuery:
    """Keep running totals of the feed below `path`, one batch after the other (see `ledger`)."""
    sink = ledger.totals_sink(path, is_malformed(events), is_critical())
    return run(events, sink, name="totals", **options)


def publish_in_order(events: DataFrame, path: str, state: str, **options) -> StreamingQuery:
    """Publish to files with a number per key that ascends with time, over all batches and runs."""
    stamped = to_messages(events, "timestamp", "event_id")
    sink = ledger.sequence_sink(path, state, ["timestamp", "event_id"])
    return run(stamped, sink, name="publish-in-order", **options)


def stream_summary(whole: Row, counts: dict[str, int], run_at: str) -> dict:
    """Totals of all batches so far."""
    return {
        "run_at": run_at,
        "topic": EVENTS_TOPIC,
        "total_messages_consumed": whole["messages"],
        "event_counts": dict(sorted(counts.items())),
        "critical_escalations_forwarded": whole["forwarded"],
        "forwarded_to_topic": ESCALATIONS_TOPIC,
        "malformed_messages": whole["malformed"],
        "late_messages": whole["late"],
        "throughput_messages_per_second": round(whole["messages_per_second"], 2),
        "elapsed_seconds": round(whole["seconds"], 2),
    }


COUNTS = T.StructType([
    T.StructField("event_type", T.StringType()), T.StructField("messages", T.LongType()),
])
#: Event types that a summary names; all of them are in the ledger.
NAMED_TYPES = 1000


def consume(events: DataFrame, folder: str, forward: Sink, run_at: str) -> dict:
    """Count all messages, forward the critical ones, write the summary of all runs so far.

    Both queries keep their offsets below `folder`, so a later run takes up new messages only.
    The summary names at most NAMED_TYPES event types, those with the most messages.
    """
    spark = events.sparkSession
    totals(events, f"{folder}/totals", checkpoint=f"{folder}/offsets/totals")
    route_critical(not_malformed(events), forward, checkpoint=f"{folder}/offsets/route")
    by_type = ledger.newest(spark, f"{folder}/totals", ledger.TOTALS).where("event_type is not null")
    largest = by_type.orderBy(F.desc("messages"), "event_type").limit(NAMED_TYPES).collect()
    counts = {r["event_type"]: r["messages"] for r in largest}
    whole = ledger.run_totals(spark, f"{folder}/totals").first()
    summary = stream_summary(whole, counts, run_at)
    write_document(spark, summary, f"{folder}/summary")
    return summary


class ProgressLog(StreamingQueryListener):
    """Log the rows read whenever another `every` messages have been consumed."""

    def __init__(self, every: int = PROGRESS_EVERY) -> None:
        self.every = every
        self.seen: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        log.info("stream %s started", event.name)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        key = str(progress.id)
        before = self.seen.get(key, 0)
        self.seen[key] = before + progress.numInputRows
        if self.seen[key] // self.every > before // self.every:
            log.info("stream %s consumed %d messages", progress.name, self.seen[key])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        log.info("stream %s ended", event.id)
