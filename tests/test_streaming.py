import json
import logging

import pytest
import samples
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.streaming import feed, ledger, live

COUNTS = feed.COUNTS


@pytest.fixture
def folder(tmp_path):
    return samples.write_all(tmp_path)["events"]


def stream(spark, folder, **options):
    return feed.file_events(spark, folder, **options)


def test_counts_every_message_and_skips_malformed_lines(spark, folder, tmp_path):
    path = str(tmp_path / "counts")
    feed.count_to_snapshot(stream(spark, folder, files_per_trigger=1), path)
    assert rows(feed.read_snapshot(spark, path, COUNTS)) == [
        ("escalation_raised", 3), ("escalation_resolved", 1), ("login", 1), ("unknown", 1)
    ]


def test_a_restart_continues_from_its_checkpoint(spark, folder, tmp_path):
    path, offsets = str(tmp_path / "counts"), str(tmp_path / "offsets")
    feed.count_to_snapshot(stream(spark, folder), path, checkpoint=offsets)
    late = {**samples.EVENTS[2], "event_id": "e9"}
    (tmp_path / "events" / "events_2025_03.jsonl").write_text(json.dumps(late) + "\n")
    feed.count_to_snapshot(stream(spark, folder), path, checkpoint=offsets)
    assert ("login", 2) in rows(feed.read_snapshot(spark, path, COUNTS))


def test_publish_then_route(spark, folder, tmp_path):
    """File -> topic with key and time stamp -> critical escalations on a second topic."""
    topic, critical = str(tmp_path / "topic"), str(tmp_path / "critical")
    feed.publish(feed.not_malformed(stream(spark, folder)), feed.file_sink(topic))
    schema = "key string, value string"
    published = spark.read.schema(schema).parquet(topic)
    assert published.filter("key = 'escalation_raised'").count() == 3
    value = json.loads(published.filter("key = 'login'").first()["value"])
    assert value["timestamp"] == "2025-01-12T08:00:00Z" and value["produced_at"].endswith("+00:00")

    messages = feed.decode(spark.readStream.schema(schema).parquet(topic))
    feed.route_critical(messages, feed.file_sink(critical))
    routed = spark.read.schema(schema).parquet(critical)
    assert routed.count() == 1
    forwarded = json.loads(routed.first()["value"])
    assert forwarded["event_id"] == "e1" and forwarded["produced_at"]


def test_consume_writes_a_summary_and_takes_up_new_messages_only(spark, folder, tmp_path):
    out = str(tmp_path / "run")
    forward = feed.file_sink(str(tmp_path / "critical"))
    first = feed.consume(stream(spark, folder), out, forward, "now")
    assert first["total_messages_consumed"] == 6 and first["critical_escalations_forwarded"] == 1
    assert list(first["event_counts"]) == [
        "escalation_raised", "escalation_resolved", "login", "unknown"]
    assert first["throughput_messages_per_second"] > 0 and first["elapsed_seconds"] > 0
    text = "".join(p.read_text() for p in (tmp_path / "run" / "summary").glob("part-*"))
    assert json.loads(text) == first
    late = {**samples.EVENTS[0], "event_id": "e9"}
    (tmp_path / "events" / "events_2025_03.jsonl").write_text(json.dumps(late) + "\n")
    again = feed.consume(stream(spark, folder), out, forward, "later")
    assert again["total_messages_consumed"] == 7 and again["critical_escalations_forwarded"] == 2


def test_progress_log(spark, folder, tmp_path, caplog):
    listener = feed.ProgressLog(every=2)
    spark.streams.addListener(listener)
    try:
        with caplog.at_level(logging.INFO, logger="ledgerloom.streaming.feed"):
            feed.count_to_snapshot(stream(spark, folder), str(tmp_path / "c"))
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    assert sum(listener.seen.values()) == 7


def test_first_events(spark):
    assert feed.first_events(spark.range(9), 4).count() == 4
    assert feed.first_events(spark.range(9), None).count() == 9


def test_live_clean_up_drops_copies(spark, folder, tmp_path):
    path = str(tmp_path / "clean")
    clean = live.clean_live_events(stream(spark, folder))
    feed.run(clean, feed.file_sink(path), name="clean")
    got = spark.read.schema("event_id string, event_month string").parquet(path)
    assert rows(got) == [(f"e{i}", "2025-01" if i < 4 else "2025-02") for i in range(1, 6)]


def test_live_volume_and_enrichment(spark, folder, tmp_path):
    path = str(tmp_path / "volume")
    feed.run(live.live_volume(stream(spark, folder), delay="1 hour"), feed.snapshot_sink(path),
             mode="complete", name="volume")
    schema = T.StructType([
        T.StructField("event_type", T.StringType()), T.StructField("event_count", T.LongType())
    ])
    got = feed.read_snapshot(spark, path, schema).filter("event_type = 'escalation_raised'")
    assert rows(got) == [("escalation_raised", 1), ("escalation_raised", 2)]
    projects = spark.createDataFrame([("P1", "One", "IT")],
                                     "project_id string, project_name string, department string")
    out = str(tmp_path / "named")
    feed.run(live.enrich_live(stream(spark, folder), projects), feed.file_sink(out), name="named")
    named = spark.read.schema("event_id string, project_name string").parquet(out)
    assert named.filter(F.col("project_name") == "One").count() == 2


class _Writer:
    """Stands in for a stream's writer and hands out its batch function."""

    def foreachBatch(self, function):
        self.function = function
        return self

    def start(self):
        return self.function


def test_totals_count_every_row_once_over_many_batches_and_a_replay(spark, tmp_path):
    schema = "event_id string, event_type string, timestamp timestamp, payload map<string,string>, _malformed string"
    path = str(tmp_path / "totals")
    empty = spark.createDataFrame([], schema)
    write = ledger.totals_sink(path, feed.is_malformed(empty), feed.is_critical(), "1 hour")(_Writer())
    for batch in range(8):
        rows_ = [(f"{batch}-{i}", "login" if i else None, f"2025-01-{batch + 1:02d} 0{i}:00:00", None, None)
                 for i in range(3)]
        rows_.append((f"{batch}-c", "escalation_raised", f"2025-01-{batch + 1:02d} 01:00:00", {"severity": "Critical"}, None))
        rows_ += [(None, None, None, None, "{oops")] * (batch % 2)
        rows_ += [(f"{batch}-l", "login", "2025-01-01 00:00:00", None, None)] * (batch > 0)
        frame = spark.createDataFrame(
            [(*r[:2], None, *r[3:]) for r in rows_], schema
        ).drop("timestamp").join(spark.createDataFrame(
            [(r[0], r[2]) for r in rows_], "event_id string, t string").dropDuplicates(["event_id"]), "event_id", "left"
        ).withColumn("timestamp", F.to_timestamp("t")).drop("t")
        write(frame, batch)
        if batch in (3, 7):
            write(frame, batch)  # the same batch again, as after a restart
    whole = ledger.run_totals(spark, path).first()
    assert (whole["batches"], whole["messages"], whole["forwarded"], whole["malformed"], whole["late"]) == (
        8, 8 * 4 + 7, 8, 4, 7)
    assert whole["seconds"] > 0 and whole["messages_per_second"] > 0
    assert ledger._batch_ids(spark, path) == [6, 7]


def test_empty_objects_are_of_unknown_type_and_broken_lines_are_counted(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text('{}\n{"event_type": "login"\n{"event_type": "login"}\n\n')
    events = feed.file_events(spark, str(tmp_path / "in"), malformed=feed.MALFORMED)
    summary = feed.consume(events, str(tmp_path / "run"), feed.file_sink(str(tmp_path / "critical")), "now")
    assert summary["event_counts"] == {"login": 1, "unknown": 1} and summary["malformed_messages"] == 1


def test_publishing_keeps_the_order_of_each_key_over_runs(spark, folder, tmp_path):
    out, state, offsets = (str(tmp_path / n) for n in ("topic", "state", "offsets"))
    for run in range(2):
        if run:
            more = [{**samples.EVENTS[i % 3], "event_id": f"x{i}", "timestamp": f"2025-03-0{1 + i % 9}T08:00:00Z"}
                    for i in range(20)]
            (tmp_path / "events" / "events_2025_03.jsonl").write_text("".join(json.dumps(m) + "\n" for m in more))
        events = feed.not_malformed(stream(spark, folder, files_per_trigger=1))
        feed.publish_in_order(events, out, state, checkpoint=offsets)
    sent = spark.read.schema("key string, value string, sequence long, batch_id long").parquet(out)
    by_key = {}
    for r in sent.orderBy("key", "sequence").collect():
        by_key.setdefault(r["key"], []).append((r["sequence"], r["batch_id"], json.loads(r["value"])["timestamp"]))
    assert sum(map(len, by_key.values())) == 26
    for places in by_key.values():
        assert [n for n, *_ in places] == list(range(1, len(places) + 1))
        assert [b for _, b, _ in places] == sorted(b for _, b, _ in places)
        for batch in {b for _, b, _ in places}:
            times = [t for _, b, t in places if b == batch]
            assert times == sorted(times)
