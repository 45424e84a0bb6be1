"""The batch event tables on a live feed, where copies and late events must be bounded in time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.joins import lookup_join
from ledgerloom.plans.events import add_date_parts


def clean_live_events(events: DataFrame, delay: str = "2 hours") -> DataFrame:
    """As the batch clean-up, with copies recognised while they arrive within `delay`."""
    complete = events.dropna(subset=["event_id", "user_id"])
    unique = complete.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(["event_id"])
    return add_date_parts(unique)


def live_volume(events: DataFrame, width: str = "1 day", delay: str = "2 hours") -> DataFrame:
    """Events per time window and type; a window is final once `delay` has passed."""
    return (
        events.withWatermark("timestamp", delay)
        .groupBy(F.window("timestamp", width), "event_type")
        .agg(F.count("*").alias("event_count"))
        .select(F.col("window.start").alias("window_start"), "event_type", "event_count")
    )


def enrich_live(events: DataFrame, projects: DataFrame) -> DataFrame:
    """Project name and department on every event, from a static table."""
    return lookup_join(
        events, projects, {"project_id": "project_id"},
        {"project_name": "project_name", "department": "department"},
    )
