"""Whole-table replacement, staging scopes and files that a scan can skip."""

import time
from pathlib import Path

import pyarrow.parquet as pq
import pytest
import samples
from conftest import rows
from pyspark.sql import functions as F

from ledgerloom.plans import events
from ledgerloom.plans.jobs import event_tables
from ledgerloom.session import (
    SHUFFLE_CLEANUP, new_path, shared_dir, stage, stage_from, stage_in_slices, stage_sorted, staging_scope,
)
from ledgerloom.sources import readers, versions


def _frame(spark, n):
    return spark.range(n).select(F.col("id").alias("k"))


def test_a_load_replaces_all_its_tables_at_once(spark, tmp_path):
    folder = str(tmp_path / "tables")
    with pytest.raises(FileNotFoundError):
        versions.read_table(spark, folder, "a")
    assert versions.write_tables({"a": _frame(spark, 2), "b": _frame(spark, 3)}, folder) == 1
    assert versions.write_tables({"a": _frame(spark, 4), "b": _frame(spark, 5)}, folder) == 2
    assert versions.read_table(spark, folder, "a").count() == 4
    assert versions.read_table(spark, folder, "b", number=1).count() == 3
    with pytest.raises(KeyError):
        versions.read_table(spark, folder, "c")


def test_a_load_that_fails_half_way_leaves_the_old_tables(spark, tmp_path):
    folder = str(tmp_path / "tables")
    versions.write_tables({"a": _frame(spark, 2), "b": _frame(spark, 3)}, folder)
    broken = _frame(spark, 3).select(F.raise_error(F.lit("lost")).cast("long").alias("k"))
    with pytest.raises(Exception, match="lost"):
        versions.write_tables({"a": _frame(spark, 9), "b": broken}, folder)
    assert versions.manifests(spark, folder) == [1]
    assert versions.read_table(spark, folder, "a").count() == 2


def test_old_loads_are_removed_and_a_taken_number_is_refused(spark, tmp_path, monkeypatch):
    folder = tmp_path / "tables"
    for n in range(1, 5):
        versions.write_tables({"a": _frame(spark, n)}, str(folder), keep=2)
    assert versions.manifests(spark, str(folder)) == [3, 4]
    assert len(list((folder / "data").iterdir())) == 2
    monkeypatch.setattr(versions, "manifests", lambda *_: [3])
    with pytest.raises(RuntimeError, match="finished first"):
        versions.write_tables({"a": _frame(spark, 1)}, str(folder))


def _staged(spark):
    root = Path(shared_dir(spark)) / "staged" / spark.sparkContext.applicationId
    return sorted(p.name for p in root.iterdir()) if root.exists() else []


def test_a_scope_removes_what_was_staged_inside(spark):
    before = stage(_frame(spark, 3), "outside")
    names = _staged(spark)
    with pytest.raises(ValueError), staging_scope(spark):
        stage(before, "inside")
        with staging_scope(spark):
            assert stage(before, "deeper").count() == 3
        raise ValueError
    assert _staged(spark) == names and before.count() == 3


def test_what_is_staged_outside_a_scope_outlives_it(spark):
    names = set(_staged(spark))
    with staging_scope(spark) as outside:
        inner = stage(spark.range(3), "inner")
        with outside():
            kept = stage(inner, "kept")
    assert kept.count() == 3 and len(set(_staged(spark)) - names) == 1
    built = stage_from(spark, lambda: stage(spark.range(4), "way").union(stage(spark.range(5), "way")), "built")
    assert built.count() == 9 and len(set(_staged(spark)) - names) == 2


def _shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_staging_gives_its_shuffle_files_back(spark):
    before = _shuffle_files(spark)
    moved = spark.range(1000).repartition(3, "id").withColumn("of", F.col("id") % 7)
    whole = stage(moved, "moved")
    parts = stage_in_slices(moved, "of", 3, "parts")
    until = time.time() + 20  # Spark removes them in the background
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(SHUFFLE_CLEANUP, None) is None
    assert rows(whole) == rows(parts) and whole.count() == 1000


def test_a_job_leaves_nothing_staged(spark, tmp_path):
    raw = readers.read_events(spark, f"{samples.write_all(tmp_path)['events']}/events_*.jsonl")
    names = _staged(spark)
    run = event_tables(raw, str(tmp_path / "out"))
    assert set(run.rows) == set(events.EVENT_TABLES) and _staged(spark) == names


def test_sorted_staging_lets_a_scan_skip_row_groups(spark):
    df = spark.range(400_000, numPartitions=4).select(
        (F.xxhash64("id") % 1_000_000).alias("amount"), F.sha2(F.col("id").cast("string"), 256).alias("wide"))
    staged = stage_sorted(df, "amount", "sorted")
    large = staged.where(F.col("amount") > 900_000)
    assert "GreaterThan(amount,900000)" in large._jdf.queryExecution().executedPlan().toString()
    groups = [pq.ParquetFile(p.removeprefix("file://").removeprefix("file:")).metadata for p in staged.inputFiles()]
    least = [m.row_group(g).column(0).statistics.max for m in groups for g in range(m.num_row_groups)]
    skipped = sum(x <= 900_000 for x in least) / len(least)
    assert len(least) > 40 and skipped > 0.8
    assert rows(large) == rows(df.where(F.col("amount") > 900_000)) and new_path(spark, "x")
