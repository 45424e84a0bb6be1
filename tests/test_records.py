"""CSV and JSON records that span lines and blocks."""

import csv
import hashlib
import json
import random
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.session import shared_dir
from ledgerloom.sources import readers, records, writers
from verification.registry import QUERIES

TEXT = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "note", "tail")])


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _notes(seed, n):
    rng = random.Random(seed)
    signs = ["a", 'say "x"', ",", "\n", "\n\n", " b ", "é", "", "'", "line\nbreak", '"', "x" * 90]
    return [(str(i), "".join(rng.choices(signs, k=rng.randint(0, 9))), f"t{i}") for i in range(n)]


def test_csv_survives_breaks_quotes_and_delimiters_over_blocks(spark, tmp_path, small_blocks):
    notes = _notes(1, 150)
    notes[70] = ("70", "long\n" * 700, "t70")  # a cell that runs over several blocks
    for part in (0, 1):
        with open(tmp_path / f"p{part}.csv", "w", newline="") as out:
            writer = csv.writer(out, lineterminator="\n" if part else "\r\n", quoting=csv.QUOTE_ALL)
            writer.writerow(["id", "note", "tail"] if part else ["note", "id", "tail"])
            for i, note, tail in notes[part::2]:
                writer.writerow([i, note, tail] if part else [note, i, tail])
    path = str(tmp_path / "*.csv")
    assert records.quoted_breaks(spark, path).select("file", "block").count() > 6
    got = readers.read_csv(spark, path, TEXT, sequence="seq")
    assert rows(got, "id", "note", "tail") == sorted(notes, key=repr)
    in_file = [r["id"] for r in got.orderBy("seq").collect() if int(r["id"]) % 2 == 0]
    assert in_file == [str(i) for i in range(0, 150, 2)]


def test_csv_round_trip(spark, tmp_path):
    cells = [("1", "a\nb", ""), ("2", 'x "y", z', None), ("3", "", "\n"), ("4", None, " pad ")]
    df = spark.createDataFrame(cells, TEXT)
    assert writers.write_csv(df, str(tmp_path / "c")) == 4
    assert rows(readers.read_csv(spark, str(tmp_path / "c"), TEXT)) == sorted(cells, key=repr)


def test_csv_without_breaks_is_read_line_by_line(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note,tail\n1,"x, ""y""",z\n')
    assert records.quoted_breaks(spark, str(tmp_path / "a.csv")) is None
    assert rows(readers.read_csv(spark, str(tmp_path / "a.csv"), TEXT)) == [("1", 'x, "y"', "z")]


@pytest.mark.parametrize("indent", [None, 2])
def test_json_arrays_over_blocks(spark, tmp_path, small_blocks, indent):
    made = [{"id": i, "note": n + ' {"}\\" ]', "deep": {"a": [{"b": "}"}]}, "tail": t} for i, n, t in _notes(2, 120)]
    (tmp_path / "a.json").write_text(json.dumps(made[:100], indent=indent))
    (tmp_path / "b.json").write_text(json.dumps(made[100:], indent=indent, ensure_ascii=False))
    (tmp_path / "c.json").write_text("[]")
    got = readers.read_json_records(spark, str(tmp_path / "*.json"), TEXT)
    assert rows(got) == sorted(((m["id"], m["note"], m["tail"]) for m in made), key=repr)
    blocks = records.json_objects(spark, str(tmp_path / "a.json")).select("block").distinct().count()
    assert blocks > 5
    one_task = spark.read.schema(TEXT).option("multiLine", True).json(str(tmp_path / "*.json"))
    assert rows(got) == rows(one_task)


def test_malformed_json_records_are_counted(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": "1", "note": "x"}, {"id": 2 oops}, {"id": "3"}]')
    got = readers.read_json_records(spark, str(tmp_path / "a.json"), TEXT, malformed="broken").collect()
    assert len(got) == 3 and [r["id"] for r in got if r["broken"] is None] == ["1", "3"]
    assert [r["broken"] for r in got if r["broken"]] == ['{"id": 2 oops}']


def test_notes_are_written_and_cut_by_as_many_tasks_as_the_table_has(spark, tmp_path):
    """Not two files whatever the size, and no piece leaves the task that read it."""
    rows = [(i, f'note {i}\n"quoted", cell {i}\n') for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.repartition(6).write.option("maxRecordsPerFile", 10).parquet(f"{tmp_path}/documents.parquet")
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))  # one file a task
    folder = Path(shared_dir(spark).removeprefix("file://"))
    earlier = set(folder.glob("staged/**/notes-*"))
    try:
        got = {r["doc_id"]: r["digest"] for r in QUERIES["notes_through_csv"](spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {i: hashlib.md5(text.encode()).hexdigest() for i, text in rows}
    [written] = set(folder.glob("staged/**/notes-*")) - earlier
    assert len(list(written.glob("part-*.csv"))) >= 6


def test_compressed_text_is_written_in_files_of_bounded_rows(spark, tmp_path, monkeypatch):
    """A compressed file cannot be split, so one task's rows go to several files."""
    monkeypatch.setattr(writers, "ROWS_PER_FILE", 10)
    made = [(str(i), f'}} "{i}" {{', None if i % 3 else "t") for i in range(60)]
    df = spark.createDataFrame(made, TEXT).coalesce(1)
    writers.write_json(df, str(tmp_path / "j"), "gzip")
    assert writers.write_csv(df, str(tmp_path / "c"), "gzip") == 60
    assert len(list((tmp_path / "j").glob("*.json.gz"))) == len(list((tmp_path / "c").glob("*.csv.gz"))) == 6
    assert rows(readers.read_json_records(spark, str(tmp_path / "j"), TEXT)) == sorted(made, key=repr)
    ordered = readers.read_csv_in_order(spark, str(tmp_path / "c"), TEXT, "seq").orderBy("seq")
    assert [tuple(r)[:3] for r in ordered.collect()] == made


def test_the_json_of_the_transactions_is_small_on_disk(spark):
    """Its text would be ten times the tables it is made from."""
    folder, sf = Path(shared_dir(spark).removeprefix("file://")), "/root/testdata/sf0.001"
    earlier = set(folder.glob("staged/**/json-*"))
    assert QUERIES["transactions_from_json"](spark, sf).count() == spark.read.parquet(f"{sf}/lineitem.parquet").count()
    [written] = {p for p in set(folder.glob("staged/**/json-*")) - earlier if list(p.glob("*json*"))}
    assert sum(p.stat().st_size for p in written.glob("part-*")) < 50 * 6000


def test_pieces_stay_in_the_task_that_read_them(spark, tmp_path):
    (tmp_path / "array.json").write_text('[{"a": "x}"}, {"a": "y"}]')
    pieces = records._pieces(spark, str(tmp_path), "}")
    states = spark.createDataFrame(
        [tuple(r) for r in pieces.select("file", "block", F.lit(False), F.lit(0)).distinct().collect()],
        "file string, block long, inside boolean, depth int")
    plans = []
    kept = records.stage
    records.stage = lambda df, *rest: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or kept(df, *rest)
    try:
        found = records._cut(pieces, states, records._json_cutter).orderBy("at").collect()
    finally:
        records.stage = kept
    assert [r["text"] for r in found][:2] == ['[{"a": "x}"}', ', {"a": "y"}']
    assert "BroadcastHashJoin" in plans[0] and "hashpartitioning" not in plans[0]
