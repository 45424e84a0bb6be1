import datetime as dt
import json
from pathlib import Path

import pytest
import samples
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import rules
from ledgerloom.operators.profile import catalog_listing
from ledgerloom.operators.quality import DataQualityError
from ledgerloom.plans import jobs, scd2
from ledgerloom.plans.cleaning import EmployeeRules
from ledgerloom.session import shared_dir, stage
from ledgerloom.sources import readers, warehouse, writers

LIMITS = EmployeeRules(as_of=dt.date(2026, 9, 1))


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    return samples.write_all(tmp_path_factory.mktemp("raw"))


@pytest.fixture(scope="module")
def inputs(raw):
    return jobs.Inputs(raw["projects"], raw["employees"], raw["history"], raw["transactions"])


def test_csv_cells_fail_one_by_one(spark, raw):
    got = {r["project_id"]: r for r in readers.read_projects(spark, raw["projects"]).collect()}
    assert len(got) == 10
    assert got["P1"]["project_name"] == "Alpha, phase 1" and got["P1"]["end_date"] is None
    assert got["P4"]["budget"] is None and got["P4"]["actual_cost"] == 10.0


def test_suspect_dates_stay_text_and_order_is_kept(spark, raw):
    got = readers.read_employees(spark, raw["employees"]).orderBy("row_seq").collect()
    assert [r["employee_id"] for r in got] == ["E1", "E2", "E3", "E3", "E4"]
    assert got[1]["hire_date"] == "-999"


def test_positions_follow_file_names_not_file_sizes(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\nx,1\n")
    (tmp_path / "b.csv").write_text("k,v\n" + "".join(f"x,{i}\n" for i in range(2, 5000)))
    schema = T.StructType().add("k", T.StringType()).add("v", T.IntegerType())
    got = readers.read_csv_in_order(spark, str(tmp_path / "*.csv"), schema).orderBy("row_seq")
    assert [r["v"] for r in got.collect()] == list(range(1, 5000))


def test_json_records_are_typed_tolerantly(spark, raw):
    got = {r["transaction_id"]: r for r in
           readers.read_transactions(spark, raw["transactions"]).collect()}
    assert got["T3"]["amount"] == 70.0 and got["T4"]["amount"] is None
    assert got["T4"]["transaction_date"] is None and got["T3"]["notes"] is None
    assert got["T1"]["transaction_date"] == dt.date(2024, 1, 15)


def test_json_lines_over_a_wildcard(spark, raw):
    got = readers.read_events(spark, f"{raw['events']}/events_*.jsonl")
    assert got.count() == 7
    assert got.filter("event_id IS NULL").count() == 1
    first = got.filter("event_id = 'e1'").first()
    assert first["timestamp"] == dt.datetime(2025, 1, 11, 12) and first["payload"] == {
        "severity": "Critical"}


def test_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "h.csv").write_text("v,k,extra\n1.5,a,x\nbad,b,y\n")
    schema = T.StructType().add("k", T.StringType()).add("v", T.DoubleType())
    assert rows(readers.read_csv(spark, str(tmp_path / "h.csv"), schema)) == [
        ("a", 1.5, "x"), ("b", None, "y")]


def test_strict_casts_and_inference(spark, raw):
    inferred = readers.read_csv(spark, raw["history"])
    typed = readers.typed_columns(inferred, {"new_salary": "decimal(12,2)"})
    assert dict(typed.dtypes)["new_salary"] == "decimal(12,2)"


def test_staged_tables_live_in_the_shared_folder(spark):
    staged = stage(spark.range(3), "probe")
    assert shared_dir(spark) in staged.inputFiles()[0]
    assert staged.count() == 3


def test_partitioned_write_splits_by_value_and_counts(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "IF(id < 90, 'hot', 'cold') AS kind")
    path = str(tmp_path / "t")
    assert writers.write_table(df, path, partition_by="kind", sort_by=["id"]) == 100
    assert sorted(p.name for p in (tmp_path / "t").glob("kind=*")) == ["kind=cold", "kind=hot"]
    assert len(list((tmp_path / "t").glob("kind=cold/*.parquet"))) == 1
    back = readers.read_parquet(spark, path, ["id", "kind"])
    assert rows(back.groupBy("kind").count()) == [("cold", 10), ("hot", 90)]
    assert writers.write_table(df.limit(5), path, single_file=True) == 5
    assert len(list((tmp_path / "t").glob("*.parquet"))) == 1


def test_csv_dates(spark, tmp_path):
    df = spark.createDataFrame([(1, dt.date(2024, 2, 3), 'say "hi", ok')], "a int, d date, s string")
    assert writers.write_csv(df, str(tmp_path / "c")) == 1
    text = "".join(p.read_text() for p in (tmp_path / "c").glob("*.csv"))
    assert text.splitlines()[0] == "a,d,s" and "2024-02-03" in text
    assert readers.read_csv(spark, str(tmp_path / "c"), df.schema).first()["s"] == 'say "hi", ok'


def _text(folder):
    return "\n".join(p.read_text(encoding="utf-8") for p in folder.glob("part-*"))


def test_foundations_writes_all_outputs(spark, inputs, tmp_path):
    run = jobs.foundations(spark, inputs, str(tmp_path), LIMITS)
    assert set(run.files) == {
        "projects_clean", "employees_clean", "employees_quality_summary", "pipeline_summary"
    }
    assert run.rows == {"projects": {"raw": 10, "clean": 10}, "employees": {"raw": 5, "clean": 4}}
    summary = json.loads(_text(tmp_path / "employees_quality_summary"))
    assert (summary["rows_before"], summary["rows_after"]) == (5, 4)
    assert summary["issues_detected_rows"]["Invalid date formats"] == 1
    assert summary["rows_affected_per_fix_type"]["missing email -> derived from name"] == 1
    assert summary["rows_with_at_least_one_flag"] == 3
    text = _text(tmp_path / "pipeline_summary")
    assert "projects: 10 raw, 10 clean" in text and "projects: null budget -> 0" in text
    clean = readers.read_csv(spark, run.files["employees_clean"])
    assert clean.filter("employee_id = 'E2'").first()["hire_date"] == dt.date(2021, 5, 1)
    metrics = jobs.metrics_table(spark, run)
    assert metrics.filter("section = 'rows' AND metric = 'clean'").agg(F.sum("value")).first()[0] == 14


def test_full_etl(spark, inputs, tmp_path):
    run = jobs.full_etl(spark, inputs, str(tmp_path), LIMITS)
    assert run.rows["transactions"] == {"raw": 4, "clean": 4}
    assert set(run.quality) == {
        "projects", "employees", "transactions", "employees_salary_history"
    }
    assert run.quality["transactions"]["checks_run"] == 9
    assert run.quality["projects"]["checks_run"] == run.quality["employees"]["checks_run"] == 8
    assert run.quality["employees_salary_history"]["checks_run"] == 6
    assert "# Quality of projects: " in _text(tmp_path / "dq_report_projects")
    back = readers.read_csv(spark, run.files["transactions_clean"])
    assert rows(back.filter("amount IS NULL"), "amount_aed") == [(0.0,), (0.0,)]


def test_full_etl_in_slices_with_compressed_tables(spark, inputs, tmp_path, monkeypatch):
    """The same tables and counts; at the checks only the clean tables and the history are staged."""
    whole = jobs.full_etl(spark, inputs, str(tmp_path / "whole"), LIMITS)
    staged, run_all = [], jobs.quality.run_all

    def noted(*args, **options):
        staged.extend(sorted({p.parent.name.rsplit("-", 1)[0] for p in scopes.glob("scope-*/**/*.parquet")}))
        return run_all(*args, **options)

    scopes = Path(shared_dir(spark).removeprefix("file://")) / "staged" / spark.sparkContext.applicationId
    monkeypatch.setattr(jobs.quality, "run_all", noted)
    monkeypatch.setattr(jobs, "SLICE_ROWS", 1)
    run = jobs.full_etl(spark, inputs, str(tmp_path / "cut"), LIMITS, compression="gzip")
    assert staged == ["csv", "employees", "projects", "transactions"]
    assert (run.rows, run.detections, run.fixes) == (whole.rows, whole.detections, whole.fixes)
    assert run.quality == whole.quality
    for name in ("projects_clean", "employees_clean", "transactions_clean"):
        assert rows(readers.read_csv(spark, run.files[name])) == rows(readers.read_csv(spark, whole.files[name]))
    assert list((tmp_path / "cut" / "transactions_clean").glob("*.csv.gz"))


def test_gated_etl_reports_or_stops(spark, inputs, tmp_path):
    day = dt.date(2026, 9, 20)
    with pytest.raises(DataQualityError, match="transactions.amount is 50% complete"):
        jobs.gated_etl(spark, inputs, str(tmp_path / "no"), LIMITS, day)
    assert not (tmp_path / "no").exists()
    lax = {name: {**spec, "completeness_optional": [
        "end_date", "manager_id", "notes", "amount", "approved_by", "transaction_date", "email",
        "budget"]} for name, spec in rules.QUALITY_RULES.items()}
    run = jobs.gated_etl(spark, inputs, str(tmp_path / "yes"), LIMITS, day, lax)
    report = _text(tmp_path / "yes" / "pipeline_report_2026-09-20")
    assert "[checks]" in report and "5 raw, 4 clean" in report
    assert run.files["pipeline_report"].endswith("pipeline_report_2026-09-20")


def test_event_job(spark, raw, tmp_path):
    events = readers.read_events(spark, f"{raw['events']}/events_*.jsonl")
    run = jobs.event_tables(events, str(tmp_path))
    assert run.raw_rows == 7 and run.events_per_second > 0
    assert run.rows == {
        "project_activity_summary": 2, "user_activity_summary": 3, "escalation_log": 2,
        "daily_event_volume": 5, "peak_usage_analysis": 4,
    }
    log = readers.read_parquet(spark, str(tmp_path / "escalation_log"))
    assert rows(log, "severity", "resolution_time_hours") == [("Critical", 1.5), ("Low", None)]
    assert (tmp_path / "daily_event_volume" / "event_date=2025-01-11").exists()


def test_warehouse(spark, inputs, tmp_path):
    history = readers.read_salary_history(spark, inputs.history)
    out = str(tmp_path)
    jobs.full_etl(spark, inputs, out, LIMITS)
    projects = readers.read_clean(spark, out, "projects")
    employees = readers.read_clean(spark, out, "employees")
    transactions = readers.read_clean(spark, out, "transactions").filter(
        "transaction_date IS NOT NULL")
    for _ in range(2):  # loading again replaces the tables
        tables = warehouse.load(spark, "spend", projects, employees, history, transactions)
    counts = {r["table_name"]: r["rows"] for r in
              catalog_listing(spark, "spend", ["dim_", "fact_", "bridge_"]).collect()}
    assert counts == {
        "bridge_employee_project": 11, "dim_date": 11323, "dim_employee": 6, "dim_project": 10,
        "dim_vendor": 2, "fact_transactions": 3,
    }
    collapsed = scd2.collapse_same_day(history)
    checks = scd2.validation(tables["dim_employee"], collapsed, employees)
    assert rows(checks.filter("violations > 0")) == []
    view = warehouse.fact_view(tables)
    assert rows(view, "transaction_id", "project_id", "vendor_name", "amount_is_missing") == [
        ("T1", "P1", "Acme", False), ("T2", "P1", "Bolt", True), ("T3", "P2", "Acme", False)
    ]
    then = tables["fact_transactions"].join(tables["dim_employee"], "employee_key")
    # T2 was approved in 2019, when E1 was still a Senior
    assert rows(then, "transaction_id", "level") == [("T1", "Lead"), ("T2", "Senior")]
    unapproved = tables["fact_transactions"].filter("employee_key IS NULL")
    assert rows(unapproved, "transaction_id", "is_approved") == [("T3", False)]
    warehouse.drop(spark, "spend")
    assert catalog_listing(spark, "spend", ["dim_"]).count() == 0
