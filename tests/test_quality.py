import datetime as dt
import json

import pytest
from conftest import rows

from ledgerloom.operators import quality
from ledgerloom.plans import reports

AS_OF = dt.date(2026, 9, 1)


def document(spark, df, config, dataset="t", **options):
    measured = quality.run_checks(df, dataset, config=config, as_of=AS_OF, **options)
    return reports.result_documents(measured, config)[dataset]


def test_result_format_is_driven_by_the_configuration(spark):
    df = spark.createDataFrame([(1, 1), (2, -5), (2, 999)], "id int, v int")
    config = {"t": {"completeness_threshold": 0.9, "pk_columns": ["id"],
                    "numeric_ranges": {"v": {"min": 0, "max": 100}}}}
    got = document(spark, df, config)
    assert got["dataset_name"] == "t"
    assert got["checks_run"] == got["checks_passed"] + got["checks_failed"] == 6
    status = {name: r["status"] for name, r in got["results"].items()}
    assert status == {
        "completeness": "PASS", "uniqueness": "FAIL", "validity_numeric": "FAIL",
        "validity_date": "PASS", "consistency": "PASS", "referential_integrity": "PASS",
    }
    details = {name: r["details"] for name, r in got["results"].items()}
    assert details["completeness"] == {"id": 1.0, "v": 1.0}
    assert details["uniqueness"] == "1 rows repeat a key of id (2 different keys in 3 rows)"
    assert details["validity_numeric"] == "v leaves [0, 100]: 1 under, 1 over"
    assert got["results"]["validity_numeric"]["failed_columns"] == ["v"]
    text = reports.quality_markdown(got, "now")
    assert text.index("## uniqueness (fail)") < text.index("## completeness (pass)")
    assert "- 1 rows repeat a key of id" in text and "- id: 100.0% filled" in text
    assert "Columns concerned: `id`" in text


def test_no_configuration_runs_the_unconditional_checks(spark):
    got = document(spark, spark.createDataFrame([(1,)], "id int"), {})
    assert got["checks_run"] == got["checks_passed"] == 6
    assert got["results"]["uniqueness"]["details"] == "the rules name no key"


def test_completeness_counts_empty_text_and_nan(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("", float("nan")), (None, None), ("b", 2.0)], "s string, x double"
    )
    got = document(spark, df, {"t": {"completeness_optional": ["x"]}})
    check = got["results"]["completeness"]
    assert check["details"] == {"s": 0.5, "x": 0.5} and check["failed_columns"] == ["s"]


def test_dates(spark):
    df = spark.createDataFrame(
        [("2024-01-01",), ("nope",), ("2027-01-01",), (None,)], "d string"
    )
    strict = {"t": {"date_columns": {"d": {"allow_future": False}, "absent": {}}}}
    got = document(spark, df, strict)["results"]["validity_date"]
    assert got["details"] == "d holds 1 unreadable and 1 later dates"
    lax = {"t": {"date_columns": {"d": {}}}}
    assert document(spark, df.filter("d <> 'nope'"), lax)["results"]["validity_date"][
        "status"] == "PASS"


def test_consistency(spark):
    df = spark.createDataFrame(
        [("2024-01-02", "2024-01-01", -1.0, "Mid", 10), ("2024-01-01", "2024-01-01", 1.0, "X", 99),
         ("2024-01-01", None, None, "Mid", 3)],
        "a string, b string, m double, level string, s int",
    )
    config = {"t": {"consistency_rules": [
        {"type": "before", "columns": ["a", "b"]},
        {"type": "non_negative", "column": "m"},
        {"type": "level_salary_band", "level_column": "level", "salary_column": "s",
         "bands": {"Mid": (1, 5)}},
        {"type": "magic"},
    ]}}
    got = document(spark, df, config)["results"]["consistency"]
    assert got["failed_columns"] == ["a", "b", "m", "s"]
    assert got["details"] == (
        "2 rows break a < b; 1 rows break m >= 0; 1 rows break salary within level band; "
        "unknown rule type magic"
    )
    only_unknown = document(spark, df, {"t": {"consistency_rules": [{"type": "magic"}]}})
    assert only_unknown["results"]["consistency"]["status"] == "FAIL"
    assert only_unknown["results"]["consistency"]["failed_columns"] == []


def test_references(spark):
    df = spark.createDataFrame([(1, 2), (2, 9), (3, None)], "id int, boss int")
    config = {"t": {"foreign_keys": {"boss": ("t", "id"), "id": ("elsewhere", "id")}}}
    got = document(spark, df, config)["results"]["referential_integrity"]
    assert got["failed_columns"] == ["boss"]
    assert got["details"] == (
        "1 values of boss are unknown to t.id; id was not compared: there is no elsewhere"
    )


def test_shares_age_and_outliers(spark):
    data = [("a", 10.0)] * 7 + [("b", 10.0)] * 2 + [("c", 1000.0), (None, None)]
    df = spark.createDataFrame(data, "k string, x double").selectExpr("*", "date'2026-08-01' AS d")
    config = {"t": {
        "distribution_max_share": {"threshold": 0.5, "columns": ["k", "absent"]},
        "freshness": {"date_column": "d", "max_age_days": 30},
        "outlier_zscore": {"threshold": 2, "columns": ["x"]},
    }}
    got = document(spark, df, config)["results"]
    assert got["distribution"]["details"] == "70% of k is 'a'"
    assert got["freshness"] == {
        "status": "FAIL", "details": "d ends 31 days ago, on 2026-08-01", "failed_columns": ["d"]
    }
    assert got["outliers"]["details"] == "1 values of x lie over 2 deviations from the mean"


def test_constant_column_has_no_outliers(spark):
    df = spark.createDataFrame([(0.1,)] * 11, "x double")
    config = {"t": {"outlier_zscore": {"threshold": 0.5, "columns": ["x"]}}}
    assert document(spark, df, config)["results"]["outliers"]["status"] == "PASS"


def test_gate_blocks_incomplete_data(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("b", None), ("c", None), ("d", None), ("e", None)],
        "project_id string, budget double",
    )
    config = {"projects": {"completeness_threshold": 0.9}}
    with pytest.raises(ValueError, match="gate needs 80%.*projects.budget is 20% complete"):
        quality.enforce_gate({"projects": df}, as_of=AS_OF, config=config)
    optional = {"projects": {"completeness_optional": ["budget"]}}
    assert set(quality.enforce_gate({"projects": df}, as_of=AS_OF, config=optional)) == {"projects"}
    measured = quality.run_all({"projects": df}, as_of=AS_OF, config=config)
    assert rows(quality.critical_failures(measured, config)) == [("projects", "budget", 0.2)]
    assert rows(quality.critical_failures(measured, optional)) == []


def test_status_table(spark):
    df = spark.createDataFrame([(1,), (1,)], "id int")
    measured = quality.run_checks(df, "t", config={"t": {"pk_columns": ["id"]}}, as_of=AS_OF)
    status = {r["check"]: (r["status"], r["failed_columns"])
              for r in quality.check_status(measured).collect()}
    assert status["uniqueness"] == ("FAIL", "id") and status["completeness"] == ("PASS", "")


def test_rules_from_a_file(tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps({"t": {"foreign_keys": {"a": ["b", "c"]}}}))
    assert quality.load_rules(str(path))["t"]["foreign_keys"] == {"a": ("b", "c")}
    path.write_text(json.dumps({"t": {"completness_threshold": 1}}))
    with pytest.raises(ValueError, match="completness_threshold"):
        quality.load_rules(str(path))
    yaml = pytest.importorskip("yaml")
    other = tmp_path / "rules.yaml"
    other.write_text(yaml.safe_dump({"t": {"pk_columns": ["id"]}}))
    assert quality.load_rules(str(other))["t"]["pk_columns"] == ["id"]
    assert "projects" in quality.load_rules()
