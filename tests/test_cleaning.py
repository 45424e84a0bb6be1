import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerloom import rules
from ledgerloom.plans import cleaning, scd2
from ledgerloom.plans.cleaning import EmployeeRules

AS_OF = dt.date(2026, 9, 1)
LIMITS = EmployeeRules(as_of=AS_OF)

PROJECTS = [
    # id, status, start, end, budget, cost, priority
    ("P1", "in  progress", "2024-01-01", None, 100.0, 120.0, "Low"),
    ("P2", "COMPLETED", "2024-01-01", "2024-01-31", 100.0, 95.0, "Low"),
    ("P3", " on hold", "2024-01-01", None, None, 50.0, "Critical"),
    ("P4", "Not Started", None, None, 0.0, None, "High"),
    ("P5", "paused", "2024-01-01", "2024-02-01", 100.0, 50.0, "Low"),
    ("P6", "Completed", "2024-01-01", "2024-02-01", 100.0, 10.0, None),
]


@pytest.fixture(scope="module")
def projects(spark):
    return spark.createDataFrame(
        PROJECTS,
        "project_id string, status string, start string, fin string, budget double, "
        "actual_cost double, priority string",
    ).selectExpr("*", "date(start) AS start_date", "date(fin) AS end_date").drop("start", "fin")


def test_projects(projects):
    clean = {r["project_id"]: r for r in cleaning.clean_projects(projects).collect()}
    assert [clean[f"P{i}"]["status_category"] for i in range(1, 7)] == [
        "Active", "Closed", "Pending", "Pending", "Unknown", "Closed"
    ]
    assert [clean[f"P{i}"]["risk_level"] for i in range(1, 7)] == [
        "High", "Medium", "High", "Medium", "Low", "Low"
    ]
    assert clean["P1"]["is_over_budget"] and not clean["P3"]["is_over_budget"]
    assert (clean["P3"]["budget"], clean["P3"]["budget_variance"]) == (0.0, None)
    assert clean["P4"]["budget_utilisation_pct"] is None
    assert clean["P2"]["duration_days"] == 30 and clean["P1"]["duration_days"] is None
    assert clean["P2"]["budget_utilisation_pct"] == 95.0


def test_project_fixes(projects):
    assert dict(rows(cleaning.project_fixes(projects))) == {
        "null budget -> 0": 1, "null actual_cost -> 0": 1,
        "status without category -> Unknown": 1,
    }


COLUMNS = (
    "employee_id string, full_name string, email string, department string, role string, "
    "level string, hire_date string, salary double, manager_id string, region string, "
    "status string, years_experience int, row_seq long"
)


def person(n, **changed):
    row = {
        "employee_id": f"EMP{n:04}", "full_name": f"Person {chr(96 + n)}",
        "email": f"p{n}@example.com", "department": "IT", "role": "Dev", "level": "Junior",
        "hire_date": "2020-05-01", "salary": 15000.0, "manager_id": None, "region": "North",
        "status": "Active", "years_experience": 2, "row_seq": n,
    }
    return tuple({**row, **changed}.values())


STAFF = [
    person(1, status="Inactive", level="Lead", salary=40000.0, years_experience=10),
    person(2, email=None, full_name=" Ann  Lee "),
    person(3, email="", full_name="Ann Lee"),
    person(4, email=None, full_name="Bo Ray"),
    person(5, email="bo.ray@example.com"),
    person(6, email=" ", full_name="Cy Fox"),
    person(7, hire_date="-999"),
    person(8, hire_date="99999-01-01"),
    person(9, hire_date="1980-01-01", status="Inactive"),
    person(10, years_experience=-1),
    person(11, years_experience=9),
    person(12, salary=75000.0),
    person(13, salary=90.0),
    person(14, manager_id="EMP0000"),
    person(15, manager_id="EMP0001"),
    person(16, department="IT "),
    person(5, email="second@example.com", row_seq=99),
    person(17, hire_date="2030-01-01"),
    person(18, level="Unlisted", salary=1.0, years_experience=70),
    person(19, role=None),
]
HISTORY = [
    ("EMP0007", "Annual Raise", "2019-01-01", 1),
    ("EMP0007", "Hire", "2018-03-04", 2),
    ("EMP0007", "Hire", "2010-01-01", 3),
    ("EMP0002", "Hire", "2000-01-01", 4),
]


@pytest.fixture(scope="module")
def checked(spark):
    staff = spark.createDataFrame(STAFF, COLUMNS).repartition(3)
    history = spark.createDataFrame(
        HISTORY, "employee_id string, change_type string, day string, row_seq long"
    ).selectExpr("employee_id", "change_type", "date(day) AS effective_date", "row_seq")
    return cleaning.check_employees(staff, history, LIMITS).cache()


@pytest.fixture(scope="module")
def clean(checked):
    return {r["employee_id"]: r for r in cleaning.finish_employees(checked, LIMITS).collect()}


def test_one_row_per_employee_and_first_copy_wins(clean):
    assert len(clean) == 19
    assert clean["EMP0005"]["email"] == "bo.ray@example.com"


def test_emails_are_derived_and_unique(clean):
    assert clean["EMP0002"]["email"] == "ann.lee.emp0002@example.com"
    assert clean["EMP0003"]["email"] == "ann.lee.emp0003@example.com"
    assert clean["EMP0004"]["email"] == "bo.ray.emp0004@example.com"
    assert clean["EMP0006"]["email"] == "cy.fox@example.com"
    emails = [r["email"] for r in clean.values()]
    assert len(set(emails)) == len(emails) and None not in emails


def test_hire_dates_are_parsed_or_recovered(clean):
    assert clean["EMP0007"]["hire_date"] == dt.date(2018, 3, 4)
    assert clean["EMP0002"]["hire_date"] == dt.date(2020, 5, 1)
    assert [clean[f"EMP{n:04}"]["hire_date"] for n in (8, 9, 17)] == [None] * 3


def test_numbers_are_repaired_by_level(clean):
    assert clean["EMP0010"]["years_experience"] == 2
    assert clean["EMP0011"]["years_experience"] == 9
    assert clean["EMP0012"]["salary"] == 15000.0
    assert clean["EMP0013"]["salary"] == 15000.0
    assert clean["EMP0018"]["salary"] == 1.0
    for r in clean.values():
        if r["level"] in rules.SALARY_BANDS:
            low, high = rules.SALARY_BANDS[r["level"]]
            assert low <= r["salary"] <= high


def test_managers(clean):
    assert clean["EMP0014"]["manager_id"] is None
    assert clean["EMP0015"]["manager_id"] == "EMP0001"


def test_audit_trail(clean):
    flags = {k: r["dq_flags"] for k, r in clean.items() if r["dq_flags"]}
    assert flags == {
        "EMP0002": "email_derived", "EMP0003": "email_derived", "EMP0004": "email_derived",
        "EMP0006": "email_derived",
        "EMP0007": "hire_date_invalid",
        "EMP0008": "hire_date_invalid;active_without_hire_date_REVIEW",
        "EMP0009": "hire_date_invalid",
        "EMP0010": "experience_imputed",
        "EMP0011": "experience_level_mismatch",
        "EMP0012": "salary_corrected", "EMP0013": "salary_corrected",
        "EMP0014": "manager_placeholder_nulled",
        "EMP0015": "manager_inactive_REVIEW",
        "EMP0017": "hire_date_invalid;active_without_hire_date_REVIEW",
    }
    assert clean["EMP0016"]["department"] == "IT"


def test_detections_and_fixes(checked):
    assert dict(rows(cleaning.employee_detections(checked))) == {
        "Missing values": 5, "Invalid date formats": 2, "Implausible dates": 2,
        "Numeric out-of-range": 3, "Logical inconsistencies (salary/experience vs level)": 3,
        "Status conflicts": 3, "Referential issues (manager_id)": 1, "Duplicates": 1,
    }
    fixes = dict(rows(cleaning.employee_fixes(checked)))
    assert len(fixes) == 18
    assert fixes["hire_date recovered from salary history"] == 1
    assert fixes["whitespace trimmed"] == 2
    assert fixes["missing role (unfixable)"] == 1


def test_constant_email_strategy(spark):
    staff = spark.createDataFrame(STAFF, COLUMNS)
    limits = EmployeeRules(as_of=AS_OF, email_strategy="constant")
    fixed = cleaning.clean_employees(staff, None, limits)
    assert fixed.filter("email = 'unknown@example.com'").count() == 4


def test_enrichment_keeps_rows_and_zeroes_missing_amounts(spark):
    t = spark.createDataFrame(
        [("t1", "P1", 5.0, "EMP0001", "2024-02-03"), ("t2", "P9", None, None, "2024-02-04"),
         ("t3", "P1", 1.0, "EMP9999", None)],
        "transaction_id string, project_id string, amount double, approved_by string, d string",
    ).selectExpr("*", "date(d) AS transaction_date").drop("d")
    p = spark.createDataFrame([("P1", "One", "IT"), ("P1", "Two", "HR")],
                              "project_id string, project_name string, department string")
    e = spark.createDataFrame([("EMP0001", "Ann")], "employee_id string, full_name string")
    got = {r["transaction_id"]: r for r in cleaning.enrich_transactions(t, p, e).collect()}
    assert len(got) == 3
    assert (got["t2"]["amount"], got["t2"]["amount_aed"], got["t2"]["is_approved"]) == (
        None, 0.0, False)
    assert got["t1"]["approver_name"] == "Ann" and got["t1"]["transaction_year_month"] == "2024-02"
    assert got["t3"]["is_approved"] and got["t3"]["approver_name"] is None


# --- version dimension -------------------------------------------------------------------------

@pytest.fixture(scope="module")
def dimension(spark):
    master = spark.createDataFrame(
        [("A", "Dev", "Senior", 300.0, "2018-01-01"), ("B", "Ops", "Mid", 50.0, "2019-06-01"),
         ("C", "Ops", "Mid", 60.0, None)],
        "employee_id string, role string, level string, salary double, hired string",
    ).selectExpr("*", "date(hired) AS hire_date").drop("hired")
    for c in ("full_name", "email", "department", "manager_id", "region", "status"):
        master = master.withColumn(c, F.concat(F.lit(f"{c} "), "employee_id"))
    master = master.withColumn("years_experience", F.lit(4))
    log = spark.createDataFrame(
        [("A", "2020-01-01", "Dev", "Junior", 100.0, "Hire", 1),
         ("A", "2021-01-01", "Dev", "Mid", 150.0, "Annual Raise", 2),
         ("A", "2021-01-01", "Dev", "Senior", 200.0, "Promotion", 3),
         ("A", "2022-01-01", "Dev", "Senior", 250.0, "Annual Raise", 4),
         ("Z", "2022-01-01", "Dev", "Senior", 250.0, "Hire", 5)],
        "employee_id string, day string, new_role string, new_level string, new_salary double, "
        "change_type string, row_seq long",
    ).selectExpr("*", "date(day) AS effective_date", "'why' AS change_reason").drop("day")
    return scd2.dim_employee(master, log), log, master


def test_versions(dimension):
    dim, _, _ = dimension
    got = [
        (r["employee_key"], r["employee_id"], r["level"], r["salary"], str(r["valid_from"]),
         str(r["valid_to"]), r["is_current"], r["change_type"])
        for r in dim.orderBy("employee_key").collect()
    ]
    assert got == [
        (1, "A", "Junior", 100.0, "2020-01-01", "2021-01-01", False, "Hire"),
        (2, "A", "Senior", 200.0, "2021-01-01", "2022-01-01", False, "Promotion"),
        (3, "A", "Senior", 300.0, "2022-01-01", "9999-12-31", True, "Annual Raise"),
        (4, "B", "Mid", 50.0, "2019-06-01", "9999-12-31", True, "Initial"),
        (5, "C", "Mid", 60.0, "1900-01-01", "9999-12-31", True, "Initial"),
    ]


def test_sound_dimension_passes_all_checks(dimension):
    dim, log, master = dimension
    known = log.filter("employee_id <> 'Z'")
    assert set(rows(scd2.validation(dim, scd2.collapse_same_day(known), master), "violations")) == {
        (0,)}
    assert tuple(scd2.version_summary(dim).first()) == (5, 3, 3)
    assert rows(scd2.most_versioned(dim), "employee_key") == [(1,), (2,), (3,)]


def test_changes_of_unknown_people_unbalance_the_rows(dimension):
    dim, log, master = dimension
    assert tuple(scd2.row_balance(dim, scd2.collapse_same_day(log), master).first()) == (5, 6)


def test_broken_dimension_is_reported(spark):
    d = dt.date
    dim = spark.createDataFrame(
        [(1, "A", d(2020, 1, 1), d(2021, 1, 1), False), (2, "A", d(2020, 6, 1), d(9999, 12, 31), True),
         (3, "B", d(2020, 1, 1), d(2020, 2, 1), False), (4, "B", d(2020, 3, 1), d(9999, 12, 31), True),
         (5, "C", d(2020, 1, 1), d(9999, 12, 31), True), (6, "C", d(2021, 1, 1), d(9999, 12, 31), True),
         (7, "D", d(2020, 1, 1), d(2021, 1, 1), False)],
        "employee_key int, employee_id string, valid_from date, valid_to date, is_current boolean",
    )
    assert rows(scd2.several_current(dim)) == [("C", 2)]
    assert rows(scd2.no_current(dim)) == [("D",)]
    assert rows(scd2.overlaps(dim), "key_a", "key_b") == [(1, 2), (5, 6)]
    assert rows(scd2.gaps(dim), "employee_id") == [("A",), ("B",), ("D",)]
