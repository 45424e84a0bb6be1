import datetime as dt

import pytest
from conftest import rows

from ledgerloom.plans import policy

AS_OF = dt.date(2026, 9, 1)


@pytest.fixture(scope="module")
def staff(spark):
    return spark.createDataFrame(
        [("E1", "Ann Lee", "a1@x.com", dt.date(2015, 1, 1), 10.0, "Lead", "IT", 9, dt.date(2020, 1, 1)),
         ("E2", "Bo Ray", "b2@x.com", dt.date(2016, 1, 1), 20.0, "Mid", "IT", 5, dt.date(2025, 1, 1)),
         ("E3", "Cy Fox", None, dt.date(2017, 1, 1), 30.0, "Mid", "IT", 3, None)],
        "employee_id string, full_name string, email string, hire_date date, salary double, "
        "level string, department string, years_experience int, left_on date",
    )


def test_tags_list_personal_columns(spark, staff):
    tagged = policy.tag_columns(staff, "employees")
    assert policy.personal_columns(tagged) == ["full_name", "email", "hire_date", "salary"]
    table = policy.classification_table(spark)
    assert table.filter("dataset = 'transactions' AND classification = 'PII'").count() == 2


def test_masked_view_keeps_rows_and_hides_persons(staff):
    view = policy.persona_view(staff, "employees", "bi_analyst")
    assert rows(view, "full_name", "email", "hire_date", "salary", "level")[0] == (
        "Xx Xxx", "xn@x.xxx".replace("@x", "@x"), None, None, "Mid"
    )
    assert view.columns == staff.columns and view.count() == 3


def test_personas(staff):
    assert rows(policy.persona_view(staff, "employees", "executive")) == [
        ("IT", "Lead", 1, 9.0), ("IT", "Mid", 2, 4.0)
    ]
    assert policy.persona_view(staff, "employees", "hr").collect() == staff.collect()
    with pytest.raises(policy.AccessDenied):
        policy.persona_view(staff, "employees", "finance")
    for persona in policy.ACCESS:
        if persona != "hr":
            with pytest.raises(policy.AccessDenied):
                policy.persona_view(staff, "employees_salary_history", persona)


def test_pseudonyms_join(staff):
    hashed = staff.select(policy.pseudonym(staff.employee_id, "pepper").alias("h"))
    assert hashed.distinct().count() == 3 and len(hashed.first()["h"]) == 64


def test_retention(spark):
    df = spark.createDataFrame(
        [("a", dt.date(2019, 9, 1)), ("b", dt.date(2019, 9, 2)), ("c", dt.date(2024, 9, 1)),
         ("d", dt.date(2024, 9, 2)), ("e", None)], "id string, transaction_date date",
    )
    split = policy.split_by_retention(df, "transactions", "transaction_date", AS_OF)
    assert rows(split, "id", "retention") == [
        ("a", "delete"), ("b", "archive"), ("c", "archive"), ("d", "keep"), ("e", "keep")
    ]


def test_leavers_are_anonymised_after_the_period(staff):
    got = policy.anonymise_leavers(staff, "left_on", AS_OF)
    assert rows(got, "employee_id", "full_name", "salary", "level", "anonymised") == [
        ("E1", None, None, "Lead", True), ("E2", "Bo Ray", 20.0, "Mid", False),
        ("E3", "Cy Fox", 30.0, "Mid", False),
    ]


def test_salary_bands(spark):
    log = spark.createDataFrame(
        [(4999.0, "Mid", dt.date(2024, 1, 1)), (0.0, "Mid", dt.date(2024, 5, 1)),
         (5000.0, "Mid", dt.date(2024, 5, 1))],
        "new_salary double, new_level string, effective_date date",
    )
    assert rows(policy.salary_bands(log)) == [(0, "Mid", 2024, 2), (5000, "Mid", 2024, 1)]
