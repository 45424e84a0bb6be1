import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dates, numbers, text


def one(spark, column, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(column(F.col("x"))).first()[0]


@pytest.mark.parametrize("raw, expected", [
    ("  in   PROGRESS ", "In Progress"),
    ("on-hold", "On-Hold"),
    ("not\tstarted\n", "Not Started"),
    ("o'brien 3rd", "O'Brien 3Rd"),
    ("", ""),
    (None, None),
])
def test_normalise_label_matches_str_title(spark, raw, expected):
    assert one(spark, text.normalise_label, raw) == expected
    if raw:
        assert expected == " ".join(raw.split()).title()


@pytest.mark.parametrize("raw, expected", [
    ("2021-1-5", dt.date(2021, 1, 5)),
    ("2021-01-05", dt.date(2021, 1, 5)),
    ("2021-02-30", None),
    ("99999-01-01", None),
    ("9999-12-31", None),
    ("-999", None),
    (" 2021-01-05", None),
    ("2021-01-05x", None),
    ("", None),
    (None, None),
])
def test_parse_day(spark, raw, expected):
    assert one(spark, dates.parse_day, raw) == expected


@pytest.mark.parametrize("raw, places, expected", [
    (0.5, 0, 0.0), (1.5, 0, 2.0), (2.5, 0, 2.0), (0.125, 2, 0.12), (-2.5, 0, -2.0),
])
def test_half_even(spark, raw, places, expected):
    assert one(spark, lambda c: numbers.half_even(c, places), raw, "x double") == expected


def test_to_number_is_tolerant(spark):
    df = spark.createDataFrame([("12.5",), ("n/a",), ("",), (None,), ("NaN",)], "x string")
    got = [r[0] for r in df.select(numbers.to_number(F.col("x"))).collect()]
    assert got == [12.5, None, None, None, None]


def test_utilisation_needs_a_positive_budget(spark):
    df = spark.createDataFrame(
        [(50.0, 200.0), (50.0, 0.0), (50.0, -1.0), (None, 10.0), (1.0, None)], "a double, b double"
    )
    got = [r[0] for r in df.select(numbers.utilisation(F.col("a"), F.col("b"))).collect()]
    assert got == [25.0, None, None, None, None]


def test_bands(spark):
    bands = {"Junior": (0, 3), "Lead": (8, 18)}
    df = spark.createDataFrame(
        [("Junior", 3), ("Junior", 4), ("Lead", 7), ("Other", 99), (None, 1), ("Lead", None)],
        "level string, x int",
    )
    got = [r[0] for r in df.select(numbers.off_band(F.col("x"), F.col("level"), bands)).collect()]
    assert got == [False, True, True, False, False, False]


def test_audit_trail_keeps_order_and_skips_unknown(spark):
    df = spark.createDataFrame([(True, None, True)], "a boolean, b boolean, c boolean")
    trail = text.audit_trail({"first": F.col("a"), "second": F.col("b"), "third": F.col("c")})
    assert df.select(trail).first()[0] == "first;third"


@pytest.mark.parametrize("name, mailbox", [
    (" Ann-Marie  Van Poe ", "annmarie.van.poe"), ("José Díaz", "jos.daz"), (None, None),
])
def test_name_to_mailbox(spark, name, mailbox):
    assert one(spark, text.name_to_mailbox, name) == mailbox


def test_hours_use_whole_seconds(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 0, 0, 900000), dt.datetime(2024, 1, 1, 0, 0, 18, 100000))],
        "a timestamp, b timestamp",
    )
    # 18 seconds are exactly half a hundredth of an hour: ties go up
    assert df.select(dates.hours_between(F.col("a"), F.col("b"))).first()[0] == 0.01
