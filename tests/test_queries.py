"""Every registered query against its SQL statement, over whole tables."""

from functools import partial
from pathlib import Path

import pytest

import __spark_entry__
from ledgerloom.plans import star
from ledgerloom.session import shared_dir, stage
from verification import compare
from verification.oracles import ORACLES as SQL
from verification.registry import QUERIES as ENTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return compare.duck(SF)


def test_every_query_has_its_statement():
    assert set(ENTRY) == set(SQL)
    assert set(ENTRY) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", ENTRY)
def test_query(spark, duck, name):
    assert compare.compare(ENTRY[name](spark, SF), duck, SQL[name]) is None


@pytest.mark.parametrize("name", [
    "transactions_enriched", "employees_clean", "bridge_employee_project", "above_avg_pending",
    "vendor_top5_other", "dq_referential", "had_issue", "level_medians_by_rank",
])
def test_query_without_broadcasts(spark, duck, name):
    """The plans taken when no side is small."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert compare.compare(ENTRY[name](spark, SF), duck, SQL[name]) is None
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _staged_since(spark, earlier=()):
    folder = Path(shared_dir(spark).removeprefix("file://")) / "staged" / spark.sparkContext.applicationId
    return sorted({p for p in folder.iterdir() if list(p.glob("part-*"))} - set(earlier))


def _labels(paths):
    return sorted(p.name.rsplit("-", 1)[0] for p in paths)


def test_facts_keep_only_what_they_are_read_from(spark, duck, monkeypatch):
    """On the path for many versions, as on the other one: rows on the way are removed."""
    monkeypatch.setattr(star, "as_of_join", partial(star.as_of_join, broadcast_rows=0))
    stage(spark.range(1), "probe")
    earlier = _staged_since(spark)
    facts = ENTRY["fact_transactions"](spark, SF)
    assert _labels(_staged_since(spark, earlier)) == [
        "dense-employee_key", "dense-project_key", "dense-transaction_key", "dense-vendor_key"]
    assert compare.compare(facts, duck, SQL["fact_transactions"]) is None


def test_constraints_are_checked_on_the_tables_as_they_were_numbered(spark, duck, monkeypatch):
    """Numbered tables are written already, so no table is copied for the checks."""
    monkeypatch.setattr(star, "as_of_join", partial(star.as_of_join, broadcast_rows=0))
    stage(spark.range(1), "probe")
    earlier = _staged_since(spark)
    found = ENTRY["star_constraints"](spark, SF)
    assert _labels(_staged_since(spark, earlier)) == [
        "dense-employee_key", "dense-project_key", "dense-transaction_key", "dense-vendor_key", "value-counts"]
    assert compare.compare(found, duck, SQL["star_constraints"]) is None


def test_entry(spark):
    result = __spark_entry__.entry(spark)
    assert result.columns == [
        "year_month", "category", "monthly_spend", "running_total", "month_over_month_pct_change"
    ]
    assert result.count() > 0
