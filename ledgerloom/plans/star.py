"""The star schema around financial transactions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import rules, schemas
from ledgerloom.functions import dates
from ledgerloom.operators.joins import as_of_join
from ledgerloom.operators.sequence import dense_key
from ledgerloom.session import staging_scope

MANAGER_ROLE = "Project Manager"
APPROVER_ROLE = "Approver"


def calendar(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """One row per day."""
    days = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("full_date"))


def dim_date(
    spark: SparkSession, first: dt.date = rules.CALENDAR[0], last: dt.date = rules.CALENDAR[1]
) -> DataFrame:
    day = F.col("full_date")
    return calendar(spark, first, last).select(
        dates.date_key(day).alias("date_key"),
        day,
        F.year(day).cast("short").alias("year"),
        F.quarter(day).cast("short").alias("quarter"),
        F.month(day).cast("short").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        dates.year_month(day).alias("year_month"),
        F.weekofyear(day).cast("short").alias("week"),
        F.dayofmonth(day).cast("short").alias("day"),
        (F.weekday(day) + 1).cast("short").alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    )


def dim_project(projects: DataFrame) -> DataFrame:
    """Current project attributes with a dense key in project id order."""
    columns = {
        "project_id": None, "project_name": None, "department": None, "status": None,
        "status_category": None, "start_date": None, "end_date": None,
        "budget": schemas.MONEY, "actual_cost": schemas.MONEY, "budget_variance": schemas.MONEY,
        "is_over_budget": None, "budget_utilisation_pct": schemas.PERCENT, "risk_level": None,
        "priority": None, "region": None, "project_manager_id": None,
    }
    typed = projects.select(*[
        F.col(c) if kind is None else F.col(c).cast(kind).alias(c) for c, kind in columns.items()
    ])
    return dense_key(typed, "project_key", ["project_id"])


def dim_vendor(transactions: DataFrame) -> DataFrame:
    """Vendors as they occur on transactions."""
    vendors = transactions.select("vendor_id", "vendor_name").distinct()
    return dense_key(vendors, "vendor_key", ["vendor_id", "vendor_name"])


def project_links(projects: DataFrame, transactions: DataFrame) -> DataFrame:
    """Who is linked to which project: its manager, and everybody who approved spend on it."""
    managers = projects.select(
        F.col("project_manager_id").alias("employee_id"),
        "project_id",
        F.lit(MANAGER_ROLE).alias("role_in_project"),
        F.col("start_date").alias("assigned_from"),
        F.col("end_date").alias("assigned_to"),
    )
    approvers = (
        transactions.filter(F.col("approved_by").isNotNull())
        .groupBy(F.col("approved_by").alias("employee_id"), "project_id")
        .agg(
            F.min("transaction_date").alias("assigned_from"),
            F.max("transaction_date").alias("assigned_to"),
        )
        .withColumn("role_in_project", F.lit(APPROVER_ROLE))
    )
    return managers.unionByName(approvers)


def bridge_employee_project(
    projects: DataFrame, transactions: DataFrame, project_dim: DataFrame, employee_dim: DataFrame
) -> DataFrame:
    """Links with the employee version valid when the link began, else the current one."""
    resolved = as_of_join(
        project_links(projects, transactions), employee_dim,
        key="employee_id", day="assigned_from", version_key="employee_id",
        value="employee_key", name="employee_key",
    ).filter(F.col("employee_key").isNotNull())
    keyed = resolved.join(project_dim.select("project_id", "project_key"), "project_id")
    return keyed.select(
        "employee_key", "project_key", "role_in_project", "assigned_from", "assigned_to"
    )


def fact_rows(
    transactions: DataFrame, project_dim: DataFrame, vendor_dim: DataFrame, employee_dim: DataFrame
) -> DataFrame:
    """Enriched transactions with all surrogate keys but their own. The employee's comes last, as its
    join may have to move and write the rows: they have only the columns of facts by then."""
    keyed = transactions.join(
        project_dim.select("project_id", "project_key"), "project_id"
    ).join(vendor_dim.select("vendor_id", "vendor_key"), "vendor_id")
    facts = keyed.select(
        "transaction_id", "project_key", "vendor_key",
        dates.date_key(F.col("transaction_date")).alias("date_key"),
        F.col("amount_aed").cast(schemas.MONEY).alias("amount"),
        F.col("amount").isNull().alias("amount_is_missing"),
        "category", "payment_status", "currency", "invoice_ref", "is_approved",
        "approved_by", "transaction_date",
    )
    approved = as_of_join(
        facts, employee_dim,
        key="approved_by", day="transaction_date", version_key="employee_id",
        value="employee_key", name="employee_key",
    )
    return approved.select(
        "transaction_id", "project_key", "employee_key", "vendor_key", "date_key", "amount",
        "amount_is_missing", "category", "payment_status", "currency", "invoice_ref", "is_approved",
    )


def fact_transactions(
    transactions: DataFrame, project_dim: DataFrame, vendor_dim: DataFrame, employee_dim: DataFrame
) -> DataFrame:
    """Facts with their own dense key, in the order of their ids and then of all their columns, as
    an id may repeat. The split points come from the ids alone; what was written on the way to the
    numbered facts is removed."""
    with staging_scope(transactions.sparkSession) as outside:
        rows = fact_rows(transactions, project_dim, vendor_dim, employee_dim)
        with outside():
            return dense_key(rows, "transaction_key", rows.columns, rows.select("transaction_id"))


def row_counts(
    project_dim: DataFrame, employee_dim: DataFrame, vendor_dim: DataFrame, bridge: DataFrame,
    fact: DataFrame,
) -> DataFrame:
    """One row with the row counts of the whole schema."""
    def rows(df):
        return df.agg(F.count("*")).scalar()

    people = employee_dim.groupBy("employee_id").agg(F.count("*").alias("n"))
    return people.agg(
        F.sum("n").alias("dim_employee_versions"), F.count("*").alias("distinct_employees")
    ).select(
        rows(project_dim).alias("dim_project"),
        "dim_employee_versions",
        "distinct_employees",
        rows(vendor_dim).alias("dim_vendor"),
        rows(bridge).alias("bridge_rows"),
        rows(fact).alias("fact_rows"),
    )
