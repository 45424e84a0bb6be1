"""The star schema as warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.plans import scd2, star
from ledgerloom.sources.writers import replace_table

TABLES = [
    "dim_date", "dim_project", "dim_employee", "dim_vendor", "bridge_employee_project",
    "fact_transactions",
]


def load(
    spark: SparkSession, database: str, projects: DataFrame, employees: DataFrame,
    history: DataFrame, transactions: DataFrame, sequence: str = "row_seq",
) -> dict[str, DataFrame]:
    """Build all tables in dependency order; re-running replaces them.

    Each table is read back before the next one uses it, so nothing is computed twice and the
    sizes of the dimensions are known to the joins.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def put(name: str, df: DataFrame) -> DataFrame:
        replace_table(df, f"{database}.{name}")
        return spark.table(f"{database}.{name}")

    tables = {"dim_date": put("dim_date", star.dim_date(spark))}
    tables["dim_project"] = put("dim_project", star.dim_project(projects))
    tables["dim_employee"] = put("dim_employee", scd2.dim_employee(employees, history, sequence))
    tables["dim_vendor"] = put("dim_vendor", star.dim_vendor(transactions))
    tables["bridge_employee_project"] = put(
        "bridge_employee_project",
        star.bridge_employee_project(
            projects, transactions, tables["dim_project"], tables["dim_employee"]
        ),
    )
    tables["fact_transactions"] = put(
        "fact_transactions",
        star.fact_transactions(
            transactions, tables["dim_project"], tables["dim_vendor"], tables["dim_employee"]
        ),
    )
    return tables


def fact_view(tables: dict[str, DataFrame]) -> DataFrame:
    """Facts with the natural columns the business questions ask for."""
    return (
        tables["fact_transactions"]
        .join(tables["dim_project"].select("project_key", "project_id"), "project_key")
        .join(tables["dim_vendor"].select("vendor_key", "vendor_name"), "vendor_key")
        .join(
            tables["dim_date"].selectExpr("date_key", "full_date AS transaction_date"), "date_key"
        )
        .withColumnRenamed("amount", "amount_aed")
    )


def drop(spark: SparkSession, database: str) -> None:
    for name in reversed(TABLES):
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
