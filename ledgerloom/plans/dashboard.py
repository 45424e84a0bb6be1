"""Data sets behind the dashboard, and its slicers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import dates
from ledgerloom.functions.numbers import percent_of
from ledgerloom.operators.grouping import top_n_with_other


def slice_projects(
    projects: DataFrame, region: str | None = None, status: str | None = None
) -> DataFrame:
    """Apply the project slicers before anything is aggregated."""
    if region is not None:
        projects = projects.filter(F.col("region") == region)
    if status is not None:
        projects = projects.filter(F.col("status") == status)
    return projects


def slice_transactions(
    transactions: DataFrame, projects: DataFrame | None = None, year: int | None = None
) -> DataFrame:
    """Keep transactions of the sliced projects and of one year."""
    if year is not None:
        day = F.col("transaction_date")
        transactions = transactions.filter(
            (day >= F.make_date(F.lit(year), F.lit(1), F.lit(1)))
            & (day <= F.make_date(F.lit(year), F.lit(12), F.lit(31)))
        )
    if projects is not None:
        transactions = transactions.join(projects.select("project_id"), "project_id", "left_semi")
    return transactions


def kpi_cards(projects: DataFrame, transactions: DataFrame) -> DataFrame:
    """Totals, share of projects over budget, number of transactions."""
    n = transactions.agg(F.count("*")).scalar()
    totals = projects.agg(
        F.sum("budget").alias("total_budget"),
        F.sum("actual_cost").alias("total_actual"),
        (F.lit(100.0) * F.avg(F.col("is_over_budget").cast("int"))).alias("over_budget_pct"),
    )
    return totals.withColumn("transaction_count", n)


def budget_vs_actual(projects: DataFrame) -> DataFrame:
    """Budget and cost of every department."""
    sums = projects.groupBy("department").agg(
        F.sum("budget").alias("budget"), F.sum("actual_cost").alias("actual")
    )
    return sums.withColumn("pct", percent_of(F.col("actual"), F.col("budget"))).orderBy(
        F.col("pct").desc(), "department"
    )


def trend_of_top_categories(
    transactions: DataFrame, n: int = 5, amount: str = "amount_aed"
) -> DataFrame:
    """Monthly spend of the `n` categories with the highest total."""
    month = dates.year_month(F.col("transaction_date")).alias("ym")
    monthly = transactions.groupBy(month, "category").agg(F.sum(amount).alias("spend"))
    # A category brings its months along (one entry per calendar month), so the transactions are
    # read once and nothing is joined back.
    per_category = monthly.groupBy("category").agg(
        F.sum("spend").alias("_total"), F.collect_list(F.struct("ym", "spend")).alias("_months")
    )
    top = per_category.orderBy(F.col("_total").desc_nulls_last(), "category").limit(n)
    return top.select("category", F.inline("_months")).select("ym", "category", "spend").orderBy(
        "ym", "category"
    )


def top_budget_variance(projects: DataFrame, n: int = 10) -> DataFrame:
    """Projects with the largest overspend; unknown variances are left out."""
    return (
        projects.filter(F.col("budget_variance").isNotNull())
        .select("project_id", "project_name", "department", "budget", "actual_cost",
                "budget_variance")
        .orderBy(F.col("budget_variance").desc(), "project_id")
        .limit(n)
    )


def vendor_split(transactions: DataFrame, n: int = 5, amount: str = "amount_aed") -> DataFrame:
    """Spend of the `n` largest vendors and of all others together."""
    spend = transactions.select("vendor_name", F.col(amount).alias("spend"))
    return top_n_with_other(spend, "vendor_name", "spend", n, "label")
